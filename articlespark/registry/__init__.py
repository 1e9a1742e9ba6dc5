"""Every operator as a query over the given tables, next to the SQL it must agree with."""

from .core import QUERIES, SQL
from . import (aggregates, charts, dates, features, joins, lists, locations, measures, modeling,  # noqa: F401
               ngrams, ordering, profile, rows, sources, strings, whole)

__all__ = ["QUERIES", "SQL"]
