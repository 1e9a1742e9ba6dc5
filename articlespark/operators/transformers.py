"""Text cleaning as stages of Spark ML pipelines, which are saved and loaded with them."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx


class TextCleaning(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """One text column in lower case without punctuation; null becomes empty."""

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), tx.lower_no_punct(F.col(self.getInputCol())))


class TextPreprocessor(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Several text columns in lower case without punctuation, joined by ``separator``; nulls become empty."""

    separator = Param(Params._dummy(), "separator", "between the columns", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCol: str | None = None, separator: str = " "):
        super().__init__()
        self._setDefault(separator=" ")
        self._set(**self._input_kwargs)

    def getSeparator(self) -> str:
        return self.getOrDefault(self.separator)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cleaned = [tx.lower_no_punct(F.col(c)) for c in self.getInputCols()]
        return dataset.withColumn(self.getOutputCol(), F.concat_ws(self.getSeparator(), *cleaned))
