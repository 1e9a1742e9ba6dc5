"""A package, so that a test file here may have the name of one above; its files import each other by their bare names."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
