from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the model code is the first run of three digits in the model name.
MODEL_CODE_PATTERN = r"\d{3}"


def model_code(model: Column) -> Column:
    """First three-digit run of ``model``; empty text when there is none."""
    return F.regexp_extract(model, MODEL_CODE_PATTERN, 0)
