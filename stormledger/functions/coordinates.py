from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def signed_degrees(text: Column, positive: str) -> Column:
    """``28.0N`` -> 28.0. Any hemisphere letter but ``positive`` makes it negative."""
    clean = F.trim(text)
    degrees = clean.substr(F.lit(1), F.length(clean) - 1).try_cast("double")
    # 0.0 + turns -0.0 into 0.0
    return F.lit(0.0) + F.when(F.right(clean, F.lit(1)) == positive, degrees).otherwise(-degrees)
