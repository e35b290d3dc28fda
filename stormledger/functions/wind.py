from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import WIND_SCALE


def wind_category(wind: Column, status: Column, scale=WIND_SCALE) -> Column:
    """Category of an integer wind: one CASE, strongest band first.

    Each band but the open top one also takes the first wind above it, and the
    stronger band wins a wind that two bands claim. Below the scale the storm's
    status is its category; a missing wind is ``uncategorized``.
    """
    top = scale[-1]
    ladder = F.when(wind >= top[1], F.lit(top[0]))
    for name, low, high, *_ in reversed(scale[:-1]):
        ladder = ladder.when(wind.between(low, high + 1), F.lit(name))
    return ladder.when(wind < scale[0][1], status).otherwise(F.lit("uncategorized"))
