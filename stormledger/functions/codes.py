from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def label(code: Column, table: dict[str, str]) -> Column:
    """Label of a trimmed code; NULL for a code that ``table`` does not hold.

    For code tables of a few dozen entries: the map is a literal inside the
    expression, so no join and no shuffle.
    """
    pairs = F.create_map(*(F.lit(x) for x in chain.from_iterable(table.items())))
    return F.try_element_at(pairs, F.trim(code))
