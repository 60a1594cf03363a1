"""Set operations (SET-3; SET-1 is :func:`pageloom.operators.extract.tagged_anchors`)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.functions.util import col_of


def fallback(primary, secondary) -> Column:
    """SET-3: per row, the primary record array when it is non-empty, else
    the secondary one (decided before the explode)."""
    p, s = col_of(primary), col_of(secondary)
    return F.when(F.size(p) > 0, p).otherwise(s)
