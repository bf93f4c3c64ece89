"""Change streams folded to current rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key. Combined before the shuffle, so repeated keys are cheap."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*df.columns)
    )
