"""Bounded deterministic samples for fitting models on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RANGE = 1 << 40


def lowest_hash(df: DataFrame, key: Column, most: int) -> DataFrame:
    """At most ``most`` rows of ``df``: those of the lowest hash of ``key``, in its order (column ``__h``).

    Tasks of a plain sorted limit each send ``most`` rows to the driver. So the rows are counted first
    (from the files' footers) and only hashes below a threshold that leaves about three times
    ``most`` rows are sorted.
    """
    share = min(1.0, (3 * most + 1000) / max(1, df.count()))
    hashed = df.withColumn("__h", F.pmod(F.xxhash64(key), F.lit(_RANGE)))
    return hashed.where(F.col("__h") < F.lit(int(share * _RANGE))).orderBy("__h").limit(most)
