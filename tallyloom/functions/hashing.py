"""Keyed hashes that stand in for random draws, so a draw never depends on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 32


def keyed_hash(key: Column, seed: int) -> Column:
    """Uniform whole number in [0, 2^32), fixed by the key and the seed."""
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
