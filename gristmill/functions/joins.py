"""Joins that hold when one key has a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.sources.tables import cut

#: A key is hot if it has at least this share of the rows: there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.01


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """The keys that have at least `share` of the rows each, so at most 1 / share keys; null is none. One pass over the rows."""
    counts = cut(df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return [r[0] for r in counts.where(F.col("n") >= max(1000, share * total)).collect()]


def split_join(big: DataFrame, small: DataFrame, key: str, how: str = "left", share: float = HOT_SHARE) -> DataFrame:
    """big JOIN small on `key`, where small has one row a key: rows of hot keys meet their few rows by broadcast, all others by shuffle."""
    hot = hot_keys(big, key, share)
    if not hot:
        return big.join(small, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    return big.where(is_hot).join(F.broadcast(small.where(F.col(key).isin(hot))), key, how).unionByName(big.where(~is_hot).join(small, key, how))
