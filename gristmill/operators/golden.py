"""Golden records: keys one wrong character apart are one entity, led by the key that came first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.sources.tables import cut


def near_keys(keys: DataFrame, key: str = "key") -> DataFrame:
    """a, b: ordered pairs of different keys with an edit distance of one.

    Keys within one edit share the key itself or a form with one character deleted, so they meet in an equi-join on those.
    """
    forms = keys.select(F.col(key).alias("k"), F.explode(F.array_distinct(F.concat(F.array(key), F.transform(F.sequence(F.lit(1), F.greatest(F.length(key), F.lit(1))), lambda i: F.concat(F.substring(key, F.lit(1), i - 1), F.substring(F.col(key), i + 1, F.length(key))))))).alias("form"))
    met = forms.select("form", F.col("k").alias("a")).join(forms.select("form", F.col("k").alias("b")), "form").where("a <> b").select("a", "b").distinct()
    return met.where(F.levenshtein("a", "b", 1) >= 0)


def leaders(keys: DataFrame) -> DataFrame:
    """key, canonical: greedy leaders in order of `first`. keys: key, first (both unique).

    A key follows the earliest leader within one edit, else it leads. That is the first maximal independent set of the
    graph of near keys: each round, keys without an undecided or leading earlier neighbour lead, and keys with an earlier
    leading neighbour follow, until none is undecided. Rounds are as many as the longest chain of near keys.
    """
    keys = cut(keys)
    edges = near_keys(keys.select("key"))
    first = keys.select(F.col("key").alias("k"), F.col("first").alias("f"))
    earlier = edges.join(first, F.col("a") == F.col("k")).withColumnRenamed("f", "fa").drop("k").join(first, F.col("b") == F.col("k")).where("f < fa").select("a", "b", F.col("f").alias("fb"))
    earlier = cut(earlier)
    state = cut(keys.join(earlier.select(F.col("a").alias("key")).distinct(), "key", "left_anti").select("key", F.lit(True).alias("leads")))
    todo = cut(keys.join(state, "key", "left_anti").select("key"))
    while not todo.isEmpty():
        seen = earlier.join(todo, earlier.a == todo.key).join(state.select(F.col("key").alias("s"), "leads"), F.col("b") == F.col("s"), "left")
        judged = seen.groupBy("key").agg(F.bool_or(F.coalesce("leads", F.lit(False))).alias("follows"), F.bool_or(F.col("leads").isNull()).alias("waits"))
        new = cut(judged.where("follows or not waits").select("key", (~F.col("follows")).alias("leads")))
        state, todo = cut(state.unionByName(new)), cut(todo.join(new, "key", "left_anti"))
    followers = earlier.join(state.where("leads").select(F.col("key").alias("b")), "b").groupBy(F.col("a").alias("key")).agg(F.min_by("b", "fb").alias("leader"))
    return state.join(followers, "key", "left").select("key", F.when(F.col("leads"), F.col("key")).otherwise(F.col("leader")).alias("canonical"))


def golden_fields(obs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """canonical, field_name, value, confidence, extraction_method, reason, the columns of `carry`, merged_keys. obs: key, field_name, value, confidence, extraction_method, reason, seq and `carry`.

    The most confident observation wins, of equals the earliest. Rows without a key are left out. Observations are kept
    between finding the keys' leaders and merging, so that they are made once.
    """
    rows = cut(obs.where("key is not null"))
    map_ = leaders(rows.groupBy("key").agg(F.min("seq").alias("first")))
    best = rows.join(map_, "key").groupBy("canonical", "field_name").agg(
        F.min_by(F.struct("value", "confidence", "extraction_method", "reason", *carry), F.struct(-F.col("confidence"), "seq")).alias("b"), F.array_sort(F.collect_set("key")).alias("merged_keys")
    )
    return best.select("canonical", "field_name", "b.*", "merged_keys")
