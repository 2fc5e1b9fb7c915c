"""Resolving missing values: impute, backfill across sources, observations with their method and confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill import params
from gristmill.functions.joins import split_join
from gristmill.functions.values import date_of
from gristmill.operators.profile import NUMBERS


def as_text(df: DataFrame, c: str) -> Column:
    """A value as text; a double has a point, and no exponent below 1e15."""
    if dict(df.dtypes)[c] in {"double", "float"}:
        v = F.col(c)
        return F.when((v == F.floor(v)) & (F.abs(v) < 1e15), F.concat(v.cast("bigint").cast("string"), F.lit(".0"))).otherwise(v.cast("string"))
    return F.col(c).cast("string")


def fill_values(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """column_name, fill_value: the mean of numbers, the smallest of the most frequent texts, `unknown` for texts without any value. One row a column."""
    types = dict(df.dtypes)
    aggs = [F.avg(F.col(c).cast("double")).cast("string").alias(c) if types[c] in NUMBERS else F.coalesce(F.mode(c, True), F.lit("unknown")).alias(c) for c in columns]
    return df.agg(*aggs).select(F.inline(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("fill_value")) for c in columns))))


def candidates(df: DataFrame, column: str, seq: int, key: str = params.KEY, time: str = params.TIME) -> DataFrame:
    """key, seq, newest: per key the newest value that a source has. One row a key, so a hot key costs nothing later."""
    day = date_of(F.col(time))
    rows = df.where(F.col(key).isNotNull() & F.col(column).isNotNull()).select(F.col(key).alias("key"), as_text(df, column).alias("value"), day.alias("day"))
    return rows.groupBy("key").agg(F.max(F.struct(F.col("day").isNotNull().alias("dated"), "day", "value")).alias("newest")).withColumn("seq", F.lit(seq))


def backfill(df: DataFrame, column: str, others: list[DataFrame], row: str = "record_id", key: str = params.KEY, time: str = params.TIME) -> DataFrame:
    """row, value of each row whose `column` is missing: of the first other source whose newest value for the key is fresher
    than the row, or any if the row has no date; null if no source has one.

    If any value of a source is fresher, its newest is, so one row a key suffices. Sources without the key or column are
    skipped; without a key column nothing is filled. Equal dates go to the larger value.
    """
    if key not in df.columns:
        return df.where(F.col(column).isNull()).select(F.col(row).alias("row"), F.lit(None).cast("string").alias("value"))
    found = [candidates(o, column, i) for i, o in enumerate(others) if column in o.columns and key in o.columns]
    rows = df.where(F.col(column).isNull()).select(F.col(row).alias("row"), F.col(key).alias("key"), date_of(F.col(time)).alias("own"))
    if not found:
        return rows.select("row", F.lit(None).cast("string").alias("value"))
    union = found[0]
    for f in found[1:]:
        union = union.unionByName(f)
    per_key = union.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("seq", "newest"))).alias("by_source"))  # at most one entry a source
    fresh = F.filter("by_source", lambda s: F.col("own").isNull() | (s["newest"]["day"] > F.col("own")))
    return split_join(rows, per_key, "key").select("row", F.get(fresh, F.lit(0))["newest"]["value"].alias("value"))


def observations(df: DataFrame, name: str, columns: tuple[str, ...], classes: dict[str, str], others: list[DataFrame], row: str = "record_id", key: str = params.KEY) -> DataFrame:
    """source, row, entity_key, field_name, value, confidence, extraction_method, reason: a row for each record and data column."""
    types = dict(df.dtypes)
    impute = tuple(c for c in columns if classes.get(c) == "MCAR")
    wide = df
    if impute:
        fills = fill_values(df, impute).groupBy().pivot("column_name", list(impute)).agg(F.first("fill_value"))
        wide = wide.crossJoin(F.broadcast(fills.select(*(F.col(c).alias(f"__fill_{c}") for c in impute))))  # one row
    for c in columns:
        if classes.get(c) == "MAR":
            filled = backfill(df, c, others, row).select(F.col("row").alias(row), F.col("value").alias(f"__fill_{c}"))
            wide = wide.join(filled, row, "left")
    cells = []
    for c in columns:
        own, cls = as_text(df, c), classes.get(c, "NONE")
        fill = F.col(f"__fill_{c}") if f"__fill_{c}" in wide.columns else F.lit(None).cast("string")
        method = F.when(own.isNotNull(), "direct").when(fill.isNotNull(), "imputed" if cls == "MCAR" else "backfilled").otherwise("human_review")
        reason = F.when(method == "human_review", "mnar_suspected" if cls == "MNAR" else "unresolved_backfill")
        cells.append(F.struct(F.lit(c).alias("field_name"), F.coalesce(own, fill).alias("value"), method.alias("extraction_method"), reason.alias("reason")))
    assert types
    out = wide.select(F.lit(name).alias("source"), F.col(row).alias("row"), F.col(key), F.inline(F.array(*cells)))
    confidence = F.create_map(*(F.lit(x) for kv in params.CONFIDENCE.items() for x in kv))[F.col("extraction_method")]
    return out.select("source", "row", key, "field_name", "value", confidence.alias("confidence"), "extraction_method", "reason")


def method_counts(obs: DataFrame) -> DataFrame:
    """extraction_method, n, share to four places; of no rows there are none."""
    n = obs.groupBy("extraction_method").agg(F.count("*").alias("n"))
    return n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("total")))).select("extraction_method", "n", F.round(F.col("n") / F.col("total"), 4).alias("share"))  # one row
