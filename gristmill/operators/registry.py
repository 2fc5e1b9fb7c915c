"""Schema registry: versions of a source's columns, with renamed and new ones, in the order in which headers arrive.

What a source knows grows only where a header is seen for the first time: a header that comes again has its unknown columns
explained by the same renames as before. So the fold runs over the different headers of a source, and its files, however
many, are only compared with what was known at their time.
"""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import MapType, StringType

from gristmill import params

STATE = "source string, version long, columns array<string>"


@F.pandas_udf(MapType(StringType(), StringType()))
def near_names(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """For each name of the first array the most similar one of the second, from RENAME_CUTOFF on."""
    for olds, names in batches:
        found = [{str(o): near[0] for o in old if (near := difflib.get_close_matches(o, list(map(str, new)), 1, params.RENAME_CUTOFF))} for old, new in zip(olds, names)]
        yield pd.Series(found, dtype=object)


def drift(known: Column, columns: Column, near: Column) -> tuple[Column, Column]:
    """(renamed, added): pairs {new, old} of known names that are gone and stand under another, the last of equals counting, and names neither known nor such."""
    pairs = F.filter(F.transform(F.array_except(known, columns), lambda o: F.struct(F.try_element_at(near, o).alias("new"), o.alias("old"))), lambda p: p["new"].isNotNull())
    names = F.transform(pairs, lambda p: p["new"])
    renamed = F.transform(F.array_sort(F.array_distinct(names)), lambda n: F.element_at(F.filter(pairs, lambda p: p["new"] == n), -1))
    return renamed, F.array_except(F.array_except(columns, known), names)


def versions(headers: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """source, file_id, seq, version, renamed (new=old, comma-separated), added, columns (known after the file). headers: source, seq, file_id, columns (array).

    A source's first sighting is version 1; each file with a renamed or new column is one version more. Columns that only
    disappear are no drift. `state` (source, version, columns) is what earlier runs knew.
    """
    held = headers.sparkSession.createDataFrame([], STATE) if state is None else state
    held = held.select("source", F.col("version").alias("__v"), F.col("columns").alias("__known"))
    kinds = headers.groupBy("source", "columns").agg(F.min("seq").alias("first"))
    names = headers.select("source", F.explode("columns").alias("c")).unionByName(held.select("source", F.explode("__known").alias("c"))).groupBy("source").agg(F.collect_set("c").alias("names"))
    kinds = kinds.join(names, "source").select("source", "columns", "first", near_names(F.array_except("names", "columns"), F.col("columns")).alias("near"))
    per_source = kinds.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("first", "columns", F.map_entries("near").alias("near")))).alias("kinds")).join(held, "source", "left")

    def step(so_far: Column, kind: Column) -> Column:
        known = F.element_at(so_far, -1)["known"]
        _, added = drift(known, kind["columns"], F.map_from_entries(kind["near"]))
        return F.concat(so_far, F.array(F.struct(kind["first"].alias("at"), F.array_union(known, added).alias("known"))))

    start = F.array(F.struct(F.lit(None).cast("string").alias("at"), F.coalesce("__known", F.array().cast("array<string>")).alias("known")))
    line = per_source.select("source", "__v", F.aggregate("kinds", start, step).alias("line"))
    rows = headers.join(line, "source").join(kinds.select("source", "columns", "near"), ["source", "columns"])
    rows = rows.withColumn("known", F.element_at(F.filter("line", lambda x: x["at"].isNull() | (x["at"] < F.col("seq"))), -1)["known"])
    renamed, added = drift(F.col("known"), F.col("columns"), F.col("near"))
    rows = rows.select("source", "file_id", "seq", "__v", "known", renamed.alias("r"), added.alias("a"))
    first = (F.col("n") == 1) & F.col("__v").isNull()
    changed = F.when(first | (F.size("r") + F.size("a") > 0), 1).otherwise(0)
    in_order = W.partitionBy("source").orderBy("seq", "file_id")  # numbers of files, a few bytes each, streamed in order
    rows = rows.withColumn("n", F.row_number().over(in_order)).withColumn("version", (F.coalesce("__v", F.lit(0)) + F.sum(changed).over(in_order.rowsBetween(W.unboundedPreceding, W.currentRow))).cast("bigint"))
    shown = F.array_join(F.transform("r", lambda p: F.concat_ws("=", p["new"], p["old"])), ",")
    return rows.select("source", "file_id", "seq", "version", F.when(first, "").otherwise(shown).alias("renamed"), F.when(first, "").otherwise(F.array_join("a", ",")).alias("added"), F.array_union("known", "a").alias("columns"))


def load(spark: SparkSession, folder: str) -> DataFrame:
    """source, version, columns: the newest version of each source that the store at `folder` holds."""
    rows = spark.read.schema(STATE).parquet(f"{folder}/schema_registry")
    return rows.groupBy("source").agg(F.max("version").alias("version"), F.max_by("columns", "version").alias("columns"))


def save(found: DataFrame, folder: str) -> None:
    """Appends each source's newest version of what `versions` found to the store; versions are never rewritten."""
    found.groupBy("source").agg(F.max("version").alias("version"), F.max_by("columns", F.struct("version", "seq", "file_id")).alias("columns")).write.mode("append").parquet(f"{folder}/schema_registry")
