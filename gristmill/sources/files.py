"""Reading files: listing in order of path, checksums, delimited files with headers of their own, pages of documents."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from gristmill.sources.registered import nulled
from gristmill.sources.tables import spread


def listing(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """path, length, checksum, file_seq of a folder's own files, ordered by path. file_seq is a sort over file names, not over rows."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return found.select("path", "length", F.sha2("content", 256).alias("checksum")).withColumn("file_seq", F.row_number().over(W.orderBy("path")))


def headers(spark: SparkSession, paths: list[str]) -> list[tuple[str, tuple[str, ...]]]:
    """(path, column names) of each file, read by tasks that open a file for its first line only."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import csv

        import pyarrow.fs as fs

        for pdf in batches:
            rows = []
            for path in pdf["path"]:
                system, place = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), re.sub(r"^file:/*", "/", path))
                line = b""
                with system.open_input_stream(place) as f:
                    while b"\n" not in line and (more := f.read(8192)):
                        line += more
                names = next(csv.reader([line.split(b"\n")[0].decode("utf-8-sig").rstrip("\r")]), [])
                rows.append((path, names))
            yield pd.DataFrame(rows, columns=["path", "names"])

    found = spread(spark.createDataFrame([(p,) for p in paths], "path string"), "path").mapInPandas(run, "path string, names array<string>")
    return [(r.path, tuple(r.names)) for r in found.collect()]  # a row a file


def delimited(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All files as one table by column name, strings with nulls; files of one header are read together. Adds source_path."""
    by_header: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for path, names in sorted(headers(spark, sorted(paths))):
        by_header[names].append(path)
    out = None
    for names, group in by_header.items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        part = nulled(spark.read.option("header", True).schema(schema).csv(group)).withColumn("source_path", F.col("_metadata.file_path"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no files")
    return out


def typed(df: DataFrame, skip: tuple[str, ...] = ("source_path",)) -> DataFrame:
    """Text columns in the type that all their values have, found in one pass: bigint (double beside nulls), double, boolean (without nulls), else string.

    A column without any value is double. Values that aren't numbers leave the whole column text.
    """
    columns = [c for c, t in df.dtypes if t == "string" and c not in skip]
    if not columns:
        return df
    counts = [F.count("*").alias("n")] + [x for i, c in enumerate(columns) for x in (
        F.count(c).alias(f"n{i}"), F.count(F.col(c).try_cast("bigint")).alias(f"w{i}"), F.count(F.col(c).try_cast("double")).alias(f"d{i}"), F.count_if(F.lower(c).isin("true", "false")).alias(f"b{i}"))]
    r, new = df.agg(*counts).first(), {}
    for i, c in enumerate(columns):
        n, full = r[f"n{i}"], r[f"n{i}"] == r["n"]
        kind = "double" if not n else "boolean" if r[f"b{i}"] == n and full else "string" if r[f"d{i}"] != n else "bigint" if r[f"w{i}"] == n and full else "double"
        if kind != "string":
            new[c] = F.col(c).try_cast(kind)
    return df.withColumns(new)


def new_files(files: DataFrame, known: DataFrame | None = None, order: tuple[str, ...] = ("file_seq",)) -> DataFrame:
    """Files whose checksum is neither in `known` nor that of an earlier file: ingest of the same content again does nothing. Null checksums are all kept."""
    first = W.partitionBy("checksum").orderBy(*order)
    kept = files.withColumn("__n", F.when(F.col("checksum").isNull(), 1).otherwise(F.row_number().over(first))).where("__n = 1").drop("__n")
    return kept if known is None else kept.join(known.select("checksum").distinct(), "checksum", "left_anti")


def assembled(pages: DataFrame, doc: str, page: str, text: str, order: tuple[str, ...] = (), confidence: Column | None = None) -> DataFrame:
    """doc, text (pages joined by blank lines in their order), mean_confidence to three places, n_pages. Null texts count as empty pages."""
    rows = F.array_sort(F.collect_list(F.struct(page, *order, F.coalesce(F.col(text), F.lit("")).alias("t"))))
    return pages.groupBy(doc).agg(
        F.array_join(F.transform(rows, lambda r: r["t"]), "\n\n").alias("text"), F.round(F.avg(confidence if confidence is not None else F.lit(1.0)), 3).alias("mean_confidence"), F.count("*").alias("n_pages")
    )
