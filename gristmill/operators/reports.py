"""Reports: usage by model with a grand total, accuracy with precision and recall."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usage(calls: DataFrame, model: str, tokens: str, latency: str) -> DataFrame:
    """model (TOTAL for the last), calls, tokens, avg_latency: nulls count as 0 and in the number of calls. Rates are the caller's."""
    return calls.rollup(model).agg(
        F.grouping(model).alias("g"), F.count("*").alias("calls"), F.sum(F.coalesce(F.col(tokens), F.lit(0))).alias("tokens"), (F.sum(F.coalesce(F.col(latency), F.lit(0))) / F.count("*")).alias("avg_latency")
    ).select(F.when(F.col("g") == 1, "TOTAL").otherwise(F.col(model)).alias("model"), "calls", "tokens", F.round("avg_latency", 6).alias("avg_latency"))


def quality_lines(counts: DataFrame) -> DataFrame:
    """extraction_method, line: `   method:     n  (12.3%)` of each method's count n, its share of all with one decimal."""
    total = counts.agg(F.sum("n").alias("all"))  # one row
    return counts.crossJoin(F.broadcast(total)).select("extraction_method", F.format_string("%14s: %5d  (%.1f%%)", "extraction_method", "n", F.col("n") * 100.0 / F.col("all")).alias("line"))


def evaluation(pairs: DataFrame) -> DataFrame:
    """class, tp, fp, fn, precision, recall, accuracy of (expected, predicted) pairs: classes are those that occur on either side; no denominator gives null."""
    n = pairs.groupBy("expected", "predicted").agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("all"), F.sum(F.when(F.col("expected") == F.col("predicted"), F.col("n")).otherwise(0)).alias("right"))
    sides = n.select(F.inline(F.array(
        F.struct(F.col("expected").alias("class"), F.when(F.col("expected") == F.col("predicted"), F.col("n")).otherwise(0).alias("tp"), F.lit(0).cast("bigint").alias("fp"), F.when(F.col("expected") != F.col("predicted"), F.col("n")).otherwise(0).alias("fn")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("tp"), F.when(F.col("expected") != F.col("predicted"), F.col("n")).otherwise(0).alias("fp"), F.lit(0).cast("bigint").alias("fn")),
    )))
    per = sides.groupBy("class").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    return per.crossJoin(F.broadcast(total)).select(  # total is one row
        "class", "tp", "fp", "fn", F.round(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), 6).alias("precision"), F.round(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), 6).alias("recall"), F.round(F.try_divide(F.col("right"), F.col("all")), 6).alias("accuracy")
    )
