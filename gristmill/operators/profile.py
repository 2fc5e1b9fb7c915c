"""Column profiles, identifier test, crosstabs: one pass over the rows each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill import params

NUMBERS = {"tinyint", "smallint", "int", "bigint", "float", "double", "boolean"}


def column_profile(df: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    """column_name, inferred_type, null_rate to four places, distinct_count (nulls apart), identifier_like of each column, in one aggregation.

    An empty table has null rates of null and is not identifier-like. Booleans are numeric.
    """
    types, cols = dict(df.dtypes), columns or tuple(df.columns)
    aggs = [F.count("*").alias("n")] + [a for i, c in enumerate(cols) for a in (F.count(c).alias(f"c{i}"), F.count_distinct(F.col(c)).alias(f"d{i}"))]
    rows = [
        F.struct(
            F.lit(c).alias("column_name"), F.lit("numeric" if types[c] in NUMBERS or types[c].startswith("decimal") else "text").alias("inferred_type"),
            F.round(1 - F.try_divide(F.col(f"c{i}").cast("double"), F.col("n")), 4).alias("null_rate"), F.col(f"d{i}").alias("distinct_count"),
            F.coalesce(F.try_divide(F.col(f"d{i}"), F.col(f"c{i}")) > params.ID_RATIO, F.lit(False)).alias("identifier_like"),
        ) for i, c in enumerate(cols)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def null_crosstab(df: DataFrame, target: str, other: str) -> DataFrame:
    """category, n_null, n_present of `target` by category of `other`; null is the category __NA__."""
    return df.groupBy(F.coalesce(F.col(other).cast("string"), F.lit("__NA__")).alias("category")).agg(F.count_if(F.col(target).isNull()).alias("n_null"), F.count(target).alias("n_present"))
