"""The project's tables as the engine reads them: null tokens are null, NaN too, and rows have a stable number."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill import params
from gristmill.sources.tables import table

#: Sources in the order of their names, which decides precedence; data columns in order.
SOURCES = {
    "finance_extract": ("region_code", "registration_number"),
    "procurement_export_batch1": ("employee_count", "region_code", "compliance_flag", "registration_number"),
    "procurement_export_batch2": ("employee_count", "region_code", "compliance_flag", "registration_no", "contract_tier"),
}
NUMERIC = ("employee_count", "region_code")


def nulled(df: DataFrame) -> DataFrame:
    """Text cells that are null tokens, and NaN, become null; all columns stay."""
    types = dict(df.dtypes)
    return df.withColumns(
        {c: F.when(~F.col(c).isin(*params.NULL_TOKENS), F.col(c)) if types[c] == "string" else F.when(~F.isnan(c), F.col(c)) for c in df.columns if types[c] in {"string", "double", "float"}}
    )


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return nulled(table(spark, folder, name))
