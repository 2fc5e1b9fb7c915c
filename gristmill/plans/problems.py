"""Registered queries of the general training-data operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.operators import drift, fill, footers
from gristmill.sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return fill.fillable(table(spark, d, "procurement_export_batch1"), table(spark, d, "finance_extract"))


def p1_filled(spark: SparkSession, d: str) -> DataFrame:
    return fill.fill_missing(table(spark, d, "procurement_export_batch1"), fill.PROCUREMENT)


def p1_filled_finance(spark: SparkSession, d: str) -> DataFrame:
    return fill.fill_missing(table(spark, d, "finance_extract"), fill.FINANCE)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.changes(table(spark, d, "raw_line"), table(spark, d, "file_registry")).select("file_id", "field_name", "change_kind")


def p2_table(spark: SparkSession, d: str) -> DataFrame:
    return drift.consistent(table(spark, d, "raw_line"), table(spark, d, "file_registry"), table(spark, d, "procurement_export_batch1"), table(spark, d, "procurement_export_batch2"))


def p2_batches(spark: SparkSession, d: str) -> DataFrame:
    """The rows of both batches in one set of columns, the second's registration_no found to be the first's registration_number."""
    old, new = table(spark, d, "procurement_export_batch1"), table(spark, d, "procurement_export_batch2")
    both = drift.from_table(old).withColumn("table_name", F.lit("procurement_export_batch1")).unionByName(drift.from_table(new).withColumn("table_name", F.lit("procurement_export_batch2")))
    return drift.replay(both, drift.aliases(drift.table_changes(old, new, "procurement_export_batch2"))).select("table_name", F.col("line_no").alias("record_id"), "file_id", "entity_key", "employee_count", "region_code", "compliance_flag", "registration_number", "contract_tier", "updated_at", F.col("_rescued").isNotNull().alias("rescued"))


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    feeds = drift.changes(table(spark, d, "raw_line"), table(spark, d, "file_registry"))
    return feeds.unionByName(drift.table_changes(table(spark, d, "procurement_export_batch1"), table(spark, d, "procurement_export_batch2"), "procurement_export_batch2"))


def p2_versions(spark: SparkSession, d: str) -> DataFrame:
    lines, files = table(spark, d, "raw_line"), table(spark, d, "file_registry")
    return drift.version_report(drift.changes(lines, files), drift.files(lines, files), files)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return footers.wrong_and_shifted(spark, d)


def p7_profile(spark: SparkSession, d: str) -> DataFrame:
    return footers.load_profiles(spark, f"{d}/procurement_export_batch1.parquet").select("file_id", "column_name", "rows", "null_rate", "distinct_count", "inferred_type")


def p7_profiles(spark: SparkSession, d: str) -> DataFrame:
    return footers.all_profiles(spark, d)


def p7_columns(spark: SparkSession, d: str) -> DataFrame:
    """As p7_profiles, of every column: the keys record_id and file_id too."""
    return footers.all_profiles(spark, d, ())


def p7_tables(spark: SparkSession, d: str) -> DataFrame:
    return footers.table_profiles(spark, d)


QUERIES = {q.__name__: q for q in (p1_found, p1_filled, p1_filled_finance, p2_found, p2_table, p2_batches, p2_report, p2_versions, p7_found, p7_profile, p7_profiles, p7_columns, p7_tables)}

_WORDS = "('', '-', '--', '?', 'n/a', 'na', '#n/a', 'nan', 'null', 'none', 'nil', 'unknown', 'not provided', 'not available', 'not known', 'missing', 'pending', 'tbd', 'tbc', 'undefined')"


def _cells(table_name: str, column: str, ok: str) -> str:
    return f"SELECT '{table_name}' AS table_name, record_id, entity_key, '{column}' AS field_name, coalesce({ok}, FALSE) AS ok FROM {table_name}"


def _registered(table_name: str) -> str:
    """A registration number that isn't a word and that no crowd of vendors shares, taken from the table itself."""
    v = "lower(trim(registration_number))"
    crowd = f"SELECT {v} FROM {table_name} WHERE registration_number IS NOT NULL GROUP BY 1 HAVING count(DISTINCT entity_key) >= greatest(20, 0.01 * (SELECT count(DISTINCT entity_key) FROM {table_name}))"
    return f"{v} NOT IN {_WORDS} AND {v} NOT IN ({crowd}) AND NOT regexp_full_match(registration_number, 'REG-(X+|0+)')"


def _profile(column: str, kind: str) -> str:
    ok = f"{column} IS NOT NULL" + (f" AND NOT isnan({column})" if column == "region_code" else "")
    return (
        f"SELECT file_id, '{column}' AS column_name, count(*)::BIGINT AS rows, round(sum(CASE WHEN {ok} THEN 0 ELSE 1 END)::DECIMAL(18,0) / count(*), 4)::DECIMAL(5,4) AS null_rate, "
        f"count(DISTINCT CASE WHEN {ok} THEN {column} END)::BIGINT AS distinct_count, '{kind}' AS inferred_type FROM procurement_export_batch1 GROUP BY file_id"
    )


_DAY = "coalesce(try_strptime(updated_at, '%Y-%m-%d'), try_strptime(updated_at, '%Y/%m/%d'), try_strptime(updated_at, '%d.%m.%Y'), try_strptime(updated_at, '%d %b %Y'), try_strptime(updated_at, '%Y-%m-%dT%H:%M:%S'))::date"


def _held(c: str) -> str:
    """The cell as written, null where it only stands for no value."""
    return f"CASE WHEN lower(trim({c}, ' ' || chr(160) || chr(9))) NOT IN {_WORDS} THEN trim({c}, ' ') END"


SQL = {
    "p1_found": "WITH c AS ("
    + " UNION ALL ".join((
        _cells("procurement_export_batch1", "employee_count", "employee_count > 0 AND employee_count < 999999"),
        _cells("procurement_export_batch1", "region_code", "region_code > 0 AND NOT isnan(region_code)"),
        _cells("procurement_export_batch1", "compliance_flag", f"lower(trim(compliance_flag)) NOT IN {_WORDS}"),
        _cells("procurement_export_batch1", "registration_number", _registered("procurement_export_batch1")),
        _cells("finance_extract", "registration_number", _registered("finance_extract")),
    ))
    + ") SELECT table_name, record_id, field_name FROM c WHERE NOT ok AND (table_name, entity_key, field_name) IN (SELECT (table_name, entity_key, field_name) FROM c WHERE ok)",
    "p2_batches": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, record_id, file_id, {_held('entity_key')} AS entity_key, employee_count, {region} AS region_code, {_held('compliance_flag')} AS compliance_flag, {_held(number)} AS registration_number, {tier} AS contract_tier, {_DAY} AS updated_at, "
        f"{_held('updated_at')} IS NOT NULL AND {_DAY} IS NULL AS rescued FROM {t}"
        for t, region, number, tier in (("procurement_export_batch1", "CASE WHEN NOT isnan(region_code) THEN region_code::BIGINT END", "registration_number", "NULL::VARCHAR"), ("procurement_export_batch2", "region_code", "registration_no", _held("contract_tier")))
    ),
    "p7_profile": " UNION ALL ".join(
        _profile(c, "numeric" if c in {"employee_count", "region_code"} else "text")
        for c in ("entity_key", "source_system", "employee_count", "region_code", "compliance_flag", "registration_number", "updated_at")
    ),
}
