"""Registered queries of the text operators, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill import params
from gristmill.llm import chunks, leaks, pii, scans, survivors, tokens, truncation
from gristmill.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return survivors.survivors(table(spark, d, "extracted_field"), table(spark, d, "procurement_export_batch1"))


def p3_current(spark: SparkSession, d: str) -> DataFrame:
    return survivors.current(table(spark, d, "extracted_field"), table(spark, d, "procurement_export_batch1"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return chunks.oversized_ids(table(spark, d, "section_chunk"))


def p4_pieces(spark: SparkSession, d: str) -> DataFrame:
    return chunks.split_oversized(table(spark, d, "section_chunk"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.details(table(spark, d, "section_chunk"))


def p5_redacted(spark: SparkSession, d: str) -> DataFrame:
    return pii.redact(table(spark, d, "section_chunk"), params.setting(spark, "pii_key", "key of the registered query").encode())


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return scans.traces(table(spark, d, "section_chunk"))


def p6_repaired(spark: SparkSession, d: str) -> DataFrame:
    done = scans.repair(table(spark, d, "section_chunk"), whole="full_section_text", page="page_number")
    return done.select("id", "repaired_text", "traces", "repaired_full_section_text", "full_section_text_traces")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", "ids")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaked(table(spark, d, "documents"), table(spark, d, "benchmark"))


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    found = leaks.stretches(leaks.leaks(table(spark, d, "documents"), table(spark, d, "benchmark")))
    return found.groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_documents"), F.round(F.max("share"), 4).alias("most_covered"))


def p9_covered(spark: SparkSession, d: str) -> DataFrame:
    """Items of which documents cover most, also where passages stand in another order or between other text."""
    found = leaks.covered(leaks.leaks(table(spark, d, "documents"), table(spark, d, "benchmark")))
    return found.select("doc_id", "item_id", F.round("share", 4).alias("share"), "covered", "span").distinct()


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncated(table(spark, d, "documents"))


def p10_report(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncation_report(table(spark, d, "documents"))


QUERIES: dict[str, Query] = {
    q.__name__: q for q in (p3_found, p3_current, p4_found, p4_pieces, p5_found, p5_redacted, p6_found, p6_repaired, p8_ids, p9_found, p9_report, p9_covered, p10_found, p10_report)
}

_NO_VALUE = "('','-','--','?','n/a','na','#n/a','nan','null','none','nil','unknown','not provided','not available','not known','missing','pending','tbd','tbc','undefined')"
_NO_NUMBER = "(-1,0,-999,-9999,999999,9999999)"
_SPELLED = "lower(regexp_replace({c}, '^[\\s\\x{{A0}}]+|[\\s\\x{{A0}}]+$', '', 'g'))"

SQL: dict[str, str] = {
    "p3_found": rf"""
WITH rows AS (
  SELECT id, field_name, value, confidence, extracted_at, upper(regexp_replace(entity_key, '[^\p{{L}}\p{{N}}]', '', 'g')) AS k FROM extracted_field WHERE entity_key IS NOT NULL AND field_name IS NOT NULL
), counted AS (SELECT k, count(*) AS n FROM (SELECT upper(regexp_replace(entity_key, '[^\p{{L}}\p{{N}}]', '', 'g')) AS k FROM extracted_field WHERE entity_key IS NOT NULL) GROUP BY k),
masks AS (SELECT k, n, left(k, i - 1) || '*' || substr(k, i + 1) AS mask FROM counted, unnest(range(1, length(k) + 1)) AS r(i) WHERE length(k) > 1),
best AS (SELECT mask, max({{'n': n, 'k': k}}) AS b FROM masks GROUP BY mask),
near AS (SELECT m.k, m.n, max(b.b) AS b FROM masks m JOIN best b ON m.mask = b.mask GROUP BY m.k, m.n),
step AS (SELECT k, CASE WHEN b.n >= 3 * n OR n <= 2 THEN b.k ELSE k END AS vendor FROM near),
vendors AS (SELECT s.k, coalesce(t.vendor, s.vendor) AS vendor FROM step s LEFT JOIN step t ON s.vendor = t.k),
ranked AS (
  SELECT r.id, count(*) OVER g AS n, row_number() OVER (PARTITION BY coalesce(v.vendor, r.k), field_name ORDER BY
    CASE WHEN coalesce({_SPELLED.format(c='value')} NOT IN {_NO_VALUE} AND NOT (field_name = 'registration_number' AND regexp_full_match(value, 'REG-(X+|0+)')) OR (field_name = 'liability_cap_status' AND {_SPELLED.format(c='value')} = 'unknown'), FALSE) THEN 0 ELSE 1 END,
    coalesce(confidence, -1) DESC, extracted_at DESC NULLS LAST, id) AS rn
  FROM rows r LEFT JOIN vendors v ON r.k = v.k WINDOW g AS (PARTITION BY coalesce(v.vendor, r.k), field_name)
), crowd AS (
  SELECT {_SPELLED.format(c='registration_number')} AS v FROM procurement_export_batch1 WHERE registration_number IS NOT NULL GROUP BY 1 HAVING count(DISTINCT entity_key) >= greatest(20, 0.01 * (SELECT count(DISTINCT entity_key) FROM procurement_export_batch1))
), batch AS (
  SELECT record_id, count(*) OVER (PARTITION BY file_id, entity_key) AS n, row_number() OVER (PARTITION BY file_id, entity_key ORDER BY
    coalesce((employee_count NOT IN {_NO_NUMBER})::int, 0) + coalesce((NOT isnan(region_code) AND region_code NOT IN {_NO_NUMBER})::int, 0)
    + coalesce(({_SPELLED.format(c='compliance_flag')} NOT IN {_NO_VALUE})::int, 0) + coalesce(({_SPELLED.format(c='registration_number')} NOT IN {_NO_VALUE} AND {_SPELLED.format(c='registration_number')} NOT IN (SELECT v FROM crowd) AND NOT regexp_full_match(registration_number, 'REG-(X+|0+)'))::int, 0) DESC,
    coalesce(try_strptime(updated_at, '%Y-%m-%d'), try_strptime(updated_at, '%Y/%m/%d'), try_strptime(updated_at, '%d.%m.%Y'), try_strptime(updated_at, '%d %b %Y'), try_strptime(updated_at, '%Y-%m-%dT%H:%M:%S'))::date DESC NULLS LAST, record_id) AS rn
  FROM procurement_export_batch1 WHERE file_id IS NOT NULL AND entity_key IS NOT NULL
)
SELECT 'extracted_field' AS table_name, id AS row_key FROM ranked WHERE n >= 2 AND rn = 1
UNION ALL SELECT 'procurement_export_batch1', record_id::varchar FROM batch WHERE n >= 2 AND rn = 1
""",
    "p4_found": "SELECT DISTINCT id FROM section_chunk WHERE length(text) > 2000",
}
