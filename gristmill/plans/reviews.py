"""Registered queries of reviews: decisions put onto fields, the queue of open ones, messages about them, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.operators import notify, store
from gristmill.sources.tables import table


def reviewed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(fields, reviews): each field that waits for a person has a review, decided where another method has a value for its entity and field: that value corrects a different one and accepts an equal one."""
    fields = table(spark, d, "extracted_field")
    reason = F.when(F.coalesce("negation_detected", F.lit(False)), "negation_ambiguous").otherwise("low_confidence")
    reviews = store.reviews_of(fields.withColumn("reason", reason))
    plain = F.lower(F.trim("extraction_method")) == "human_review"
    others = fields.where(~plain & F.col("value").isNotNull()).groupBy("entity_key", "field_name").agg(F.max_by("value", F.struct("extracted_at", "id")).alias("other"))
    waiting = fields.where(plain).select(F.col("id").alias("extracted_field_id"), "entity_key", "field_name", "value")
    both = reviews.select(F.col("id").alias("review_id"), "extracted_field_id", "created_at").join(waiting.join(others, ["entity_key", "field_name"]), "extracted_field_id")
    same = F.coalesce(F.lower(F.trim("value")) == F.lower(F.trim("other")), F.lit(False))
    decisions = both.select("review_id", F.when(same, "accepted").otherwise("corrected").alias("resolution"), F.when(~same, F.col("other")).alias("corrected_value"), F.lit("reviewer").alias("reviewer_id"), F.col("created_at").alias("reviewed_at"))
    return fields, store.decided(reviews, decisions)


def c09_resolved(spark: SparkSession, d: str) -> DataFrame:
    fields, reviews = reviewed(spark, d)
    return store.resolved(fields, reviews).select("id", "value", "confidence", "extraction_method")


def f13_pending(spark: SparkSession, d: str) -> DataFrame:
    fields, reviews = reviewed(spark, d)
    return store.pending(reviews, fields, table(spark, d, "file_registry"))


def k07_review_reasons(spark: SparkSession, d: str) -> DataFrame:
    return reviewed(spark, d)[1].groupBy("reason", "resolution").agg(F.count("*").alias("n"), F.count("corrected_value").alias("n_corrected"), F.min("created_at").alias("first_created"))


def k11_messages(spark: SparkSession, d: str) -> DataFrame:
    return notify.messages(f13_pending(spark, d))


QUERIES = {q.__name__: q for q in (c09_resolved, f13_pending, k07_review_reasons, k11_messages)}

_REVIEWED = """
w AS (SELECT *, lower(trim(extraction_method)) = 'human_review' AS waits FROM extracted_field),
o AS (SELECT entity_key, field_name, value AS other FROM (SELECT *, row_number() OVER (PARTITION BY entity_key, field_name ORDER BY extracted_at DESC NULLS LAST, id DESC) AS rn FROM w WHERE NOT waits AND value IS NOT NULL) WHERE rn = 1),
r AS (
  SELECT sha256('review' || chr(1) || w.id) AS review_id, w.*, o.other, o.entity_key IS NOT NULL AS done, coalesce(lower(trim(w.value)) = lower(trim(o.other)), FALSE) AS same,
    CASE WHEN coalesce(negation_detected, FALSE) THEN 'negation_ambiguous' ELSE 'low_confidence' END AS reason
  FROM w LEFT JOIN o ON w.entity_key = o.entity_key AND w.field_name = o.field_name WHERE waits
)
"""
_PENDING = "SELECT review_id, reason, source_uri, r.entity_key, field_name, value, confidence, negation_detected FROM r JOIN file_registry f ON r.file_id = f.id WHERE NOT done"

SQL = {
    "c09_resolved": f"""WITH {_REVIEWED} SELECT w.id, CASE WHEN r.done AND NOT r.same AND r.other <> '' THEN r.other ELSE w.value END AS value,
      CASE WHEN r.done AND (r.same OR r.other <> '') THEN 1.0::DECIMAL(4,3) ELSE w.confidence END AS confidence, CASE WHEN r.done THEN 'human_review' ELSE w.extraction_method END AS extraction_method FROM w LEFT JOIN r ON w.id = r.id""",
    "f13_pending": f"WITH {_REVIEWED} {_PENDING}",
    "k07_review_reasons": f"WITH {_REVIEWED} SELECT reason, CASE WHEN done AND same THEN 'accepted' WHEN done THEN 'corrected' END AS resolution, count(*) AS n, count(*) FILTER (done AND NOT same) AS n_corrected, min(extracted_at) AS first_created FROM r GROUP BY 1, 2",
    "k11_messages": f"""WITH {_REVIEWED}, p AS ({_PENDING}) SELECT review_id,
      'HITL review: ' || field_name || '=' || CASE WHEN value IS NULL THEN 'None' ELSE chr(39) || value || chr(39) END || ' on ' || coalesce(entity_key, 'None') || ' (' || reason || ')' AS summary,
      'File: ' || list_extract(string_split(source_uri, '/'), -1) || chr(10) || 'Entity: ' || coalesce(entity_key, 'None') || chr(10) || 'Field: ' || field_name || chr(10) || 'Value: ' || coalesce(value, 'None') || chr(10) || 'Reason: ' || reason AS description FROM p""",
}
