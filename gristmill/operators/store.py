"""The store: seven tables as Parquet folders, idempotent writes by load, queues and cohorts read from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of the store's tables.
TABLES = {
    "file_registry": "id string, source_uri string, file_type string, source_system string, schema_version int, checksum string, row_count int, page_count int, lexical_match boolean, ingest_status string, received_at timestamp_ntz, processed_at timestamp_ntz",
    "extraction_run": "id string, file_id string, stage string, status string, error string, started_at timestamp_ntz, completed_at timestamp_ntz",
    "column_profile": "id string, file_id string, column_name string, inferred_type string, null_rate decimal(5,4), missingness_class string, distinct_count int",
    "section_chunk": "id string, file_id string, section_name string, text string, full_section_text string, page_number int",
    "extracted_field": "id string, file_id string, entity_key string, field_name string, value string, confidence decimal(4,3), extraction_method string, negation_detected boolean, extraction_pass smallint, source_ref string, extracted_at timestamp_ntz",
    "hitl_review": "id string, extracted_field_id string, reason string, reviewer_id string, resolution string, corrected_value string, reviewed_at timestamp_ntz, created_at timestamp_ntz",
    "audit_log": "id string, file_id string, model string, prompt string, response string, latency_ms int, input_tokens int, output_tokens int, estimated_cost_usd decimal(10,6), created_at timestamp_ntz",
}


def create(spark: SparkSession, folder: str) -> None:
    """Writes the tables that don't exist yet, empty."""
    for name, ddl in (*TABLES.items(), ("schema_registry", "source string, version long, columns array<string>")):
        spark.createDataFrame([], ddl).write.mode("ignore").parquet(f"{folder}/{name}")


def conform(df: DataFrame, name: str) -> DataFrame:
    """df with the columns and types of the table `name`: missing ones null, others dropped."""
    want = df.sparkSession.createDataFrame([], TABLES[name]).schema
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in want))


def append_new(df: DataFrame, folder: str, name: str, key: str = "id") -> None:
    """Appends rows whose key the table doesn't hold, so that writing the same again changes nothing. Ids come from content."""
    held = df.sparkSession.read.parquet(f"{folder}/{name}").select(key)
    conform(df, name).dropDuplicates([key]).join(held, key, "left_anti").select(*conform(df, name).columns).write.mode("append").parquet(f"{folder}/{name}")


def field_id(*columns: str):
    """An id made of content: the same row gets the same id in every run."""
    return F.sha2(F.concat_ws("\u0001", *(F.coalesce(F.col(c).cast("string"), F.lit("\u0002")) for c in columns)), 256)


def review_queue(fields: DataFrame, files: DataFrame) -> DataFrame:
    """field_id, source_uri, file_type, entity_key, field_name, value, confidence, extraction_method of the fields that wait for a person."""
    waiting = fields.where(F.lower(F.trim("extraction_method")) == "human_review")
    files = files.select(F.col("id").alias("file_id"), "source_uri", "file_type")
    return waiting.join(files, "file_id").select(F.col("id").alias("field_id"), "source_uri", "file_type", "entity_key", "field_name", "value", "confidence", "extraction_method")


def reviews_of(fields: DataFrame) -> DataFrame:
    """A row of hitl_review, open, for each field that waits for a person. fields: id, extraction_method, reason, and the time at which they came, extracted_at."""
    waiting = fields.where(F.lower(F.trim("extraction_method")) == "human_review")
    return waiting.select(
        F.sha2(F.concat(F.lit("review\u0001"), F.col("id")), 256).alias("id"), F.col("id").alias("extracted_field_id"), "reason", *(F.lit(None).cast("string").alias(c) for c in ("reviewer_id", "resolution", "corrected_value")),
        F.lit(None).cast("timestamp_ntz").alias("reviewed_at"), F.col("extracted_at").cast("timestamp_ntz").alias("created_at"),
    )


def decided(reviews: DataFrame, decisions: DataFrame) -> DataFrame:
    """`reviews` with the newest decision on each put in: review_id, resolution (accepted, corrected, rejected), corrected_value, reviewer_id, reviewed_at."""
    newest = decisions.where("review_id is not null and resolution is not null").groupBy(F.col("review_id").alias("id")).agg(F.max_by(F.struct("resolution", "corrected_value", "reviewer_id", "reviewed_at"), F.struct("reviewed_at", "resolution", "corrected_value")).alias("d"))
    both = reviews.join(newest, "id", "left")
    given = F.col("d").isNotNull()
    return both.withColumns({c: F.when(given, F.col("d")[c]).otherwise(F.col(c)) for c in ("resolution", "corrected_value", "reviewer_id")} | {"reviewed_at": F.when(given, F.col("d.reviewed_at").cast("timestamp_ntz")).otherwise(F.col("reviewed_at"))}).select(*reviews.columns)


def resolved(fields: DataFrame, reviews: DataFrame) -> DataFrame:
    """`fields` as decided reviews leave them: a correction that isn't empty gives its value with confidence 1, acceptance confidence 1, and any decision the method human_review.

    A field with several decided reviews follows the newest. Open reviews change nothing.
    """
    done = reviews.where("resolution is not null").groupBy(F.col("extracted_field_id").alias("id")).agg(F.max_by(F.struct("resolution", "corrected_value"), F.struct("reviewed_at", F.col("id"))).alias("__d"))
    both, how = fields.join(done, "id", "left"), F.col("__d.resolution")
    corrected = F.coalesce((how == "corrected") & (F.length("__d.corrected_value") > 0), F.lit(False))
    types = dict(fields.dtypes)
    return both.withColumns({
        "value": F.when(corrected, F.col("__d.corrected_value")).otherwise(F.col("value")),
        "confidence": F.when(corrected | F.coalesce(how == "accepted", F.lit(False)), F.lit(1.0).cast(types["confidence"])).otherwise(F.col("confidence")),
        "extraction_method": F.when(how.isNotNull(), "human_review").otherwise(F.col("extraction_method")),
    }).select(*fields.columns)


def pending(reviews: DataFrame, fields: DataFrame, files: DataFrame) -> DataFrame:
    """review_id, reason, source_uri, entity_key, field_name, value, confidence, negation_detected of the reviews without a resolution whose field and file are known."""
    f = fields.select(F.col("id").alias("extracted_field_id"), "file_id", "entity_key", "field_name", "value", "confidence", "negation_detected")
    open_ = reviews.where("resolution is null").select(F.col("id").alias("review_id"), "extracted_field_id", "reason")
    both = open_.join(f, "extracted_field_id").join(files.select(F.col("id").alias("file_id"), "source_uri"), "file_id")
    return both.select("review_id", "reason", "source_uri", "entity_key", "field_name", "value", "confidence", "negation_detected")


def cohort(fields: DataFrame) -> DataFrame:
    """entity_key, value, confidence of uncapped liabilities, not by a person, whose entity also has indemnification."""
    method, value = F.lower(F.trim("extraction_method")), F.lower(F.trim("value"))
    uncapped = fields.where((F.col("field_name") == "liability_cap_status") & (value == "uncapped") & (method != "human_review"))
    indemnified = fields.where((F.col("field_name") == "indemnification_present") & (value == "true")).select("entity_key")
    return uncapped.join(indemnified, "entity_key", "left_semi").select("id", "entity_key", F.lower("value").alias("value"), "confidence")
