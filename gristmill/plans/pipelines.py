"""Pipelines from files to the store: structured exports, and documents. Both can run again: what is known by checksum is left alone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill import params
from gristmill.functions import text as T
from gristmill.operators import extract, golden, missingness, profile, registry, reports, resolve, store
from gristmill.sources import files, pages
from gristmill.sources.tables import cut


def structured(spark: SparkSession, folder: str, target: str, pattern: str = "*.csv", priors: dict[str, str] = params.PRIORS) -> DataFrame | None:
    """Takes the new delimited files of `folder`, in order of path, into the store at `target`; gives the lines of the quality report, or None if nothing is new.

    Of each file: schema version, profile, class of missingness of each data column (all but key, source and time), and
    observations, missing values resolved by their class out of the folder's other files. Observations of all files merge
    into golden fields, and those that stay open get a review. A file is a load, so plans are made file by file; rows are
    handled by Spark alone.
    """
    listed = cut(files.listing(spark, folder, pattern))
    fresh = files.new_files(listed, spark.read.parquet(f"{target}/file_registry")).orderBy("file_seq").collect()  # a row a file
    if not fresh:
        return None
    frames = {r.path: files.typed(files.delimited(spark, [r.path]).drop("source_path")).withColumn("__row", F.monotonically_increasing_id()) for r in listed.orderBy("file_seq").collect()}
    columns = {p: tuple(c for c in df.columns if c != "__row") for p, df in frames.items()}
    data = {p: tuple(c for c in cs if c not in {params.KEY, params.SOURCE, params.TIME}) for p, cs in columns.items()}
    systems, counts = {}, {}
    for r in fresh:
        df = frames[r.path]
        name = F.min_by(params.SOURCE, "__row") if params.SOURCE in df.columns else F.lit(None).cast("string")
        systems[r.path], counts[r.path] = df.agg(F.coalesce(name, F.lit("unknown")), F.count("*")).first()

    headers = spark.createDataFrame([(systems[r.path], f"{r.file_seq:012d}", r.checksum, list(columns[r.path])) for r in fresh], "source string, seq string, file_id string, columns array<string>")
    versions = cut(registry.versions(headers, registry.load(spark, target)))
    registry.save(versions, target)
    version = {v.file_id: v for v in versions.collect()}  # a row a file
    rows = [(r.checksum, r.path, "csv", systems[r.path], int(version[r.checksum].version), r.checksum, counts[r.path], "processed") for r in fresh]
    registered = spark.createDataFrame(rows, "id string, source_uri string, file_type string, source_system string, schema_version int, checksum string, row_count int, ingest_status string")
    now = F.current_timestamp().cast("timestamp_ntz")
    store.append_new(registered.withColumns({"received_at": now, "processed_at": now}), target, "file_registry", "checksum")

    profiles, observed = [], []
    for r in fresh:
        df, names = frames[r.path], data[r.path]
        if not names:
            continue
        classes = {c.column_name: c.missingness_class for c in missingness.classify(df, names, priors).collect()}  # a row a column
        kind = F.create_map(*(F.lit(x) for kv in classes.items() for x in kv))
        profiles.append(profile.column_profile(df, columns[r.path]).select(F.sha2(F.concat(F.lit(r.checksum), F.col("column_name")), 256).alias("id"), F.lit(r.checksum).alias("file_id"), "*", F.try_element_at(kind, F.col("column_name")).alias("missingness_class")))
        keyed = df if params.KEY in df.columns else df.withColumn(params.KEY, F.col("__row").cast("string"))
        obs = resolve.observations(keyed, r.checksum, names, classes, [f for p, f in frames.items() if p != r.path], "__row")
        observed.append(obs.withColumn("seq", F.lit(r.file_seq * (1 << 44)) + F.col("row")).withColumnRenamed(params.KEY, "key"))
    if not observed:
        return None
    store.append_new(reduce(DataFrame.unionByName, profiles), target, "column_profile")
    obs = cut(reduce(DataFrame.unionByName, observed))
    fields = golden.golden_fields(obs, ("source",)).withColumnsRenamed({"source": "file_id", "canonical": "entity_key"}).withColumn("extracted_at", now)
    fields = cut(fields.withColumn("id", store.field_id("file_id", "entity_key", "field_name")))
    store.append_new(fields, target, "extracted_field")
    store.append_new(store.reviews_of(fields), target, "hitl_review")
    return reports.quality_lines(obs.groupBy("extraction_method").agg(F.count("*").alias("n")))


def contracts(spark: SparkSession, folder: str, target: str, read: pages.Reader, first: extract.Backend, second: extract.Backend, model: str, pattern: str = "*.pdf") -> DataFrame:
    """Takes the new documents of `folder` into the store at `target`; gives file_id, path, lexical_match, n_redacted, error of each.

    Pages become texts, details are redacted before anything else sees them, and documents without a trigger word end
    there. Of the others come sections, indemnification by rule, and the liability status from a model with a verify pass
    over the first relevant section; answers under the threshold (setting `threshold`) get a review. A document that can't
    be read, or whose answer can't, has its error in the result and stops no other.
    """
    listed = cut(files.listing(spark, folder, pattern))
    fresh = files.new_files(listed, spark.read.parquet(f"{target}/file_registry")).select("path", F.col("checksum").alias("file_id"))
    page_rows = cut(pages.pages(spark, folder, read, pattern).join(fresh, "path"))
    broken = page_rows.where("error is not null").select("file_id", "path", "error")
    texts = pages.documents(page_rows).join(fresh, "path")
    texts = texts.withColumn("n_redacted", T.redaction_count(F.col("text"))).withColumn("text", T.redacted(F.col("text")))
    texts = cut(texts.withColumn("lexical_match", T.matches_vocabulary(F.col("text"))))
    now = F.current_timestamp().cast("timestamp_ntz")
    status = F.when(F.col("lexical_match"), "processed").otherwise("discarded_no_lexical_match")
    store.append_new(texts.select(F.col("file_id").alias("id"), F.col("path").alias("source_uri"), F.lit("pdf").alias("file_type"), F.col("file_id").alias("checksum"), F.col("n_pages").alias("page_count"), "lexical_match", status.alias("ingest_status"), now.alias("received_at"), now.alias("processed_at")), target, "file_registry", "checksum")

    kept = texts.where("lexical_match").select("file_id", "entity_key", T.sections(F.col("text")).alias("s"))
    chunks = kept.select("file_id", F.posexplode("s").alias("n", "c")).select("file_id", "n", "c.*").withColumn("full_section_text", F.col("text"))
    store.append_new(chunks.withColumn("id", store.field_id("file_id", "n")), target, "section_chunk")

    ruled = T.relevant(F.col("s"), params.INDEMNITY_SECTIONS)
    value, confidence = extract.indemnification(F.array_join(F.transform(ruled, lambda c: c["text"]), "\n"))
    rules = kept.select("file_id", "entity_key", F.lit("indemnification_present").alias("field_name"), value.alias("value"), confidence.alias("confidence"), F.lit("rule").alias("extraction_method"))
    section = F.get(T.relevant(F.col("s"), params.LIABILITY_SECTIONS), F.lit(0))["text"]
    asked = extract.prompts(extract.prompts(kept.select("file_id", "entity_key", section.alias("section")), extract.FIRST, "section"), extract.VERIFY, "section", "verify_prompt")
    answers = cut(extract.extract(asked, "prompt", first, second, "verify_prompt"))
    store.append_new(extract.audit_rows(answers.withColumn("prompt", F.when(F.col("extraction_pass") == 2, F.col("verify_prompt")).otherwise(F.col("prompt"))), model), target, "audit_log")
    found = answers.where("error is null").withColumn("negation_detected", extract.negated(F.col("liability_cap_status"), F.col("evidence_span"))).withColumn("extraction_method", F.lit("llm"))
    found = extract.gate(found, params.setting(spark, "threshold", params.THRESHOLD)).select("file_id", "entity_key", F.lit("liability_cap_status").alias("field_name"), F.col("liability_cap_status").alias("value"), "confidence", "extraction_method", "negation_detected", "extraction_pass", F.to_json(F.struct("evidence_span")).alias("source_ref"), "reason")
    fields = found.unionByName(rules, allowMissingColumns=True).withColumn("extracted_at", now)
    fields = cut(fields.withColumn("id", store.field_id("file_id", "entity_key", "field_name")))
    store.append_new(fields, target, "extracted_field")
    store.append_new(store.reviews_of(fields), target, "hitl_review")
    failed = answers.where("error is not null").select("file_id", "error")
    result = texts.join(failed, "file_id", "left").select("file_id", "path", "lexical_match", "n_redacted", "error")
    return result.unionByName(broken, allowMissingColumns=True)
