"""Extracting fields from sections: rules, a pluggable model backend with a verify pass, a confidence gate."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill import params
from gristmill.functions.text import json_in, mentions
from gristmill.sources.tables import cut

#: Phrases of the deterministic backend.
UNCAPPED, CAPPED, DEFERRED = r"(?i)without any upper bound|no ceiling applies|not be limited|unlimited", r"(?i)up to [A-Z]{3} [0-9]|may reach [0-9.]+ percent|rises to [A-Z]{3} [0-9]|shall not exceed", r"(?i)leave the amount of the ceiling open|to be determined|subject to further negotiation"


def indemnification(text: Column) -> tuple[Column, Column]:
    """("true", 0.95) if a term of indemnification is part of the text, else ("false", 0.7)."""
    hit = mentions(text, params.INDEMNITY_TERMS)
    return F.when(hit, "true").otherwise("false"), F.when(hit, params.RULE_TRUE).otherwise(params.RULE_FALSE)


def liability(text: Column) -> tuple[Column, Column, Column]:
    """(status, confidence, evidence_span) by rules: no upper bound wins, then a cap, then deferred terms, else unknown.

    The evidence is the matched phrase, empty if there is none.
    """
    t = F.coalesce(text, F.lit(""))
    status = F.when(t.rlike(UNCAPPED), "uncapped").when(t.rlike(DEFERRED), "unknown").when(t.rlike(CAPPED), "capped").otherwise("unknown")
    confidence = F.when(t.rlike(UNCAPPED) & t.rlike(CAPPED), 0.8).when(t.rlike(UNCAPPED) | t.rlike(CAPPED), 0.95).when(t.rlike(DEFERRED), 0.9).otherwise(1.0)
    span = F.when(t.rlike(UNCAPPED), F.regexp_extract(t, UNCAPPED, 0)).when(t.rlike(DEFERRED), F.regexp_extract(t, DEFERRED, 0)).when(t.rlike(CAPPED), F.regexp_extract(t, CAPPED, 0)).otherwise("")
    return status, confidence, span


def needs_verify(confidence: Column, evidence: Column, threshold: float = params.THRESHOLD) -> Column:
    return (confidence < threshold) | mentions(evidence, params.HEDGES)


def negated(status: Column, evidence: Column) -> Column:
    return F.contains(status, F.lit("uncapped")) | F.coalesce(F.contains(F.lower(evidence), F.lit("not be limited")), F.lit(False))


def gate(df: DataFrame, threshold: float = params.THRESHOLD) -> DataFrame:
    """df (confidence, negation_detected, extraction_method) with reason, and human_review for those strictly under the threshold; null confidence is under it."""
    low = F.coalesce(F.col("confidence") < threshold, F.lit(True))
    return df.withColumn("reason", F.when(low & F.coalesce("negation_detected", F.lit(False)), "negation_ambiguous").when(low, "low_confidence")).withColumn("extraction_method", F.when(low, "human_review").otherwise(F.col("extraction_method")))


RESULT = "liability_cap_status string, confidence double, evidence_span string"
CALL = "answer string, latency_ms long, input_tokens long, output_tokens long, error string"
#: What a backend gives for a prompt: the answer, or the answer with the tokens it read and wrote.
Backend = Callable[[str], "str | tuple[str, int, int]"]


def call_model(df: DataFrame, prompt: str, backend: Backend, number: int = 1) -> DataFrame:
    """df with the fields of RESULT and CALL and extraction_pass, from a model backend called once a row in tasks.

    The answer's object, whatever stands around it, is read on the JVM. A row whose call fails, or whose answer has no
    object with a status and a confidence, has that as its error and nulls; others go on. A null prompt is an error too.
    """
    kept = df.drop(*(c.split()[0] for c in f"{RESULT}, {CALL}".split(", ")), "extraction_pass")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for asked in pdf[prompt]:
                began = time.perf_counter()
                try:
                    got = backend(asked)
                    text, *used = got if isinstance(got, tuple) else (got, None, None)
                    rows.append((text, *used, None))
                except Exception as e:  # noqa: BLE001: any failure is the row's own
                    rows.append((None, None, None, f"{type(e).__name__}: {e}"))
                rows[-1] = (rows[-1][0], int((time.perf_counter() - began) * 1000), *rows[-1][1:])
            made = pd.DataFrame(rows, columns=[c.split()[0] for c in CALL.split(", ")]).astype({c: "Int64" for c in ("latency_ms", "input_tokens", "output_tokens")})
            yield pd.concat([pdf.reset_index(drop=True), made], axis=1)

    called = kept.mapInPandas(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", " + CALL)
    read = called.withColumn("__r", F.from_json(json_in(F.col("answer")), RESULT))
    good = F.col("__r.liability_cap_status").isNotNull() & F.col("__r.confidence").isNotNull()
    error = F.when(F.col("error").isNotNull(), F.col("error")).when(json_in(F.col("answer")).isNull(), "ValueError: no object in the answer").when(~good, "ValueError: no status and confidence in the answer")
    fields = [F.when(good, F.col(f"__r.{c}")).alias(c) for c in ("liability_cap_status", "confidence")] + [F.when(good, F.coalesce("__r.evidence_span", F.lit(""))).alias("evidence_span")]
    return read.select(*kept.columns, *fields, F.lit(number).alias("extraction_pass"), "answer", "latency_ms", "input_tokens", "output_tokens", error.alias("error"))


def extract(df: DataFrame, prompt: str, first: Backend, second: Backend, verify: str | None = None) -> DataFrame:
    """One call a row, and a second that replaces it where the first was unsure or hedged; with `verify`, the column of the
    second prompt. Between them the rows are kept, so no model is asked twice for one pass.
    """
    done = cut(call_model(df, prompt, first))
    unsure = F.coalesce(needs_verify(F.col("confidence"), F.col("evidence_span")), F.lit(False))
    return done.where(~unsure).unionByName(call_model(done.where(unsure), verify or prompt, second, 2))


#: Templates of both passes; {text} stands for the section.
FIRST = "Read the section below. Answer with one JSON object of liability_cap_status (capped, uncapped or unknown), confidence (0 to 1) and evidence_span (the words that decide).\n\n{text}"
VERIFY = "An earlier reading of the section below was unsure. Look for negations, exceptions and terms that are left open, and whose liability is meant. Answer with one JSON object of liability_cap_status (capped, uncapped or unknown), confidence (0 to 1) and evidence_span.\n\n{text}"


def prompts(df: DataFrame, template: str, text: str, name: str = "prompt") -> DataFrame:
    """df with the column `name`: the template with the section's text in the place of {text}; null text gives null."""
    before, after = template.split("{text}")
    return df.withColumn(name, F.concat(F.lit(before), F.col(text), F.lit(after)))


def audit_rows(answers: DataFrame, model: str) -> DataFrame:
    """A row for the audit table of each call: id, file_id, model, prompt, response (the parsed answer as JSON, the error if there was one), latency_ms, input_tokens, output_tokens, created_at."""
    response = F.coalesce("error", F.to_json(F.struct("liability_cap_status", "confidence", "evidence_span")))
    key = F.sha2(F.concat_ws("\u0001", "file_id", F.lit(model), "prompt", F.col("extraction_pass").cast("string")), 256)
    return answers.select(key.alias("id"), "file_id", F.lit(model).alias("model"), "prompt", response.alias("response"), "latency_ms", "input_tokens", "output_tokens", F.current_timestamp().cast("timestamp_ntz").alias("created_at"))
