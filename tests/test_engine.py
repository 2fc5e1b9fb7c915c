"""Operators of the engine, against values worked out by hand or by brute force."""

import difflib
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from gristmill import params
from gristmill.functions import text as T
from gristmill.functions.stats import chi_squared_tail, t_two_sided
from gristmill.operators import extract, golden, missingness, notify, profile, registry, reports, resolve, store
from gristmill.plans import pipelines
from gristmill.sources import files
from gristmill.streaming.ingest import ingest_stream


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_profile_and_empty_table(spark):
    df = spark.createDataFrame([("a", 1, True), ("a", None, None), (None, 3, False), ("b", 3, True)], "s string, n bigint, b boolean")
    got = {r.column_name: r for r in profile.column_profile(df).collect()}
    assert (got["s"].null_rate, got["s"].distinct_count, got["s"].inferred_type, got["s"].identifier_like) == (0.25, 2, "text", True)
    assert (got["n"].null_rate, got["n"].distinct_count, got["b"].inferred_type) == (0.25, 2, "numeric")
    empty = profile.column_profile(df.where("false")).collect()
    assert {r.null_rate for r in empty} == {None} and not any(r.identifier_like for r in empty)


def test_tails(spark):
    r = spark.range(1).select(t_two_sided(F.lit(13.0767), F.lit(50.0386)).alias("t"), t_two_sided(F.lit(-3.3751), F.lit(17.4017)).alias("u"), chi_squared_tail(F.lit(1.17647), F.lit(2.0)).alias("c"), t_two_sided(F.lit(float("inf")), F.lit(1.0)).alias("i")).first()
    assert r.t < 1e-15 and abs(r.u - 0.003502) < 1e-5 and abs(r.c - 0.5553) < 1e-4 and r.i == 0


def frame(spark, data):
    return spark.createDataFrame(data, "employee_count bigint, region_code string, compliance_flag string")


def test_missingness_classes(spark):
    rng = random.Random(7)
    data = []
    for i in range(400):
        n = rng.randint(1, 4) if i % 4 == 0 else rng.randint(20, 500)
        data.append((n, None if n < 5 else f"R{rng.randint(1, 9)}", None if rng.random() < 0.4 else rng.choice(["clear", "flagged"])))
    got = {r.column_name: r for r in missingness.classify(frame(spark, data), ("employee_count", "region_code", "compliance_flag")).collect()}
    assert (got["employee_count"].missingness_class, got["employee_count"].strategy) == ("NONE", "skip")
    assert (got["region_code"].missingness_class, got["region_code"].explained_by) == ("MAR", "employee_count")
    assert got["compliance_flag"].missingness_class == "MNAR"
    assert {r.missingness_class for r in missingness.classify(frame(spark, []), ("employee_count", "region_code")).collect()} == {"NONE"}


def test_backfill_takes_fresher_values_of_the_first_source(spark):
    ddl = "record_id bigint, entity_key string, registration_number string, updated_at string"
    own = spark.createDataFrame([(1, "A", None, "2026-01-01"), (2, "A", "REG-1", "2026-01-01"), (3, "B", None, "2026-03-01"), (4, "C", None, None), (5, None, None, None)], ddl)
    one = spark.createDataFrame([(1, "A", "REG-2", "2026-02-01"), (2, "A", "REG-0", "2026-01-15"), (3, "B", "REG-3", "2026-01-01")], ddl)
    two = spark.createDataFrame([(1, "B", "REG-4", "01.04.2026"), (2, "C", "REG-5", None), (3, "A", "REG-9", "2026-09-01")], ddl)
    got = dict(rows(resolve.backfill(own, "registration_number", [one, two]), "row", "value"))
    assert got == {1: "REG-2", 3: "REG-4", 4: "REG-5", 5: None}
    assert rows(resolve.backfill(own.drop("entity_key"), "registration_number", [one]), "row") == [(1,), (3,), (4,), (5,)]


def test_observations_and_counts(spark):
    ddl = "record_id bigint, entity_key string, region_code double, compliance_flag string, updated_at string"
    df = spark.createDataFrame([(1, "A", 10.0, None, "2026-01-01"), (2, "B", None, "clear", "2026-01-01"), (3, "C", 20.0, "clear", "2026-01-01")], ddl)
    obs = resolve.observations(df, "s", ("region_code", "compliance_flag"), {"region_code": "MCAR", "compliance_flag": "MNAR"}, [])
    got = {(r.row, r.field_name): (r.value, r.extraction_method, r.reason, r.confidence) for r in obs.collect()}
    assert got[1, "region_code"] == ("10.0", "direct", None, 1.0) and got[2, "region_code"] == ("15.0", "imputed", None, 0.9)
    assert got[1, "compliance_flag"] == (None, "human_review", "mnar_suspected", 0.0)
    assert dict(rows(resolve.method_counts(obs), "extraction_method", "n")) == {"direct": 4, "imputed": 1, "human_review": 1}
    fills = dict(rows(resolve.fill_values(spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None)], "x string, y string"), ("x", "y")), "column_name", "fill_value"))
    assert fills == {"x": "a", "y": "unknown"}


def edits(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        p, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            p, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, p + (x != y))
    return d[-1]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_leaders_equal_greedy_clustering(spark, seed):
    rng = random.Random(seed)
    keys = list(dict.fromkeys("".join(rng.choice("AB") for _ in range(rng.randint(1, 6))) for _ in range(40)))
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, first bigint")
    assert rows(golden.near_keys(df), "a", "b") == sorted((a, b) for a, b in itertools.permutations(keys, 2) if edits(a, b) == 1)
    lead, want = [], {}
    for k in keys:
        want[k] = next((x for x in lead if edits(x, k) <= 1), k)
        lead += [k] if want[k] == k else []
    assert dict(rows(golden.leaders(df), "key", "canonical")) == want


def test_golden_fields_prefer_confidence_then_order(spark):
    data = [("VENAAA111", "f", None, 0.0, "human_review", "x", 1), ("VENAAA112", "f", "clear", 0.8, "backfilled", None, 2), ("VENAAA111", "f", "late", 0.8, "direct", None, 3), ("VENZZZ999", "f", "z", 1.0, "direct", None, 4), (None, "f", "n", 1.0, "direct", None, 5)]
    got = {r.canonical: r for r in golden.golden_fields(spark.createDataFrame(data, "key string, field_name string, value string, confidence double, extraction_method string, reason string, seq bigint")).collect()}
    assert set(got) == {"VENAAA111", "VENZZZ999"} and got["VENAAA111"].value == "clear" and got["VENAAA111"].merged_keys == ["VENAAA111", "VENAAA112"]


def seen(spark, headers, state=None):
    rows_ = [(src, f"{i:04d}", f"f{i}", cols) for i, (src, cols) in enumerate(headers)]
    return registry.versions(spark.createDataFrame(rows_, "source string, seq string, file_id string, columns array<string>"), state)


def test_registry(spark, tmp_path):
    first = [("s", ["entity_key", "registration_number"]), ("s", ["entity_key", "registration_number"]), ("s", ["entity_key", "registration_no"]), ("s", ["entity_key", "registration_number", "contract_tier"]), ("t", ["a"])]
    found = seen(spark, first)
    got = rows(found, "file_id", "version", "renamed", "added")
    assert got == [("f0", 1, "", ""), ("f1", 1, "", ""), ("f2", 2, "registration_no=registration_number", ""), ("f3", 3, "", "contract_tier"), ("f4", 1, "", "")]
    store.create(spark, str(tmp_path))
    registry.save(found, str(tmp_path))
    later = seen(spark, [("s", ["entity_key", "registration_number", "contract_tier"]), ("s", ["entity_key", "registration_number", "contract_tier", "due"]), ("u", ["b"])], registry.load(spark, str(tmp_path)))
    assert rows(later, "file_id", "version", "added") == [("f0", 3, ""), ("f1", 4, "due"), ("f2", 1, "")]
    registry.save(later, str(tmp_path))
    assert rows(registry.load(spark, str(tmp_path)), "source", "version") == [("s", 4), ("t", 1), ("u", 1)]
    assert registry.versions(spark.createDataFrame([], "source string, seq string, file_id string, columns array<string>")).count() == 0


def test_registry_equals_a_walk_over_all_files(spark):
    rng, names = random.Random(4), ["amount", "amounts", "amount_eur", "vendor", "vendors", "vendor_id", "tier", "tiers", "day"]
    headers = [(rng.choice("ab"), rng.sample(names, rng.randint(2, 5))) for _ in range(60)]
    known, want = {}, []
    for i, (src, cols) in enumerate(headers):
        if src not in known:
            known[src] = [1, list(cols)]
            want.append((f"f{i}", 1, "", ""))
            continue
        near = {}
        for o in known[src][1]:
            if o not in cols and (n := difflib.get_close_matches(o, cols, 1, 0.75)):
                near[n[0]] = o
        new = [c for c in cols if c not in known[src][1] and c not in near]
        known[src][0] += bool(near or new)
        known[src][1] += new
        want.append((f"f{i}", known[src][0], ",".join(f"{n}={o}" for n, o in sorted(near.items())), ",".join(new)))
    assert rows(seen(spark, headers), "file_id", "version", "renamed", "added") == sorted(want)


def test_text_functions(spark):
    t = "Call 512-555-0199 or a.b@example.com. SSN 123-45-6789, EIN 12-3456789. Nothing else changes."
    df = spark.createDataFrame([(t, "Hold,\nHarmless the liabilities"), (None, None), ("", "")], "a string, b string")
    got = df.select(T.redacted(F.col("a")).alias("r"), T.redaction_count(F.col("a")).alias("n"), T.matches_vocabulary(F.col("b")).alias("m"), T.sections(F.col("b")).alias("s")).collect()
    assert got[0].n == 4 and got[0].r.endswith("Nothing else changes.") and "555" not in got[0].r and got[0].m
    assert got[1].r is None and got[1].m is False and got[1].s is None and got[2].m is False
    doc = "Preamble\nRecitals:\nOne.\n\nLimitation of Liability\nTwo may.\nGoverning Law:\n\nIndemnification:\n Three "
    s = spark.createDataFrame([(doc,)], "t string").select(T.sections(F.col("t")).alias("s")).select("s", T.relevant(F.col("s"), ("nothing",)).alias("all"), T.relevant(F.col("s"), ("recitals",)).alias("one")).first()
    assert [(x.section_name, x.text) for x in s.s] == [("recitals", "One."), ("limitation_of_liability", "Two may."), ("indemnification", "Three")]
    assert len(s.all) == 3 and len(s.one) == 1
    assert spark.createDataFrame([('x {"a": {"b": 1}} y',), ("none",)], "t string").select(T.json_in(F.col("t")).alias("j")).collect()[0].j == '{"a": {"b": 1}}'


def test_extraction_verifies_unsure_rows_and_isolates_errors(spark):
    def first(t):
        return f"Sure: {json.dumps({'liability_cap_status': 'capped', 'confidence': 0.5 if 'unsure' in t else 0.97, 'evidence_span': 'it may' if 'hedge' in t else 'x'})}" if "bad" not in t else "no object"

    def second(t):
        return json.dumps({"liability_cap_status": "uncapped", "confidence": 0.4, "evidence_span": "shall not be limited"})

    df = spark.createDataFrame([(1, "fine"), (2, "unsure"), (3, "hedge"), (4, "bad")], "id bigint, text string")
    got = {r.id: r for r in extract.extract(df, "text", first, second).collect()}
    assert [got[i].extraction_pass for i in (1, 2, 3)] == [1, 2, 2] and got[2].liability_cap_status == "uncapped" and got[4].error.startswith("ValueError")
    gated = extract.gate(spark.createDataFrame([(0.85, True, "llm"), (0.84, True, "llm"), (0.1, False, "llm"), (None, None, "llm")], "confidence double, negation_detected boolean, extraction_method string"))
    assert [r.reason for r in gated.collect()] == [None, "negation_ambiguous", "low_confidence", "low_confidence"]


def test_store_is_idempotent_and_stream_ingests_once(spark, tmp_path):
    folder = str(tmp_path / "store")
    store.create(spark, folder)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("entity_key,x\nA,1\n")
    (tmp_path / "in" / "b.csv").write_text("entity_key,x\nA,1\n")
    (tmp_path / "in" / "c.csv").write_text("y,entity_key\nNA,B\n")
    for _ in range(2):
        q = ingest_stream(spark, str(tmp_path / "in"), folder, str(tmp_path / "cp"))
        q.awaitTermination()
    assert spark.read.parquet(f"{folder}/file_registry").count() == 2
    listed = files.listing(spark, str(tmp_path / "in"), "*.csv")
    assert [r.file_seq for r in files.new_files(listed).orderBy("file_seq").collect()] == [1, 3]
    got = files.delimited(spark, [str(tmp_path / "in" / x) for x in ("a.csv", "c.csv")])
    assert rows(got.select("entity_key", F.coalesce("x", F.lit("-")).alias("x"), F.coalesce("y", F.lit("-")).alias("y")), "entity_key", "x", "y") == [("A", "1", "-"), ("B", "-", "-")]


def test_reports_and_notifications(spark):
    pairs = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")], "expected string, predicted string")
    got = {r["class"]: r for r in reports.evaluation(pairs).collect()}
    assert (got["a"].tp, got["a"].fp, got["a"].fn, got["a"].accuracy, got["c"].precision) == (1, 1, 1, 0.5, None)
    use = {r.model: r for r in reports.usage(spark.createDataFrame([("m", 5, None), ("m", None, 4), ("n", 1, 2)], "model string, tokens bigint, ms bigint"), "model", "tokens", "ms").collect()}
    assert (use["m"].calls, use["m"].tokens, use["m"].avg_latency, use["TOTAL"].tokens) == (2, 5, 2.0, 6)
    queue = spark.createDataFrame([("1", "f", None, "E"), ("2", "f", "v", None)], "field_id string, field_name string, value string, entity_key string")
    assert [r.summary for r in notify.payloads(queue).orderBy("field_id").collect()] == ["HITL review: f=None on E", "HITL review: f='v' on None"]
    notify.deliver(queue, lambda r: 1 / 0)
    notify.deliver(queue, lambda r: 1 / 0, enabled=True)
    assert params.ALPHA == 0.05


def test_pages_and_audit(spark, tmp_path):
    from gristmill.sources import pages

    (tmp_path / "contract_1.pdf").write_bytes(b"A page with plenty of its own text.|")
    (tmp_path / "broken.pdf").write_bytes(b"!")

    def read(content):
        if content == b"!":
            raise ValueError("broken")
        own, rest = content.decode().split("|")
        return [(own, [], []), (rest, ["read", " ", "words"], [90.0, -1.0, 100.0])]

    rows = pages.pages(spark, str(tmp_path), read)
    assert [r.error for r in rows.where("error is not null").collect()] == ["ValueError: broken"]
    doc = pages.documents(rows).first()
    assert (doc.text, doc.mean_confidence, doc.n_pages, doc.entity_key) == ("A page with plenty of its own text.\n\nread words", 0.975, 2, "contract_1")
    asked = extract.prompts(spark.createDataFrame([("f", "body")], "file_id string, text string"), "Read: {text}", "text")
    audit = extract.audit_rows(extract.call_model(asked, "prompt", lambda p: ("nothing", 7, 2)), "m").first()
    assert audit.prompt == "Read: body" and audit.response.startswith("ValueError") and (audit.input_tokens, audit.output_tokens) == (7, 2) and audit.latency_ms >= 0 and audit.created_at


def test_reviews_change_fields(spark):
    fields = spark.createDataFrame([(i, "file", "E", "f", "old", 0.2, "human_review", False, None) for i in "abcd"], "id string, file_id string, entity_key string, field_name string, value string, confidence double, extraction_method string, negation_detected boolean, extracted_at timestamp_ntz").withColumn("reason", F.lit("low_confidence"))
    reviews = store.reviews_of(fields)
    ids = dict(rows(reviews, "extracted_field_id", "id"))
    made = spark.createDataFrame([(ids["a"], "corrected", "new", "me", 2), (ids["a"], "accepted", None, "me", 1), (ids["b"], "accepted", None, "me", 1), (ids["c"], "rejected", "x", "me", 1), ("nobody", "accepted", None, "me", 1)], "review_id string, resolution string, corrected_value string, reviewer_id string, reviewed_at int")
    done = store.decided(reviews, made.withColumn("reviewed_at", F.timestamp_seconds("reviewed_at")))
    assert rows(store.resolved(fields.withColumn("extraction_method", F.lit("llm")), done), "id", "value", "confidence", "extraction_method") == [("a", "new", 1.0, "human_review"), ("b", "old", 1.0, "human_review"), ("c", "old", 0.2, "human_review"), ("d", "old", 0.2, "llm")]
    open_ = store.pending(done, fields, spark.createDataFrame([("file", "x/y.csv")], "id string, source_uri string"))
    assert [(r.review_id, r.reason) for r in open_.collect()] == [(ids["d"], "low_confidence")]
    m = notify.messages(open_).first()
    assert m.summary == "HITL review: f='old' on E (low_confidence)" and m.description == "File: y.csv\nEntity: E\nField: f\nValue: old\nReason: low_confidence"


def test_structured_pipeline(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rng = random.Random(3)
    keys = [f"VEN{i:02d}{i:02d}{i:02d}" for i in range(60)]
    small = {k: i < 12 for i, k in enumerate(keys)}
    lines = [f"{k},north,{rng.randint(1, 4) if small[k] else rng.randint(20, 500)},{'' if small[k] else f'REG-{i:06d}'},{rng.choice(['clear', '']) },2026-01-01" for i, k in enumerate(keys)]
    (tmp_path / "in" / "b.csv").write_text("entity_key,source_system,employee_count,registration_number,compliance_flag,updated_at\n" + "\n".join(lines) + "\n")
    (tmp_path / "in" / "a.csv").write_text("entity_key,source_system,registration_number,updated_at\n" + "\n".join(f"{k},finance,REG-9{i:05d},2026-02-01" for i, k in enumerate(keys[:6])) + "\n")
    target = str(tmp_path / "store")
    store.create(spark, target)
    lines = {r.extraction_method: r.line for r in pipelines.structured(spark, str(tmp_path / "in"), target).collect()}
    assert set(lines) == {"direct", "backfilled", "human_review"} and lines["backfilled"] == "    backfilled:     6  (3.2%)"
    held = {t: spark.read.parquet(f"{target}/{t}") for t in store.TABLES}
    assert rows(held["file_registry"], "source_system", "schema_version", "row_count", "ingest_status") == [("finance", 1, 6, "processed"), ("north", 1, 60, "processed")]
    kinds = {(r.column_name, r.inferred_type, r.missingness_class) for r in held["column_profile"].collect()}
    assert ("employee_count", "numeric", "NONE") in kinds and ("registration_number", "text", "MAR") in kinds and ("updated_at", "text", None) in kinds
    by_method = dict(rows(held["extracted_field"].groupBy("extraction_method").count(), "extraction_method", "count"))
    assert held["hitl_review"].count() == by_method["human_review"] > 0 and held["extracted_field"].count() == 180
    assert {r.reason for r in held["hitl_review"].collect()} == {"mnar_suspected", "unresolved_backfill"}
    assert pipelines.structured(spark, str(tmp_path / "in"), target) is None


def test_contract_pipeline(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "c1.pdf").write_text("Recitals:\nA.B., 123-45-6789, shall hold harmless.\nLimitation of Liability:\nLiability shall not be limited.")
    (tmp_path / "in" / "c2.pdf").write_text("Order details and nothing else that matters here.")
    (tmp_path / "in" / "c3.pdf").write_text("!")
    (tmp_path / "in" / "c4.pdf").write_text("Limitation of Liability:\nThe liability is of a sort unclear.")

    def read(content):
        if content == b"!":
            raise ValueError("broken")
        return [(content.decode(), [], [])]

    def model(p):
        sure = "not be limited" in p
        return json.dumps({"liability_cap_status": "uncapped" if sure else "unknown", "confidence": 0.95 if sure else 0.4, "evidence_span": "shall not be limited" if sure else ""}), 10, 5

    target = str(tmp_path / "store")
    store.create(spark, target)
    for again in (False, True):
        got = {r.path.split("/")[-1]: r for r in pipelines.contracts(spark, str(tmp_path / "in"), target, read, model, model, "m").collect()}
        assert set(got) == ({"c3.pdf"} if again else {"c1.pdf", "c2.pdf", "c3.pdf", "c4.pdf"}) and got["c3.pdf"].error == "ValueError: broken"
        held = {t: spark.read.parquet(f"{target}/{t}") for t in store.TABLES}
        assert rows(held["file_registry"], "ingest_status", "lexical_match", "page_count") == [("discarded_no_lexical_match", False, 1), ("processed", True, 1), ("processed", True, 1)]
        assert rows(held["extracted_field"], "entity_key", "field_name", "value", "extraction_method") == [("c1", "indemnification_present", "true", "rule"), ("c1", "liability_cap_status", "uncapped", "llm"), ("c4", "indemnification_present", "false", "rule"), ("c4", "liability_cap_status", "unknown", "human_review")]
        assert held["hitl_review"].count() == 1 and held["audit_log"].count() == 2 and held["section_chunk"].where("text like '%6789%'").count() == 0
