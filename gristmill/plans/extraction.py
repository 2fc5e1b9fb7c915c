"""Registered queries of the engine's operators over the project's tables, and their SQL. Names begin with the operator's id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill import params
from gristmill.functions import text as T
from gristmill.functions.values import plain_key
from gristmill.operators import drift, extract, golden, missingness, notify, profile, registry, reports, resolve, store
from gristmill.sources.files import assembled, new_files
from gristmill.sources.registered import NUMERIC, SOURCES, source
from gristmill.sources.tables import table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- SQL pieces -----------------------------------------------------------------------------------------------------
_TOKENS = ", ".join(f"'{t}'" for t in params.NULL_TOKENS)


def _null(t: str, c: str) -> str:
    """A column as the engine reads it."""
    if c == "region_code" and t.endswith("1"):
        return "CASE WHEN NOT isnan(region_code) THEN region_code END"
    return c if c in NUMERIC else f"CASE WHEN {c} NOT IN ({_TOKENS}) THEN {c} END"


def _src(t: str) -> str:
    return f"(SELECT record_id, file_id, entity_key, updated_at, {', '.join(f'{_null(t, c)} AS {c}' for c in SOURCES[t])} FROM {t})"


def _kind(c: str) -> str:
    return "numeric" if c in NUMERIC else "text"


def _profile_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{_kind(c)}' AS inferred_type, round(1 - count({c})::DOUBLE / count(*), 4) AS null_rate, count(DISTINCT {c}) AS distinct_count, coalesce(count(DISTINCT {c})::DOUBLE / nullif(count({c}), 0) > 0.5, FALSE) AS identifier_like FROM {_src(t)}"
        for t, cols in SOURCES.items() for c in cols
    )


def _simpson(f: str, low: str, high: str) -> str:
    return f"(SELECT sum((CASE WHEN i = 0 OR i = 400 THEN 1.0 WHEN i % 2 = 1 THEN 4.0 ELSE 2.0 END) * ({f.replace('X', f'({low} + ({high} - {low}) / 400 * i)')})) * ({high} - {low}) / 400 / 3 FROM range(401) r(i))"


def _number_tests_sql() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{a}' AS target, '{b}' AS other, count({b}) FILTER ({a} IS NOT NULL) AS n_present, count({b}) FILTER ({a} IS NULL) AS n_missing, avg({b}::DOUBLE) FILTER ({a} IS NOT NULL) AS ap, avg({b}::DOUBLE) FILTER ({a} IS NULL) AS am, var_samp({b}::DOUBLE) FILTER ({a} IS NOT NULL) AS vp, var_samp({b}::DOUBLE) FILTER ({a} IS NULL) AS vm FROM {_src(t)}"
        for t, cols in SOURCES.items() for a in cols for b in cols if a != b and b in NUMERIC
    )
    theta, width = "atan(abs(t) / sqrt(df))", "12.0 / sqrt(df)"
    g = "pow(greatest(cos(X), 0.0), df - 1)"
    return f"""stats AS ({rows}), tests AS (
      SELECT *, (ap - am) / sqrt(vp / n_present + vm / n_missing) AS t, pow(vp / n_present + vm / n_missing, 2) / (pow(vp / n_present, 2) / (n_present - 1) + pow(vm / n_missing, 2) / (n_missing - 1)) AS df
      FROM stats WHERE n_present >= 5 AND n_missing >= 5
    ), number_tests AS (
      SELECT table_name, target, other, n_present, n_missing, t, df, {_simpson(g, theta, f"least(pi() / 2, {theta} + {width})")} / {_simpson(g, "0.0", f"least(pi() / 2, {width})")} AS p, abs(ap - am) AS gap, sqrt(vp) AS spread FROM tests
    )"""


def _category_tests_sql() -> str:
    tabs = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{a}' AS target, '{b}' AS other, coalesce({b}, '__NA__') AS category, count(*) FILTER ({a} IS NULL) AS n_null, count({a}) AS n_present, count(DISTINCT {b}) AS d, count({b}) AS n_other FROM {_src(t)} GROUP BY category"
        for t, cols in SOURCES.items() for a in cols for b in cols if a != b and b not in NUMERIC
    )
    g = "pow(X, dof - 1) * exp(-X * X / 2)"
    return f"""tabs AS ({tabs}), full_tabs AS (SELECT *, sum(n_null) OVER w AS nulls, sum(n_present) OVER w AS present, count(*) OVER w AS k, sum(d) OVER w AS ds, sum(n_other) OVER w AS os FROM tabs WINDOW w AS (PARTITION BY table_name, target, other)),
    terms AS (SELECT *, (n_null + n_present) * nulls::DOUBLE / (nulls + present) AS en, (n_null + n_present) * present::DOUBLE / (nulls + present) AS ep FROM full_tabs WHERE nulls > 0 AND present > 0 AND k >= 2 AND os > 0),
    chi AS (SELECT table_name, target, other, sum(pow(abs(n_null - en) - CASE WHEN k = 2 THEN least(0.5, abs(n_null - en)) ELSE 0 END, 2) / en + pow(abs(n_present - ep) - CASE WHEN k = 2 THEN least(0.5, abs(n_present - ep)) ELSE 0 END, 2) / ep) AS chi2, (max(k) - 1)::DOUBLE AS dof, max(n_null::DOUBLE / (n_null + n_present)) AS high, min(n_null::DOUBLE / (n_null + n_present)) AS low, max(ds)::DOUBLE / greatest(max(os), 1) > 0.5 AS identifier_like FROM terms GROUP BY table_name, target, other),
    category_tests AS (SELECT *, {_simpson(g, "sqrt(chi2)", "(sqrt(chi2) + 14 + sqrt(dof))")} / {_simpson(g, "0.0", "(sqrt(chi2) + 14 + sqrt(dof))")} AS p FROM chi)"""


def _classes_sql() -> str:
    cols = " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS column_name, {i} AS seq, count(*) - count({c}) AS n_null FROM {_src(t)}" for t, cs in SOURCES.items() for i, c in enumerate(cs))
    return f"""{_number_tests_sql()}, {_category_tests_sql()}, cols AS ({cols}), all_tests AS (
      SELECT table_name, target, other, p, p < 0.05 AND gap > 0.5 * spread AS explains FROM number_tests
      UNION ALL SELECT table_name, target, other, p, NOT identifier_like AND high > 0.9 AND low < 0.1 FROM category_tests
    ), judged AS (
      SELECT a.table_name, a.target, bool_or(explains) AS explained, bool_or(coalesce(p < 0.05, FALSE)) AS dependent, arg_min(other, c.seq) FILTER (explains) AS explained_by
      FROM all_tests a JOIN cols c ON a.table_name = c.table_name AND a.other = c.column_name GROUP BY a.table_name, a.target
    ), classes AS (
      SELECT c.table_name, c.column_name, CASE WHEN n_null = 0 THEN 'NONE' WHEN coalesce(explained, FALSE) THEN 'MAR' WHEN c.column_name = 'compliance_flag' THEN 'MNAR' WHEN coalesce(dependent, FALSE) THEN 'MNAR' ELSE 'MCAR' END AS missingness_class,
        CASE WHEN n_null > 0 AND coalesce(explained, FALSE) THEN explained_by END AS explained_by FROM cols c LEFT JOIN judged j ON c.table_name = j.table_name AND c.column_name = j.target
    )"""


_DATE = "coalesce(try_strptime(updated_at, '%Y-%m-%d'), try_strptime(updated_at, '%Y/%m/%d'), try_strptime(updated_at, '%d.%m.%Y'), try_strptime(updated_at, '%d %b %Y'), try_strptime(updated_at, '%Y-%m-%dT%H:%M:%S'))::date"


def _as_text(t: str, c: str) -> str:
    return f"({c}::BIGINT)::VARCHAR || '.0'" if c == "region_code" and t.endswith("1") else f"{c}::VARCHAR"


def _backfill_sql(t: str, c: str, name: str) -> str:
    """CTEs; the last, `name`, has record_id and value."""
    others = [o for o in SOURCES if o != t and c in SOURCES[o]]
    found = " UNION ALL ".join(
        f"SELECT {i} AS seq, entity_key, {_as_text(o, c)} AS value, {_DATE} AS day FROM {_src(o)} WHERE entity_key IS NOT NULL AND {c} IS NOT NULL" for i, o in enumerate(others)
    ) or "SELECT 0 AS seq, NULL::VARCHAR AS entity_key, NULL::VARCHAR AS value, NULL::DATE AS day WHERE FALSE"
    return f"""{name}_c AS ({found}), {name}_r AS (
      SELECT r.record_id, k.value, row_number() OVER (PARTITION BY r.record_id ORDER BY k.seq, k.day DESC NULLS LAST, k.value DESC) AS rn
      FROM (SELECT record_id, entity_key, {_DATE} AS own FROM {_src(t)} WHERE {c} IS NULL) r LEFT JOIN {name}_c k ON r.entity_key = k.entity_key AND (r.own IS NULL OR k.day > r.own)
    ), {name} AS (SELECT record_id, value FROM {name}_r WHERE rn = 1)"""


def _observations_sql() -> str:
    ctes, rows = [], []
    for t, cols in SOURCES.items():
        for c in cols:
            n = f"b_{t}_{c}"
            ctes.append(_backfill_sql(t, c, n))
            fill = f"(SELECT avg({c}::DOUBLE)::VARCHAR FROM {_src(t)})" if c in NUMERIC else "'x'"
            rows.append(
                f"SELECT '{t}' AS source, '{c}' AS field_name, CASE WHEN s.{c} IS NOT NULL THEN 'direct' WHEN k.missingness_class = 'MCAR' AND {fill} IS NOT NULL THEN 'imputed' WHEN k.missingness_class = 'MAR' AND b.value IS NOT NULL THEN 'backfilled' ELSE 'human_review' END AS extraction_method "
                f"FROM {_src(t)} s JOIN classes k ON k.table_name = '{t}' AND k.column_name = '{c}' LEFT JOIN {n} b ON s.record_id = b.record_id"
            )
    return f"{_classes_sql()}, {', '.join(ctes)}, obs AS ({' UNION ALL '.join(rows)})"


# ---- structured tables ----------------------------------------------------------------------------------------------
@query(_profile_sql())
def a01_column_profile(spark: SparkSession, d: str) -> DataFrame:
    return union([profile.column_profile(source(spark, d, t), cols).select(F.lit(t).alias("table_name"), "*") for t, cols in SOURCES.items()])


@query(f"SELECT coalesce(compliance_flag, '__NA__') AS category, count(*) FILTER (registration_number IS NULL) AS n_null, count(registration_number) AS n_present FROM {_src('procurement_export_batch1')} GROUP BY category")
def a08_null_crosstab(spark: SparkSession, d: str) -> DataFrame:
    return profile.null_crosstab(source(spark, d, "procurement_export_batch1"), "registration_number", "compliance_flag")


@query(f"WITH {_number_tests_sql()} SELECT table_name, target, other, n_present, n_missing, round(t, 4) AS t, round(df, 3) AS df, round(p, 4) AS p, round(gap, 3) AS gap, round(spread, 3) AS spread FROM number_tests")
def a06_welch_tests(spark: SparkSession, d: str) -> DataFrame:
    r = union([missingness.number_tests(source(spark, d, t), cols).select(F.lit(t).alias("table_name"), "*") for t, cols in SOURCES.items()])
    return r.select("table_name", "target", "other", "n_present", "n_missing", F.round("t", 4).alias("t"), F.round("df", 3).alias("df"), F.round("p", 4).alias("p"), F.round("gap", 3).alias("gap"), F.round("spread", 3).alias("spread"))


@query(f"WITH {_category_tests_sql()} SELECT table_name, target, other, round(chi2, 4) AS chi2, dof, round(p, 4) AS p, round(high, 4) AS high, round(low, 4) AS low, identifier_like FROM category_tests")
def a10_chi_squared_tests(spark: SparkSession, d: str) -> DataFrame:
    r = union([c.select(F.lit(t).alias("table_name"), "*") for t, cols in SOURCES.items() if (c := missingness.category_tests(source(spark, d, t), cols)) is not None])
    return r.select("table_name", "target", "other", F.round("chi2", 4).alias("chi2"), "dof", F.round("p", 4).alias("p"), F.round("high", 4).alias("high"), F.round("low", 4).alias("low"), "identifier_like")


def _classes(spark: SparkSession, d: str) -> DataFrame:
    return union([missingness.classify(source(spark, d, t), cols).select(F.lit(t).alias("table_name"), "*") for t, cols in SOURCES.items()])


@query(f"WITH {_classes_sql()} SELECT table_name, column_name, missingness_class, explained_by, CASE missingness_class WHEN 'MCAR' THEN 'auto_impute' WHEN 'MAR' THEN 'cross_file_backfill' WHEN 'MNAR' THEN 'flag_for_hitl' ELSE 'skip' END AS strategy FROM classes")
def c01_missingness_class(spark: SparkSession, d: str) -> DataFrame:
    return _classes(spark, d)


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, " + (f"round(avg({c}::DOUBLE), 6)::VARCHAR AS fill_value FROM {_src(t)}" if c in NUMERIC else f"coalesce((SELECT {c} FROM {_src(t)} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1), 'unknown') AS fill_value")
    for t, cols in SOURCES.items() for c in cols
))
def a04_fill_values(spark: SparkSession, d: str) -> DataFrame:
    r = union([resolve.fill_values(source(spark, d, t), cols).select(F.lit(t).alias("table_name"), "*") for t, cols in SOURCES.items()])
    return r.withColumn("fill_value", F.when(F.col("column_name").isin(*NUMERIC), F.round(F.expr("try_cast(fill_value AS double)"), 6).cast("string")).otherwise(F.col("fill_value")))


@query(f"WITH {_backfill_sql('procurement_export_batch1', 'registration_number', 'b')} SELECT record_id AS row, value FROM b")
def j01_backfill(spark: SparkSession, d: str) -> DataFrame:
    names = [t for t in SOURCES if t != "procurement_export_batch1"]
    return resolve.backfill(source(spark, d, "procurement_export_batch1"), "registration_number", [source(spark, d, t) for t in names])


def _observations(spark: SparkSession, d: str) -> DataFrame:
    frames = {t: source(spark, d, t) for t in SOURCES}
    classes = {(r.table_name, r.column_name): r.missingness_class for r in _classes(spark, d).collect()}  # a row a column
    return union([resolve.observations(frames[t], t, cols, {c: classes[t, c] for c in cols}, [frames[o] for o in SOURCES if o != t]) for t, cols in SOURCES.items()])


@query(f"WITH {_observations_sql()} SELECT source, field_name, extraction_method, count(*) AS n FROM obs GROUP BY ALL")
def f08_observations(spark: SparkSession, d: str) -> DataFrame:
    return _observations(spark, d).groupBy("source", "field_name", "extraction_method").agg(F.count("*").alias("n"))


def _values_sql() -> str:
    """CTEs; the last, `vals`, has a row for each record and data column, as observations gives them."""
    ctes, rows = [], []
    for i, (t, cols) in enumerate(SOURCES.items()):
        for c in cols:
            n = f"v_{t}_{c}"
            ctes.append(_backfill_sql(t, c, n))
            fill = f"(SELECT avg({c}::DOUBLE)::VARCHAR FROM {_src(t)})" if c in NUMERIC else f"coalesce((SELECT {c} FROM {_src(t)} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1), 'unknown')"
            rows.append(
                f"SELECT '{t}' AS source, {i} AS s, s.record_id AS row, s.entity_key, '{c}' AS field_name, {_as_text(t, f's.{c}')} AS own, k.missingness_class AS cls, CASE k.missingness_class WHEN 'MCAR' THEN {fill} WHEN 'MAR' THEN b.value END AS fill "
                f"FROM {_src(t)} s JOIN classes k ON k.table_name = '{t}' AND k.column_name = '{c}' LEFT JOIN {n} b ON s.record_id = b.record_id"
            )
    return f"""{_classes_sql()}, {', '.join(ctes)}, parts AS ({' UNION ALL '.join(rows)}), vals AS (
      SELECT source, s, row, entity_key, field_name, coalesce(own, fill) AS value, CASE WHEN own IS NOT NULL THEN 1.0 WHEN fill IS NULL THEN 0.0 WHEN cls = 'MCAR' THEN 0.9 ELSE 0.8 END::DOUBLE AS confidence,
        CASE WHEN own IS NOT NULL THEN 'direct' WHEN fill IS NULL THEN 'human_review' WHEN cls = 'MCAR' THEN 'imputed' ELSE 'backfilled' END AS extraction_method,
        CASE WHEN own IS NULL AND fill IS NULL THEN CASE WHEN cls = 'MNAR' THEN 'mnar_suspected' ELSE 'unresolved_backfill' END END AS reason FROM parts)"""


@query(f"WITH {_values_sql()} SELECT source, row, entity_key, field_name, value, confidence, extraction_method, reason FROM vals")
def f08_values(spark: SparkSession, d: str) -> DataFrame:
    return _observations(spark, d)


@query(f"WITH {_values_sql()} SELECT extraction_method, printf('%14s: %5d  (%.1f%%)', extraction_method, count(*), count(*) * 100.0::DOUBLE / sum(count(*)) OVER ()) AS line FROM vals GROUP BY extraction_method")
def k14_quality_lines(spark: SparkSession, d: str) -> DataFrame:
    return reports.quality_lines(_observations(spark, d).groupBy("extraction_method").agg(F.count("*").alias("n")))


@query(f"WITH {_observations_sql()} SELECT extraction_method, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (), 4) AS share FROM obs GROUP BY extraction_method")
def a03_method_counts(spark: SparkSession, d: str) -> DataFrame:
    return resolve.method_counts(_observations(spark, d))


def _keys(spark: SparkSession, d: str) -> DataFrame:
    rows = union([table(spark, d, t).select(F.lit(i).alias("s"), "record_id", F.col("entity_key").alias("key")) for i, t in enumerate(SOURCES)])
    return rows.where("key is not null").groupBy("key").agg(F.min(F.struct("s", "record_id")).alias("o")).select("key", (F.col("o.s") * F.lit(1 << 40) + F.col("o.record_id")).alias("first"))


_KEYS = " UNION ".join(f"SELECT entity_key AS k FROM {t} WHERE entity_key IS NOT NULL" for t in SOURCES)


@query(f"WITH keys AS ({_KEYS}) SELECT a.k AS a, b.k AS b FROM keys a JOIN keys b ON a.k <> b.k AND abs(length(a.k) - length(b.k)) <= 1 AND (left(a.k, 4) = left(b.k, 4) OR right(a.k, 4) = right(b.k, 4)) AND levenshtein(replace(a.k, chr(160), '~'), replace(b.k, chr(160), '~')) = 1")
def d01_near_keys(spark: SparkSession, d: str) -> DataFrame:
    return golden.near_keys(_keys(spark, d))


_LED = "list_filter(f.leads, lambda x: levenshtein(x.c, n.c) <= 1)"
_LEADERS = f"""
all_keys AS ({" UNION ALL ".join(f"SELECT entity_key AS key, {i}::BIGINT * 1099511627776 + record_id AS first FROM {t}" for i, t in enumerate(SOURCES))}),
numbered AS (SELECT key, replace(key, chr(160), '~') AS c, row_number() OVER (ORDER BY min(first)) AS rn FROM all_keys WHERE key IS NOT NULL GROUP BY key),
folded AS (
  SELECT 0::BIGINT AS rn, NULL::VARCHAR AS key, NULL::VARCHAR AS canonical, []::STRUCT(k VARCHAR, c VARCHAR)[] AS leads
  UNION ALL SELECT n.rn, n.key, coalesce({_LED}[1].k, n.key), CASE WHEN len({_LED}) > 0 THEN f.leads ELSE list_append(f.leads, {{'k': n.key, 'c': n.c}}) END FROM folded f JOIN numbered n ON n.rn = f.rn + 1
)"""


@query(f"WITH RECURSIVE {_LEADERS} SELECT key, canonical FROM folded WHERE rn > 0")
def d03_golden_keys(spark: SparkSession, d: str) -> DataFrame:
    return golden.leaders(_keys(spark, d))


@query(f"""WITH RECURSIVE {_LEADERS}, {_values_sql()}, ranked AS (
  SELECT canonical, v.*, row_number() OVER (PARTITION BY canonical, field_name ORDER BY confidence DESC, s, row) AS rn FROM vals v JOIN folded f ON v.entity_key = f.key
), merged AS (SELECT canonical, field_name, list_sort(list(DISTINCT entity_key)) AS merged_keys FROM ranked GROUP BY ALL)
SELECT r.canonical, r.field_name, value, confidence, extraction_method, reason, merged_keys FROM ranked r JOIN merged m ON r.canonical = m.canonical AND r.field_name = m.field_name WHERE rn = 1""")
def a15_golden_fields(spark: SparkSession, d: str) -> DataFrame:
    order = F.create_map(*(x for i, t in enumerate(SOURCES) for x in (F.lit(t), F.lit(i))))
    obs = _observations(spark, d).withColumn("seq", order[F.col("source")] * F.lit(1 << 40) + F.col("row")).withColumnRenamed("entity_key", "key")
    return golden.golden_fields(obs)


@query("SELECT id, checksum FROM (SELECT id, checksum, row_number() OVER (PARTITION BY checksum ORDER BY received_at, id) AS n FROM file_registry) WHERE n = 1 OR checksum IS NULL")
def f01_new_files(spark: SparkSession, d: str) -> DataFrame:
    return new_files(table(spark, d, "file_registry"), order=("received_at", "id")).select("id", "checksum")


@query("SELECT sha256(text) AS checksum, count(*) AS n_documents, min(doc_id) AS first_doc FROM documents WHERE text IS NOT NULL GROUP BY 1")
def s03_text_checksums(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text is not null").groupBy(F.sha2("text", 256).alias("checksum")).agg(F.count("*").alias("n_documents"), F.min("doc_id").alias("first_doc"))


@query()
def c06_schema_versions(spark: SparkSession, d: str) -> DataFrame:
    f = drift.files(table(spark, d, "raw_line"), table(spark, d, "file_registry")).where("feed is not null")
    seq = F.concat_ws(" ", F.coalesce(F.date_format("received_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("")), "file_id")
    return registry.versions(f.select(F.col("feed").alias("source"), seq.alias("seq"), "file_id", F.col("headers").alias("columns"))).select("source", "file_id", "version", "renamed", "added")


# ---- texts ----------------------------------------------------------------------------------------------------------
_DETAILS = (("SSN", r"\b\d{3}-\d{2}-\d{4}\b"), ("PHONE", r"\b\(?\d{3}\)?[-.\s]\d{3}[-.\s]\d{4}\b"), ("EIN", r"(?i)\bEIN[:\s]*\d{2}-\d{7}\b"), ("EMAIL", r"\b[\w.+-]+@[\w-]+\.[\w.-]+\b"))


def _redact_sql(c: str) -> str:
    for label, p in _DETAILS:
        c = f"regexp_replace({c}, '{p}', '[REDACTED_{label}]', 'g')"
    return c


def _count_sql(c: str) -> str:
    parts = []
    for label, p in _DETAILS:
        parts.append(f"len(regexp_extract_all({c}, '{p}'))")
        c = f"regexp_replace({c}, '{p}', '[REDACTED_{label}]', 'g')"
    return " + ".join(parts)


@query(f"SELECT id, md5({_redact_sql('text')}) AS redacted_md5, ({_count_sql('text')})::BIGINT AS n_redacted FROM section_chunk WHERE text IS NOT NULL")
def t01_redacted(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return table(spark, d, "section_chunk").where("text is not null").select("id", F.md5(T.redacted(t)).alias("redacted_md5"), T.redaction_count(t).cast("bigint").alias("n_redacted"))


_WORDS = r"' ' || array_to_string(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+(?:[''’.][\p{L}\p{N}_]+)*'), ' ') || ' '"
_GATE = "(" + " OR ".join(f"contains({_WORDS}, ' {t} ')" for t in params.TRIGGERS) + ")"


@query(f"SELECT doc_id, coalesce({_GATE}, FALSE) AS matches FROM documents")
def f04_lexical_gate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.matches_vocabulary(F.col("text")).alias("matches"))


@query(f"SELECT file_id, CASE WHEN bool_or(coalesce({_GATE}, FALSE)) THEN 'processed' ELSE 'discarded_no_lexical_match' END AS ingest_status, count(*) AS n_chunks FROM section_chunk GROUP BY file_id")
def f05_gated_files(spark: SparkSession, d: str) -> DataFrame:
    hit = F.bool_or(T.matches_vocabulary(F.col("text")))
    return table(spark, d, "section_chunk").groupBy("file_id").agg(F.when(hit, "processed").otherwise("discarded_no_lexical_match").alias("ingest_status"), F.count("*").alias("n_chunks"))


_HEAD = r"(?im)^[ \t\r]*(" + "|".join(params.HEADINGS) + r")[ \t]*:?[ \t\r]*$"
_SECTIONS = f"""
SELECT doc_id, section_name, md5(body) AS body_md5 FROM (
  SELECT doc_id, replace(lower(h[i]), ' ', '_') AS section_name, regexp_replace(p[i + 1], '^[ \\t\\n\\r\\f\\v]+|[ \\t\\n\\r\\f\\v]+$', '', 'g') AS body
  FROM (SELECT doc_id, regexp_extract_all(text, '{_HEAD}', 1) AS h, regexp_split_to_array(text, '{_HEAD}') AS p FROM documents WHERE text IS NOT NULL), unnest(range(1, len(h) + 1)) r(i)
) WHERE body <> ''
UNION ALL SELECT doc_id, 'unstructured', md5(text) FROM documents WHERE text IS NOT NULL AND NOT regexp_matches(text, '{_HEAD}')
"""


@query(_SECTIONS)
def t02_sections(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "documents").where("text is not null").select("doc_id", F.explode(T.sections(F.col("text"))).alias("s"))
    return s.select("doc_id", "s.section_name", F.md5("s.text").alias("body_md5"))


_NAMED = f"""
named AS (
  SELECT doc_id, i, replace(lower(h[i]), ' ', '_') AS section_name, regexp_replace(p[i + 1], '^[ \\t\\n\\r\\f\\v]+|[ \\t\\n\\r\\f\\v]+$', '', 'g') AS body
  FROM (SELECT doc_id, regexp_extract_all(text, '{_HEAD}', 1) AS h, regexp_split_to_array(text, '{_HEAD}') AS p FROM documents WHERE text IS NOT NULL), unnest(range(1, len(h) + 1)) r(i)
), per_doc AS (
  SELECT doc_id, CASE WHEN NOT regexp_matches(text, '{_HEAD}') THEN ['unstructured'] ELSE coalesce((SELECT list(section_name ORDER BY i) FROM named n WHERE n.doc_id = d.doc_id AND body <> ''), []) END AS names FROM documents d WHERE text IS NOT NULL
), chosen AS (SELECT doc_id, CASE WHEN list_has_any(names, ['limitation_of_liability', 'unstructured']) THEN list_filter(names, lambda x: x IN ('limitation_of_liability', 'unstructured')) ELSE names END AS s FROM per_doc)"""


@query(f"WITH {_NAMED} SELECT doc_id, len(s)::INTEGER AS n_relevant, s[1] AS first_section, CASE WHEN len(s) = 0 THEN 'no section' END AS error FROM chosen")
def f11_relevant_sections(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "documents").where("text is not null").select("doc_id", T.relevant(T.sections(F.col("text")), params.LIABILITY_SECTIONS).alias("s"))
    first = F.get("s", F.lit(0))
    return s.select("doc_id", F.size("s").alias("n_relevant"), first["section_name"].alias("first_section"), F.when(first.isNull(), "no section").alias("error"))


_NAME = "replace(lower(trim(section_name)), ' ', '_')"
_TERMS = " OR ".join(f"contains(lower(text), '{t}')" for t in params.INDEMNITY_TERMS)


@query(f"SELECT file_id, CASE WHEN bool_or({_TERMS}) THEN 'true' ELSE 'false' END AS value, CASE WHEN bool_or({_TERMS}) THEN 0.95 ELSE 0.7 END::DOUBLE AS confidence FROM section_chunk WHERE {_NAME} IN ('indemnification', 'recitals', 'unstructured') AND text IS NOT NULL GROUP BY file_id")
def t03_indemnification(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "section_chunk").where("text is not null").where(F.regexp_replace(F.lower(F.trim("section_name")), " ", "_").isin(*params.INDEMNITY_SECTIONS))
    hit = F.bool_or(T.mentions(F.col("text"), params.INDEMNITY_TERMS))
    return c.groupBy("file_id").agg(F.when(hit, "true").otherwise("false").alias("value"), F.when(hit, params.RULE_TRUE).otherwise(params.RULE_FALSE).alias("confidence"))


def _m(p: str) -> str:
    return f"regexp_matches(coalesce(text, ''), '{p}')"


_U, _C, _D = extract.UNCAPPED, extract.CAPPED, extract.DEFERRED
_STATUS = f"CASE WHEN {_m(_U)} THEN 'uncapped' WHEN {_m(_D)} THEN 'unknown' WHEN {_m(_C)} THEN 'capped' ELSE 'unknown' END"
_CONF = f"CASE WHEN {_m(_U)} AND {_m(_C)} THEN 0.8 WHEN {_m(_U)} OR {_m(_C)} THEN 0.95 WHEN {_m(_D)} THEN 0.9 ELSE 1.0 END"
_SPAN = f"CASE WHEN {_m(_U)} THEN regexp_extract(text, '{_U}') WHEN {_m(_D)} THEN regexp_extract(text, '{_D}') WHEN {_m(_C)} THEN regexp_extract(text, '{_C}') ELSE '' END"


@query(f"""
WITH r AS (SELECT id, {_STATUS} AS value, ({_CONF})::DOUBLE AS confidence, {_SPAN} AS evidence_span FROM section_chunk WHERE {_NAME} IN ('limitation_of_liability', 'unstructured'))
SELECT id, value, confidence, evidence_span, confidence < 0.85 OR {" OR ".join(f"contains(lower(evidence_span), '{h}')" for h in params.HEDGES)} AS verify, contains(value, 'uncapped') OR contains(lower(evidence_span), 'not be limited') AS negation_detected,
  CASE WHEN confidence < 0.85 THEN 'human_review' ELSE 'rule' END AS extraction_method,
  CASE WHEN confidence < 0.85 AND (contains(value, 'uncapped') OR contains(lower(evidence_span), 'not be limited')) THEN 'negation_ambiguous' WHEN confidence < 0.85 THEN 'low_confidence' END AS reason FROM r
""")
def c08_liability_rules(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "section_chunk").where(F.regexp_replace(F.lower(F.trim("section_name")), " ", "_").isin(*params.LIABILITY_SECTIONS))
    value, confidence, span = extract.liability(F.col("text"))
    r = c.select("id", value.alias("value"), confidence.cast("double").alias("confidence"), span.alias("evidence_span"), F.lit("rule").alias("extraction_method"))
    r = r.withColumn("verify", extract.needs_verify(F.col("confidence"), F.col("evidence_span"))).withColumn("negation_detected", extract.negated(F.col("value"), F.col("evidence_span")))
    return extract.gate(r)


@query("SELECT id, json_extract_string(source_ref, '$.evidence_span') AS evidence_span FROM extracted_field WHERE source_ref IS NOT NULL")
def t07_json_salvage(spark: SparkSession, d: str) -> DataFrame:
    prose = F.concat(F.lit("The answer is "), F.col("source_ref"), F.lit(" as asked."))
    return table(spark, d, "extracted_field").where("source_ref is not null").select("id", F.get_json_object(T.json_in(prose), "$.evidence_span").alias("evidence_span"))


@query("SELECT file_id, md5(string_agg(coalesce(text, ''), '\n\n' ORDER BY page_number NULLS FIRST, id)) AS text_md5, count(*) AS n_pages FROM section_chunk GROUP BY file_id")
def s06_assembled_files(spark: SparkSession, d: str) -> DataFrame:
    return assembled(table(spark, d, "section_chunk"), "file_id", "page_number", "text", ("id",)).select("file_id", F.md5("text").alias("text_md5"), "n_pages")


# ---- store and reports ----------------------------------------------------------------------------------------------
_QUEUE = "SELECT f.id AS field_id, source_uri, file_type, entity_key, field_name, value, confidence, extraction_method FROM extracted_field f JOIN file_registry r ON f.file_id = r.id WHERE lower(trim(extraction_method)) = 'human_review'"


@query(_QUEUE)
def j02_review_queue(spark: SparkSession, d: str) -> DataFrame:
    return store.review_queue(table(spark, d, "extracted_field"), table(spark, d, "file_registry"))


@query(f"SELECT field_id, 'HITL review: ' || field_name || '=' || CASE WHEN value IS NULL THEN 'None' ELSE '''' || value || '''' END || ' on ' || coalesce(entity_key, 'None') AS summary FROM ({_QUEUE})")
def k11_notifications(spark: SparkSession, d: str) -> DataFrame:
    return notify.payloads(store.review_queue(table(spark, d, "extracted_field"), table(spark, d, "file_registry"))).select("field_id", "summary")


@query("SELECT id, entity_key, lower(value) AS value, confidence FROM extracted_field WHERE field_name = 'liability_cap_status' AND lower(trim(value)) = 'uncapped' AND lower(trim(extraction_method)) <> 'human_review' AND entity_key IN (SELECT entity_key FROM extracted_field WHERE field_name = 'indemnification_present' AND lower(trim(value)) = 'true')")
def j03_cohort(spark: SparkSession, d: str) -> DataFrame:
    return store.cohort(table(spark, d, "extracted_field"))


@query("SELECT CASE WHEN grouping(event_type) = 1 THEN 'TOTAL' ELSE event_type END AS model, count(*) AS calls, round(sum(coalesce(value, 0)), 2) AS tokens, round(sum(coalesce(user_id, 0))::DOUBLE / count(*), 6) AS avg_latency FROM events GROUP BY ROLLUP (event_type)")
def a11_usage_report(spark: SparkSession, d: str) -> DataFrame:
    return reports.usage(table(spark, d, "events"), "event_type", "value", "user_id").withColumn("tokens", F.round("tokens", 2))


_PAIRS = """
WITH p AS (SELECT upper(regexp_replace(entity_key, '[^A-Za-z0-9]', '', 'g')) AS k, lower(trim(extraction_method)) AS m, lower(trim(value)) AS v, id FROM extracted_field WHERE field_name = 'liability_cap_status' AND lower(trim(value)) IN ('capped', 'uncapped', 'unknown')),
e AS (SELECT k, arg_min(v, id) AS expected FROM p WHERE m = 'human_review' GROUP BY k), g AS (SELECT k, arg_min(v, id) AS predicted FROM p WHERE m = 'llm' GROUP BY k), pairs AS (SELECT expected, predicted FROM e JOIN g ON e.k = g.k),
c AS (SELECT DISTINCT unnest([expected, predicted]) AS class FROM pairs)
"""


@query(_PAIRS + """SELECT class, count(*) FILTER (expected = class AND predicted = class) AS tp, count(*) FILTER (expected <> class AND predicted = class) AS fp, count(*) FILTER (expected = class AND predicted <> class) AS fn,
round(count(*) FILTER (expected = class AND predicted = class)::DOUBLE / nullif(count(*) FILTER (predicted = class), 0), 6) AS precision, round(count(*) FILTER (expected = class AND predicted = class)::DOUBLE / nullif(count(*) FILTER (expected = class), 0), 6) AS recall,
round(count(*) FILTER (expected = predicted)::DOUBLE / nullif(count(*), 0), 6) AS accuracy FROM c, pairs GROUP BY class""")
def a12_evaluation(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "extracted_field").select(plain_key(F.col("entity_key")).alias("k"), F.lower(F.trim("extraction_method")).alias("m"), F.lower(F.trim("value")).alias("v"), "id", "field_name")
    p = p.where("field_name = 'liability_cap_status' and v in ('capped', 'uncapped', 'unknown')")
    expected = p.where("m = 'human_review'").groupBy("k").agg(F.min_by("v", "id").alias("expected"))
    predicted = p.where("m = 'llm'").groupBy("k").agg(F.min_by("v", "id").alias("predicted"))
    return reports.evaluation(expected.join(predicted, "k").select("expected", "predicted"))
