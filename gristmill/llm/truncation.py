"""Problem 10: texts that were cut off, found by how often a text's last words stand inside texts and how often at their ends.

All of it is Spark SQL. Words are taken in classes, so that counts speak for the kind of place and not for one name or
number: digits become 9, capitalised words inside a sentence N, rare first words of sentences N too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions.joins import split_join
from gristmill.sources.tables import cut, written

#: A first word of sentences is kept as it is if it begins at least this share of them: so at most 1 / share words are kept, which bounds what is broadcast.
STARTER_SHARE = 0.001
#: A last trigram is frequent inside texts from here on, and almost never terminal up to this share of its places.
FREQUENT, TERMINAL_SHARE = 12, 0.03
#: The share for short last lines, whose words also fill running lines.
SHORT_SHARE = 0.004

#: Marks that a sender leaves where it cut a text.
MARK = r"(?:\s*(?:\[\s*(?:\.{2,}|…|cut|truncated|more)\s*\]|\(\s*(?:\.{3}|…|cut|truncated|more)\s*\)|\.{3,}|…|\x{FFFD}+))\s*$"

TOKENS = r"""
WITH clean AS (
  SELECT doc_id, source, xxhash64(text) AS copy, regexp_like(text, r'{mark}') AS marked,
         regexp_replace(regexp_replace(regexp_replace(rtrim(regexp_replace(text, r'{mark}', '')), r'[­​-‏﻿]', ''), r'\r\n?', '\n'), r'(?<=\S)[^\S\n]*\n(?=\p{{Ll}})', ' ') AS t
  FROM {docs} WHERE text IS NOT NULL AND text RLIKE r'\S'
), parts AS (
  SELECT doc_id, source, copy, marked, raw FROM clean LATERAL VIEW explode(array(concat(array('¶', '¶'), regexp_extract_all(t, r'\n[\s]*|[\p{{L}}\p{{N}}]+(?:[\x27’.,/-][\p{{L}}\p{{N}}]+)*|[^\s\p{{L}}\p{{N}}]', 0)))) x AS raw
)
SELECT doc_id, source, copy, marked, raw[size(raw) - 1] AS last_raw, words
FROM parts LATERAL VIEW explode(array(transform(raw, (w, i) -> CASE WHEN w RLIKE r'^[\n¶]' THEN '¶' WHEN w RLIKE '[0-9]' THEN regexp_replace(w, r'[0-9]+(?:[.,][0-9]+)*', '9')
         WHEN NOT w RLIKE r'^\p{{Lu}}' THEN w WHEN i > 0 AND raw[i - 1] RLIKE r'^[\n¶.!?]' THEN concat('^', w) ELSE 'N' END))) y AS words
"""

COUNTED = """
SELECT a, b, c, sum(IF(at = n - 3, 0L, 1L)) AS inside FROM (
  SELECT n, posexplode(arrays_zip(slice(words, 1, n - 2), slice(words, 2, n - 2), slice(words, 3, n - 2))) AS (at, g) FROM (SELECT words, size(words) AS n FROM {tokens}) WHERE n > 2
) LATERAL VIEW inline(array(g)) x AS a, b, c GROUP BY a, b, c
"""

STARTERS = """
WITH s AS (SELECT c, sum(inside) AS n FROM {counted} WHERE startswith(c, '^') GROUP BY c)
SELECT c AS word FROM s WHERE n >= {share} * (SELECT sum(n) FROM s)
"""

CLASSED = """
SELECT /*+ BROADCAST(x), BROADCAST(y), BROADCAST(z) */ {key}
  IF(startswith(a, '^') AND x.word IS NULL, 'N', a) AS a, IF(startswith(b, '^') AND y.word IS NULL, 'N', b) AS b, IF(startswith(c, '^') AND z.word IS NULL, 'N', c) AS c, {value}
FROM {rows} LEFT JOIN {starters} x ON a = x.word LEFT JOIN {starters} y ON b = y.word LEFT JOIN {starters} z ON c = z.word {group}
"""

ENDS = """
SELECT doc_id, source, copy, marked, last_raw, words[size(words) - 3] AS a, words[size(words) - 2] AS b, words[size(words) - 1] AS c,
       NOT exists(slice(words, greatest(size(words) - 7, 2), 8), w -> w = '¶') AS running FROM {tokens} WHERE size(words) > 2
"""

KINDS = "SELECT a, b, c, last_raw, running, marked, count(DISTINCT copy) AS copies FROM {ends} GROUP BY a, b, c, last_raw, running, marked"

JUDGED = """
WITH terminal AS (SELECT a, b, c, running, count(DISTINCT copy) AS terminal FROM {ends} GROUP BY a, b, c, running),
last_inside AS (SELECT t.a, t.b, t.c, t.running, t.terminal, coalesce(i.inside, 0L) AS inside FROM terminal t LEFT JOIN {inside} i ON t.a = i.a AND t.b = i.b AND t.c = i.c),
fragments AS (SELECT DISTINCT a, b, last_raw FROM {kinds} WHERE last_raw RLIKE r'^\\p{{L}}'),
bare AS (SELECT a, b, trim(LEADING '^' FROM c) AS w, inside FROM {inside} WHERE c RLIKE r'^\\^?\\p{{L}}.'),
wanted AS (SELECT /*+ MERGE(f) */ b.a, b.b, b.w, b.inside FROM bare b LEFT SEMI JOIN (SELECT DISTINCT a, b, left(last_raw, 1) AS initial FROM fragments) f ON b.a = f.a AND b.b = f.b AND left(b.w, 1) = f.initial),
beginnings AS (SELECT a, b, beginning, sum(inside) AS longer FROM (SELECT a, b, inside, explode(transform(sequence(1, length(w) - 1), n -> left(w, n))) AS beginning FROM wanted) GROUP BY a, b, beginning),
seen AS (SELECT a, b, last_raw, c, count(DISTINCT copy) AS ends FROM {ends} GROUP BY a, b, last_raw, c)
SELECT xxhash64(e.a, e.b, e.c, e.last_raw, e.running, e.marked) AS kind, l.inside, l.terminal, coalesce(g.longer, 0L) AS longer,
  CASE WHEN e.c RLIKE r'^[.!?]' AND NOT e.marked THEN FALSE
       WHEN e.marked AND NOT e.c RLIKE r'^[.!?]' THEN TRUE
       WHEN e.c RLIKE r'^[,;(-]' THEN TRUE
       WHEN l.inside >= {frequent} AND l.terminal <= 1 + IF(l.running, {share}, {short}) * l.inside THEN TRUE
       WHEN coalesce(g.longer, 0L) >= 4 AND coalesce(g.longer, 0L) > IF(e.c = 'N', 0, 4) * l.inside AND s.ends <= 1 + {share} * g.longer THEN TRUE
       ELSE FALSE END AS cut
FROM {kinds} e JOIN last_inside l ON e.a = l.a AND e.b = l.b AND e.c = l.c AND e.running = l.running
LEFT JOIN beginnings g ON e.a = g.a AND e.b = g.b AND e.last_raw = g.beginning
LEFT JOIN seen s ON e.a = s.a AND e.b = s.b AND e.last_raw = s.last_raw AND e.c = s.c
"""


def endings(docs: DataFrame, frequent: int = FREQUENT, share: float = TERMINAL_SHARE) -> DataFrame:
    """A row for each document with a word: its last three words in classes, how often they stand inside texts and at
    ends, how often longer words with the same beginning stand in their place (longer), whether a mark of a cut follows
    (marked), and whether the text was cut (cut).

    Cut are: a marked text that doesn't end a sentence; one whose last trigram is frequent inside and almost never
    terminal; one whose last word only begins a word that is frequent there. A text that ends a sentence is whole. Null,
    empty and blank texts have no ending and no row. Exact copies count once at ends and get the same verdict.
    """
    spark = docs.sparkSession
    tokens = written(spark.sql(TOKENS.replace("{mark}", MARK.replace("{", "{{").replace("}", "}}")), docs=docs.select("doc_id", "source", "text")))
    counted = cut(spark.sql(COUNTED, tokens=tokens))
    starters = cut(spark.sql(STARTERS, counted=counted, share=STARTER_SHARE))
    inside = cut(spark.sql(CLASSED.replace("{key}", "").replace("{value}", "sum(inside) AS inside").replace("{group}", "GROUP BY 1, 2, 3"), rows=counted, starters=starters))
    ends = cut(spark.sql(CLASSED.replace("{key}", "doc_id, source, copy, marked, last_raw, running,").replace(", {value}", "").replace("{group}", ""), rows=spark.sql(ENDS, tokens=tokens), starters=starters))
    # endings of one kind get one verdict, and kinds that many texts share don't meet them in one task
    verdicts = cut(spark.sql(JUDGED, ends=ends, inside=inside, kinds=cut(spark.sql(KINDS, ends=ends)), frequent=frequent, share=share, short=SHORT_SHARE))
    rows = ends.withColumn("kind", F.xxhash64("a", "b", "c", "last_raw", "running", "marked"))
    return split_join(rows, verdicts, "kind", "inner").select("doc_id", "source", "marked", "a", "b", "c", "last_raw", "inside", "terminal", "longer", "cut")


def truncated(docs: DataFrame) -> DataFrame:
    """doc_id of each cut text."""
    return endings(docs).where("cut").select("doc_id").distinct()


def truncation_report(docs: DataFrame) -> DataFrame:
    """source, n_texts, n_cut, share_cut of each source, over texts with at least a word; a null source is one of its own."""
    return docs.sparkSession.sql(
        "SELECT source, count(*) AS n_texts, count_if(cut) AS n_cut, round(count_if(cut) / count(*), 4) AS share_cut FROM {e} GROUP BY source", e=endings(docs)
    )
