"""Text expressions: redaction by patterns, lexical gate, sections, rules, JSON out of prose. All JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill import params


def redacted(text: Column, patterns: tuple[tuple[str, str], ...] = params.REDACTIONS) -> Column:
    """The text with each pattern's matches replaced in turn by [REDACTED_<LABEL>]."""
    for label, p in patterns:
        text = F.regexp_replace(text, p, f"[REDACTED_{label}]")
    return text


def redaction_count(text: Column, patterns: tuple[tuple[str, str], ...] = params.REDACTIONS) -> Column:
    """How many matches are replaced, each pattern counted on what the earlier ones left."""
    n = F.lit(0)
    for label, p in patterns:
        n = n + F.regexp_count(text, F.lit(p))
        text = F.regexp_replace(text, p, f"[REDACTED_{label}]")
    return n


def phrase_text(text: Column) -> Column:
    """The text's words in lower case, blanks around each: a phrase is in it whatever stands between its words."""
    return F.concat(F.lit(" "), F.array_join(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+(?:['’.][\p{L}\p{N}_]+)*"), F.lit(0)), " "), F.lit(" "))


def matches_vocabulary(text: Column, terms: tuple[str, ...] = params.TRIGGERS) -> Column:
    """True if any term stands in the text as whole words in order; null texts match nothing."""
    words = phrase_text(text)
    hit = F.lit(False)
    for t in terms:
        hit = hit | F.contains(words, F.lit(f" {t.lower()} "))
    return F.coalesce(hit, F.lit(False))


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def heading_pattern(headings: tuple[str, ...] = params.HEADINGS) -> str:
    return r"(?im)^[ \t\r]*(" + "|".join(headings) + r")[ \t]*:?[ \t\r]*$"


def sections(text: Column, headings: tuple[str, ...] = params.HEADINGS) -> Column:
    """Array of {section_name, text}: bodies after headings that stand alone on their line.

    What precedes the first heading, and empty bodies, are left out; without any heading the whole text, as it is, is the
    section `unstructured`. Null gives null.
    """
    p = heading_pattern(headings)
    heads = F.regexp_extract_all(text, F.lit(p), F.lit(1))
    bodies = F.split(text, p, -1)
    named = F.zip_with(heads, F.slice(bodies, 2, F.greatest(F.size(heads), F.lit(1))), lambda h, b: F.struct(F.regexp_replace(F.lower(h), " ", "_").alias("section_name"), stripped(F.coalesce(b, F.lit(""))).alias("text")))
    whole = F.array(F.struct(F.lit("unstructured").alias("section_name"), text.alias("text")))
    return F.when(text.isNotNull(), F.when(F.size(heads) > 0, F.filter(named, lambda s: s["text"] != "")).otherwise(whole))


def relevant(chunks: Column, names: tuple[str, ...]) -> Column:
    """Sections of these names, or all if there are none."""
    mine = F.filter(chunks, lambda s: s["section_name"].isin(*names))
    return F.when(F.size(mine) > 0, mine).otherwise(chunks)


def mentions(text: Column, terms: tuple[str, ...]) -> Column:
    """True if any term is a part of the text, in lower case."""
    hit = F.lit(False)
    for t in terms:
        hit = hit | F.contains(F.lower(text), F.lit(t))
    return F.coalesce(hit, F.lit(False))


def json_in(text: Column) -> Column:
    """What stands from the first { to the last }, null if there is none."""
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))
