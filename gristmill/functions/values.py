"""Reading dirty cells: what stands for no value, spellings of keys and values, dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words and marks that stand for no value, in lower case and trimmed.
NO_VALUE = ("", "-", "--", "?", "n/a", "na", "#n/a", "nan", "null", "none", "nil", "unknown", "not provided", "not available", "not known", "missing", "pending", "tbd", "tbc", "undefined")
#: Numbers that stand for no value.
NO_NUMBER = (-1, 0, -999, -9999, 999999, 9999999)
#: An identifier none of whose digits or letters tells one thing from another: all zeros, all nines or all X behind its prefix.
BLANK_IDENTIFIER = r"^(?:[a-z]{1,5}[-/ ]?)?(?:0{3,}|9{4,}|x{3,})$"
#: An identifier stands for none if at least this many keys hold it, and this share of all keys that hold any.
SHARED_KEYS, SHARED_SHARE = 20, 0.01

#: Blanks that may stand around a value.
BLANKS = " \t\n\r\f\v\u00a0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u200b\u202f\u205f\u3000\ufeff"


def spelled(c: Column) -> Column:
    """The cell in lower case without blanks of any kind at its ends or doubled inside."""
    t = F.btrim(F.lower(c.cast("string")), F.lit(BLANKS))
    return F.when(F.contains(t, F.lit("  ")), F.regexp_replace(t, r"\s{2,}", " ")).otherwise(t)


def has_text(c: Column) -> Column:
    """True if a text cell holds a value; null counts as none."""
    return F.coalesce(~spelled(c).isin(*NO_VALUE), F.lit(False))


def has_identifier(c: Column, shared: tuple[str, ...] = ()) -> Column:
    """True if a text cell holds an identifier: neither a word for no value nor blank digits, nor one of `shared`, spelled as shared_identifiers gives them."""
    s = spelled(c)
    return F.coalesce(~s.isin(*NO_VALUE, *shared) & ~s.rlike(BLANK_IDENTIFIER), F.lit(False))


def shared_identifiers(df: DataFrame, column: str, key: str) -> tuple[str, ...]:
    """Values of an identifier column, spelled, that far more keys hold than any real one: they only stand for no value.

    A real identifier belongs to one key and a few spellings of it. Each value found is held by SHARED_SHARE of the keys,
    so what comes to the driver is bounded by the values a key has, over SHARED_SHARE. A null column or key counts for nothing.
    """
    keys = df.where(F.col(key).isNotNull()).agg(F.approx_count_distinct(key, 0.01)).first()[0]
    pairs = df.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), spelled(F.col(column)).alias("v")).where(F.col("v").isNotNull() & ~F.col("v").isin(*NO_VALUE)).distinct()
    held = pairs.groupBy("v").agg(F.count("*").alias("n")).where(F.col("n") >= max(SHARED_KEYS, SHARED_SHARE * keys))
    return tuple(sorted(r.v for r in held.collect()))


def has_number(c: Column) -> Column:
    """True if a numeric cell holds a value: not null, not NaN, none of the numbers that stand for no value."""
    d = c.cast("double")
    return F.coalesce(~F.isnan(d) & ~d.isin(*map(float, NO_NUMBER)), F.lit(False))


def plain_key(c: Column) -> Column:
    """A vendor key in upper case without anything but letters and digits."""
    return F.upper(F.regexp_replace(c, r"[^\p{L}\p{N}]", ""))


#: First letters of English months.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def date_of(c: Column) -> Column:
    """The date in a text cell, day before month unless the year comes first; a time after it is left out; null if there is none.

    Cells are put into ISO order by their form and cast; parsing by formats would raise inside for each that fails.
    """
    t = F.regexp_replace(F.trim(c), r"(?<=\d)[T ]\d{2}:\d{2}.*$", "")
    month = F.create_map(*(x for i, m in enumerate(MONTHS, 1) for x in (F.lit(m), F.lit(f"{i:02d}"))))
    named = F.concat(F.regexp_extract(t, r"(\d{4})$", 1), F.lit("-"), F.try_element_at(month, F.lower(F.regexp_extract(t, r" ([A-Za-z]{3})", 1))), F.lit("-"), F.regexp_extract(t, r"^(\d{1,2})", 1))
    iso = (
        F.when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), t).when(t.rlike(r"^\d{4}[/.]\d{1,2}[/.]\d{1,2}$"), F.regexp_replace(t, r"[/.]", "-"))
        .when(t.rlike(r"^\d{1,2}[./-]\d{1,2}[./-]\d{4}$"), F.regexp_replace(t, r"^(\d{1,2})[./-](\d{1,2})[./-](\d{4})$", "$3-$2-$1"))
        .when(t.rlike(r"^\d{1,2} [A-Za-z]{3,9} \d{4}$"), named)
    )
    return iso.try_cast("date")
