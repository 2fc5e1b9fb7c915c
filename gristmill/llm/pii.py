"""Problem 5: personal details in free text, replaced by typed placeholders with format-preserving pseudonyms.

Details are found by their format and check digits; names by given names and titles, and by the words beside which names
stand in this corpus: those are learned, and so are given names that no list has. Numbers and dates of birth are permuted
within their format by a keyed Feistel network, valid ones to valid ones; other details are named by a keyed hash. Equal
values get equal placeholders in all documents.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import hmac
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm import scans
from gristmill.llm.scans import PAGE_IN, PAGE_LINE
from gristmill.sources.tables import cut

#: Titles, and common given names, from which contexts are learned; both are parameters.
TITLES = ("Dr", "Mr", "Mrs", "Ms", "Prof", "Ing", "Herr", "Frau", "Mme", "Sr", "Sra")
GIVEN_NAMES = tuple(
    "Adam Ahmed Alan Alex Alice Amira Amy Andrea Andrew Anna Anne Antonio Astrid Barbara Ben Bernard Bruno Carla Carlos Carmen Carol Caroline Charles "
    "Chen Christine Clara Claire Daniel David Diana Diego Edward Elena Elias Elizabeth Emil Emily Emma Eric Erik Eva Fatima Felix Fiona Francois Frank "
    "Fritz George Grace Greta Hanna Hannah Hans Harry Heinrich Helen Helena Henrik Henry Hugo Ibrahim Ines Ingrid Irene Isabel Ivan Jack Jacob James Jan "
    "Jane Javier Jean Jennifer Johan John Jonas Jorge Jose Joseph Juan Julia Julian Karen Karin Karl Kate Laura Lars Leila Lena Leon Linda Lisa Louis Lucas "
    "Lucia Luis Luke Magnus Marcus Maria Marie Mark Marta Martin Mary Matthew Maya Michael Miguel Mohamed Monica Nadia Nicole Nina Nora Oliver Olga Omar "
    "Oscar Otto Pablo Patricia Paul Pavel Peter Petra Philip Pierre Priya Rachel Raj Ravi Richard Robert Rosa Ruth Samir Samuel Sandra Sara Sarah Sofia "
    "Sophie Simon Stefan Stephen Susan Sven Tariq Teresa Thomas Tom Ursula Victor Vera Walter Yasmin Yusuf Zoe".split()
)
#: What follows or precedes the name of a street.
STREETS = "Street|Road|Lane|Drive|Avenue|Court|Boulevard|Square|Way|Terrace|Close"
STREETS_SHORT = "St|Rd|Ln|Ave|Ct|Blvd"
STREETS_BEFORE = "rue|avenue|boulevard|place|Calle|Avenida|Plaza|Via|Rue"
#: Words after which a date of birth stands.
BORN = r"(?:born(?:\s+on)?|date\s+of\s+birth:?|geb\.|geboren\s+am|née?\s+le)"
#: Words beside a name are a context if they stand beside at least LEAST known names, this share of all such, and if KNOWN of the pairs of capitalised words there are known names; a given name is learned from NAMES places in contexts, and that share of them. So at most 1 / SHARE of each are learned.
LEAST, SHARE, KNOWN, NAMES = 5, 0.001, 0.9, 3

_HY = r"(?:[-‐¬\xad]\s*\n\s*)?"
_S = r"[^\S\n]?\n?[^\S\n]?"  # one space, or a line's end
_W = r"[^\W\d_]"


#: Two capitalised words that may be a name, an initial between them; of three, both pairs.
PAIR = re.compile(r"\b(?=([A-ZÀ-Þ][\w!|]+(?:\s+[A-Z]\.)?\s+[A-ZÀ-Þ][\w!|]+(?:-[A-ZÀ-Þ]\w+)?))")


def beside(text: str, begin: int, end: int) -> tuple[str, ...]:
    """The two words before a place and the two after it, in lower case, marked by side; none where fewer stand there."""
    before, after = text[max(0, begin - 40) : begin].lower().split()[-2:], text[end : end + 40].lower().split()[:2]
    return (*(("< " + " ".join(before),) if len(before) == 2 and text[begin - 1 : begin].isspace() else ()), *(("> " + " ".join(after),) if len(after) == 2 else ()))


def luhn(value: str) -> bool:
    """Whether the digits' check digit is right."""
    d = [int(c) for c in value if c.isdigit()][::-1]
    return (sum(d[::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])) % 10 == 0


def mod97(value: str) -> bool:
    """Whether the check digits of an international account number are right."""
    v = "".join(value.split())
    return 15 <= len(v) <= 34 and int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


def valid(value: str, kind: str) -> bool:
    """Whether a number keeps the rules of its format: check digits, areas and groups that are given out, lengths."""
    d = "".join(c for c in value if c.isdigit())
    if kind == "card_number":
        return luhn(value)
    if kind == "account_number":
        return mod97(value)
    if kind == "identity_number" and re.fullmatch(r"\d{3}\D\d{2}\D\d{4}", value):
        return not (d[:3] in {"000", "666"} or d[0] == "9" or d[3:5] == "00" or d[5:] == "0000")
    if kind == "identity_number" and re.fullmatch(r"\d{6}-\d{4}", value):
        return luhn(value)
    return True


def learn_names(df: DataFrame, text: str = "text", given: tuple[str, ...] = GIVEN_NAMES, titles: tuple[str, ...] = TITLES) -> tuple[list[str], list[str]]:
    """(contexts, given names) of the corpus. Pairs of capitalised words are counted by what stands beside them; where nearly
    all are known names, by their first word or a title before, the rest are names as well, and their first words given names.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            counts = Counter((c, m.group(1).split()[0]) for t in pdf["text"] for m in PAIR.finditer(t) for c in beside(t, *m.span(1)))
            yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["context", "first", "n"])

    counts = df.where(F.length(text) > 0).select(F.col(text).alias("text")).mapInPandas(run, "context string, first string, n long").groupBy("context", "first").agg(F.sum("n").alias("n"))
    counts = cut(counts)
    known = F.col("first").isin(*given) | F.col("first").isin(*(g.upper() for g in given)) | F.col("context").rlike(rf"^< .*\b(?:{'|'.join(t.lower() for t in titles)})\.?$")
    per = counts.groupBy("context").agg(F.sum(F.when(known, F.col("n")).otherwise(0)).alias("known"), F.sum("n").alias("n"))
    total = per.agg(F.coalesce(F.sum("known"), F.lit(0))).first()[0]
    good = cut(per.where((F.col("known") >= max(LEAST, SHARE * total)) & (F.col("known") >= KNOWN * F.col("n"))).select("context"))
    names = counts.join(F.broadcast(good), "context").where(~F.col("first").isin(*given)).groupBy("first").agg(F.sum("n").alias("n")).where((F.col("n") >= max(NAMES, SHARE * total)) & F.col("first").rlike(r"^\p{Lu}\p{Ll}+$"))
    return sorted(r.context for r in good.collect()), sorted(r["first"] for r in names.select("first").collect())


class Finder:
    """Finds details of five kinds in a text, without overlaps, in order of place."""

    def __init__(self, given: tuple[str, ...] = GIVEN_NAMES, titles: tuple[str, ...] = TITLES, contexts: frozenset[str] = frozenset()):
        self.contexts = contexts
        names = "|".join(sorted(given, key=len, reverse=True))
        cap = rf"[A-ZÀ-Þ][a-zà-ÿ]+{_HY}[a-zà-ÿ]*"
        surname = rf"{cap}(?:-{_S}{cap})?"
        initial = rf"(?:[\s]+[A-Z]\.)?"
        title = rf"(?:(?:{'|'.join(titles)})\.?\s+)"
        upper = r"[A-ZÀ-Þ]{3,}(?:-[A-ZÀ-Þ]{2,})?"
        self.email = re.compile(
            rf"(?<!\w)[^\W_][\w.+-]*(?:\s*(?:\(at\)|\[at\])\s*|\s?@\s?)(?:{_W}|\d)[\w-]*(?:(?:\.{_HY}|\s*(?:\[dot\]|\(dot\))\s*)\w[\w-]*)+"
            rf"|(?<!\w)[^\W_][\w.+-]*\s+at\s+\w[\w-]*(?:\s+dot\s+\w[\w-]*)+",
            re.I,
        )
        self.phone = re.compile(
            r"(?<![\w.-])(?:\+\d{1,3}[ .\n-]?\(?\d{2,4}\)?[ ./\n-]\d{3,4}[ .\n-]?\d{3,4}|00\d{1,3}[ \n]\d{2,4}[ \n]\d{6,8}|0\d{2,4}[ \n]\d{3,4}[ \n]\d{3,4}"
            r"|\(\d{3,4}\)[ \n]?\d{3}[ .\n-]\d{4}|\d{3}[/. \n-]\d{3}[. \n-]\d{4})(?:[ \n]?(?:ext\.?|x)[ \n]?\d{1,5})?(?![\w-]|\.\d)"
        )
        self.identity = re.compile(
            r"(?<![\w.-])(?:\d{3}([- \n])\d{2}[- \n]\d{4}|\d{2}-\d{7}|\d{6}-\d{4}|\d{2}[ \n]\d{3}[ \n]\d{3}[ \n]\d{3}|[A-Z]{2}\d{7})(?![\w-]|[.,]\d| \d{3}\b)"
        )
        self.street = re.compile(
            rf"(?:(?:Flat|Apt\.?|Unit|Suite)\s+\d+\w?,\s+)?(?<!/ )\b\d{{1,5}}[a-z]?(?:-\d{{1,5}}[a-z]?)?\s+(?:(?:North|South|East|West|Old|New|Upper|Lower)\s+)?{cap}(?:[ \n]{cap})?[ \n](?:(?:{STREETS})\b|(?:{STREETS_SHORT})\b\.?)(?:,\s+(?:Flat|Apt\.?|Unit|Suite)\s+\d+)?"
            rf"|\b\d{{1,5}}[a-z]?,?\s+(?:{STREETS_BEFORE})\s+(?:(?:du|de|des|la|le|les)\s+)*{cap}|\b(?:rue|Rue|Calle|Avenida|Plaza|Via)\s+(?:(?:du|de|del|la)\s+)*{cap},?\s+\d{{1,5}}[a-z]?\b"
            rf"|\b[A-ZÀ-Þ][a-zà-ÿ]+{_HY}[a-zà-ÿ]*?(?:str{_HY}a{_HY}(?:ss|ß)e|weg|gasse|platz)\s+\d{{1,5}}[a-z]?\b"
        )
        self.name = re.compile(
            rf"\b(?=[A-ZÀ-Þ])(?:(?:\b{title})?\b(?:{names})\b{initial}\s+{surname}|\b{title}(?:[A-Z]\.\s+)*{surname}(?:\s+(?:[A-Z]\.\s+)?{surname})?"
            rf"|\b(?:{title})?{upper},\s+(?:{names}|[A-Z]\.)(?:\b|(?<=\.))(?:\s+[A-Z]\.)?|\b(?:{names.upper()})\s+{upper})"
        )
        self.pair = PAIR
        self.card = re.compile(r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-]|[.,]\d)")
        self.account = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
        self.birth = re.compile(rf"\b{BORN}\s+(\d{{4}}-\d{{2}}-\d{{2}}|\d{{1,2}}[./]\d{{1,2}}[./]\d{{4}})(?!\d)", re.I)
        self.known = {*given, *(g.upper() for g in given), *titles}
        self.capital = re.compile(r"\b[A-ZÀ-Þ][A-Za-zÀ-ÿ]+")
        self.digits = re.compile(r"\d[\d ./)\n-]{6,}\d|\b[A-Z]{2}\d{7}\b")
        self.obfuscated = re.compile(r"[(\[]at[)\]]|\bdot\b", re.I)
        self.company = re.compile(r"\b(?:Works|Services|Systems|Supply|Storage|Ltd|Inc|LLC|plc|GmbH|SA|BV|Oy)$")
        self.roads = tuple(f"{s}{end}" for s in STREETS.split("|") for end in (" ", ",", ".", "\n")) + tuple(f"{b}{s}" for s in STREETS_SHORT.split("|") for b in (" ", "\n")) + ("rue", "Rue", "avenue", "boulevard", "place ", "Calle", "Avenida", "Plaza", "Via", "str", "weg ", "gasse ", "platz ")

    def find(self, text: str) -> list[tuple[int, int, str]]:
        found: list[tuple[int, int, str]] = []
        taken = bytearray(len(text))

        def take(kind: str, pattern: re.Pattern, group: int = 0, valid=None) -> None:
            for m in pattern.finditer(text):
                b, e = m.span(group)
                if valid and not valid(m.group(group)):
                    continue
                if not any(taken[b:e]) and not (kind == "name" and self.company.search(m.group(group))):
                    taken[b:e] = b"\1" * (e - b)
                    found.append((b, e, kind))

        if "@" in text or self.obfuscated.search(text):
            take("email", self.email)
        if self.digits.search(text):
            take("phone", self.phone)
            take("identity_number", self.identity)
            take("card_number", self.card, valid=luhn)
            take("account_number", self.account, valid=mod97)
        if any(map(text.__contains__, self.roads)):
            take("street_address", self.street)
        if not self.known.isdisjoint(self.capital.findall(text)):
            take("name", self.name)
        if self.contexts:
            for m in self.pair.finditer(text):
                b, e = m.span(1)
                if not self.contexts.isdisjoint(beside(text, b, e)):
                    # words that also stand in lower case here are no names
                    if not any(taken[b:e]) and not self.company.search(m.group(1)) and not any(re.search(rf"\b{re.escape(w.lower())}\b", text) for w in m.group(1).split()):
                        taken[b:e] = b"\1" * (e - b)
                        found.append((b, e, "name"))
        if "born" in text or "birth" in text or "geb" in text or "née" in text:
            take("date_of_birth", self.birth, 1)
        return sorted(found)


def interruptions(text: str, titles: scans.Titles | None) -> list[tuple[int, int]]:
    """Where running titles, by their shapes, and page numbers stand that may part a detail, with the blank or line end after each."""
    out, at, shaped = [], 0, titles.of(text.lower()) if titles else []
    if "\n" in text:
        for line in text.split("\n"):
            if 0 < len(line) < 24 and (line[-1].isdigit() or line[-1] in "]- \r") and PAGE_LINE.match(line) or any(p.fullmatch(line.strip()) for p in shaped):
                out.append((at, min(len(text), at + len(line) + 1)))
            at += len(line) + 1
    else:
        out = [m.span() for m in PAGE_IN.finditer(text)] + [m.span() for p in shaped for m in p.finditer(text)]
        out = [(b, min(len(text), e + (text[e : e + 1] == " "))) for b, e in sorted(out) if not b or text[b - 1] == " "]
        out = [x for i, x in enumerate(out) if not i or x[0] >= out[i - 1][1]]
    return out


def find_across(text: str, finder: Finder, titles: scans.Titles | None = None) -> list[tuple[int, int, str, str, str]]:
    """(begin, end, kind, value, what interrupts it) of each detail, those parted by what the page left included."""
    found = [(b, e, k, text[b:e], "") for b, e, k in finder.find(text)]
    cuts = interruptions(text, titles)
    if not cuts:
        return found
    kept, places = [], []
    for b, e in zip([0, *(e for _, e in cuts)], [*(b for b, _ in cuts), len(text)]):
        kept.append(text[b:e])
        places += range(b, e)
    joined = "".join(kept)
    for b, e, kind in finder.find(joined):
        begin, end = places[b], places[e - 1] + 1
        if end - begin > e - b and not any(x[0] < end and begin < x[1] for x in found):
            found.append((begin, end, kind, joined[b:e], " " + " ".join(text[x:y].strip() for x, y in cuts if begin < x < end)))
    return sorted(found)


def feistel(number: int, size: int, key: bytes, tweak: bytes, rounds: int = 8) -> int:
    """A keyed permutation of 0 .. size - 1 (cycle walking over an even number of bits)."""
    half = max(1, (max(2, size) - 1).bit_length() + 1 >> 1)
    mask = (1 << half) - 1
    while True:
        left, right = number >> half, number & mask
        for r in range(rounds):
            h = hmac.new(key, tweak + bytes([r]) + right.to_bytes(8, "big"), hashlib.sha256).digest()
            left, right = right, left ^ (int.from_bytes(h[:8], "big") & mask)
        number = left << half | right
        if number < size:
            return number


def permuted(value: str, kind: str, key: bytes) -> str:
    """`value` with its digits permuted as one number and its upper-case letters as another; all else stays in place. A valid number gives a valid one, another another: the permutation is walked until it is back in its class."""
    was = valid(value, kind)
    while True:
        value = permuted_once(value, kind, key)
        if valid(value, kind) == was:
            return value


def permuted_once(value: str, kind: str, key: bytes) -> str:
    digits, letters = re.findall(r"\d", value), re.findall(r"[A-Z]", value)
    tweak, new = f"{kind}:{len(digits)}:{len(letters)}".encode(), {}
    for alphabet, chars in (("0123456789", digits), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", letters)):
        if not chars:
            continue
        n = 0
        for c in chars:
            n = n * len(alphabet) + alphabet.index(c)
        n, out = feistel(n, len(alphabet) ** len(chars), key, tweak), []
        for _ in chars:
            n, r = divmod(n, len(alphabet))
            out.append(alphabet[r])
        new[alphabet] = iter(out[::-1])
    return "".join(next(new["0123456789"]) if "0" <= c <= "9" else next(new["ABCDEFGHIJKLMNOPQRSTUVWXYZ"]) if "A" <= c <= "Z" else c for c in value)


#: Dates of birth are permuted among the days from here on, so many of them.
FIRST_DAY, DAYS = dt.date(1900, 1, 1), 47_482


def permuted_date(value: str, key: bytes) -> str | None:
    """A date permuted among all days of 1900 to 2029, in its own form; None if it is none of them."""
    parts = [int(x) for x in re.findall(r"\d+", value)]
    year_first = len(re.match(r"\d+", value).group()) == 4
    try:
        at = (dt.date(*parts) if year_first else dt.date(*parts[::-1])) - FIRST_DAY
    except ValueError:
        return None
    if not 0 <= at.days < DAYS:
        return None
    new = FIRST_DAY + dt.timedelta(days=feistel(at.days, DAYS, key, b"date"))
    fields = iter((new.year, new.month, new.day) if year_first else (new.day, new.month, new.year))
    return re.sub(r"\d+", lambda m: str(next(fields)).zfill(len(m.group()) if len(m.group()) > 1 else 1), value)


def placeholder(value: str, kind: str, key: bytes) -> str:
    """The typed placeholder of a value: [PHONE +44 20 8315 0912], [NAME 5f0c2a91]. Letter case and line ends don't matter to it."""
    plain = " ".join(value.split())
    if kind == "date_of_birth" and (new := permuted_date(plain, key)):
        return f"[DATE_OF_BIRTH {new}]"
    if kind in {"phone", "identity_number", "card_number", "account_number"} and len(re.findall(r"\d", plain)) <= 38:
        return f"[{kind.upper()} {permuted(plain, kind, key)}]"
    named = re.sub(r"\s*(?:\(at\)|\[at\])\s*", "@", re.sub(r"\s*(?:\(dot\)|\[dot\])\s*", ".", plain.lower()))
    return f"[{kind.upper()} {hmac.new(key, f'{kind}:{named}'.encode(), hashlib.sha256).hexdigest()[:8]}]"


def redact_text(text: str | None, finder: Finder, key: bytes, titles: scans.Titles | None = None) -> tuple[str | None, list[str]]:
    if not text:
        return text, []
    out, at, kinds = [], 0, []
    for b, e, kind, value, within in find_across(text, finder, titles):
        out += [text[at:b], placeholder(value, kind, key), within]
        at = e
        kinds.append(kind)
    return "".join(out) + text[at:], kinds


def learned(df: DataFrame, text: str = "text") -> tuple[list[tuple[str, str]], list[str], list[str]]:
    """(shapes of running titles that may part a detail, contexts of names, given names), all as the corpus itself shows them."""
    return (scans.shapes(cut(scans.titles(df))) if {"file_id", "text"} <= set(df.columns) else [], *learn_names(df, text))


def redact(df: DataFrame, key: bytes, columns: tuple[str, ...] = ("text", "full_section_text")) -> DataFrame:
    """`df` with each of `columns` redacted under the caller's secret `key` and, for each, `<column>_kinds`: the kind of each detail, in order.

    Null stays null, with no kinds; empty texts stay as they are. Everything outside the details is unchanged. No text is
    shuffled; columns of the added names are replaced, all others stay. Contexts of names come from the first column.
    """
    patterns, contexts, given = learned(df, columns[0])
    made = ", ".join(f"t{i}: string, k{i}: array<string>" for i in range(len(columns)))

    @F.pandas_udf(f"struct<{made}>")
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:  # one column comes as a bare series
        finder, titles = Finder((*GIVEN_NAMES, *given), contexts=frozenset(contexts)), scans.Titles(patterns)
        for series in batches:
            rows = []
            for texts in zip(*series) if isinstance(series, tuple) else zip(series):
                row: list = []
                for i, t in enumerate(texts):
                    # a text that ends in one already done, after a line of its own, needs only that line looked at
                    done = next((j for j in range(i) if t and texts[j] and t.endswith(texts[j]) and (len(t) == len(texts[j]) or t[-len(texts[j]) - 1] == "\n")), None)
                    if done is None:
                        row += redact_text(t, finder, key, titles)
                    else:
                        head, kinds = redact_text(t[: len(t) - len(texts[done])], finder, key, titles)
                        row += (head + row[2 * done], kinds + row[2 * done + 1])
                rows.append(row)
            yield pd.DataFrame(rows, columns=[x for i in range(len(columns)) for x in (f"t{i}", f"k{i}")])

    df = df.withColumn("__r", run(*map(F.col, columns)))
    return df.withColumns({x: y for i, c in enumerate(columns) for x, y in ((c, F.col(f"__r.t{i}")), (f"{c}_kinds", F.col(f"__r.k{i}")))}).drop("__r")


def details(chunks: DataFrame, kinds: tuple[str, ...] = ("name", "email", "phone", "identity_number", "street_address")) -> DataFrame:
    """id, kind: each of `kinds` that the text of the chunk has, once, as redact finds them."""
    patterns, contexts, given = learned(chunks)

    @F.pandas_udf("array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder, titles = Finder((*GIVEN_NAMES, *given), contexts=frozenset(contexts)), scans.Titles(patterns)
        for texts in batches:
            yield pd.Series([sorted({x[2] for x in find_across(t, finder, titles)} & set(kinds)) if t else [] for t in texts], dtype=object)

    found = chunks.select("id", run.asNondeterministic()(F.col("text")).alias("kinds"))  # else Spark calls it again in a filter on its size
    return found.select("id", F.explode("kinds").alias("kind")).distinct()
