"""Problem 6: repairing text from scanned pages.

Skip-gram vectors of the corpus' frequent words are trained by Spark. A rare word is linked to frequent words that differ
from it by glyphs that scanners take for one another; at each place where it stands, the linked word whose vector fits the
words around it takes its place. Running titles are lines that come again in a file; their common shapes, learned over all
files, also find titles that a file shows once. Hyphenated words are joined where the joined word is known.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import StopWordsRemover, Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.sources.tables import cut, spread, written

#: Glyphs as misread, and what may have stood there.
MISREAD = (
    ("1", "l"), ("1", "i"), ("!", "i"), ("!", "l"), ("|", "l"), ("|", "i"), ("0", "o"), ("5", "s"), ("6", "b"), ("9", "g"), ("8", "b"), ("c", "e"), ("e", "c"),
    ("l", "i"), ("i", "l"), ("f", "t"), ("t", "f"), ("rn", "m"), ("m", "rn"), ("ii", "u"), ("u", "ii"), ("li", "h"), ("h", "li"), ("cl", "d"), ("d", "cl"), ("vv", "w"), ("w", "vv"), ("ri", "n"), ("n", "ri"), ("o", "a"), ("a", "o"), ("b", "h"), ("h", "b"), ("v", "y"), ("y", "v"), ("q", "g"), ("g", "q"), ("o", "c"), ("c", "o"), ("n", "u"), ("u", "n"),
)
#: A frequent word stands at least this often, and this many times as often as the rare word that is linked to it.
FREQUENT, RATIO = 12, 15
#: Entries of a dictionary that tasks may hold; beyond that it is joined.
HELD = 200_000
#: Words with a vector, the most frequent ones: the bound of what training holds and tasks get; length of a vector, words of its window.
VOCABULARY, LENGTH, WINDOW = 60_000, 16, 2
#: Words from this share of all places on are function words, at most 1 / COMMON of them: they stand beside anything, so vectors leave them out.
COMMON = 0.002
#: Words on both sides of a place that a linked word has to fit.
AROUND = 4
#: How near to the words around it a linked word must be, as a cosine.
FITTING = 0.0
#: A word of titles is part of their shape if it stands in titles of at least this share of files with one, and a shape counts if at least SHAPE_SHARE of them, and two, have it: so there are at most 1 / SHAPE_SHARE shapes.
WORD_SHARE, SHAPE_SHARE = 0.05, 0.01

WORD = re.compile(r"[\w!|'’-]+")
EDGES = "!|'’-_"
#: Where a word was parted: a hyphen at a line's end, or with the break gone a space or an end-of-line hyphen left.
PARTED = re.compile(r"[-‐¬\xad](?<=[^\W_].)(?:[^\S\n]*\n\s*(?=[a-zà-ÿ!|0-9]*[a-zà-ÿ])|(?<!-) ?(?=[a-zà-ÿ])|(?<=-) (?!and\b|or\b|und\b|et\b|ou\b|y\b|bis\b)(?=[a-zà-ÿ]))")
BEFORE, AFTER = re.compile(r"[^\W_]+$"), re.compile(r"[\w!|]+")
NUMBER = re.compile(r"\d+(?:[.,]\d+)*")
#: A digit or mark among letters.
ODD = r"^[a-zà-ÿ]+(?:[015689!|]+[a-zà-ÿ]+)+$"
#: Page numbers on lines of their own, and such as are known by their form anywhere.
PAGE_LINE = re.compile(r"^[^\S\n]*(?:(?:Page|Seite|PAGE|page|p\.|S\.|Pag\.)[^\S\n]?\d{1,4}(?:[^\S\n](?:of|von|/)[^\S\n]\d{1,4})?|-[^\S\n]?\d{1,4}[^\S\n]?-|\[\d{1,4}\]|\d{1,4}(?:[^\S\n]?/[^\S\n]?\d{1,4})?)[^\S\n]*$", re.M)
PAGE_IN = re.compile(r"[PSp\[\d-](?:(?:(?<=P)(?:age|AGE)|(?<=S)(?:eite|EITE)|(?<=p)(?:age|\.)) \d{1,4}(?: (?:of|von|OF) \d{1,4})?|(?<=-) \d{1,4} -|(?<=\[)\d{1,4}\]|(?<=\d)\d{0,3} / \d{1,4})")  # first letters as a set: re looks for those alone
#: Parts of a compound.
PARTS = re.compile(r"[^-’']+")
def rejoined(text: str) -> str:
    return PARTED.sub("", text)


class Tokens(dict):
    """The words of what stands between blanks, in lower case, numbers as 9, a blank behind each: most of it comes again and again."""

    def __missing__(self, chunk: str) -> str:
        self[chunk] = found = "".join([f"{w if w.isalpha() else '9' if w.isdigit() else w.strip(EDGES)} " for w in WORD.findall(chunk)])
        return found


def tokens(text: str, known: Tokens) -> str | None:
    """The words of a text, a blank between two; None if it has none."""
    found = "".join(map(known.__getitem__, text.lower().split()))
    return found[:-1] if found else None


def sentences(chunks: DataFrame) -> DataFrame:
    """words: the words of each text, in lower case, numbers as 9, parted words joined."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            known = Tokens()  # as large as a batch at most
            yield pd.Series([tokens(rejoined(t), known) for t in texts], dtype=object)

    # as one string they come out of Python at less cost; no word has a blank
    joined = chunks.where(F.length("text") > 0).select(run(F.col("text")).alias("joined"))
    return joined.select(F.coalesce(F.split("joined", " "), F.array().cast("array<string>")).alias("words"))


def vectors(texts: DataFrame, words: DataFrame, most: int = VOCABULARY) -> DataFrame:
    """word, vector: skip-gram vectors of the `most` most frequent words that stand FREQUENT times or more, but function words, trained over all texts.

    texts: words (array). words: word, n. Beyond `most` words, the least count that a word needs is raised until so many are left.
    """
    often = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] * COMMON
    least, known = FREQUENT, words.where((F.col("n") >= FREQUENT) & (F.col("n") < often))
    n = known.count()
    if n > most:
        least = int(known.agg(F.percentile("n", 1 - most / n)).first()[0]) + 1
    if not n:
        return texts.sparkSession.createDataFrame([], "word string, vector array<float>")
    common = words.where(F.col("n") >= often).select("word").collect()
    texts = StopWordsRemover(inputCol="words", outputCol="content", stopWords=sorted(r.word for r in common), caseSensitive=True).transform(texts)
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    model = Word2Vec(vectorSize=LENGTH, windowSize=WINDOW, minCount=least, numPartitions=parts, maxIter=1, seed=7, inputCol="content", outputCol="v").fit(texts)
    return model.getVectors().select("word", vector_to_array("vector", "float32").alias("vector"))


def misreadings(word: str) -> set[str]:
    """How a scanner may have read `word`: with one glyph misread, or two of which one became a digit or mark."""

    def once(w: str) -> set[str]:
        return {w[:i] + wrong + w[i + len(right) :] for wrong, right in MISREAD for i in range(len(w) - len(right) + 1) if w.startswith(right, i)}

    first = once(word)
    return (first | {x for w in first if re.search(r"[0-9!|]", w) for x in once(w)}) - {word}


def unread(word: str) -> set[str]:
    """What a word with digits or marks among its letters may have been: each of them taken for a letter."""
    found, done = {word}, set()
    while found:
        w = found.pop()
        if not re.search(r"[0-9!|]", w):
            done.add(w)
            continue
        i = re.search(r"[0-9!|]", w).start()
        found |= {w[:i] + right + w[i + 1 :] for wrong, right in MISREAD if wrong == w[i] and len(done) + len(found) < 256}
    return done


def links(words: DataFrame) -> DataFrame:
    """word, right, n, n_right: each rare word with the words it may be a misreading of. words: word, n.

    These are at least FREQUENT and RATIO times as frequent. A word with digits or marks among its letters is no word, so
    any known word that it may be will do, and itself where none is known.
    """

    def edit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                part = pdf[at : at + 500]
                yield pd.DataFrame([(v, w, n) for w, n in zip(part["right"], part["n_right"]) for v in misreadings(w)], columns=["word", "right", "n_right"])

    def back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(w, n, v) for w, n in zip(pdf["word"], pdf["n"]) for v in unread(w)], columns=["word", "n", "right"])

    most = words.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    rare = words.where((F.col("n") * RATIO <= most) & (F.length("word") >= 3) & F.col("word").rlike(r"[a-zà-ÿ]") & ~F.col("word").rlike(r"^[0-9]+-?[a-z]?$|[-’']"))
    plain = words.where((F.length("word") >= 3) & F.col("word").rlike(r"^[^\W\d_]+$")).select(F.col("word").alias("right"), F.col("n").alias("n_right"))
    near = spread(plain.where(F.col("n_right") >= FREQUENT), "right").mapInPandas(edit, "word string, right string, n_right long").join(rare, "word").where(F.col("n_right") >= F.col("n") * RATIO)
    odd = words.where(F.col("word").rlike(ODD))
    known = odd.mapInPandas(back, "word string, n long, right string").join(plain, "right").where("n_right >= 2")
    found = near.select("word", "right", "n", "n_right").unionByName(known.select("word", "right", "n", "n_right")).distinct()
    return found.unionByName(odd.join(found.select("word").distinct(), "word", "left_anti").select("word", F.col("word").alias("right"), "n", F.col("n").alias("n_right")))


def compounds(words: DataFrame) -> DataFrame:
    """word, joined: hyphenated words, with joined where the word without its hyphen is the known one, else null."""
    hyphened = words.where(F.col("word").rlike(r"^[a-zà-ÿ]{2,}-[a-zà-ÿ]{2,}$")).withColumn("joined", F.regexp_replace("word", "-", ""))
    both = hyphened.join(words.select(F.col("word").alias("joined"), F.col("n").alias("n_joined")), "joined", "left")
    known = F.coalesce(F.col("n_joined"), F.lit(0))
    return both.where((F.col("n") >= 3) | (known >= FREQUENT)).select("word", F.when((known >= FREQUENT) & (known >= F.col("n") * RATIO), F.col("joined")).alias("joined"))


def titles(chunks: DataFrame) -> DataFrame:
    """file_id, title: lines in lower case that stand in two or more different texts of a file, apart from prose and table rows."""
    line = F.trim(F.lower(F.col("line")))
    lines = chunks.where("text is not null and file_id is not null").select("file_id", F.xxhash64("text").alias("copy"), F.explode(F.split("text", "\n")).alias("line"))
    lines = lines.where(F.length("line").between(6, 200) & ~F.col("line").rlike(r"[.;,:]\s*$|^\s*(?:\(?\d+[.)]|[-•*])\s|\|.*\|") & F.col("line").rlike(r"^\s*\p{Lu}"))
    return lines.groupBy("file_id", line.alias("title")).agg(F.countDistinct("copy").alias("texts")).where("texts >= 2").select("file_id", "title")


def shapes(found: DataFrame) -> list[tuple[str, str]]:
    """(words that any such title has, pattern) of the shapes that titles of many files share: their common words in order, numbers as such, and runs of up to five capitalised words in the place of others. found: file_id, title."""
    token = F.regexp_replace(F.col("token"), r"\d+", "9")
    split = found.select("file_id", "title", F.posexplode(F.split("title", " ")).alias("at", "token")).select("file_id", "title", "at", token.alias("token"))
    files = found.agg(F.count_distinct("file_id")).first()[0]
    common = split.groupBy("token").agg(F.count_distinct("file_id").alias("n")).where(F.col("n") >= max(2, WORD_SHARE * files)).select("token", F.lit(True).alias("common"))  # a title has few words, so these are few
    marked = split.join(F.broadcast(common), "token", "left").groupBy("file_id", "title").agg(F.array_sort(F.collect_list(F.struct("at", F.when(F.col("common"), F.col("token")).otherwise("*").alias("token")))).alias("t"))
    shape = F.regexp_replace(F.array_join(F.transform("t", lambda x: x["token"]), " "), r"\*(?: \*)+", "*")
    n = marked.groupBy(shape.alias("shape")).agg(F.count_distinct("file_id").alias("n")).where((F.col("n") >= max(2, SHAPE_SHARE * files)) & F.col("shape").rlike(r"[^* 9]{3}"))
    made = {"*": r"(?-i:[A-ZÀ-Þ])[\w-]*(?: (?-i:[A-ZÀ-Þ])[\w-]*){0,4}"}
    found = n.orderBy(F.desc("n"), F.length("shape").desc(), "shape").collect()
    return [(max(re.split("[*9]", r.shape), key=len), "(?<!\\w)" + " ".join(made.get(t) or r"\d+".join(map(re.escape, t.split("9"))) for t in r.shape.split(" ")) + "(?!\\w)") for r in found]


class Titles:
    """Titles of known shapes in a text; patterns are tried only where their words stand."""

    def __init__(self, patterns: list[tuple[str, str]]):
        self.patterns = [(hint, re.compile(p, re.I)) for hint, p in patterns]

    def of(self, low: str) -> list[re.Pattern]:
        """The patterns that a text, in lower case, may have."""
        return [p for hint, p in self.patterns if hint in low]


def joints(text: str) -> set[str]:
    """Words parted by a hyphen, as compounds."""
    ends = [(BEFORE.search(text, max(0, m.start() - 40), m.start()), AFTER.match(text, m.end())) for m in PARTED.finditer(text)]
    return {f"{a.group()}-{b.group()}".lower() for a, b in ends if a and b}


class Reader:
    """What was learned of a corpus, as tasks hold it: patterns of titles, vectors of words."""

    def __init__(self, patterns: list[tuple[str, str]], words: list[str], rows: np.ndarray):
        self.titles = Titles(patterns)
        self.place = {w: i for i, w in enumerate(words)}
        self.rows = rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9) if len(words) else rows

    def fitting(self, linked: list[tuple[str, int]], around: list[str]) -> str | None:
        """Of the linked words the one that fits the words around best, the more frequent of equals; None if none fits. Where vectors can't tell, the most frequent one."""
        near = [self.place[w] for w in around if w in self.place]
        known = [(right, n) for right, n in linked if right in self.place]
        if not near or not known:
            return max(linked, key=lambda x: (x[1], x[0]))[0]
        context = self.rows[near].sum(axis=0)
        context /= max(float(np.linalg.norm(context)), 1e-9)
        score, _, right = max((float(self.rows[self.place[right]] @ context), n, right) for right, n in known)
        return right if score >= FITTING else None


def needs_mending(word: str, right: dict[str, list[tuple[str, int]]], hyphened: dict[str, str | None]) -> bool:
    """Whether a word in lower case, or a part of it, is linked to others or known without its hyphen."""
    if word in right:
        return True
    return not word.isalnum() and bool("-" in word and hyphened.get(word) or any(x.strip(EDGES) in right for x in PARTS.findall(word)))


def find_traces(text: str, reader: Reader, right: dict[str, list[tuple[str, int]]], hyphened: dict[str, str | None], running: set[str], page: int | None = None, plainly: set[str] | None = None) -> list[tuple[int, int, str, str]]:
    """(begin, end, kind, what to put there) of each trace, in order of place and without overlaps. Where the chunk's page is known, another number is no page number.

    plainly: what stands between blanks, in lower case, and has no word that needs mending by `right` and `hyphened`; more
    of it is put in.
    """
    plainly = set() if plainly is None else plainly
    found: list[tuple[int, int, str, str]] = []
    taken = bytearray(len(text))

    def take(b: int, e: int, kind: str, new: str) -> None:
        if not any(taken[b:e]):
            taken[b:e] = b"\1" * (e - b)
            found.append((b, e, kind, new))

    def of_page(number: str) -> bool:
        return page is None or int(re.search(r"\d+", number).group()) == page

    low = text.lower()
    shaped = reader.titles.of(low)
    if "\n" in text:
        at = 0
        for line in text.split("\n"):
            if running and line.strip().lower() in running or shaped and any(p.fullmatch(line.strip()) for p in shaped):
                take(at, at + len(line), "header", "")
            elif len(line) < 24 and PAGE_LINE.match(line) and of_page(line):
                take(at, at + len(line), "page_number", "")
            at += len(line) + 1
    for title in running:
        b = low.find(title)
        while b >= 0:
            take(b, b + len(title), "header", "")
            b = low.find(title, b + len(title))
    for m in (m for p in shaped for m in p.finditer(text)):
        # a shape with free words, amid a line, could run into what stands beside it
        if "\n" not in text or re.search(r"\d", m.group()) and not re.search(r" [/|] |: ", m.group()):
            take(*m.span(), "header", "")
    for m in PAGE_IN.finditer(text):
        if (not m.start() or text[m.start() - 1].isspace()) and text[m.end() : m.end() + 1].isspace() and of_page(m.group()):
            take(*m.span(), "page_number", "")
    for m in PARTED.finditer(text):
        head, tail = BEFORE.search(text, max(0, m.start() - 40), m.start()), AFTER.match(text, m.end())
        if head is None or tail is None:
            continue
        if m.group()[0] == "-" and "\n" in m.group():
            whole = f"{head.group()}-{tail.group()}".lower()
            if whole in hyphened and hyphened[whole] is None:
                continue
        take(head.start(), tail.end(), "hyphenation", head.group() + tail.group())
    bad = set()
    for chunk in set(low.split()) - plainly:
        here = {w for w in WORD.findall(chunk) if needs_mending(w, right, hyphened)}
        bad |= here
        if not here:
            plainly.add(chunk)
    if bad:
        seen = WORD.findall(low)
        plain = [w.strip(EDGES) for w in seen]
        same_places = len(low) == len(text)  # few letters get longer in lower case
        for k, m in enumerate(WORD.finditer(text)):
            if same_places and seen[k] not in bad:
                continue
            word = m.group().lower()
            if word not in right and word.isalnum():
                continue
            if "-" in word and (joined := hyphened.get(word)):
                take(*m.span(), "hyphenation", m.group().replace("-", ""))
            for part in PARTS.finditer(m.group()) if not word.isalnum() else (m,):
                w = part.group().strip(EDGES).lower()
                if w in right and (part.group()[0].islower() or right[w][0][0] != w) and (new := reader.fitting(right[w], plain[max(0, k - AROUND) : k] + plain[k + 1 : k + 1 + AROUND])):
                    b = part.start() + (m.start() if part is not m else 0) + len(part.group()) - len(part.group().lstrip(EDGES))
                    take(b, b + len(w), "characters", new.upper() if part.group().isupper() else new.capitalize() if part.group()[0].isupper() else new)
    return sorted(found)


def repaired(text: str, found: list[tuple[int, int, str, str]]) -> str:
    """The text with its traces mended: what the page left goes, lines inside a paragraph run on, paragraphs stay apart."""
    out, at = [], 0
    for b, e, _, new in found:
        out += [text[at:b], new]
        at = e
    text = "".join(out) + text[at:]
    text = re.sub(r"(?<=[^\s.!?:;|])\s*\n\s*\n+\s*(?=[a-zà-ÿ])", " ", text)  # a page's end inside a sentence
    text = re.sub(r"(?<=[^\n])\n(?=[^\n\-•*(\d|])(?![^\n]*\|[^\n]*\|)", " ", text)
    return re.sub(r"[^\S\n]{2,}", " ", text).strip()


Learned = tuple[DataFrame, DataFrame, DataFrame, list[tuple[str, str]], DataFrame]


def learn(chunks: DataFrame) -> Learned:
    """(links, compounds, titles, patterns of titles, vectors) of the corpus."""
    texts = written(sentences(chunks))
    words = cut(texts.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")))
    running = cut(titles(chunks))
    return cut(links(words)), cut(compounds(words)), running, shapes(running), cut(vectors(texts, words))


def repair(chunks: DataFrame, text: str = "text", learned: Learned | None = None, whole: str | None = None, page: str | None = None, kinds: bool = False) -> DataFrame:
    """`chunks` with repaired_text, and traces: an array of {kind, was, now} in order; with `whole`, a column that may hold
    the text under its heading, also repaired_<whole> and <whole>_traces. `page` is the column of the chunk's page number.
    With `kinds`, only kinds, the array of different kinds of the text's traces, in the place of all these.

    Links and compounds go to the tasks as a dictionary while they have at most HELD entries; beyond that each chunk's come
    to it by joins. A file's titles come by a join, vectors (at most VOCABULARY) to the tasks. Null texts stay null without
    traces, empty ones empty. Equal texts of a file and page get equal results. Columns of the names added are replaced.
    """
    linked, hyphened, running, patterns, trained = learned or learn(chunks)
    made = {"repaired_text": "string", "traces": "array<struct<kind:string,was:string,now:string>>"}
    if whole:
        made |= {f"repaired_{whole}": "string", f"{whole}_traces": made["traces"]}
    if kinds:
        made = {"kinds": "array<string>"}
    base, struct = chunks.drop(*made), f"struct<{','.join(f'{n}:{t}' for n, t in made.items())}>"
    texts_of = (F.col(text), F.col(whole) if whole else F.lit(None).cast("string"), F.col(page).cast("string") if page else F.lit(None).cast("string"))
    pairs = trained.collect()  # at most VOCABULARY
    known = chunks.sparkSession.sparkContext.broadcast((patterns, [r.word for r in pairs], np.array([r.vector for r in pairs], dtype=np.float32).reshape(len(pairs), LENGTH)))

    def result(t: str, found: list[tuple[int, int, str, str]]) -> tuple:
        return repaired(t, found) if found else t, [{"kind": k, "was": t[b:e], "now": new} for b, e, k, new in found]

    def mend(t: str | None, w: str | None, p: str | None, *known, plainly: set[str] | None = None) -> tuple:
        at = int(p) if p else None
        found = find_traces(t, *known, at, plainly) if t else []
        if kinds:
            return (sorted({k for _, _, k, _ in found}),)
        out = result(t, found) if t else (t, [])
        if not whole:
            return out
        if not w or w == t:
            return *out, *((w, []) if not w else out)
        head = w[: len(w) - len(t)] if t and w.endswith(t) else ""
        # a heading on lines of its own: what was found in the text stands as far behind it
        if "\n" in (t or "") and head.endswith("\n") and head.rstrip()[-1:] not in "-‐¬\xad":
            both = find_traces(head, *known, at, plainly) + [(b + len(head), e + len(head), k, new) for b, e, k, new in found]
            return *out, *result(w, both)
        return *out, *result(w, find_traces(w, *known, at, plainly))

    here = running.groupBy("file_id").agg(F.collect_list("title").alias("__t"))  # few lines a file
    base = base.join(F.broadcast(here) if running.count() <= HELD else here, "file_id", "left")
    rights = linked.groupBy("word").agg(F.collect_list(F.struct("right", "n_right")).alias("to"))  # as many as a word has misreadings
    if linked.count() + hyphened.count() <= HELD:
        held = chunks.sparkSession.sparkContext.broadcast(({x.word: [tuple(t) for t in x.to] for x in rights.collect()}, {x.word: x.joined for x in hyphened.collect()}))

        @F.pandas_udf(struct)
        def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
            reader = Reader(*known.value)
            for *columns, here in batches:
                plainly = set()  # as large as a batch at most
                done = [mend(*row, reader, *held.value, set() if ts is None else set(ts), plainly=plainly) for *row, ts in zip(*columns, here)]
                yield pd.DataFrame(done, columns=list(made))

        once = run.asNondeterministic() if kinds else run  # else Spark would run it twice, as a filter of the explode too
        return base.withColumn("__m", once(*texts_of, F.col("__t"))).select(*[c for c in chunks.columns if c not in made], "__m.*")

    @F.pandas_udf(struct)
    def run_joined(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        reader = Reader(*known.value)
        for *columns, rights, hyphens, here in batches:
            done = [
                mend(*row, reader, {} if r is None else {x["word"]: [(t["right"], t["n_right"]) for t in x["to"]] for x in r}, {} if h is None else {x["word"]: x["joined"] for x in h}, set() if ts is None else set(ts))
                for *row, r, h, ts in zip(*columns, rights, hyphens, here)
            ]
            yield pd.DataFrame(done, columns=list(made))

    @F.pandas_udf("array<string>")
    def distinct_words(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([sorted({p for w in WORD.findall((t or "").lower()) for p in (w, w.strip(EDGES), *PARTS.findall(w), *(x.strip(EDGES) for x in PARTS.findall(w)))} | joints(t or "")) for t in texts], dtype=object)

    used = [text, whole] if whole else [text]
    base = base.withColumn("__row", F.concat_ws("/", F.coalesce(F.col("id"), F.lit("")), F.xxhash64(*used).cast("string")))
    words = base.select("__row", F.explode(F.array(*used)).alias("t")).distinct().select("__row", F.explode(distinct_words(F.col("t"))).alias("word")).distinct()
    of_row = words.join(rights, "word").groupBy("__row").agg(F.collect_list(F.struct("word", "to")).alias("__r"))
    hyphens = words.join(hyphened, "word").groupBy("__row").agg(F.collect_list(F.struct("word", "joined")).alias("__h"))
    joined = base.join(of_row, "__row", "left").join(hyphens, "__row", "left")
    once = run_joined.asNondeterministic() if kinds else run_joined
    return joined.withColumn("__m", once(*texts_of, F.col("__r"), F.col("__h"), F.col("__t"))).select(*[c for c in chunks.columns if c not in made], "__m.*")


def traces(chunks: DataFrame) -> DataFrame:
    """id, kind: each kind of trace that the text of the chunk has, once."""
    done = repair(chunks.select("id", "file_id", "text", "page_number"), page="page_number", kinds=True)
    return done.select("id", F.explode("kinds").alias("kind")).distinct()
