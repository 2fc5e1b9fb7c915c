"""Problem 9: evaluation texts that stand, whole or in part, inside corpus documents.

Greedy string tiling: shared runs of a few words are the seeds that join documents to items; for each such pair the
longest common runs of words that no longer run covers are marked as tiles, found by running hashes of their first words
(Karp-Rabin) and compared word by word. Tiles that follow one another in the item's order, with small gaps, make a stretch.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of a seed, which is also the shortest tile.
SEED = 4
#: Words, in the item and in the document, that may be changed, missing or added between two tiles of a stretch.
GAP = 3
#: Words of all items that tasks may hold: the bound of what is broadcast. Beyond it documents and items meet by a join of their seeds.
HELD_WORDS = 2_000_000
#: Characters without width, and hyphens at which a printed line was parted.
INVISIBLE = re.compile("[­​-‏⁠﻿]")
PARTED = re.compile(r"(?<=\w)[-‐¬]\s*\n\s*(?=[a-z])")
WORD = re.compile(r"[^\W_]+")
#: Base of the running hash, odd.
BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    """Words in lower case without marks and accents; hyphens part words, so that their presence does not matter."""
    if not text:
        return []
    text = unicodedata.normalize("NFKD", INVISIBLE.sub("", text)).lower()
    return WORD.findall("".join(c for c in text if not unicodedata.combining(c)) if not text.isascii() else text)


class Codes(dict):
    """A 64-bit hash for each word, kept while there are at most a million."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        code = self[word] = xxhash.xxh64_intdigest(word) - (1 << 63)
        return code


CODES = Codes()


def run_hashes(found: list[str], n: int = SEED) -> np.ndarray:
    """The hash of the n words from each place on, by a running sum of powers: no word is hashed twice."""
    if len(found) < n:
        return np.zeros(0, dtype=np.uint64)
    codes = np.fromiter(map(CODES.__getitem__, found), dtype=np.int64, count=len(found)).view(np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(len(found) - n + 1, dtype=np.uint64)
        for k in range(n):  # the same polynomial for each window; n is a handful
            out = out * BASE + codes[k : k + len(out)]
    return out


def shared_seeds(item: list[str], doc: list[str], least: int = SEED) -> list[tuple[int, int]]:
    """(place in the item, place in the document) of each seed that both have, by their hashes."""
    places = defaultdict(list)
    for i, h in enumerate(run_hashes(item, least).tolist()):
        places[h].append(i)
    return [(i, d) for d, h in enumerate(run_hashes(doc, least).tolist()) for i in places.get(h, ())]


def tiles(item: list[str], doc: list[str], least: int = SEED, seeds: list[tuple[int, int]] | None = None) -> list[tuple[int, int, int]]:
    """(place in the item, place in the document, words) of each tile, by place in the document; no word is in two tiles. seeds: as shared_seeds gives them, if known."""
    runs = set()
    for i, d in shared_seeds(item, doc, least) if seeds is None else seeds:
        if i and d and item[i - 1] == doc[d - 1] and item[i : i + least - 1] == doc[d : d + least - 1]:
            continue  # the run began before
        n = 0
        while i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n]:
            n += 1
        if n >= least:
            runs.add((n, i, d))
    out, in_item, in_doc, queue = [], [False] * len(item), [False] * len(doc), sorted(runs, key=lambda r: (-r[0], r[1], r[2]))
    while queue:
        n, i, d = queue.pop(0)
        free = [not in_item[i + k] and not in_doc[d + k] for k in range(n)]
        if all(free):
            out.append((i, d, n))
            in_item[i : i + n] = in_doc[d : d + n] = [True] * n
            continue
        k = 0  # what longer tiles left of this run comes up again at its own length
        while k < n:
            if free[k]:
                m = k
                while m < n and free[m]:
                    m += 1
                if m - k >= least:
                    queue.append((m - k, i + k, d + k))
                k = m
            k += 1
        queue.sort(key=lambda r: (-r[0], r[1], r[2]))
    return sorted(out, key=lambda t: t[1])


def stretch(found: list[tuple[int, int, int]], gap: int = GAP) -> tuple[int, int]:
    """(words of the item spanned, words of them matched) of the best run of tiles in order with gaps of at most `gap` words."""
    best, ends = (0, 0), []
    for i, d, n in found:
        span, same = n, n
        for i2, d2, span2, same2 in ends:
            gi, gd = i - i2, d - d2
            if 0 <= gi <= gap and 0 <= gd <= gap and same2 + n > same:
                span, same = span2 + gi + n, same2 + n
        ends.append((i + n, d + n, span, same))
        best = max(best, (span, same), key=lambda x: (x[1], -x[0]))
    return best


PAIRS = "doc_id long, item_id long, covered long, share double, span long, matched long"


def tiled(doc: int, w: list[str], item: int, text: list[str], seeds: list[tuple[int, int]] | None = None) -> tuple:
    found = tiles(text, w, seeds=seeds)
    n = sum(t[2] for t in found)
    return (doc, item, n, n / len(text), *stretch(found))


def leaks(docs: DataFrame, items: DataFrame, least_seeds: int = 2, held: int = HELD_WORDS) -> DataFrame:
    """doc_id, item_id, covered, share, span, matched of each pair of document and item with at least `least_seeds` shared seeds (any stretch of 15 words with a changed one has more).

    covered: words of the item under tiles, in any order; share: that over the item's words, which also catches reordered
    passages; span and matched: of the best stretch in order. Null and empty texts share nothing. A doc_id that stands
    twice gives its rows twice. Items must be numbered by a unique item_id. While they have at most `held` words, tasks
    hold them and documents are read once and never shuffled; beyond that, seeds of both sides meet in a join.
    """
    texts = docs.where(F.length("text") > 0).select("doc_id", "text")
    size = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    if size > held:
        return leaks_by_join(texts, items, least_seeds)
    known = docs.sparkSession.sparkContext.broadcast([(r.item_id, words(r.text)) for r in items.select("item_id", "text").toLocalIterator()])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of_item, index = dict(known.value), defaultdict(list)
        for item, w in known.value:
            for i, h in enumerate(run_hashes(w).tolist()):
                index[h].append((item, i))
        seeds = np.sort(np.fromiter(index, dtype=np.uint64, count=len(index)))
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                w = words(text)
                hashes = run_hashes(w)
                at = np.minimum(np.searchsorted(seeds, hashes), max(len(seeds) - 1, 0))
                shared = defaultdict(list)
                for d in np.flatnonzero(seeds[at] == hashes).tolist() if len(seeds) else ():
                    for item, i in index[int(hashes[d])]:
                        shared[item].append((i, d))
                rows += [tiled(doc, w, item, of_item[item], found) for item, found in sorted(shared.items()) if len({d for _, d in found}) >= least_seeds]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PAIRS.split(", ")])

    return texts.mapInPandas(run, PAIRS)


def leaks_by_join(texts: DataFrame, items: DataFrame, least_seeds: int) -> DataFrame:
    """The same for any number of items: places of seeds are counted for each document and seed, meet those of the items,
    and only pairs with enough of them get their texts. A seed that many documents have is one row of each; the items'
    side is spread with it by Spark's skew join.
    """

    @F.pandas_udf("array<struct<h:long,n:int>>")
    def seeds_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            yield pd.Series([[{"h": h, "n": n} for h, n in Counter(run_hashes(words(t)).view(np.int64).tolist()).items()] for t in series], dtype=object)

    rows = texts.withColumn("row", F.xxhash64("doc_id", "text"))
    in_docs = rows.select("row", F.explode(seeds_of(F.col("text"))).alias("s")).select("row", "s.*")
    in_items = items.where("text is not null").select("item_id", F.explode(seeds_of(F.col("text"))).alias("s")).select("item_id", "s.h")
    pairs = in_docs.join(in_items, "h").groupBy("row", "item_id").agg(F.sum("n").alias("n")).where(F.col("n") >= least_seeds).select("row", "item_id")
    both = rows.join(pairs, "row").join(items.select("item_id", F.col("text").alias("item")), "item_id").select("doc_id", "text", "item_id", "item")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = [tiled(d, words(t), i, words(x)) for d, t, i, x in zip(pdf["doc_id"], pdf["text"], pdf["item_id"], pdf["item"])]
            yield pd.DataFrame(done, columns=[c.split()[0] for c in PAIRS.split(", ")])

    return both.mapInPandas(run, PAIRS)


def stretches(found: DataFrame, least: int = 15, least_share: float = 0.7) -> DataFrame:
    """Pairs with a stretch of at least `least` words of the item, in its order, of which `least_share` are matched."""
    return found.where((F.col("span") >= least) & (F.col("matched") >= least_share * F.col("span")))


def covered(found: DataFrame, least_share: float = 0.6) -> DataFrame:
    """Pairs whose tiles cover at least `least_share` of the item, in whatever order they stand."""
    return found.where(F.col("share") >= least_share)


def leaked(docs: DataFrame, items: DataFrame, least: int = 15, least_share: float = 0.7) -> DataFrame:
    """doc_id, item_id: a stretch of at least `least` words of the item, in its order, of which `least_share` are matched."""
    return stretches(leaks(docs, items), least, least_share).select("doc_id", "item_id").distinct()
