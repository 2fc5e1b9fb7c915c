"""Problem 4: cutting oversized texts at natural boundaries, placed by content.

A rolling hash over the text marks landmarks: places whose hash is the greatest for some way around, wherever pieces begin.
Each piece ends at the strongest landmark of its size window, moved to the nearest natural boundary, so that an edit
changes only the pieces around it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Natural boundaries: after a paragraph, a line that ends a sentence or list entry, a sentence; where a window has none, after a line, a clause, a word.
BOUNDARIES = tuple(
    re.compile(p) for p in (r"\n[^\S\n]*\n\s*", r"(?<=[.!?;:|])[^\S\n]*\n\s*", r"(?<=[.!?])['\")\]»]*\s+(?=[^\s\da-zà-ÿ])", r"\n\s*", r"(?<=[,;:])\s+", r"\s+")
)
NATURAL = 3
#: A landmark has the greatest hash of the places this far before and after it.
REACH = 150
WINDOW, BASE = 48, np.uint64(0x9E3779B97F4A7C15 | 1)


def rolling(text: str) -> np.ndarray:
    """A rolling hash for each position: that of the WINDOW characters before it, the same wherever they stand."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        up = np.cumprod(np.full(len(codes), BASE, dtype=np.uint64))
        down = np.cumprod(np.full(len(codes), inverse, dtype=np.uint64))
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(codes * up, dtype=np.uint64)])
        begin = np.maximum(np.arange(len(codes) + 1) - WINDOW, 0)
        h = (sums - sums[begin]) * np.concatenate([np.ones(1, dtype=np.uint64), down])[begin]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))


def landmarks(marks: np.ndarray, reach: int = REACH) -> np.ndarray:
    """Places whose hash is the greatest within `reach` on both sides, in order; found by running maxima of blocks, in time linear in the text."""
    width = 2 * reach + 1
    padded = np.zeros(-(-(len(marks) + 2 * reach) // width) * width, dtype=np.uint64)
    padded[reach : reach + len(marks)] = marks
    blocks = padded.reshape(-1, width)
    ahead = np.maximum.accumulate(blocks, axis=1).ravel()
    back = np.maximum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.flatnonzero(np.maximum(back[: len(marks)], ahead[width - 1 : width - 1 + len(marks)]) == marks)


def pieces(text: str, limit: int = 2000, overlap: int = 200, least: int = 600) -> list[tuple[int, int, int]]:
    """(begin, new, end) of each piece: text[begin:end], of which text[begin:new] repeats the piece before.

    Every piece has at most `limit` characters; new parts run on without a gap. A run without any boundary is cut at the limit.
    """
    if len(text) <= limit:
        return [(0, 0, len(text))]
    levels = [np.array([m.end() for m in b.finditer(text) if 0 < m.end() < len(text)], dtype=np.int64) for b in BOUNDARIES]
    natural = np.unique(np.concatenate(levels[:NATURAL]))
    marks, out, begin, new = rolling(text), [], 0, 0
    places = landmarks(marks)
    while len(text) - begin > limit:
        low, high = new + min(least, limit - overlap) // (1 if len(text) - new > 2 * least else 2), begin + limit
        end = high
        if high > low:
            inside = places[(places >= low) & (places <= high)]
            at = int(inside[np.argmax(marks[inside])]) if len(inside) else high
            for ends in (natural, *levels[NATURAL:]):
                near = ends[(ends >= low) & (ends <= high)]
                if len(near):
                    end = int(near[np.argmin(np.abs(near - at))])
                    break
        out.append((begin, new, end))
        new, begin = end, end
        if overlap:
            for ends in (levels[2], levels[5]):
                near = ends[(ends >= end - overlap) & (ends < end) & (ends > out[-1][0])]
                if len(near):
                    begin = int(near[0])
                    break
            else:
                begin = max(end - overlap, out[-1][0] + 1)
    out.append((begin, new, len(text)))
    return out


def split_oversized(df: DataFrame, text: str = "text", limit: int = 2000, overlap: int = 200, least: int = 600) -> DataFrame:
    """One row for each piece of each row: all columns of `df` but `text` repeated, with piece, n_pieces, piece_begin, piece_new, piece_text.

    piece counts from 1. Characters are Unicode code points. A text within the limit is its own only piece; an empty one
    gives one empty piece, a null one a piece whose text is null. Rows of equal content give equal pieces. No shuffle, and
    only texts over the limit pass through Python. Columns of the names added are replaced.
    """

    @F.pandas_udf("array<struct<b:int,m:int,e:int>>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([None if t is None else [{"b": b, "m": m, "e": e} for b, m, e in pieces(t, limit, overlap, least)] for t in texts], dtype=object)

    t = F.col(text)
    long = F.char_length(t) > limit
    kept = [c for c in df.columns if c not in {text, "piece", "n_pieces", "piece_begin", "piece_new", "piece_text"}]
    short = df.where(~F.coalesce(long, F.lit(False))).select(
        *kept, F.lit(1).alias("piece"), F.lit(1).alias("n_pieces"), F.lit(0).alias("piece_begin"), F.lit(0).alias("piece_new"), t.alias("piece_text")
    )
    cut = df.where(long).withColumn("__spans", spans.asNondeterministic()(t))  # else Spark calls it again in a filter on its size
    cut = cut.select("*", F.size("__spans").alias("__n"), F.posexplode("__spans").alias("__i", "__s"))
    cut = cut.select(
        *kept, (F.col("__i") + 1).alias("piece"), F.col("__n").alias("n_pieces"), F.col("__s.b").alias("piece_begin"), F.col("__s.m").alias("piece_new"),
        F.substring(t, F.col("__s.b") + 1, F.col("__s.e") - F.col("__s.b")).alias("piece_text"),
    )
    return short.unionByName(cut)


def oversized_ids(chunks: DataFrame, limit: int = 2000) -> DataFrame:
    """Ids whose text took more than one piece, each once."""
    return split_oversized(chunks.select("id", "text"), limit=limit).where("n_pieces > 1 and piece = 1").select("id").distinct()
