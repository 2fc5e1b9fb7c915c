"""Problem 8: encoding a corpus with a public byte-level BPE, by dynamic programming over byte prefixes.

A sequence of tokens is the BPE encoding of its bytes exactly if each pair of neighbours is, so every byte prefix of a
piece has one valid last token. The table keeps that token for each prefix: ids are read back from the end, bytes can be
appended without touching what is there, and an edit re-encodes from its own place only.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the pattern that parts a text into pieces before merging, as the public tokenizer defines it.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Where the vocabulary files lie, unless the caller or the environment says otherwise.
TOKENIZERS = os.environ.get("GRISTMILL_TOKENIZERS", "/opt/tokenizers")
#: Pieces whose ids a worker remembers; only speed depends on it.
REMEMBERED = 200_000


class Vocabulary:
    """Tokens of a rank file, and which pairs of them may stand side by side."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}
        self.bytes_of = {r: t for t, r in self.rank.items()}
        self.longest = max(map(len, self.rank))
        self._alone: dict[int, bool] = {}
        self._beside: dict[tuple[int, int], bool] = {}

    def merged(self, data: bytes) -> list[int]:
        """Merging by lowest rank, the definition of the encoding; used on single tokens and pairs only."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranks = [self.rank.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
            low = min(ranks)
            if low == 1 << 60:
                break
            at = ranks.index(low)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.rank[p] for p in parts]

    def alone(self, token: int) -> bool:
        if (known := self._alone.get(token)) is None:
            known = self._alone[token] = self.merged(self.bytes_of[token]) == [token]
        return known

    def beside(self, left: int, right: int) -> bool:
        if (known := self._beside.get((left, right))) is None:
            known = self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
            self._beside[left, right] = known
        return known


class Prefixes:
    """Bytes of one piece with, for each prefix, its last token."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> Prefixes:
        """Adds bytes; the entries of the prefixes already there stay as they are."""
        begin, self.data = len(self.data), self.data + more
        v, data, last = self.vocabulary, self.data, self.last
        for end in range(begin + 1, len(data) + 1):
            for start in range(max(0, end - v.longest), end):
                token = v.rank.get(data[start:end])
                if token is not None and (v.alone(token) if start == 0 else v.beside(last[start], token) and v.alone(token)):
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token ends at byte {end}")
        return self

    def edit(self, start: int, stop: int, new: bytes) -> Prefixes:
        """Replaces data[start:stop]; prefixes up to `start` keep their entries."""
        tail = self.data[stop:]
        self.data, self.last = self.data[:start], self.last[: start + 1]
        return self.append(new + tail)

    def ids(self) -> list[int]:
        out, at = [], len(self.data)
        while at:
            out.append(self.last[at])
            at -= len(self.vocabulary.bytes_of[self.last[at]])
        return out[::-1]


@lru_cache(maxsize=2)
def encoder(path: str):
    """Text to ids; one for each worker and rank file."""
    import regex

    vocabulary, pieces = Vocabulary(path), regex.compile(PIECES)

    @lru_cache(maxsize=REMEMBERED)
    def piece_ids(piece: str) -> tuple[int, ...]:
        data = piece.encode("utf-8", "surrogatepass")
        if (whole := vocabulary.rank.get(data)) is not None and vocabulary.alone(whole):
            return (whole,)
        return tuple(Prefixes(vocabulary, data).ids())

    def ids(text: str | None) -> list[int]:
        return [] if not text else [i for piece in pieces.findall(text) for i in piece_ids(piece)]

    return ids


def encode(df: DataFrame, text: str = "text", out: str = "ids", name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """`df` with the ids of `text` in `out`, as array<bigint>; all other columns stay, one of the name `out` is replaced.

    Null and empty texts give an empty list. Blank texts have ids like any other. Special tokens are neither added nor
    recognised. No shuffle: each task loads the rank file once and walks its own rows.
    """
    path = f"{folder}/{name}.tiktoken"

    @F.pandas_udf("array<bigint>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ids = encoder(path)
        for texts in batches:
            yield pd.Series([ids(t) for t in texts], dtype=object)

    return df.withColumn(out, run(F.col(text)))
