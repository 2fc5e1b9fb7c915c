"""Documents to pages: a pluggable reader runs in tasks, page by page; text comes from the file or, where it has too little, from recognised words."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.sources.files import assembled

#: Fixed value: characters of a page's own text from which it is not recognised.
NATIVE_CHARS = 20
#: A reader: file content to pages of (own text, recognised words, confidence of each word in percent, below 0 for none).
Reader = Callable[[bytes], Iterable[tuple[str, list[str], list[float]]]]
PAGE = "path string, page_no int, text string, confidence double, error string"


def page_text(own: str, words: list[str], confidences: list[float]) -> tuple[str, float]:
    """Own text with confidence 1, else the words that aren't blank on one line with their mean confidence."""
    own = own.strip()
    if len(own) >= NATIVE_CHARS:
        return own, 1.0
    known = [c for c in confidences if c >= 0]
    return " ".join(w for w in words if w.strip()), sum(known) / len(known) / 100 if known else 0.0


def pages(spark: SparkSession, folder: str, read: Reader, pattern: str = "*.pdf") -> DataFrame:
    """path, page_no, text, confidence, error: a row for each page; a file that can't be read has one row with its error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    rows = [(path, i, *page_text(*p), None) for i, p in enumerate(read(bytes(content)), 1)]
                except Exception as e:  # noqa: BLE001: the file's own failure
                    rows = [(path, None, None, None, f"{type(e).__name__}: {e}")]
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in PAGE.split(", ")])

    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "content").mapInPandas(run, PAGE)


def documents(page_rows: DataFrame) -> DataFrame:
    """path, text, mean_confidence, n_pages, entity_key (the file's name without its ending) of the files without an error."""
    good = page_rows.where("error is null")
    return assembled(good, "path", "page_no", "text", confidence=F.col("confidence")).withColumn("entity_key", F.regexp_extract("path", r"([^/]+)\.[^.]+$", 1))
