"""Windows of words that occur more than once anywhere, by level-wise doubling.

A window of ``WINDOW`` words can only repeat if every shorter window in it does. Level by level,
windows of 8, 16 and 32 words are tried, and only windows all of whose shorter levels are repeated
go on to twice the length; the last step is the full length. At each level one short window stands
for all full windows around it: the one with the smallest hash among those inside the full window,
so a level makes about 2 / (WINDOW - length + 2) rows per word and equal full windows make equal rows.

Nulls: a null text has no words. A null id is an id of its own; rows of one id count as separate
documents for repetition (a repeated row repeats its windows) but are reported one by one. Texts
with fewer words than the window keep everything. An empty table gives an empty result; other
columns are ignored. Runs jobs when called."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridstone.llm.common import (
    Slice, Spans, belongs, bucketed, covered, distinct, in_two_places, lists, missing_last, record, signed, slices, sliding,
    spread, windows, written,
)

WINDOW, FIRST = 35, 8


class WordWindows:
    """The words of a slice and, for windows of ``window`` words, which ones are whole."""

    def __init__(self, s: Slice, window: int):
        self.begin, self.stop, self.offsets = s.words()
        self.row, end = spread(self.offsets)
        self.spans, self.window = Spans(s.word_symbols(self.begin, self.stop)), window
        self.whole = windows(end, window)

    def least(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the windows of a shorter length, and the smallest inside each full window."""
        short = self.spans.every(length)
        return short, sliding(short, self.window - length + 1, np.minimum)

    def starting(self, length: int, values: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Full windows whose smallest window of a length is among the (values, rows)."""
        _, least = self.least(length)
        at = np.flatnonzero(self.whole[: len(least)] & np.isin(self.row[: len(least)], rows))
        return at[belongs(least[at], self.row[at], values, rows)]

    def signs(self, length: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct smallest windows of a length inside the given full windows: row, hash, and at
        how many places of the row each stands."""
        short, least = self.least(length)
        wanted = np.zeros(len(least), np.uint64)
        wanted[starts] = least[starts]
        width = self.window - length + 1
        pad = np.zeros(width - 1, np.uint64)
        place = np.flatnonzero((sliding(np.concatenate([pad, wanted, pad]), width, np.maximum)[: len(short)] == short) & (short > 0)) if len(least) else starts
        return distinct(self.row[place], short[place])


def remove_repeated(documents: DataFrame, key: str = "doc_id", text: str = "text", keep: bool = True, window: int = WINDOW, first: int = FIRST) -> DataFrame:
    """Per document ``key``, n_words, n_removed, kept_sha256 and, with ``keep``, the kept words
    joined by one space, after each word covered by a window that also starts elsewhere is removed."""
    spark = documents.sparkSession
    name, docs = bucketed(documents.select(missing_last(key).alias("__key"), F.col(text).alias("text")), "__key", "window_dedup")
    n_docs = docs.count()
    out = pa.schema([("__key", pa.int64()), ("sig", pa.int64()), ("n", pa.int64())])

    def level(length: int, before: int | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for s in slices(batch):
                    w = WordWindows(s, window)
                    starts = np.flatnonzero(w.whole) if before is None else w.starting(before, *lists(batch, "sigs", s))
                    if length < window:
                        row, value, n = w.signs(length, starts)
                    else:
                        row, value, n = distinct(w.row[starts], w.spans.of(starts, starts + window))
                    if len(row):
                        keys = batch.column("__key").slice(s.first, len(s)).to_numpy()
                        yield record(out, keys[row], signed(value), n)
        return run

    state, before, length = None, None, min(first, window)
    while True:
        candidates = docs if state is None else docs.join(state, "__key")
        step = level(length, before)
        rows = in_two_places(lambda d, step=step: d.mapInArrow(step, "__key long, sig long, n long"), candidates, n_docs, "n")
        state = written(rows.groupBy("__key").agg(F.collect_list("sig").alias("sigs")), f"windows_{length}")
        if length == window:
            break
        before, length = length, min(2 * length, window)

    shape = pa.schema([("__key", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), *[("kept", pa.string())] * keep])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch):
                w = WordWindows(s, window)
                values, rows = lists(batch, "sigs", s)
                some = np.flatnonzero(w.whole & np.isin(w.row, rows))
                starts = some[belongs(w.spans.of(some, some + window), w.row[some], values, rows)]
                gone = covered(len(w.begin), starts, window)
                bounds, data = w.offsets, s.data.tobytes()
                kept = []
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    at = a + np.flatnonzero(~gone[a:b])
                    kept.append(b" ".join([data[i:j] for i, j in zip(w.begin[at].tolist(), w.stop[at].tolist(), strict=True)]))
                removed = np.diff(np.append(0, np.cumsum(gone))[bounds])
                keys = batch.column("__key").slice(s.first, len(s))
                yield record(shape, keys, np.diff(bounds), removed, [hashlib.sha256(k).hexdigest() for k in kept], *[[k.decode() for k in kept]] * keep)

    schema = "__key long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * keep
    result = written(docs.join(state, "__key", "left").mapInArrow(cut, schema), "window_dedup_result")
    spark.sql(f"DROP TABLE {name}")
    return result.withColumn("__key", F.nullif("__key", F.lit((1 << 63) - 1))).withColumnRenamed("__key", key)

