"""Byte spans that already occur in an earlier document, by a depth-limited radix sort of suffixes.

Suffixes are told apart only through their first ``DEPTH`` bytes, by passes from a coarse digit to
the full depth; a suffix alone in its group leaves the sort.

1. The most significant digit of a suffix is content-defined: the smallest hash among the
   ``GRAM``-byte strings within its first ``DEPTH`` bytes. Consecutive suffixes share it, so that
   one row per document and digit stands for about 16 suffixes. Digits of one document stop here.
2. Runs of consecutive suffixes with one digit are compared as whole strings. A run that occurs
   in an earlier document is settled. Where a digit has only one string, nothing is left to sort.
3. The suffixes of the remaining runs (the edges of matches) get a longer digit of the same kind.
4. What is left of them is compared at full depth.

Any fixed order of digits that depends on content alone gives the same final groups as byte order:
equal groups are exactly the repeated windows.

Nulls: a null text is empty. A null id counts as larger than every other; rows of one id are not
earlier than each other, and each is judged by itself. Texts under DEPTH bytes keep everything.
An empty table gives an empty result; other columns are ignored. Runs jobs when called."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridstone.llm.common import (
    Aside, Slice, Spans, belongs, covered, distinct, lists, missing_last, mix, record, sample_frequent, signed, slices, sliding, whole_groups, written,
)

DEPTH, GRAM, LONGER = 50, 20, 32
PIECE = 1 << 17  # text hashed at once: its arrays stay in the cache
TOGETHER = 1 << 20  # digits packed at once
_BUCKET_BITS = 12  # of the ranges that digits are dealt into; a task judges one after the other
_PACKED = pa.schema([("bucket", pa.int32()), ("__key", pa.list_(pa.int64())), ("sig", pa.list_(pa.int64()))])
_DIGIT_BITS = np.uint64(48)
RESULT = "__key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


class Suffixes:
    """The suffixes of a slice that are at least DEPTH long, as runs of consecutive ones with one
    digit. Single suffixes are listed only for the runs that are asked for."""

    def __init__(self, s: Slice, depth: int, gram: int):
        self.spans, self.depth = Spans(s.byte_symbols()), depth
        digit = self.digits(gram)
        size = np.diff(s.offsets)
        n = np.maximum(size - depth + 1, 0)  # suffixes of each text
        there = np.repeat(np.tile([True, False], len(n)), np.column_stack([n, size - n]).ravel())[: len(digit)]
        new = np.ones(len(digit), bool)
        new[1:] = digit[1:] != digit[:-1]
        new[s.offsets[:-1][n > 0]] = True
        self.begin = np.flatnonzero(new & there)
        self.run_row = np.searchsorted(s.offsets, self.begin, "right") - 1
        self.run_digit = digit[self.begin]
        stop = s.offsets[self.run_row + 1] - depth + 1
        stop[:-1] = np.minimum(stop[:-1], self.begin[1:])
        self.count = stop - self.begin

    def digits(self, gram: int) -> np.ndarray:
        """The digit of every suffix, by start."""
        return sliding(self.spans.every(gram) >> (np.uint64(64) - _DIGIT_BITS), self.depth - gram + 1, np.minimum)

    def runs(self) -> np.ndarray:
        return self.spans.of(self.begin, self.begin + self.length())

    def length(self) -> np.ndarray:
        """Bytes of each run: from its first suffix to DEPTH bytes into its last one."""
        return self.count + self.depth - 1

    def within(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and start of every suffix of some runs."""
        n = self.count[runs]
        ahead = np.cumsum(n) - n
        return np.repeat(self.run_row[runs], n), np.arange(n.sum()) + np.repeat(self.begin[runs] - ahead, n)

    def whole(self, start: np.ndarray) -> np.ndarray:
        return self.spans.of(start, start + self.depth)


def _keys(batch: pa.RecordBatch, s: Slice) -> np.ndarray:
    return batch.column("__key").slice(s.first, len(s)).to_numpy()


def _rows(df: DataFrame, step, schema: str, names: tuple[str, ...]) -> DataFrame:
    """One row for what ``step`` gives of each slice: a document's row and columns of 64 bits."""
    out = pa.schema([("__key", pa.int64()), *((n, pa.int64()) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch, size=PIECE):
                row, *columns = step(batch, s)
                if len(row):
                    yield record(out, _keys(batch, s)[row], *(signed(c) for c in columns))

    return df.mapInArrow(run, schema)


def _in_two_documents(docs: DataFrame, step, n_docs: int) -> DataFrame:
    """(__key, sig) of the digits that two keys have, among what ``step`` gives of each slice. They travel packed,
    one row for each range of digits; those known to be frequent need no judgement and are spread over all ranges."""
    shape = "__key long, sig long"
    common = np.array(sample_frequent(lambda d: _rows(d, step, shape, ("sig",)), docs, "__key", n_docs), np.int64)
    out = pa.schema([("__key", pa.int64()), ("sig", pa.int64())])

    def dealt(kept: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        key, sig = (np.concatenate(x) for x in zip(*kept, strict=True))
        bucket = (mix(np.where(np.isin(sig, common), key, sig).view(np.uint64)) >> np.uint64(64 - _BUCKET_BITS)).astype(np.uint16)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        offsets = pa.array(np.append(first, len(bucket)), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(bucket[first], pa.int32()), *(pa.ListArray.from_arrays(offsets, pa.array(x[order])) for x in (key, sig))], schema=_PACKED)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for batch in batches:
            for s in slices(batch, size=PIECE):
                row, sig = step(batch, s)
                if len(row):
                    kept.append((_keys(batch, s)[row], signed(sig)))
                    size += len(row)
                if size >= TOGETHER:
                    yield dealt(kept)
                    kept, size = [], 0
        if kept:
            yield dealt(kept)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, "bucket"):
            key, sig = (pc.list_flatten(group.column(c)).to_numpy() for c in ("__key", "sig"))
            order = np.argsort(sig)
            key, sig = key[order], sig[order]
            first = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
            twice = np.minimum.reduceat(key, first) < np.maximum.reduceat(key, first)
            keep = np.repeat(twice | np.isin(sig[first], common), np.diff(np.append(first, len(sig))))
            yield record(out, key[keep], sig[keep])

    packed = docs.mapInArrow(pack, "bucket int, __key array<long>, sig array<long>")
    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(judge, shape)


def remove_earlier(documents: DataFrame, key: str = "doc_id", text: str = "text", keep: bool = True, depth: int = DEPTH, gram: int = GRAM, longer_gram: int = LONGER) -> DataFrame:
    """Per document ``key``, n_bytes, n_removed, n_spans, kept_sha256 and, with ``keep``, the kept
    bytes, after each byte covered by a string of ``depth`` bytes that also starts in a document
    with a smaller key is removed."""
    aside = Aside(documents.sparkSession, "suffix_dedup")
    docs = aside.put_bucketed(documents.select(missing_last(key).alias("__key"), F.col(text).alias("text")), "__key", "documents")

    def digits(batch, s):
        x = Suffixes(s, depth, gram)
        row, digit, _ = distinct(x.run_row, x.run_digit)
        return row, digit

    # Pass 1: digits that two documents have.
    n_docs = docs.count()
    marks = aside.put(_in_two_documents(docs, digits, n_docs).groupBy("__key").agg(F.collect_list("sig").alias("digits")), "digits")

    # Pass 2: runs of such suffixes as whole strings.
    def runs(batch, s):
        x = Suffixes(s, depth, gram)
        at = np.flatnonzero(belongs(x.run_digit, x.run_row, *lists(batch, "digits", s)))
        whole = x.runs()[at]
        row, value, _ = distinct(x.run_row[at], whole)
        order = np.lexsort((whole, x.run_row[at]))
        first = np.searchsorted(np.rec.fromarrays([x.run_row[at][order], whole[order]]), np.rec.fromarrays([row, value])) if len(row) else row
        return row, x.run_digit[at][order][first], value

    strings = aside.put(_rows(docs.join(marks, "__key"), runs, "__key long, sig long, run long", ("sig", "run")), "runs")
    aside.drop("digits")
    first = strings.groupBy("sig", "run").agg(F.min("__key").alias("__first"))
    several = first.groupBy("sig").agg(F.count("*").alias("n")).where("n > 1").select("sig", F.lit(True).alias("several"))
    judged = strings.join(aside.put(first.join(several, "sig", "left"), "firsts"), ["sig", "run"])
    settled, still = F.when(F.col("__key") > F.col("__first"), F.col("run")), F.when((F.col("__key") == F.col("__first")) & F.col("several"), F.col("run"))
    state = aside.put(judged.select("__key", settled.alias("s"), still.alias("o")).where("s is not null or o is not null")
                    .groupBy("__key").agg(F.collect_list("s").alias("settled"), F.collect_list("o").alias("open")), "judged")

    aside.drop("runs", "firsts")

    # Pass 3: a longer digit, for the suffixes of runs that are left.
    def longer(batch, s):
        x = Suffixes(s, depth, gram)
        row, start = x.within(np.flatnonzero(belongs(x.runs(), x.run_row, *lists(batch, "open", s))))
        return distinct(row, x.digits(longer_gram)[start])[:2]

    opened = docs.join(state.where(F.size("open") > 0).select("__key", "open"), "__key")
    narrowed = _in_two_documents(opened, longer, n_docs)
    narrowed = aside.put(narrowed.groupBy("__key").agg(F.collect_list("sig").alias("longer")).join(state.select("__key", "open"), "__key"), "longer")

    # Pass 4: full depth.
    def edges(batch, s):
        x = Suffixes(s, depth, gram)
        row, start = x.within(np.flatnonzero(belongs(x.runs(), x.run_row, *lists(batch, "open", s))))
        some = np.flatnonzero(belongs(x.digits(longer_gram)[start], row, *lists(batch, "longer", s)))
        return distinct(row[some], x.whole(start[some]))[:2]

    single = aside.put(_rows(docs.join(narrowed, "__key"), edges, "__key long, suffix long", ("suffix",)), "suffixes")
    aside.drop("longer")
    least = single.groupBy("suffix").agg(F.min("__key").alias("__first"), F.max("__key").alias("__last")).where("__first < __last")
    repeated = aside.put(single.join(least, "suffix").where("__key > __first").groupBy("__key").agg(F.collect_list("suffix").alias("suffixes")), "repeated")
    aside.drop("suffixes")
    found = state.select("__key", "settled").join(repeated, "__key", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([("__key", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), *[("kept", pa.binary())] * keep])
        for batch in batches:
            for s in slices(batch, size=PIECE):
                gone = np.zeros(len(s.data), bool)
                settled, suffixes = lists(batch, "settled", s), lists(batch, "suffixes", s)
                if len(settled[0]) or len(suffixes[0]):
                    x = Suffixes(s, depth, gram)
                    hit = belongs(x.runs(), x.run_row, *settled)
                    row, start = x.within(np.flatnonzero(~hit & np.isin(x.run_row, suffixes[1])))
                    start = start[belongs(x.whole(start), row, *suffixes)]
                    gone = covered(len(s.data), np.append(x.begin[hit], start), np.append(x.length()[hit], np.full(len(start), depth)))
                begins = gone.copy()
                begins[1:] &= ~gone[:-1]
                inner = s.offsets[(s.offsets > 0) & (s.offsets < len(gone))]
                begins[inner] |= gone[inner]
                bounds = s.offsets
                count = lambda x: np.diff(np.append(0, np.cumsum(x))[bounds])  # noqa: B023, E731
                kept = [s.data[a:b][~gone[a:b]].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield record(out, _keys(batch, s), np.diff(bounds), count(gone), count(begins), [hashlib.sha256(k).hexdigest() for k in kept], *[kept] * keep)

    cutting = docs.join(found, "__key", "left").select("__key", "text", "settled", "suffixes")
    result = written(cutting.mapInArrow(cut, RESULT + ", kept binary" * keep), "suffix_dedup_result")
    aside.close()
    return result.withColumn("__key", F.nullif("__key", F.lit((1 << 63) - 1))).withColumnRenamed("__key", key)
