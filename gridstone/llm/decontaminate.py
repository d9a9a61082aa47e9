"""Benchmark items inside documents, by size-partitioned MinHash containment search.

Items are partitioned by the size of their shingle set: a part holds sizes up to twice its smallest.
For a part of largest size u every document is seen as windows of 3 u / 2 shingles, starting every
u / 2, so any passage as long as an item of the part lies in one window that is at most three times as
large. The similarity that containment implies is then at least a quarter, however long the document.
An item is a candidate in a document when one of ``HASHES`` minhashes of the item equals that of a
window. The minhash of a window is worked out lazily: only around places where a shingle stands that
is the minimum of some item. Candidates are verified by exact containment in the document's set.

The benchmark is a stated set of queries. It is taken in blocks of bounded size, each sent to all tasks
and held against all documents, so nothing grows with both sides at once.

Nulls: a null text has no words and holds nothing; a null item text matches nothing. An item with
fewer words than a shingle is one shingle of all its words, found only in a document of these words.
Repeated items and rows are reported each. Ids may be null. Jobs over the benchmark run when called."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridstone.llm.common import Slice, Spans, mix, sent, slices, spread, windows
from gridstone.llm.minhash_dedup import shingles

HASHES = 64
BLOCK_BYTES = 16 << 20


class Block:
    """Items of one block: their sets, and which shingle is the minimum of which item under which hash."""

    def __init__(self, items: list[tuple[int | None, str]], width: int):
        texts = [t.encode() for _, t in items]
        whole = Slice(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]), 0, len(texts))
        row, value = shingles(whole, width)
        self.ids = [i for i, _ in items]
        self.sets = np.split(value, np.searchsorted(row, np.arange(1, len(items))))
        self.salts = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
        owners: dict[int, list[tuple[int, int]]] = {}
        for item, own in enumerate(self.sets):
            if len(own):
                for h, salt in enumerate(self.salts):
                    owners.setdefault(int(own[np.argmin(own * salt)]), []).append((item, h))
        self.owners = owners
        self.minima = np.sort(np.fromiter(owners, np.uint64, len(owners)))
        # The largest size of each item's part: a power of two.
        self.largest = [1 << max(1, (max(1, len(s)) - 1).bit_length()) for s in self.sets]

    def candidates(self, places: np.ndarray, sequence: np.ndarray) -> set[int]:
        """Items of which a minhash equals that of a window over the sequence; ``places`` has where
        minima of items stand."""
        found: set[int] = set()
        for p in places.tolist():
            for item, h in self.owners[int(sequence[p])]:
                if item in found:
                    continue
                half = max(1, self.largest[item] // 2)
                first = p // half
                for start in range(max(0, first - 2), first + 1):
                    window = sequence[start * half : (start + 3) * half]
                    if (window * self.salts[h]).min() == (sequence[p : p + 1] * self.salts[h])[0]:
                        found.add(item)
                        break
        return found


def find_items(documents: DataFrame, benchmark: DataFrame, carry: Sequence[str], text: str = "text", item: str = "item_id", item_text: str = "text", width: int = 5, percent: int = 80, name: str = "items") -> DataFrame:
    """The documents' columns ``carry`` and, as ``name``, an array of (item, size, shared) for each
    item of which ``percent`` of the shingles are in the document."""
    spark = documents.sparkSession
    items = benchmark.where(F.col(item_text).isNotNull()).select(F.col(item).alias("i"), F.col(item_text).alias("t"))
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n_blocks = max(1, -(-size // BLOCK_BYTES))
    kind = items.schema["i"].dataType.simpleString()
    fields = [*carry, "__text", "__found"]
    result = documents.select(*carry, F.col(text).alias("__text"), F.array().cast(f"array<struct<item:{kind},size:long,shared:long>>").alias("__found"))
    schema = result.schema
    for b in range(n_blocks):
        own = items.where(F.pmod(F.xxhash64("t"), F.lit(n_blocks)) == b).sort("i", "t")
        block = sent(spark, Block([(r.i, r.t) for r in own.toLocalIterator()], width))
        result = result.mapInArrow(_search(block, width, percent, fields), schema)
    return result.withColumnRenamed("__found", name).drop("__text")


def _search(block, width: int, percent: int, fields: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b: Block = block()
        for batch in batches:
            held = batch.column("__found").to_pylist()
            for s in slices(batch, "__text"):
                for row, sequence in _with_minima(s, b, width):
                    places = np.flatnonzero(np.isin(sequence, b.minima))
                    for item in sorted(b.candidates(places, sequence)):
                        own = b.sets[item]
                        shared = int(np.isin(own, sequence).sum())
                        if shared * 100 >= len(own) * percent:
                            held[s.first + row].append({"item": b.ids[item], "size": len(own), "shared": shared})
            columns = [batch.column(f) for f in fields[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(held, batch.schema.field("__found").type)], fields)
    return run


def _with_minima(s: Slice, b: Block, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Texts with a shingle that is some item's minimum: their row, and their shingles in order."""
    begin, stop, offsets = s.words()
    row, end = spread(offsets)
    spans = Spans(s.word_symbols(begin, stop, folded=True))
    counts = np.diff(offsets)
    short = np.flatnonzero((counts > 0) & (counts < width))
    starts = np.flatnonzero(windows(end, width))
    value = spans.of(starts, starts + width)
    at = np.searchsorted(b.minima, value) if len(b.minima) else starts
    hit = b.minima[np.minimum(at, len(b.minima) - 1)] == value if len(b.minima) else np.zeros(len(value), bool)
    for r in np.unique(row[starts[hit]]).tolist():
        yield r, value[np.searchsorted(starts, offsets[r]) : np.searchsorted(starts, offsets[r + 1])]
    whole = spans.of(offsets[short], offsets[short + 1])
    for r, v in zip(short.tolist(), whole, strict=True):
        if len(b.minima) and b.minima[min(np.searchsorted(b.minima, v), len(b.minima) - 1)] == v:
            yield r, np.array([v])
