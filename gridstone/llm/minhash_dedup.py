"""Near-duplicate documents by MinHash with tensored banding, every link confirmed on full sets.

A document's set holds its distinct shingles of folded words. Two collections of ``tables`` short
tuples of minhashes are computed; each pair of a tuple from the first and one from the second is a
bucket key, so ``tables ** 2`` keys cost only ``2 * tables`` tuples. With the defaults a pair at
similarity 0.85 misses every key with a chance under 0.0001, one at 0.95 under 1e-7.

Documents with equal sets form one class, named by its smallest id; only classes are searched.
A bucket does not emit all its pairs. Its smallest class is compared with the others; once links are
merged, buckets that still hold several components go on without that class. After ``ROUNDS`` rounds
the pairs of a bucket that are in different components are compared one by one, if it holds few. Larger
buckets are taken together where they share classes, split into blocks of about BLOCK classes, and every
two blocks are compared within one task, which returns only links that join components. So each pair of
a bucket is confirmed, refused, or already in one component, and no row is made for a pair of a large one.

Nulls: documents without words, and rows without an id, have links with nothing; the latter have no
component and are kept. Rows of one id are one document, searched by one of its texts. An empty table gives an empty result; other
columns are ignored. Runs jobs when called."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstone.llm.common import Slice, Spans, distinct, mix, signed, slices, spread, windows, written

ROUNDS = 2
FEW, BLOCK = 32, 64


def shingles(s: Slice, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a slice's texts, as (row, hash) in order. A text with fewer words
    than the width has all of them as one shingle."""
    begin, stop, offsets = s.words()
    row, end = spread(offsets)
    spans = Spans(s.word_symbols(begin, stop, folded=True))
    starts = np.flatnonzero(windows(end, width))
    counts = np.diff(offsets)
    short = np.flatnonzero((counts > 0) & (counts < width))
    rows = np.concatenate([row[starts], short])
    return distinct(rows, np.concatenate([spans.of(starts, starts + width), spans.of(offsets[short], offsets[short + 1])]))[:2]


def _salts(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


def _sketches(documents: DataFrame, width: int, tables: int, length: int) -> DataFrame:
    out = pa.schema([("node", pa.int64()), ("mark", pa.int64()), ("size", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("first", pa.list_(pa.int64())), ("second", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = _salts(2 * tables * length)
        for batch in batches:
            for s in slices(batch):
                row, value = shingles(s, width)
                size = np.bincount(row, minlength=len(s))
                some = np.flatnonzero(size)
                at = np.searchsorted(row, some)
                sums = np.zeros((2, len(s)), np.uint64)
                tuples = np.zeros((len(s), 2 * tables), np.uint64)
                if len(some):
                    sums[0][some] = np.add.reduceat(mix(value), at)
                    sums[1][some] = np.add.reduceat(mix(value ^ np.uint64(0x5851F42D4C957F2D)), at)
                    for i, salt in enumerate(salts):
                        least = np.minimum.reduceat((value ^ (salt >> np.uint64(7))) * salt, at)
                        tuples[some, i // length] = mix(tuples[some, i // length] * np.uint64(3) + least)
                node, mark = (batch.column(c).slice(s.first, len(s)) for c in ("node", "mark"))
                parts = [pa.FixedSizeListArray.from_arrays(pa.array(signed(t.ravel())), tables).cast(pa.list_(pa.int64())) for t in (tuples[:, :tables], tuples[:, tables:])]
                yield pa.RecordBatch.from_arrays([node, mark, pa.array(size.astype(np.int64)), *(pa.array(signed(x)) for x in sums), *parts], schema=out)

    return documents.mapInArrow(run, "node long, mark long, size long, s1 long, s2 long, first array<long>, second array<long>")


def _sets(documents: DataFrame, width: int) -> DataFrame:
    out = pa.schema([("node", pa.int64()), ("set", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch):
                row, value = shingles(s, width)
                bounds = np.searchsorted(row, np.arange(len(s) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(s.first, len(s)), pa.ListArray.from_arrays(pa.array(bounds), pa.array(signed(value)))], schema=out)

    return documents.mapInArrow(run, "node long, set array<long>")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of linked nodes (a, b): the smallest node reachable. Alternates linking every
    neighbour above, then every neighbour below, to the smallest one, until only stars are left."""
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    while True:
        parents = edges.select(F.col("v").alias("p"), F.lit(1).alias("x")).distinct()
        deep = edges.join(parents, F.col("u") == F.col("p"), "left_semi").limit(1).count()
        if not deep and edges.count() == edges.select("u").distinct().count():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = written(large, "links_large")
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = written(small.where("u <> v").distinct(), "links")


def _alike(a: Column, b: Column, percent: int) -> Column:
    """100 * intersection >= percent * union of two sets."""
    both = F.size(F.array_intersect(a, b))
    return both * 100 >= (F.size(a) + F.size(b) - both) * percent


def _large(members: DataFrame, sets: DataFrame, tuples: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components, from buckets with many classes."""
    families = components(members.select(F.col("pivot").alias("a"), F.col("node").alias("b")))
    nodes = members.select("node", "component").distinct().join(families.select("node", F.col("component").alias("family")), "node", "left").withColumn("family", F.coalesce("family", "node"))
    blocks = nodes.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = nodes.join(blocks, "family").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    full = dealt.join(sets, "node").join(tuples, "node")
    filled = written(full.groupBy("family", "blocks", "block").agg(F.collect_list(F.struct("node", "component", "set", "first", "second")).alias("held")), "blocks")
    one = filled.select("family", F.col("block").alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"), F.col("held").alias("one"))
    other = filled.select("family", F.explode(F.sequence(F.lit(0).cast("long"), "block")).alias("i"), F.col("block").alias("j"), F.col("held").alias("other"))
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                links = _between(batch.column("one")[r].values, batch.column("other")[r].values, percent)
                if len(links):
                    yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], schema=out)

    return one.join(other, ["family", "i", "j"]).select("one", "other").mapInArrow(run, "a long, b long")


def _between(one: pa.StructArray, other: pa.StructArray, percent: int) -> np.ndarray:
    """Links between two blocks' classes that share a bucket and are in different components; of
    several that join the same components, one."""
    column = lambda block, name: block.field(name).to_numpy(zero_copy_only=False)
    table = lambda block, name: np.stack([x.values.to_numpy() for x in block.field(name)])
    near = np.ones((len(one), len(other)), bool)
    for name in ("first", "second"):
        near &= (table(one, name)[:, None, :] == table(other, name)[None, :, :]).any(axis=2)
    in_one, in_other = column(one, "component"), column(other, "component")
    near &= in_one[:, None] != in_other[None, :]
    if not near.any():
        return np.zeros((0, 2), np.int64)
    sets = [[x.values.to_numpy() for x in block.field("set")] for block in (one, other)]
    values = np.unique(np.concatenate(sets[0] + sets[1]))
    held = [np.zeros((len(block), len(values)), np.float32) for block in sets]
    for block, own in zip(sets, held, strict=True):
        for i, x in enumerate(block):
            own[i, np.searchsorted(values, x)] = 1
    both = np.rint(held[0] @ held[1].T).astype(np.int64)
    sizes = [np.array([len(x) for x in block]) for block in sets]
    i, j = np.nonzero(near & (100 * both >= percent * (sizes[0][:, None] + sizes[1][None, :] - both)))
    _, kept = np.unique(np.sort(np.column_stack([in_one[i], in_other[j]]), axis=1), axis=0, return_index=True)
    return np.column_stack([column(one, "node")[i[kept]], column(other, "node")[j[kept]]])


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, tables: int = 8, length: int = 2) -> DataFrame:
    """Per row ``key``, n_shingles, component_id, kept, and class_id, the smallest id with an equal set."""
    docs = documents.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text"), F.xxhash64(text).alias("mark"))
    sketches = written(_sketches(docs, width, tables, length), "sketches")
    whole = sketches.where("node is not null and size > 0")
    classes = whole.groupBy("s1", "s2").agg(F.min("node").alias("class_id"))
    named = written(sketches.join(classes, ["s1", "s2"], "left").select("node", "size", F.when((F.col("size") > 0) & F.col("node").isNotNull(), F.col("class_id")).otherwise(F.col("node")).alias("class_id")), "classes")

    # Of an id's texts the same one gives the sketch and the set.
    own = whole.join(classes.select(F.col("class_id").alias("node")), "node", "left_semi")
    of_class = own.groupBy("node").agg(F.min(F.struct("mark", "size", "first", "second")).alias("least")).select("node", "least.*")
    pairs_of_tuples = F.flatten(F.transform("first", lambda x, i: F.transform("second", lambda y, j: F.xxhash64(i, j, x, y))))
    rows = of_class.select("node", "size", F.explode(pairs_of_tuples).alias("bucket"))
    pivots = rows.groupBy("bucket").agg(F.min("node").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    members = written(rows.join(pivots.select("bucket", "pivot"), "bucket"), "buckets")
    wanted = of_class.join(members.select("node").distinct(), "node", "left_semi").select("node", "mark")
    sets = written(_sets(docs.where("node is not null").dropDuplicates(["node", "mark"]).join(wanted, ["node", "mark"], "left_semi"), width), "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        left = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
        right = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
        return pairs.join(left, "a").join(right, "b").select("a", "b", _alike(F.col("set_a"), F.col("set_b"), percent).alias("linked"))

    # Sets that differ in size by more than this are never that similar.
    fits = lambda x, y: F.least(x, y) * 100 >= F.greatest(x, y) * percent
    def compared(pairs: DataFrame) -> DataFrame:
        pairs = pairs.distinct()
        return written(confirmed(pairs if checked is None else pairs.join(checked.select("a", "b"), ["a", "b"], "left_anti")), "confirmed")

    checked, component, left = None, None, True
    for _ in range(ROUNDS):
        sizes = members.where("node = pivot").select("bucket", F.col("size").alias("pivot_size"))
        new = compared(members.where("node <> pivot").join(sizes, "bucket").where(fits(F.col("size"), F.col("pivot_size"))).select(F.col("pivot").alias("a"), F.col("node").alias("b")))
        checked = new if checked is None else checked.unionByName(new)
        component = components(checked.where("linked"))
        rest = members.where("node <> pivot").select("bucket", "node", "size").join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
        active = rest.groupBy("bucket").agg(F.min("node").alias("pivot"), F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n")).where("low < high")
        members = written(rest.join(active.select("bucket", "pivot", "n"), "bucket"), "buckets")
        left = not members.isEmpty()
        if not left:
            break
    if left:
        one = members.where(F.col("n") <= FEW).select("bucket", F.col("node").alias("a"), F.col("size").alias("size_a"), F.col("component").alias("in_a"))
        other = members.where(F.col("n") <= FEW).select("bucket", F.col("node").alias("b"), F.col("size").alias("size_b"), F.col("component").alias("in_b"))
        few = compared(one.join(other, "bucket").where("a < b and in_a <> in_b").where(fits(F.col("size_a"), F.col("size_b"))).select("a", "b"))
        many = _large(members.where(F.col("n") > FEW), sets, of_class.select("node", "first", "second"), percent)
        component = components(checked.unionByName(few).where("linked").select("a", "b").unionByName(many))
    merged = component.select(F.col("node").alias("class_id"), F.col("component").alias("__component"))
    found = named.join(merged, "class_id", "left").withColumn("component_id", F.coalesce("__component", "class_id"))
    return found.select(F.col("node").alias(key), F.col("size").alias("n_shingles"), "component_id", F.coalesce(F.col("node") == F.col("component_id"), F.lit(True)).alias("kept"), "class_id")
