"""Helpers shared by the operators: words in SQL, words and window hashes in numpy, written steps.

A word is a maximal run of characters other than the space and U+0009 to U+000D. These are all
ASCII, so bytes of UTF-8 can be split without decoding. Words are hashed piece by piece. Hashes of
spans of words or of short spans of bytes come from prefix sums of a polynomial modulo 2**64 whose
coefficients are scrambled first; any span then costs O(1)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridstone.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLICE_BYTES = 1 << 20  # text handled at once inside a task; a longer document is a slice of its own

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_STEP = 0x9E3779B97F4A7C15
_BASE, _BASE_INVERSE = 0xD1342543DE82EF95, pow(0xD1342543DE82EF95, -1, 1 << 64)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def sent(spark: SparkSession, value):
    """Sends an object to all tasks, with its class; gives the function that has it there."""
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(packed.value)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Queries run within remove their shuffle files when they end: their result is in files."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read back: later steps start from files."""
    path = scratch_path(df.sparkSession, label)
    with tidy(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(text: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(0)), F.array().cast("array<string>"))


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers, one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_SYMBOLS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_STEP))
#: Masks that leave the first bytes of a piece of eight.
_LEADING = np.array([[255] * k + [0] * (8 - k) for k in range(9)], np.uint8).view(np.uint64)[:, 0]
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _ladder(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to n."""
    if len(_powers[0]) <= n:
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(2 * n + 1, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0], _powers[1]


class Spans:
    """Hashes of any span of a sequence of 64-bit symbols."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        up, self.down = _ladder(n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def every(self, length: int) -> np.ndarray:
        """All spans of one length, by start."""
        n = len(self.sums) - 1 - length
        if n < 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[length:] - self.sums[: n + 1]) * self.down[: n + 1])


class Slice:
    """Consecutive texts of a batch as one run of bytes. ``offsets`` bounds them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int, last: int):
        self.data, self.offsets, self.first, self.last = data, offsets, first, last

    def __len__(self) -> int:
        return self.last - self.first

    def byte_symbols(self) -> np.ndarray:
        return _SYMBOLS[self.data]

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end byte of every word, and where each text's words begin in these."""
        solid = ~_SPACE[self.data]
        starts, ends = solid.copy(), solid.copy()
        starts[1:] &= ~solid[:-1]
        ends[:-1] &= ~solid[1:]
        inner = self.offsets[(self.offsets > 0) & (self.offsets < len(solid))]
        starts[inner] |= solid[inner]
        ends[inner - 1] |= solid[inner - 1]
        begin, stop = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        return begin, stop, np.searchsorted(begin, self.offsets)

    def word_symbols(self, begin: np.ndarray, stop: np.ndarray, folded: bool = False) -> np.ndarray:
        """A hash of each word, of any length: the sum over its pieces of eight bytes, each scrambled with
        its place. A polynomial, as of spans, is equal for some long words of a regular pattern."""
        if not len(begin):
            return np.zeros(0, np.uint64)
        data = np.concatenate([_FOLD[self.data] if folded else self.data, np.zeros(8, np.uint8)])
        size = stop - begin
        pieces = -(-size // 8)
        first = np.cumsum(pieces) - pieces
        place = np.arange(int(pieces.sum())) - np.repeat(first, pieces)
        piece = np.lib.stride_tricks.sliding_window_view(data, 8)[np.repeat(begin, pieces) + 8 * place].view(np.uint64)[:, 0]
        left = np.minimum(np.repeat(size, pieces) - 8 * place, 8)
        scrambled = mix(mix(piece & _LEADING[left]) + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(_STEP))
        return mix(np.add.reduceat(scrambled, first) + size.astype(np.uint64))


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[Slice]:
    """The batch's texts (null: empty) in slices of bounded size."""
    texts = pc.fill_null(batch.column(column), "").cast(pa.large_binary())
    _, bounds, data = texts.buffers()
    n = len(texts)
    offsets = np.frombuffer(bounds, np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1))
        yield Slice(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], i, j)
        i = j


def lists(batch: pa.RecordBatch, column: str, s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column over a slice's rows, and the row within the slice of each."""
    col = batch.column(column).slice(s.first, len(s))
    sizes = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.list_flatten(col).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return values, np.repeat(np.arange(len(s)), sizes)


def belongs(value: np.ndarray, row: np.ndarray, values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Which (value, row) are among (values, rows)."""
    if not len(values) or not len(value):
        return np.zeros(len(value), bool)
    tag = lambda v, r: v ^ mix((r.astype(np.uint64) + np.uint64(1)) * np.uint64(_STEP))
    return np.isin(tag(value, row), tag(values, rows))


def distinct(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, value), sorted, and how often each occurs."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return row[at], value[at], np.diff(np.append(at, len(row)))


def sliding(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """best over every full window of a width, by start."""
    if len(x) < width:
        return x[:0]
    reach = 1
    while 2 * reach <= width:
        x = best(x[:-reach], x[reach:])
        reach *= 2
    rest = width - reach
    return best(x[: len(x) - rest], x[rest:]) if rest else x


def windows(ends: np.ndarray, length: int) -> np.ndarray:
    """Which positions start a whole window. ``ends``: where the text of each position ends."""
    return np.arange(len(ends)) + length <= ends


def spread(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and end of every position, given the bounds of the rows."""
    sizes = np.diff(offsets)
    return np.repeat(np.arange(len(sizes)), sizes), np.repeat(offsets[1:], sizes)


def covered(n: int, starts: np.ndarray, length: int | np.ndarray) -> np.ndarray:
    """Which of n positions lie in a window starting at one of ``starts``, of one length or one each."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + length, -1)
    return np.cumsum(steps[:-1]) > 0


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Rows sorted by a key, cut anew so that those of one key stay together."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        last = batch.column(key)[-1].as_py()
        if kept and kept[-1].column(key)[-1].as_py() == last:
            kept.append(batch)
            continue
        cut = int(np.searchsorted(batch.column(key).to_numpy(), last))
        if kept or cut:
            yield pa.concat_batches([*kept, batch.slice(0, cut)])
        kept = [batch.slice(cut)]
    if kept:
        yield pa.concat_batches(kept)


def missing_last(key: str) -> Column:
    """An id to group and compare by: null counts as the largest."""
    return F.coalesce(F.col(key).cast("long"), F.lit((1 << 63) - 1))


class Aside:
    """Steps whose files go as soon as no later step reads them: tables of a database in the shared folder."""

    def __init__(self, spark: SparkSession, label: str):
        path = scratch_path(spark, label)
        self.spark, self.name = spark, path.rsplit("/", 1)[1].replace("-", "_")
        spark.sql(f"CREATE DATABASE {self.name} LOCATION '{path}'")

    def put(self, df: DataFrame, label: str) -> DataFrame:
        with tidy(self.spark):
            df.write.option("compression", "zstd").saveAsTable(f"{self.name}.{label}")
        return self.spark.table(f"{self.name}.{label}")

    def put_bucketed(self, df: DataFrame, key: str, label: str) -> DataFrame:
        """Bucketed by a key, so that joins on it move only the other side."""
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        with tidy(self.spark):
            df.repartition(n, key).write.bucketBy(n, key).option("compression", "zstd").saveAsTable(f"{self.name}.{label}")
        return self.spark.table(f"{self.name}.{label}")

    def drop(self, *labels: str) -> None:
        for label in labels:
            self.spark.sql(f"DROP TABLE {self.name}.{label}")

    def close(self) -> None:
        self.spark.sql(f"DROP DATABASE {self.name} CASCADE")


def bucketed(df: DataFrame, key: str, label: str) -> tuple[str, DataFrame]:
    """The rows as a table bucketed by a key in the shared folder, so that joins on that key
    move only the other side. Gives the table's name; drop it when done."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with tidy(spark):
        df.repartition(n, key).write.bucketBy(n, key).option("path", path).option("compression", "zstd").saveAsTable(name)
    return name, spark.table(name)


def sample_frequent(rows_of: Callable[[DataFrame], DataFrame], docs: DataFrame, key: str, n_docs: int, value: str = "sig", about: int = 5000, share: float = 0.01) -> Sequence[int]:
    """Values that some one in a hundred documents or more contain, from about ``about`` of them.

    Only says which values to keep out of the shuffle that counts the rest, because their answer
    is known: at most (values of a document) / ``share`` of them."""
    step = max(1, n_docs // about)
    least = max(20, int(share * min(n_docs, about)))
    some = rows_of(docs.where(F.pmod(F.xxhash64(key), F.lit(step)) == 0))
    return [r[0] for r in some.groupBy(value).agg(F.count("*").alias("n")).where(F.col("n") >= least).select(value).collect()]


def in_two_places(rows_of: Callable[[DataFrame], DataFrame], docs: DataFrame, n_docs: int, count: str | None = None) -> DataFrame:
    """(__key, sig) of the values of (__key, sig) that two keys have or, with a count column, that
    are counted twice in all, among the rows that ``rows_of`` gives of the documents. Values known to be frequent are spread over many groups."""
    common = sample_frequent(rows_of, docs, "__key", n_docs)
    rows = rows_of(docs)
    often = rows.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, common)).cast("array<long>")).alias("sig"), F.lit(True).alias("__often"))
    marked = rows.join(F.broadcast(often), "sig", "left").withColumn("__part", F.when(F.col("__often"), F.col("__key")).otherwise(0))
    group = Window.partitionBy("sig", "__part")
    twice = F.sum(count).over(group) > 1 if count else F.min("__key").over(group) < F.max("__key").over(group)
    return marked.withColumn("__twice", twice).where("__often or __twice").select("__key", "sig")


def frequent(counts: DataFrame, count: str, most: int, by: Sequence[str] = ()) -> DataFrame:
    """The most frequent rows, at most ``most`` in all or for each value of ``by``: every row whose
    count is above a limit, found from how many rows have each count."""
    spread_of = counts.groupBy(*by, count).agg(F.count("*").alias("__rows")).orderBy(*by, F.desc(count)).collect()
    limits: dict[tuple, int] = {}
    taken: dict[tuple, int] = {}
    full = set()
    for r in spread_of:
        group = tuple(r[c] for c in by)
        taken[group] = taken.get(group, 0) + r["__rows"]
        if taken[group] > most:
            full.add(group)
        if group not in full:
            limits[group] = r[count]
    wanted = F.lit(False)
    for group, least in limits.items():
        own = F.lit(True)
        for c, v in zip(by, group, strict=True):
            own = own & (F.col(c) == F.lit(v))
        wanted = wanted | (own & (F.col(count) >= least))
    return counts.where(wanted)
