"""Cross-entropy difference of documents under a target and a background model.

Both are interpolated bigram models of folded words over one vocabulary: every word of the documents,
and one unknown word for those only met later. They are matched: the same vocabulary and bigrams, the
same smoothing, and background counts scaled to the target's number of words, so that a difference
comes from the text and not from the size of a corpus. Counts cover every document, word and bigram.

Counts are one table by code: of bigrams, of words, and of words that another one follows. Tasks hold the
BIGRAMS and WORDS most frequent codes; all others are looked up in the table. Which way a code goes changes
no result. Codes travel packed: a row holds those of one slice (some MB of text) and one of BUCKETS ranges,
each once, and its answer gives counts in the same order. Words before have no codes on the way: counted is
only how their number differs from that of the word, and a word is answered with both. With ``once=False`` the
table leaves out codes met once: a fitted document that does not find a code has the one occurrence itself, on
its own side, so its score stays exact; such models score fitted documents only.

Nulls: a null text has no words; a document without words has n_words 0 and null losses. A document
whose ``target`` is null belongs to the background. Ids may be null or repeated, each row is scored by its
own text. With an empty corpus on either side that model is uniform; an empty table gives an empty result;
columns other than key and text are ignored. Runs jobs when called."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstone.llm.common import Aside, Slice, frequent, mix, record, sent, signed, slices, spread, whole_groups, written

BIGRAMS, WORDS = 500_000, 500_000
WEIGHT, FLOOR = 0.7, 0.5  # of the bigram; added to every word's count
SIDES = ("target", "background")
PAIR, WORD, BEFORE = 0, 1, 2  # kinds of codes, in their lowest two bits
TEXT_BYTES = 1 << 22  # of a slice
BUCKETS, _BUCKET_BITS = 4096, 12  # ranges of codes; a task merges one after the other
COMBINED = 1 << 21  # codes of several slices counted together in a task
ROW_CODES = 1 << 16  # counts in one row before they become rows
_LONGS = pa.list_(pa.int64())
_PACKED = pa.schema([("__slice", pa.int64()), ("bucket", pa.int32()), ("code", _LONGS), *((x, _LONGS) for x in SIDES)])
_ANSWERS = (*SIDES, *(f"before_{x}" for x in SIDES))
_ANSWER = pa.schema([*(_PACKED.field(c) for c in ("__slice", "bucket")), *((x, _LONGS) for x in _ANSWERS)])
_MERGED = pa.schema([*(_PACKED.field(c) for c in ("code", *SIDES)), ("n_words", pa.int64()), *((f"n_{x}", pa.int64()) for x in SIDES)])
PACKED = "__slice long, bucket int, code array<long>, target array<long>, background array<long>"
ANSWER = "__slice long, bucket int, target array<long>, background array<long>, before_target array<long>, before_background array<long>"
MERGED = "code array<long>, target array<long>, background array<long>, n_words long, n_target long, n_background long"


@dataclass
class Codes:
    """Distinct codes of bigrams and words of a slice, sorted (a text's start is a word before, so it is a word,
    too); and of each word the place of its bigram's, its own and the word before's among them, and its row."""

    code: np.ndarray
    pair: np.ndarray
    word: np.ndarray
    before: np.ndarray
    row: np.ndarray

    @classmethod
    def of(cls, s: Slice) -> Codes:
        begin, stop, offsets = s.words()
        word, at = np.unique(s.word_symbols(begin, stop, folded=True), return_inverse=True)
        n = len(word)
        before = np.full(len(at), n)
        before[1:] = at[:-1]
        before[offsets[:-1][np.diff(offsets) > 0]] = n
        pair, pair_at = np.unique(before * (n + 1) + at, return_inverse=True)
        word = np.append(word, np.zeros(min(n, 1), np.uint64))
        kind = lambda x, k: mix(x) & ~np.uint64(3) | np.uint64(k)
        pairs = kind(word[pair // (n + 1)] * np.uint64(3) + word[pair % (n + 1)], PAIR)
        code, place = np.unique(np.concatenate([pairs, kind(word, WORD)]), return_inverse=True)
        words = place[len(pair) :]
        return cls(code, place[: len(pair)][pair_at], words[at], words[before], spread(offsets)[0])

    def words(self) -> np.ndarray:
        """Which codes are of words."""
        return _kind(self.code) == WORD

    def counted(self, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and counts at the marked words and at the others; of words before, by how much their
        counts differ from those of the word."""
        n = np.empty((2, len(self.code)), np.int64)
        change = np.empty_like(n)
        for side, some in enumerate((marked, ~marked)):
            word, before = (np.bincount(x[some], minlength=len(self.code)) for x in (self.word, self.before))
            n[side] = np.bincount(self.pair[some], minlength=len(self.code)) + word
            change[side] = before - word
        there, changed = n.any(axis=0), change.any(axis=0) & self.words()
        return np.append(self.code[there], _before(self.code[changed])), np.concatenate([n[:, there], change[:, changed]], axis=1)


def _kind(code: np.ndarray) -> np.ndarray:
    return code & np.uint64(3)


def _before(word: np.ndarray) -> np.ndarray:
    """The codes of words as words before."""
    return word + np.uint64(BEFORE - WORD)


def _summed(code: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each code once, sorted, with the sum of its counts."""
    if not len(code):
        return code, counts
    order = np.argsort(code)
    code = code[order]
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    return code[first], np.add.reduceat(counts[:, order], first, axis=1)


def _values(column: pa.Array) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False)


def _packed(number: int, code: np.ndarray, counts: np.ndarray | None = None) -> pa.RecordBatch:
    """Sorted codes as one row for each bucket that has any. With counts a row's codes are ordered by these, which
    compresses well."""
    bucket = (code >> np.uint64(64 - _BUCKET_BITS)).astype(np.int32)
    if counts is not None:
        small = np.clip(counts, 0, 255)
        order = np.argsort(bucket.astype(np.int64) << 16 | small[0] << 8 | small[1], kind="stable")
        code, counts = code[order], counts[:, order]
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(code) else np.zeros(0, np.int64)
    offsets = pa.array(np.append(first, len(code)), pa.int32())
    full = lambda x: pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64()))
    rest = [pa.nulls(len(first), _LONGS)] * len(SIDES) if counts is None else [full(x) for x in counts]
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(first), number)), pa.array(bucket[first]), full(signed(code)), *rest], schema=_PACKED)


def _by_bucket(packed: DataFrame) -> DataFrame:
    return packed.repartition("bucket").sortWithinPartitions("bucket")


def _counted(documents: DataFrame) -> DataFrame:
    """Rows with codes and how often each occurs in either corpus; and, of each row, its words in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []

        def combined() -> pa.RecordBatch:
            rows = _packed(-1, *_summed(np.concatenate([c for c, _ in kept]), np.concatenate([n for _, n in kept], axis=1)))
            kept.clear()
            return rows

        for batch in batches:
            marked = np.asarray(batch.column("target").to_numpy(zero_copy_only=False), bool)
            for s in slices(batch, size=TEXT_BYTES):
                codes = Codes.of(s)
                kept.append(codes.counted(marked[s.first : s.last][codes.row]))
                if sum(len(c) for c, _ in kept) >= COMBINED:
                    yield combined()
        if kept:
            yield combined()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, "bucket"):
            code, n = _values(group.column("code")).view(np.uint64), np.array([_values(group.column(x)) for x in SIDES])
            word = _kind(code) == WORD
            code, n = _summed(np.append(code, _before(code[word])), np.concatenate([n, n[:, word]], axis=1))
            there = n.any(axis=0)
            code, n = code[there], n[:, there]
            for i in range(0, len(code), ROW_CODES):
                some, counts = code[i : i + ROW_CODES], n[:, i : i + ROW_CODES]
                word = _kind(some) == WORD
                yield record(_MERGED, [signed(some)], *([x] for x in counts), [word.sum()], *([x[word].sum()] for x in counts))

    return _by_bucket(documents.mapInArrow(count, PACKED)).mapInArrow(merge, MERGED)


class Held:
    """Counts of some codes."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.codes, first = np.unique(codes, return_index=True)
        self.counts = counts[:, first]

    @classmethod
    def from_rows(cls, df: DataFrame) -> Held:
        t = df.select("code", *SIDES).toArrow()
        return cls(np.ascontiguousarray(t["code"].to_numpy()).view(np.uint64), np.array([t[x].to_numpy() for x in SIDES], float).reshape(2, -1))

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which codes are held, and where those are."""
        if not len(self.codes):
            return np.zeros(len(codes), bool), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        known = self.codes[at] == codes
        return known, at[known]


@dataclass
class Models:
    """Counts by code as a table; those of the most frequent codes in memory."""

    counts: DataFrame
    sizes: tuple[float, float]  # words of each corpus
    vocabulary: int  # with the unknown word
    once: bool
    held: Held  # bigrams
    held_words: Held  # words, and words before


@dataclass
class _Scorer:
    sizes: tuple[float, float]
    vocabulary: int
    held: tuple[Held, Held]

    def known(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which codes are held, and counts, of codes that are not held 0."""
        known, counts = np.zeros(len(code), bool), np.zeros((len(SIDES), len(code)))
        for held in self.held:
            there, at = held.find(code)
            known |= there
            counts[:, there] = held.counts[:, at]
        return known, counts

    def asked(self, codes: Codes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which codes to look up; counts held of all codes, and of the words as words before."""
        words = codes.words()
        (known, counts), (known_before, counts_before) = self.known(codes.code), self.known(_before(codes.code[words]))
        known[words] &= known_before
        return ~known, counts, counts_before

    def losses(self, codes: Codes, counts: np.ndarray, counts_before: np.ndarray, own: np.ndarray) -> list[np.ndarray]:
        """Loss of every word under each model. ``own``: per side and word, the count of a code found nowhere."""
        before_at = (np.cumsum(codes.words()) - 1)[codes.before]
        found, found_before = counts.any(axis=0), counts_before.any(axis=0)[before_at]
        losses = []
        for side in range(len(SIDES)):
            pair, word = (np.where(found[at], counts[side][at], own[side]) for at in (codes.pair, codes.word))
            before = np.where(found_before, counts_before[side][before_at], own[side])
            scale = self.sizes[0] / self.sizes[1] if side and all(self.sizes) else 1.0
            single = (word * scale + FLOOR) / (self.sizes[side] * scale + FLOOR * self.vocabulary)
            known = before > 0
            chance = np.where(known, WEIGHT * pair / np.maximum(before, 1), 0.0)
            losses.append(-np.log(chance + np.where(known, 1 - WEIGHT, 1.0) * single))
        return losses


def fit(documents: DataFrame, target: Column, text: str = "text", n_bigrams: int = BIGRAMS, n_words: int = WORDS, once: bool = True) -> Models:
    """The models; tasks will hold ``n_bigrams`` bigrams and ``n_words`` other codes at most. Without ``once``
    they score fitted documents only."""
    docs = documents.select(F.col(text).alias("text"), F.coalesce(target.cast("boolean"), F.lit(False)).alias("target"))
    total, kind = F.col("target") + F.col("background"), F.col("code").bitwiseAND(3)
    seen = Observation()
    merged = _counted(docs).observe(seen, *(F.coalesce(F.sum(f"n_{x}"), F.lit(0)).alias(x) for x in ("words", *SIDES)))
    whole = merged.select(F.inline(F.arrays_zip("code", *SIDES)))
    counts = written(whole if once else whole.where(total > 1), "lm_counts")
    r = seen.get
    totals = counts.withColumn("total", total)
    held = [Held.from_rows(frequent(totals.where(some), "total", n)) for some, n in ((kind == PAIR, n_bigrams), (kind != PAIR, n_words))]
    return Models(counts, (float(r["target"]), float(r["background"])), r["words"] + 1, once, *held)


@contextmanager
def sliced(documents: DataFrame, text: str = "text") -> Iterator[DataFrame]:
    """The documents in slices of TEXT_BYTES of text (and the rest of its last document), numbered in ``__slice``,
    written so that a slice's rows lie together. ``fit`` and ``score`` may both start from there, within the context."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            ends = size + np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            begins = np.append(size, ends[:-1])[: len(ends)]
            size = int(ends[-1]) if len(ends) else size
            yield batch.append_column("__slice", pa.array(number + begins // TEXT_BYTES))

    schema = T.StructType([*documents.schema.fields, T.StructField("__slice", T.LongType())])
    aside = Aside(documents.sparkSession, "lm_slices")
    yield aside.put_bucketed(documents.mapInArrow(cut, schema), "__slice", "documents")
    aside.close()


def score(documents: DataFrame, models: Models, key: str = "doc_id", text: str = "text", fitted: Column | None = None) -> DataFrame:
    """Per row ``key``, n_words, the mean loss per word under each model, and their difference: the
    lower it is, the more the text is like the target. ``fitted`` says that exactly these documents were
    fitted, and with which target."""
    if fitted is None and not models.once:
        raise ValueError("models without codes met once score fitted documents only: give their target")
    side = F.lit(None).cast("boolean") if fitted is None else F.coalesce(fitted.cast("boolean"), F.lit(False))
    cut = [c for c in documents.columns if c == "__slice"]
    docs = documents.select(F.col(key).alias("__key"), F.col(text).alias("text"), side.alias("__side"), *cut)
    with nullcontext(docs) if cut else sliced(docs) as docs:
        return _scored(docs, models, key)


def _one_slice(table: pa.Table) -> tuple[pa.RecordBatch, Slice]:
    batch = table.combine_chunks().to_batches()[0]
    return batch, next(slices(batch, size=1 << 62))


def _scored(docs: DataFrame, models: Models, key: str) -> DataFrame:
    """Scores of (__key, text, __side, __slice)."""
    spark = docs.sparkSession
    there = sent(spark, _Scorer(models.sizes, models.vocabulary, (models.held, models.held_words)))
    aside = Aside(spark, "lm_answers")

    def ask(table: pa.Table) -> pa.Table:
        codes = Codes.of(_one_slice(table)[1])
        return pa.Table.from_batches([_packed(table.column("__slice")[0].as_py(), codes.code[there().asked(codes)[0]])])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, *counts = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("code", *SIDES))
            yield _packed(-1, *_summed(code.view(np.uint64), np.array(counts)))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, "bucket"):
            counted = pc.less(group.column("__slice"), 0)
            table, asked = group.filter(counted), group.filter(pc.invert(counted))
            held = Held(_values(table.column("code")).view(np.uint64), np.array([_values(table.column(x)) for x in SIDES]))
            code = _values(asked.column("code")).view(np.uint64)
            words = _kind(code) == WORD
            ends = np.append(0, np.cumsum(pc.list_value_length(asked.column("code")).to_numpy()))
            columns = []
            for codes, offsets in ((code, ends), (_before(code[words]), np.append(0, np.cumsum(words))[ends])):
                known, at = held.find(codes)
                for counts in held.counts:
                    n = np.zeros(len(codes), np.int64)
                    n[known] = counts[at]
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(n)))
            yield pa.RecordBatch.from_arrays([asked.column("__slice"), asked.column("bucket"), *columns], schema=_ANSWER)

    asked = docs.select("__slice", "text").groupBy("__slice").applyInArrow(ask, PACKED)
    answers = aside.put(_by_bucket(asked.unionByName(models.counts.mapInArrow(pack, PACKED))).mapInArrow(answer, ANSWER), "answers")

    def judge(table: pa.Table, answers: pa.Table) -> pa.Table:
        batch, s = _one_slice(table)
        codes, answers = Codes.of(s), answers.sort_by("bucket")
        scorer: _Scorer = there()
        asked, *counts = scorer.asked(codes)
        told = [_values(answers.column(x).combine_chunks()) for x in _ANSWERS]
        counts[0][:, asked], counts[1][:, asked[codes.words()]] = told[:2], told[2:]
        sides = batch.column("__side").to_pylist()
        own = np.array([[x is True, x is False] for x in sides], float).reshape(-1, 2).T
        n = np.bincount(codes.row, minlength=len(s))
        means = [np.bincount(codes.row, weights=x, minlength=len(s)) / np.maximum(n, 1) for x in scorer.losses(codes, *counts, own[:, codes.row])]
        return pa.table([batch.column("__key"), pa.array(n, pa.int64()), *(pa.array(m, mask=n == 0) for m in means)], [key, "n_words", *(f"loss_{x}" for x in SIDES)])

    losses = T.StructType([T.StructField(key, docs.schema["__key"].dataType), T.StructField("n_words", T.LongType()), *(T.StructField(f"loss_{x}", T.DoubleType()) for x in SIDES)])
    scored = written(docs.groupBy("__slice").cogroup(answers.groupBy("__slice")).applyInArrow(judge, losses), "lm_losses")
    aside.close()
    return scored.withColumn("difference", F.col("loss_target") - F.col("loss_background"))
