"""Spelling variants: words one edit apart, found through reduced words, and the form each is a variant of.

Letters are hashed to ``SYMBOLS`` symbols, so words become reduced words over a tiny alphabet. If two
words are one edit apart, their reduced words are equal (a letter was replaced by one of the same symbol)
or one edit apart at the same place. So for every word all reduced words one edit away are generated,
which the small alphabet keeps to about 8 a letter, and joined to the reduced words of the vocabulary;
what meets there is verified on the original strings. An edit leaves the first letters alone or the last
ones: a key therefore holds, besides the reduced word, the exact first ``least_chars // 2`` letters if
the edit comes behind them, else as many last letters, and words are filed under both. That keeps groups
small however many words share a reduced word. The place of the edit is carried along and only the
first place that explains a pair counts, so every pair is met once from either side.

Generated rows hold numbers only, so a word of many thousand letters costs rows in proportion to its
length, not copies of itself. Words are counted within tasks before they are shuffled.

Nulls: a null text has no words; a null id counts as an empty one. Repeated rows count each. Ties in
frequency go to the word that is smaller in code-point order. Texts are taken whole. An empty table gives
an empty result. Columns other than the two named are left out. Runs jobs when called."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gridstone.llm.common import _FOLD, _STEP, mix, signed, slices, written

SYMBOLS = 4
#: Distinct words that a task counts before it hands them on.
HELD = 300_000
_LONG = 64  # bytes of a run whose check sums are taken one by one

_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LEAD = 0xC3  # first byte of U+00C0 to U+00FF


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def check_sums(before: np.ndarray, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of a prefix, given its own, followed by a run of bytes; many at once."""
    order = np.argsort(-size, kind="stable")
    state, at, size = ~before[order], begin[order], size[order]
    long = int(np.searchsorted(-size, -_LONG))
    for j in range(int(size[long]) if long < len(size) else 0):
        m = int(np.searchsorted(-size, -j))
        some = state[long:m]
        state[long:m] = _CRC[(some ^ data[at[long:m] + j]) & 255] ^ (some >> np.uint32(8))
    state = ~state
    for i in range(long):
        state[i] = zlib.crc32(data[at[i] : at[i] + size[i]].tobytes(), int(before[order[i]]))
    out = np.empty_like(state)
    out[order] = state
    return out


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte and text of every maximal run of A-Z, a-z and U+00C0 to U+00FF."""
    lead = data == _LEAD
    letter = _ASCII_LETTER[data] | lead
    letter[1:] |= lead[:-1]
    edge = np.diff(np.concatenate([[False], letter, [False]]).astype(np.int8))
    begin, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    cut = np.unique(inner[letter[inner] & letter[inner - 1]]) if len(inner) else inner
    begin, stop = np.sort(np.concatenate([begin, cut])), np.sort(np.concatenate([stop, cut]))
    return begin, stop, np.searchsorted(offsets, begin, "right") - 1


def _counted(ids: list[bytes], data: np.ndarray, offsets: np.ndarray, least_chars: int, slip: int) -> pa.Table | None:
    """(word, n) of some texts."""
    data = _FOLD[data]
    begin, stop, row = runs(data, offsets)
    leads = np.append(0, np.cumsum(data == _LEAD))
    long_enough = (stop - begin) - (leads[stop] - leads[begin]) >= least_chars
    begin, stop, row = begin[long_enough], stop[long_enough], row[long_enough]
    if not len(begin):
        return None
    marks = np.zeros(len(data) + 1, np.int8)
    np.add.at(marks, begin, 1)
    np.add.at(marks, stop, -1)
    joined, bounds = data[np.cumsum(marks[:-1]) > 0], np.append(0, np.cumsum(stop - begin)).astype(np.int64)
    encoded = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(bounds), pa.py_buffer(joined)]).dictionary_encode()
    kinds = encoded.dictionary
    code = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    pair, often = np.unique(row * len(kinds) + code, return_counts=True)
    row, code = pair // len(kinds), pair % len(kinds)
    words, counts = [], []
    if slip:
        _, at, flat = kinds.buffers()
        at, flat = np.frombuffer(at, np.int64)[: len(kinds) + 1], np.frombuffer(flat, np.uint8)
        before = np.array([zlib.crc32(i + b":") for i in ids], np.uint32)
        sums = check_sums(before[row], flat, at[:-1][code], np.diff(at)[code])
        hit = sums % slip == 0
        for c, h, n in zip(code[hit].tolist(), sums[hit].tolist(), often[hit].tolist(), strict=True):
            word = kinds[c].as_py().decode()
            if len(word) > least_chars:
                words.append(word[: h % len(word)] + word[h % len(word) + 1 :])
                counts.append(n)
        code, often = code[~hit], often[~hit]
    n = np.bincount(code, often, minlength=len(kinds)).astype(np.int64)
    some = np.flatnonzero(n)
    word = pa.concat_arrays([kinds.take(pa.array(some)).cast(pa.large_string()), pa.array(words, pa.large_string())])
    return pa.table({"word": word, "n": pa.concat_arrays([pa.array(n[some]), pa.array(counts, pa.int64())])})


def _summed(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = 6, least: int = 5, slip: int = 0) -> DataFrame:
    """(word, n) of the runs of letters, A-Z lower-cased, with enough code points and occurrences.

    ``slip``: where it divides the CRC-32 of ``<id>:<run>``, the run loses the code point at that number
    modulo its length, which gives a text known slips of the pen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        out = lambda t: [pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), b.column(1)], ["word", "n"]) for b in t.to_batches(100_000)]
        for batch in batches:
            ids = [(i or "").encode() for i in batch.column("key").to_pylist()]
            for s in slices(batch, "text"):
                some = _counted(ids[s.first : s.last], s.data, s.offsets, least_chars, slip)
                if some is not None:
                    held.append(some)
                if sum(map(len, held)) > HELD:
                    held = [_summed(held)]
                    if len(held[0]) > HELD // 2:
                        yield from out(held.pop())
        if held:
            yield from out(_summed(held))

    counted = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


class Reduced:
    """Words of a batch, letter by letter, over the reduced alphabet."""

    def __init__(self, words: pa.Array, affix: int):
        self.size = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        letters = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.uint64)
        self.first = np.append(0, np.cumsum(self.size))
        self.symbol = (mix(letters * np.uint64(_STEP)) % np.uint64(SYMBOLS)).astype(np.int64)
        self.word = np.repeat(np.arange(len(self.size)), self.size)
        self.place = np.arange(len(letters)) - self.first[self.word]
        self.power = np.cumprod(np.append(np.uint64(1), np.full(int(self.size.max(initial=0)) + 1, _BASE, np.uint64)))
        self.value = mix((np.arange(SYMBOLS, dtype=np.uint64) + np.uint64(1)) * np.uint64(_STEP))
        self.term = self.value[self.symbol] * self.power[self.place]
        self.sums = np.append(np.uint64(0), np.cumsum(self.term))
        self.whole = self.sums[self.first[1:]] - self.sums[self.first[:-1]]
        # Farther apart than any two letters, lest a word's first letters have the hash of another's last ones.
        self.start, self.end = (np.full(len(self.size), np.uint64(tag)) for tag in (1 << 32, 1 << 33))
        for i in range(affix):
            self.start = mix(self.start + letters[self.first[:-1] + i])
            self.end = mix(self.end + letters[self.first[1:] - 1 - i])

    @staticmethod
    def key(reduced: np.ndarray, affix: np.ndarray) -> np.ndarray:
        return signed(mix(mix(reduced) + affix))


_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))
#: What was done to a word to get its neighbour. SAME: a letter became another of the same symbol.
SAME, REPLACED, DELETED, INSERTED = range(4)


def _chunks(words: pa.Array, letters: int = 50_000) -> Iterator[tuple[int, int]]:
    """Bounds of runs of words with about so many letters, one word at least."""
    ends = np.cumsum(pc.utf8_length(words).to_numpy(zero_copy_only=False))
    i = 0
    while i < len(words):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + letters, "right")))
        yield i, j
        i = j


def neighbourhoods(words: DataFrame, affix: int) -> DataFrame:
    """Per word (id, word) the keys of all reduced words one edit away: (key, id, kind, place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in _chunks(batch.column("word")):
                ids = batch.column("id").slice(i, j - i).to_numpy()
                x = Reduced(batch.column("word").slice(i, j - i), affix)
                w, p = x.word, x.place
                side = lambda w, p: np.where(p >= affix, x.start[w], x.end[w])
                before, behind = x.sums[:-1] - x.sums[x.first[w]], x.sums[x.first[w + 1]]
                parts = [(np.arange(len(ids)), x.whole, x.start, SAME, -1), (np.arange(len(ids)), x.whole, x.end, SAME, -2)]
                parts.append((w, before + (behind - x.sums[1:]) * _INVERSE, side(w, p), DELETED, p))
                for turn in range(1, SYMBOLS):
                    other = x.value[(x.symbol + turn) % SYMBOLS] * x.power[p]
                    parts.append((w, x.whole[w] - x.term + other, side(w, p), REPLACED, p))
                last = np.arange(len(ids))
                for value in x.value:
                    parts.append((w, before + value * x.power[p] + (behind - x.sums[:-1]) * _BASE, side(w, p), INSERTED, p))
                    parts.append((last, x.whole + value * x.power[x.size], side(last, x.size), INSERTED, x.size))
                for w, reduced, sides, kind, place in parts:
                    n = len(w)
                    columns = [pa.array(x.key(reduced, sides)), pa.array(ids[w]), pa.array(np.full(n, kind, np.int8)), pa.array(np.broadcast_to(np.asarray(place, np.int32), n))]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "id", "kind", "place"])

    return words.select("id", "word").mapInArrow(run, "key long, id long, kind tinyint, place int")


def filed(words: DataFrame, affix: int) -> DataFrame:
    """The vocabulary under its reduced words: (key, other, other_n), two rows a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in _chunks(batch.column("word")):
                some = batch.slice(i, j - i)
                x = Reduced(some.column("word"), affix)
                for side in (x.start, x.end):
                    yield pa.RecordBatch.from_arrays([pa.array(x.key(x.whole, side)), some.column("word"), some.column("n")], ["key", "other", "other_n"])

    return words.select("word", "n").mapInArrow(run, "key long, other string, other_n long")


def one_edit(word: Column, other: Column, kind: Column, place: Column, affix: int) -> Column:
    """Whether the edit at this place turns a word into the other, and no earlier place does."""
    letter = lambda s: F.substr(s, place + 1, F.lit(1))
    rest = lambda s, skip: F.substr(s, place + 1 + skip)
    alike = F.substr(word, F.lit(1), place) == F.substr(other, F.lit(1), place)
    moved = alike & (letter(word) != letter(other))
    # A replacement within one symbol has no place yet: it is behind the first letters, or within them.
    behind = F.substr(word, F.lit(1), F.lit(affix)) == F.substr(other, F.lit(1), F.lit(affix))
    same = (F.length(word) == F.length(other)) & (F.levenshtein(word, other, 1) == 1) & (behind == (place == -1))
    return (
        F.when(kind == SAME, same)
        .when(kind == REPLACED, moved & (rest(word, 1) == rest(other, 1)))
        .when(kind == DELETED, moved & (rest(word, 1) == rest(other, 0)))
        .otherwise(moved & (rest(word, 0) == rest(other, 1)))
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: pointers are doubled until none moves."""
    ways = written(forms.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        moved = Observation()
        ahead = ways.select(F.col("word").alias("root"), F.col("root").alias("__ahead"))
        ways = written(
            ways.join(ahead, "root", "left").observe(moved, F.count("__ahead").alias("n"))
            .select("word", F.coalesce("__ahead", "root").alias("root")), "spelling_roots")
        if not moved.get["n"]:
            return ways


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = 6, least: int = 5, times: int = 5, slip: int = 0) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of the vocabulary. A word's form is its most
    frequent near word, if that is ``times`` as frequent at least; its root ends the chain of forms."""
    affix = least_chars // 2
    words = written(vocabulary(docs, key, text, least_chars, least, slip).withColumn("id", F.monotonically_increasing_id()), "spelling_words")
    met = neighbourhoods(words, affix).join(filed(words, affix).hint("shuffle_hash"), "key").select("id", "kind", "place", "other", "other_n")
    fits = one_edit(F.col("word"), F.col("other"), F.col("kind"), F.col("place"), affix)
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("word")))
    near = met.join(words, "id").where(fits).groupBy("id").agg(F.count("*").alias("n_near"), best.alias("best"))
    taken = -F.col("best.less") >= F.lit(times) * F.col("n")
    judged = written(
        words.join(near, "id", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(taken, F.col("best.word")).alias("form"), F.when(taken, -F.col("best.less")).alias("form_n")), "spelling_near")
    roots = _roots(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
