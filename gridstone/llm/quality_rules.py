"""Quality rules as a short-circuit cascade, ordered by rejections per cost.

A rule says which texts fail. All rules must pass, so their order decides only how much work is done:
a text that one rule rejects is not shown to the next ones. The order comes from a sample: every rule
is run on all sampled texts and timed, and the rules are taken greedily, each time the one that rejects
most of what is left per second. A rule that rejects nothing of the sample comes after those that do,
cheapest first. The sample decides no verdict, and reruns agree whatever it times.

The base counts are wanted for every text and so come first; rules that only compare them cost next to
nothing afterwards. Texts that fail the base test run no other rule.

A word is a maximal run of characters other than the space and U+0009 to U+000D, a line what stands
between ``\\n``. Lines and words are compared as exact bytes; five-word windows by a chain of scrambled
64-bit numbers, within one text only.

Nulls: a null text is one without words and fails the base test; a null id is kept as it is. Repeated
rows are judged one by one. Texts are taken whole, a text over ``SLICE_BYTES`` alone. An empty table
gives an empty result. Columns other than the two named are left out, so their names cannot clash.
One job, for the sample, runs when called."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridstone.llm.common import Slice, covered, mix, record, sent, slices, windows

#: About so many texts are sampled to order the rules.
SAMPLE = 2000
#: A text fails with fewer words, or when more words than this share lie in repeated windows.
LEAST_WORDS, WINDOW, MOST_REPEATED_PERCENT = 10, 5, 20

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _marks(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in characters]] = True
    return table


_SYMBOL = _marks("#*$%&|<>")
_UPPER, _LOWER = _marks("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _marks("abcdefghijklmnopqrstuvwxyz")
#: Bytes that make a word one with letters: A-Z, a-z, and all beyond ASCII.
_LETTER = _UPPER | _LOWER
_LETTER[0x80:] = True
_SCALARS = np.ones(256, bool)  # bytes that begin a code point
_SCALARS[0x80:0xC0] = False


def _codes(data: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """One number for each distinct run of bytes. Runs must not overlap and stand in order."""
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, begin, 1)
    np.add.at(inside, stop, -1)
    joined = data[np.cumsum(inside[:-1]) > 0]
    offsets = np.append(0, np.cumsum(stop - begin)).astype(np.int64)
    runs = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(joined))])
    return runs.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


class Texts:
    """Some whole texts as bytes, with counts that are made when first asked for."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def only(self, rows: np.ndarray) -> Texts:
        """The rows of a mask, with the words and counts that are known of them."""
        sizes = np.diff(self.offsets)
        some = Texts(self.data[np.repeat(rows, sizes)], np.append(0, np.cumsum(sizes[rows])))
        if "words" in self.__dict__:
            begin, stop, first = self.words
            count = np.diff(first)
            mine = np.repeat(rows, count)
            moved = np.repeat((some.offsets[:-1] - self.offsets[:-1][rows]), count[rows])
            some.words = (begin[mine] + moved, stop[mine] + moved, np.append(0, np.cumsum(count[rows])))
            if "word_codes" in self.__dict__:
                some.word_codes = self.word_codes[mine]
        for name in BASE:
            if name in self.__dict__:
                setattr(some, name, getattr(self, name)[rows])
        return some

    def _per_text(self, marks: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(marks))[self.offsets])

    def _per_word_text(self, marks: np.ndarray) -> np.ndarray:
        """Counts of marked words."""
        return np.diff(np.append(0, np.cumsum(marks))[self.words[2]])

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return Slice(self.data, self.offsets, 0, len(self)).words()

    @cached_property
    def word_codes(self) -> np.ndarray:
        return _codes(self.data, *self.words[:2])

    @cached_property
    def n_words(self) -> np.ndarray:
        return np.diff(self.words[2])

    @cached_property
    def word_chars(self) -> np.ndarray:
        until = np.append(0, np.cumsum(_SCALARS[self.data]))
        begin, stop, first = self.words
        return np.diff(np.append(0, np.cumsum(until[stop] - until[begin]))[first])

    @cached_property
    def n_symbols(self) -> np.ndarray:
        return self._per_text(_SYMBOL[self.data])

    @cached_property
    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of every line with a word, and the text of each."""
        breaks = np.flatnonzero(self.data == 0x0A)
        begin = np.unique(np.concatenate([self.offsets[:-1], breaks + 1]))
        begin = begin[begin < len(self.data)]
        stop = np.append(begin[1:], len(self.data))[: len(begin)]
        stop = stop - (self.data[stop - 1] == 0x0A)
        with_word = np.searchsorted(self.words[0], stop) > np.searchsorted(self.words[0], begin)
        begin, stop = begin[with_word], stop[with_word]
        return begin, stop, np.searchsorted(self.offsets, begin, "right") - 1

    @cached_property
    def n_lines(self) -> np.ndarray:
        return np.bincount(self.lines[2], minlength=len(self))

    @cached_property
    def n_dup_lines(self) -> np.ndarray:
        begin, stop, row = self.lines
        code = _codes(self.data, begin, stop)
        kinds = np.unique(row * (len(code) + 1) + code)
        return self.n_lines - np.bincount(kinds // (len(code) + 1), minlength=len(self))

    @cached_property
    def n_repeat_words(self) -> np.ndarray:
        first, code = self.words[2], self.word_codes
        count = np.diff(first)
        row, ends = np.repeat(np.arange(len(self)), count), np.repeat(first[1:], count)
        whole = np.flatnonzero(windows(ends, WINDOW))
        chain = mix(row[whole].astype(np.uint64))
        for i in range(WINDOW):
            chain = mix(chain + code[whole + i].astype(np.uint64) + np.uint64(1))
        _, which, often = np.unique(chain, return_inverse=True, return_counts=True)
        return self._per_word_text(covered(len(code), whole[often[which] > 1], WINDOW))

    @cached_property
    def top_word(self) -> np.ndarray:
        """How often the most frequent word occurs."""
        return self._most(self.word_codes, np.diff(self.words[2]))

    @cached_property
    def top_pair(self) -> np.ndarray:
        """How often the most frequent pair of consecutive words occurs."""
        count = np.diff(self.words[2])
        first = np.flatnonzero(windows(np.repeat(self.words[2][1:], count), 2))
        code = self.word_codes
        return self._most(code[first] * (len(code) + 1) + code[first + 1], np.maximum(count - 1, 0))

    @staticmethod
    def _most(code: np.ndarray, count: np.ndarray) -> np.ndarray:
        row = np.repeat(np.arange(len(count)), count)
        order = np.lexsort((code, row))
        row, code = row[order], code[order]
        new = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (code[1:] != code[:-1]))) if len(row) else np.zeros(0, np.int64)
        most = np.zeros(len(count), np.int64)
        np.maximum.at(most, row[new], np.diff(np.append(new, len(row))))
        return most

    @cached_property
    def n_stutters(self) -> np.ndarray:
        """Words that equal the one before."""
        same = np.append(False, self.word_codes[1:] == self.word_codes[:-1])[: len(self.word_codes)]
        same[self.words[2][:-1][np.diff(self.words[2]) > 0]] = False
        return self._per_word_text(same)

    @cached_property
    def n_letter_words(self) -> np.ndarray:
        """Words with a letter."""
        begin, stop, _ = self.words
        until = np.append(0, np.cumsum(_LETTER[self.data]))
        return self._per_word_text(until[stop] > until[begin])

    @cached_property
    def n_upper(self) -> np.ndarray:
        return self._per_text(_UPPER[self.data])

    @cached_property
    def n_lower(self) -> np.ndarray:
        return self._per_text(_LOWER[self.data])

    def base_failed(self) -> np.ndarray:
        return (self.n_words < LEAST_WORDS) | (100 * self.n_repeat_words > MOST_REPEATED_PERCENT * self.n_words)


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Callable[[Texts], np.ndarray]


RULES = (
    Rule("word_length", lambda t: (t.word_chars < 2 * t.n_words) | (t.word_chars > 15 * t.n_words)),
    Rule("symbols", lambda t: 10 * t.n_symbols > t.n_words),
    Rule("repeated_lines", lambda t: 100 * t.n_dup_lines > 50 * t.n_lines),
    Rule("letters", lambda t: 100 * t.n_letter_words < 70 * t.n_words),
    Rule("upper_case", lambda t: 100 * t.n_upper > 50 * (t.n_upper + t.n_lower)),
    Rule("stutter", lambda t: 100 * t.n_stutters > 30 * t.n_words),
    Rule("top_word", lambda t: 100 * t.top_word > 30 * t.n_words),
    Rule("top_pair", lambda t: 100 * t.top_pair > 20 * t.n_words),
)


def texts_of(batch: pa.RecordBatch, column: str) -> Iterator[tuple[Slice, Texts]]:
    for s in slices(batch, column):
        yield s, Texts(s.data, s.offsets)


def measured(docs: DataFrame, rules: Sequence[Rule], text: str, sample: int) -> tuple[dict[str, float], list[tuple[int, int]]]:
    """Seconds each rule took on the sample, and how many sampled texts failed which set of rules (bits)."""
    share = min(1.0, sample / max(1, docs.count()))
    there = sent(docs.sparkSession, tuple(rules))
    out = pa.schema([("failed", pa.int64()), ("texts", pa.int64()), *((f"s{i}", pa.float64()) for i in range(len(rules)))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = there()
        for batch in batches:
            for _, t in texts_of(batch, "text"):
                open_texts = t.only(~t.base_failed())
                failed, seconds = np.zeros(len(open_texts), np.int64), []
                for i, rule in enumerate(rules):
                    fresh = open_texts.only(np.ones(len(open_texts), bool))
                    began = time.perf_counter()
                    failed |= rule.fails(fresh).astype(np.int64) << i
                    seconds.append(time.perf_counter() - began)
                kinds, often = np.unique(failed, return_counts=True)
                shares = often / max(1, len(failed))
                yield record(out, kinds, often, *(x * shares for x in seconds))

    names = [f.name for f in out]
    rows = docs.select(F.col(text).alias("text")).sample(share, seed=7).mapInArrow(run, ", ".join(f"{n} {'long' if k < 2 else 'double'}" for k, n in enumerate(names)))
    found = rows.groupBy("failed").agg(*(F.sum(n).alias(n) for n in names[1:])).collect()
    return {r.name: sum(x[f"s{i}"] or 0.0 for x in found) for i, r in enumerate(rules)}, [(x.failed, x.texts) for x in found]


def ordered(rules: Sequence[Rule], seconds: dict[str, float], patterns: list[tuple[int, int]]) -> list[Rule]:
    """Greedy: next the rule that rejects most of what is left per second, then the cheapest."""
    bit = {r.name: 1 << i for i, r in enumerate(rules)}
    left, out = list(rules), []
    while left:
        rejects = {r.name: sum(n for failed, n in patterns if failed & bit[r.name]) for r in left}
        best = min(left, key=lambda r: (-rejects[r.name] / max(seconds[r.name], 1e-9), seconds[r.name]))
        out.append(best)
        left.remove(best)
        patterns = [(failed, n) for failed, n in patterns if not failed & bit[best.name]]
    return out


def apply_rules(texts: Texts, rules: Sequence[Rule]) -> np.ndarray:
    """Which texts pass: each rule sees what those before it left."""
    kept = ~texts.base_failed()
    left, rows = texts.only(kept), np.flatnonzero(kept)
    for rule in rules:
        if not len(rows):
            break
        failed = rule.fails(left)
        if failed.any():
            kept[rows[failed]] = False
            left, rows = left.only(~failed), rows[~failed]
    return kept


def cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """Per row ``key``, the base counts, base_failed and kept."""
    there = sent(docs.sparkSession, tuple(ordered(rules, *measured(docs, rules, text, sample))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = there()
        for batch in batches:
            for s, t in texts_of(batch, "text"):
                counts = [pa.array(getattr(t, name).astype(np.int64)) for name in BASE]
                columns = [batch.column("key").slice(s.first, len(s)), *counts, pa.array(t.base_failed()), pa.array(apply_rules(t, rules))]
                yield pa.RecordBatch.from_arrays(columns, [key, *BASE, "base_failed", "kept"])

    kind = docs.schema[key].dataType.simpleString()
    wanted = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return wanted.mapInArrow(run, f"`{key}` {kind}, {', '.join(f'{n} long' for n in BASE)}, base_failed boolean, kept boolean")
