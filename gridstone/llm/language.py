"""Language of a text from words first, then from ever shorter character n-grams.

Words are runs of letters, lower-cased. A known word scores by its log frequency in each language. For
an unseen word the longest n-grams (with its edges marked) that any language knows decide, from four
characters down to one. A text gets the language with the best total.

Words are counted over every labelled document that is not held out; n-grams follow from the word
counts. What is sent to tasks is bounded: at most the WORDS most frequent words and, per length, at most the GRAMS
most frequent n-grams of each of at most LANGUAGES languages.

Nulls: a text that is null or has no letter is ``und`` with score 0, as is every text when nothing was
learned. Documents without a language, or without an id, teach nothing; the latter are not held out.
Repeated rows count each time. Runs jobs when called."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstone.llm.common import frequent, sent, written

WORDS, GRAMS, LONGEST, LANGUAGES = 20_000, 5_000, 4, 64
UNKNOWN = "und"
_AT_ONCE = 100_000  # different words of texts judged together; a text is never split
_CERTAIN_AFTER = 12  # words whose evidence is added up in full; a longer text counts as so many


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


class Model:
    """Log frequencies by language of words and n-grams, one row each."""

    def __init__(self, words: list[tuple[str, str, int]], grams: list[tuple[str, str, int]], totals: dict[str, int]):
        self.languages = sorted(totals)
        place = {x: i for i, x in enumerate(self.languages)}
        values, self.logs = self._table(words, place, np.array([totals[x] for x in self.languages], float))
        self.index = {v: i for i, v in enumerate(values)}
        self.grams = {}
        for n in range(1, LONGEST + 1):
            own = [g for g in grams if len(g[1]) == n and g[1] != "_"]
            sums = np.ones(len(place))
            for language, _, count in own:
                sums[place[language]] += count
            values, logs = self._table(own, place, sums)
            keys = _keys(_codes("".join(values)), n)[::n]
            order = np.argsort(keys)
            self.grams[n] = keys[order], logs[order]

    @staticmethod
    def _table(rows, place, totals) -> tuple[list[str], np.ndarray]:
        counts: dict[str, np.ndarray] = {}
        for language, value, n in rows:
            counts.setdefault(value, np.zeros(len(place)))[place[language]] = n
        known = np.array(list(counts.values())).reshape(len(counts), len(place))
        return list(counts), np.log((known + 0.5) / (totals + 0.5 * (len(counts) + 1)))

    def unseen(self, words: list[str]) -> np.ndarray:
        """Mean log frequency of each word's longest known n-grams; zeros where none is known."""
        codes = _codes("".join(f"_{w}_" for w in words))
        sizes = np.array([len(w) + 2 for w in words], np.int64)
        word, end = np.repeat(np.arange(len(words)), sizes), np.repeat(np.cumsum(sizes), sizes)
        result, waiting = np.zeros((len(words), len(self.languages))), np.ones(len(words), bool)
        for n in range(LONGEST, 0, -1):
            table, logs = self.grams[n]
            if not len(table):
                continue
            keys = _keys(codes, n)
            at = np.flatnonzero(waiting[word[: len(keys)]] & (np.arange(len(keys)) + n <= end[: len(keys)]))
            near = np.minimum(np.searchsorted(table, keys[at]), len(table) - 1)
            hit = table[near] == keys[at]
            of, near = word[at[hit]], near[hit]
            found = np.bincount(of, minlength=len(words))
            for i in range(len(self.languages)):
                result[:, i] += np.bincount(of, logs[near, i], len(words)) / np.maximum(found, 1)
            waiting &= found == 0
        return result


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _keys(codes: np.ndarray, n: int) -> np.ndarray:
    """A number for the n characters from each position on."""
    count = max(0, len(codes) - n + 1)
    key = np.zeros(count, np.uint64)
    for i in range(n):
        key = key * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + count]
    return key


def learn(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    taught = documents.where(F.col(key).isNotNull() & ~held_out(F.col(key)) & F.col(lang).isNotNull())
    words = taught.select(F.col(lang).cast("string").alias("lang"), F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"(\p{L}+)"), F.lit(0))).alias("value"))
    counted = written(words.groupBy("lang", "value").agg(F.count("*").alias("n")), "language_words")
    totals = {r.lang: r.n for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).limit(LANGUAGES + 1).collect()}
    if len(totals) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    top = frequent(counted, "n", WORDS, ["lang"]).toArrow()
    marked = F.concat(F.lit("_"), "value", F.lit("_"))
    pieces = F.flatten(F.array(*[
        F.transform(F.sequence(F.lit(1), F.greatest(F.length(marked) - n + 1, F.lit(1))), lambda i, n=n: F.substring(marked, i, n))
        for n in range(1, LONGEST + 1)
    ]))
    grams = counted.select("lang", "n", F.explode(pieces).alias("value")).groupBy("lang", "value").agg(F.sum("n").alias("n")).withColumn("size", F.length("value"))
    some = frequent(written(grams, "language_grams"), "n", GRAMS, ["lang", "size"]).toArrow()
    rows = lambda t: list(zip(*(t[c].to_pylist() for c in ("lang", "value", "n")), strict=True))
    return Model(rows(top), rows(some), totals)


def identify(documents: DataFrame, model: Model, carry: Sequence[str] = ("doc_id",), text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns ``carry`` with the language of the text and how sure it is, from 0 to 1."""
    spark = documents.sparkSession
    shared = sent(spark, model)
    source = documents.select(*carry, F.col(text).alias("__text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "__text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared()
        letters = regex.compile(r"\p{L}+")
        known = len(m.index)
        for batch in batches:
            texts = batch.column("__text")
            said, sure = [], []
            while len(said) < len(texts):
                place, times, per_text, fresh = [], [], [], {}
                for text in texts.slice(len(said)):
                    t = text.as_py()
                    counts = Counter(letters.findall(t.lower())) if t and m.languages else {}
                    for word in counts:
                        if (i := m.index.get(word)) is None:
                            i = known + fresh.setdefault(word, len(fresh))
                        place.append(i)
                    times.extend(counts.values())
                    per_text.append(len(counts))
                    if len(place) >= _AT_ONCE:
                        break
                best, score = _judge(np.concatenate([m.logs, m.unseen(list(fresh))]), np.array(place, np.int64), np.array(times, float), np.array(per_text))
                said += [m.languages[b] if n else UNKNOWN for b, n in zip(best.tolist(), per_text, strict=True)]
                sure += score.tolist()
            kept = [batch.column(c) for c in batch.schema.names if c != "__text"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(said, pa.string()), pa.array(sure, pa.float64())], [*(c for c in batch.schema.names if c != "__text"), *names])

    return source.mapInArrow(run, ", ".join([*fields, f"`{names[0]}` string", f"`{names[1]}` double"]))


def _judge(logs: np.ndarray, place: np.ndarray, times: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best language and its share for each text, given the rows of its different words and how often
    each occurs; no words, share 0."""
    if not logs.shape[1]:
        return np.zeros(len(per_text), np.int64), np.zeros(len(per_text))
    of, n = np.repeat(np.arange(len(per_text)), per_text), len(per_text)
    total = np.column_stack([np.bincount(of, times * logs[place, i], n) for i in range(logs.shape[1])])
    size = np.bincount(of, times, n)
    z = total * (np.minimum(size, _CERTAIN_AFTER) / np.maximum(size, 1))[:, None]
    share = 1 / np.exp(z - z.max(axis=1, keepdims=True)).sum(axis=1)
    return z.argmax(axis=1), np.where(per_text > 0, share, 0.0)
