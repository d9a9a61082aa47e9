"""Removal of repeated spans, against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest

from gridstone.llm import suffix_dedup
from gridstone.llm.suffix_dedup import remove_earlier
from gridstone.llm.window_dedup import remove_repeated

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(3)
    own = [" ".join(rnd.choice(["ab", "c", "dé", "e,"]) for _ in range(rnd.choice([3, 40, 90]))) for _ in range(25)]
    shared = " ".join(f"w{rnd.randrange(900)}" for _ in range(60))
    own += [f"start {i} {shared} end {i}" for i in range(6)] + ["x y " * 50, "z " * 80, None, "", "\x0b \x1c tab\tword", "ÿ" * 70]
    return own + own[:4] + [own[-1]]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, 1, "k") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, sig long, kept string")


def earlier(texts, depth=50):
    first = {}
    for d, t in enumerate(texts):
        b = (t or "").encode()
        for i in range(len(b) - depth + 1):
            first.setdefault(b[i : i + depth], d)
    for d, t in enumerate(texts):
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - depth + 1):
            if first[b[i : i + depth]] < d:
                gone[i : i + depth] = [True] * depth
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        yield d, len(b), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(kept).hexdigest(), kept


def repeated(texts, window=35):
    found = [WORDS.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in found for i in range(len(w) - window + 1))
    for d, w in enumerate(found):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        yield d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept


def test_earlier_bytes(docs, texts):
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in remove_earlier(docs).collect())
    assert got == list(earlier(texts))


def test_repeated_words(docs, texts):
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in remove_repeated(docs).collect())
    assert got == list(repeated(texts))


def test_rows_without_an_id_come_last(spark):
    same = "abcdefghij" * 6
    df = spark.createDataFrame([(None, same), (4, same), (4, same)], "doc_id long, text string")
    assert sorted((r.doc_id is None, r.n_removed) for r in remove_earlier(df).collect()) == [(False, 0), (False, 0), (True, 60)]
    assert len(remove_repeated(df).collect()) == 3


def test_empty_table_and_no_leftover_tables(spark, docs):
    assert remove_earlier(docs.where("false")).collect() == [] and remove_repeated(docs.where("false")).collect() == []
    assert not [t for t in spark.catalog.listTables() if "dedup" in t.name]


@pytest.mark.parametrize("together", [7, 1 << 20])
def test_digits_of_two_documents_travel_packed(spark, monkeypatch, together):
    monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
    rng = random.Random(3)
    everywhere = "".join(rng.choices("abcdefgh", k=120))
    texts = [everywhere + "".join(rng.choices("abcdefgh", k=rng.randrange(200))) for _ in range(40)] + [None, "short", "x" * 300]
    texts += [texts[3][100:] + "tail", "x" * 200]
    df = spark.createDataFrame(list(enumerate(texts)), "__key long, text string").repartition(3).unionAll(spark.createDataFrame([(42, "y" * 300), (42, "y" * 300)], "__key long, text string")).persist()

    def digits(batch, s):
        x = suffix_dedup.Suffixes(s, 50, 20)
        row, digit, _ = suffix_dedup.distinct(x.run_row, x.run_digit)
        return row, digit

    every = [tuple(r) for r in suffix_dedup._rows(df, digits, "__key long, sig long", ("sig",)).collect()]
    keys = {}
    for k, sig in every:
        keys.setdefault(sig, set()).add(k)
    assert max(map(len, keys.values())) >= 40  # such digits are known to be frequent beforehand
    found = suffix_dedup._in_two_documents(df, digits, len(texts))
    assert sorted(map(tuple, found.collect())) == sorted((k, sig) for k, sig in every if len(keys[sig]) > 1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(bucket" in plan and "Window" not in plan
    docs = df.where("__key != 42")
    rest = [t for i, t in enumerate(texts) if i != 42]
    got = sorted((r["__key"], r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_earlier(docs, key="__key", keep=False).collect())
    assert [r[1:] for r in got] == [r[1:5] for r in earlier(rest)]
    df.unpersist()
