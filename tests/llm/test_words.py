"""Hashes of words: long words of a regular pattern are told apart wherever words are compared."""

import random

import numpy as np
import pytest

from gridstone.llm.common import Slice
from gridstone.llm.decontaminate import find_items
from gridstone.llm.lm_scoring import fit, score
from gridstone.llm.minhash_dedup import near_duplicates
from gridstone.llm.window_dedup import remove_repeated


def doubling(n, letters="ab"):
    """Each half is the other letters' version of the one before: sums of powers cancel on these."""
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


@pytest.fixture(scope="module", params=[1024, 2048, 4096])
def pair(request):
    return doubling(request.param), doubling(request.param, "ba")


def hashes(words, folded=False):
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    s = Slice(data, np.array([0, len(data)]), 0, 1)
    return s.word_symbols(*s.words()[:2], folded=folded).tolist()


def test_hashes_differ_by_content_length_and_place():
    rnd = random.Random(4)
    words = {"".join(rnd.choice("abé日\x00") for _ in range(rnd.randrange(1, 40))) for _ in range(5000)}
    words |= {"a" * n for n in range(1, 200)} | {"a\x00", "a\x00\x00", "\x00"} | {"abcdefgh" * n + x for n in range(5) for x in ("", "i", "j")} - {""}
    words |= {f(n, x) for n in (64, 256, 1024, 2048, 4096) for x in ("ab", "ba") for f in (doubling,)} | {doubling(512, (a, b)) for a, b in (("abcdefgh", "hgfedcba"), ("hgfedcba", "abcdefgh"))}
    words = sorted(words)
    assert len(set(hashes(words))) == len(words)
    assert hashes(["aBc", "x" * 9 + "Q"], folded=True) == hashes(["abc", "x" * 9 + "q"], folded=True)
    assert hashes(["one", "two", "one"])[0] == hashes(["two", "one"])[1]
    assert hashes([]) == []


def test_windows_that_differ_in_one_long_word(spark, pair):
    rest = [f"w{i}" for i in range(40)]
    texts = [" ".join([*rest[:20], p, *rest[20:]]) for p in pair]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.n_removed for r in remove_repeated(df).collect()] == [0, 0]


def test_documents_and_items_that_differ_in_one_long_word(spark, pair):
    a, b = pair
    df = spark.createDataFrame([(0, f"{a} x y"), (1, f"{b} x y"), (2, f"{a} x y")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_duplicates(df).collect()} == {0: 0, 1: 1, 2: 0}
    items = spark.createDataFrame([(0, f"{b} x y")], "item_id long, text string")
    assert {r.doc_id: len(r["items"]) for r in find_items(df, items, ["doc_id"]).collect()} == {0: 0, 1: 1, 2: 0}


def test_long_words_have_their_own_counts(spark, pair):
    a, b = pair
    df = spark.createDataFrame([(0, f"{a} {a} {a}", True), (1, f"{b} {b} {b}", False), (2, a, None), (3, b, None)], "doc_id long, text string, good boolean")
    got = {r.doc_id: r for r in score(df, fit(df, df["good"])).collect()}
    numbers = lambda r: [v for c, v in r.asDict().items() if isinstance(v, float)]
    assert numbers(got[2]) != numbers(got[3])
