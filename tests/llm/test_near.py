"""Near duplicates and benchmark items, against brute force."""

import random

import pytest

from gridstone.llm import minhash_dedup
from gridstone.llm.decontaminate import find_items
from gridstone.llm.minhash_dedup import near_duplicates


def shingle_set(text, width):
    w = (text or "").lower().split()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


@pytest.mark.parametrize("few", [32, 3])
def test_components_equal_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(minhash_dedup, "FEW", few)
    monkeypatch.setattr(minhash_dedup, "BLOCK", 16)
    monkeypatch.setattr(minhash_dedup, "ROUNDS", 1)
    rnd = random.Random(1)
    base = [rnd.choice("abcdefghij") + str(rnd.randrange(50)) for _ in range(120)]
    texts = []
    for _ in range(90):
        w = list(base)
        for _ in range(rnd.randrange(0, 14)):
            w[rnd.randrange(len(w))] = f"z{rnd.randrange(10**6)}"
        texts.append(" ".join(w))
    texts += [texts[3].upper(), texts[4], "", None, "one two", "one two", "three"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[0], "x")], "doc_id long, text string, node string")
    sets = [shingle_set(t, 3) for t in texts]
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    got = {r.doc_id: r for r in near_duplicates(df, width=3, percent=85).collect()}
    assert [got[i].component_id for i in range(len(sets))] == root
    assert [got[i].n_shingles for i in range(len(sets))] == [len(s) for s in sets]
    assert all(got[i].kept == (root[i] == i) for i in range(len(sets)))
    assert got[None].component_id is None and got[None].kept


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90)], "a long, b long")
    got = {r.node: r.component for r in minhash_dedup.components(links).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and got[100] == 90


def test_nothing_to_compare(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).collect() == []
    assert near_duplicates(empty.unionByName(spark.createDataFrame([(1, None)], empty.schema))).first().component_id == 1


def test_items_in_documents(spark):
    rnd = random.Random(5)
    word = lambda: f"v{rnd.randrange(500)}"
    items = [" ".join(word() for _ in range(n)) for n in (3, 9, 20, 40, 58)] + [None, ""]
    long = [" ".join(word() for _ in range(3000)) for _ in range(8)]
    texts = [f"{long[i]} {items[i % 5].upper()} {long[-i]}" for i in range(8)] + long + ["", None, items[0], items[2].rsplit(" ", 3)[0]]
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], "item_id long, text string, doc_id string")
    docs = spark.createDataFrame([(i, t, "y") for i, t in enumerate(texts)], "doc_id long, text string, item_id string")
    got = {(r.doc_id, i.item, i.size, i.shared) for r in find_items(docs, bench, ["doc_id"]).collect() for i in r["items"]}
    want = set()
    for d, t in enumerate(texts):
        own = shingle_set(t, 5)
        for i, item in enumerate(items):
            q = shingle_set(item, 5)
            if q and 100 * len(q & own) >= 80 * len(q):
                want.add((d, i, len(q), len(q & own)))
    assert got == want and len(want) > 6
    assert find_items(docs, bench.where("false"), ["doc_id"]).where("size(items) > 0").count() == 0
    assert find_items(docs.where("false"), bench, ["doc_id"]).collect() == []
