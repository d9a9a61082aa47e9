"""Hard negatives, against brute force."""

import math
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from gridstone.llm import hard_negatives
from gridstone.llm.hard_negatives import RTree, Tiles, mine

TYPES = "vec_id long, embedding array<double>, label int, id string, v int"


def brute(rows):
    rows = [(i, x, [math.floor(256 * c) for c in v]) for i, v, x, *_ in rows if i is not None and x is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    first = {}
    for i, x, v in sorted(rows):
        first.setdefault(i, (x, v))
    for a, (label, av) in first.items():
        if a % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(av, v, strict=True)), i, x) for i, x, v in rows if i != a and len(v) == len(av))
        for p, positive, _ in [s for s in scored if s[2] == label][:5]:
            fits = [s for s in scored if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p][:5]
            out += [(a, positive, rank, i, -p, -s) for rank, (s, i, _) in enumerate(fits, 1)]
    return sorted(out)


def vectors(n, length, seed, spread=0.3):
    rnd = np.random.default_rng(seed)
    centres = rnd.standard_normal((6, length))
    return [[float(c) for c in centres[rnd.integers(6)] + spread * rnd.standard_normal(length)] for _ in range(n)]


@pytest.mark.parametrize("page,leaf,block", [(4096, 64, 1 << 19), (50, 4, 60)])
def test_results_equal_brute_force(spark, monkeypatch, page, leaf, block):
    for name, value in (("PAGE", page), ("LEAF", leaf), ("BLOCK_NUMBERS", block), ("SAMPLE_NUMBERS", 1000)):
        monkeypatch.setattr(hard_negatives, name, value)
    rnd = random.Random(4)
    some = vectors(700, 8, 1)
    some[200:420] = [some[200]] * 220  # a third of the rows are one vector
    rows = [(i, v, rnd.randrange(3), "x", 1) for i, v in enumerate(some)]
    rows += [(1000 + i, v, rnd.randrange(2), "x", 1) for i, v in enumerate(vectors(40, 3, 2))]
    rows += [(1200, [], 1, "x", 1), (1201, [], 2, "x", 1), (1202, [], 1, "x", 1), (1300, [0.0] * 8, 1, "x", 1)]
    rows += [(1400, None, 1, "x", 1), (1500, [1.0, None] * 4, 1, "x", 1), (1600, [math.nan] * 8, 1, "x", 1), (1700, [math.inf] * 8, 1, "x", 1), (1800, some[0], None, "x", 1), (None, some[0], 1, "x", 1)]
    rows += [(300, some[5], 0, "x", 1), (7, some[7], 1, "x", 1), (7, some[7], 1, "x", 1)]  # an id twice, a row again
    got = sorted(map(tuple, mine(spark.createDataFrame(rows, TYPES), F.col("vec_id") % 100 == 0).collect()))
    want = brute(rows)
    assert got == want and len(want) > 100


def test_large_scores_are_exact_and_those_beyond_longs_refused(spark):
    large = 5e4
    rows = [(i, [large + i / 256, large, -float(i)], i % 2, "x", 1) for i in range(0, 60, 1)]
    df = spark.createDataFrame(rows, TYPES)
    assert sorted(map(tuple, mine(df, F.col("vec_id") % 100 == 0).collect())) == brute(rows)
    with pytest.raises(ValueError):
        mine(df.withColumn("embedding", F.array(F.lit(1e300))), F.col("vec_id") % 100 == 0)


def test_scores_between_doubles_and_longs(spark):
    rows = [(i, [2.0**20 + i / 256, 2.0**20 - i / 128], i % 2, "x", 1) for i in range(30)]
    assert sorted(map(tuple, mine(spark.createDataFrame(rows, TYPES), F.col("vec_id") == 0).collect())) == brute(rows)


def test_nothing_to_mine(spark):
    empty = spark.createDataFrame([], TYPES)
    assert mine(empty, F.col("vec_id") % 100 == 0).collect() == []
    lone = spark.createDataFrame([(100, [1.0], 1, "x", 1), (3, [1.0], 2, "x", 1)], TYPES)
    assert mine(lone, F.col("vec_id") % 100 == 0).collect() == []
    assert mine(lone, F.col("vec_id") == 5).collect() == []


def test_boxes_bound_and_prune():
    rnd = np.random.default_rng(3)
    v = np.floor(256 * np.array(vectors(3000, 6, 5, 0.05)))
    label = rnd.integers(0, 4, 3000)
    tree = RTree(np.arange(3000), label, v)
    anchors = v[:5]
    least, most = tree.scores_of(anchors)
    assert sorted(tree.ids.tolist()) == list(range(3000)) and len(tree.low) == len(tree.children)
    for k in range(tree.leaves):
        rows = slice(tree.begin[k], tree.begin[k + 1])
        score = tree.vectors[rows] @ anchors.T
        assert (score.min(axis=0) >= least[:, k]).all() and (score.max(axis=0) <= most[:, k]).all()
        assert tree.labels[0][k] == tree.label[rows].min() and tree.labels[1][k] == tree.label[rows].max()
    seen = []
    bound = np.sort(v @ anchors[0])[-5]
    tree.search(anchors[0], least[0], most[0], np.ones(len(tree.low), bool), lambda low, high: high >= bound, lambda rows, score: seen.append((rows, score)))
    assert len(seen) < tree.leaves / 2 and sum((s >= bound).sum() for _, s in seen) == (v @ anchors[0] >= bound).sum()


def test_tiles_hold_all_rows():
    rnd = np.random.default_rng(8)
    v, label = rnd.standard_normal((4000, 5)), rnd.integers(0, 3, 4000)
    tiles = Tiles(label[:1000], v[:1000], 30)
    n = np.bincount(tiles.of(label, v), minlength=tiles.n)
    assert n.sum() == 4000 and tiles.n >= 20 and n.max() < 4000 / 6
