"""The operators that judge documents one by one, and the pipeline."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridstone.llm import lm_scoring, mixing
from gridstone.llm.language import held_out, identify, learn
from gridstone.llm.lm_scoring import FLOOR, WEIGHT, fit, score
from gridstone.llm.mixing import mix_sources
from gridstone.llm.neighbours import nearest
from gridstone.llm.pseudonyms import feistel, permuted_digits, replace_personal
from gridstone.llm.queries import HOST_RULES, QUERIES, SQL
from gridstone.llm.url_filter import Rule, judge

duckdb = pytest.importorskip("duckdb")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, small, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
    df = QUERIES[name](spark, small)
    columns = sorted(df.columns)
    want = con.execute(f"select {', '.join(columns)} from ({SQL[name]})").fetchall()
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(map(repr, want))


def test_lm_scores_equal_a_plain_model(spark):
    texts = [("a b a c", True), ("a b b", True), ("c c d a b", False), ("d", None), ("", False), (None, True)]
    df = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(texts)], "doc_id long, text string, good boolean")
    got = {r.doc_id: r for r in score(df, fit(df, F.col("good"))).collect()}
    words = [(t or "").split() for t, _ in texts]
    vocabulary = {w for ws in words for w in ws}
    counts = {}
    for side in (True, False):
        own = [w for w, (_, g) in zip(words, texts, strict=True) if bool(g) == side]
        counts[side] = Counter(x for w in own for x in w), Counter(p for w in own for p in zip([None, *w], w, strict=False)), Counter(b for w in own for b in [None, *w][:-1])
    totals = {s: sum(c[0].values()) for s, c in counts.items()}
    for side, name in ((True, "loss_target"), (False, "loss_background")):
        scale = 1 if side else totals[True] / totals[False]
        single, pair, before = counts[side]
        for i, w in enumerate(words):
            if not w:
                assert got[i][name] is None and got[i].n_words == 0
                continue
            loss = 0.0
            for b, x in zip([None, *w], w, strict=False):
                base = (single[x] * scale + FLOOR) / (totals[True] + FLOOR * (len(vocabulary) + 1))
                weight = WEIGHT if before[b] else 0
                loss -= math.log(weight * (pair[b, x] / before[b] if before[b] else 0) + (1 - weight) * base)
            assert got[i][name] == pytest.approx(loss / len(w))


@pytest.mark.parametrize("n_bigrams", [0, 3])
def test_lm_scores_do_not_depend_on_what_is_held(spark, n_bigrams):
    texts = [("a b a c a b", True), ("a b b", True), ("c c d a b", False), ("d e f g", None), ("", False), (None, True)]
    df = spark.createDataFrame([(i % 4, t, g) for i, (t, g) in enumerate(texts)], "doc_id long, text string, good boolean")
    rows = lambda models, docs: sorted(map(tuple, score(docs, models).collect()), key=repr)
    few, all_held = fit(df, F.col("good"), n_bigrams=n_bigrams), fit(df, F.col("good"))
    assert len(few.held.codes) <= n_bigrams < len(all_held.held.codes) == 14
    later = spark.createDataFrame([(9, "a b never seen a b"), (None, "b a"), (9, "d e")], "doc_id long, text string")
    for docs in (df, later):
        got, want = rows(few, docs), rows(all_held, docs)
        assert len(got) == docs.count() and [r[:2] for r in got] == [r[:2] for r in want]
        assert all(g == w or g == pytest.approx(w) for g, w in zip([x for r in got for x in r[2:]], [x for r in want for x in r[2:]], strict=True))
    r = next(r for r in score(later, few).collect() if r.n_words == 6)
    single = lambda n: (n + FLOOR) / (9 + FLOOR * 8)  # noqa: E731  # 9 words in the target, 7 different ones and the unknown
    pair = lambda n, of, w: WEIGHT * n / of + (1 - WEIGHT) * w
    chances = [pair(2, 2, single(4)), pair(3, 4, single(4)), pair(0, 4, single(0)), single(0), single(4), pair(3, 4, single(4))]
    assert r.loss_target == pytest.approx(-sum(map(math.log, chances)) / 6)


@pytest.mark.parametrize("held", [{}, {"n_bigrams": 0, "n_words": 0}, {"n_bigrams": 2, "n_words": 3}])
def test_lm_scores_of_fitted_documents_need_no_codes_met_once(spark, held):
    texts = [("a b a c a b", True), ("a b b", True), ("c c d a b", False), ("d e f g", None), ("", False), (None, True), ("d e f g", True), ("x y x", True), ("y z", False), ("z", None)]
    df = spark.createDataFrame([(i % 4 or None, t, g, 1.0) for i, (t, g) in enumerate(texts)], "doc_id long, text string, good boolean, loss_target double")
    rows = lambda scored: sorted((tuple(r) for r in scored.collect()), key=repr)
    few = fit(df, F.col("good"), once=False, **held)
    got, want = rows(score(df, few, fitted=F.col("good"))), rows(score(df, fit(df, F.col("good"))))
    assert len(got) == len(texts) and few.counts.where("target + background < 2").isEmpty()
    for g, w in zip(got, want, strict=True):
        assert g[:2] == w[:2] and all(x == y or x == pytest.approx(y) for x, y in zip(g[2:], w[2:], strict=True))
    with pytest.raises(ValueError, match="fitted"):
        score(df, few)


@pytest.mark.parametrize("held", [{}, {"n_bigrams": 0, "n_words": 0}])
def test_lm_codes_travel_once_a_slice(spark, monkeypatch, held):
    rng = random.Random(5)
    texts = [" ".join(rng.choices("abcdefgh", k=rng.randrange(1, 30))) for _ in range(60)] + [None, "", "a" * 3000, f"{'b ' * 900}z"]
    df = spark.createDataFrame([(i, t, i % 3 == 0) for i, t in enumerate(texts)], "doc_id long, text string, good boolean").coalesce(2)
    rows = lambda scored: sorted((tuple(r) for r in scored.collect()), key=repr)
    want, travelled, by_bucket = rows(score(df, fit(df, F.col("good")))), [], lm_scoring._by_bucket
    monkeypatch.setattr(lm_scoring, "_by_bucket", lambda packed: travelled.append(packed.collect()) or by_bucket(packed))
    for size in (200, 1 << 22):  # many slices, of a few texts each or of one long text; one slice a task
        monkeypatch.setattr(lm_scoring, "TEXT_BYTES", size)
        monkeypatch.setattr(lm_scoring, "COMBINED", size)
        monkeypatch.setattr(lm_scoring, "ROW_CODES", 1 + size // 100)
        travelled.clear()
        with lm_scoring.sliced(df) as docs:
            slices = docs.select("__slice").distinct().count()
            got = rows(score(docs, fit(docs, F.col("good"), once=False, **held), fitted=F.col("good")))
        assert (5 if size == 200 else 0) < slices <= (64 if size == 200 else 2)
        for g, w in zip(got, want, strict=True):
            assert g[:2] == w[:2] and all(x == y or x == pytest.approx(y) for x, y in zip(g[2:], w[2:], strict=True))
        asked = [(r["__slice"], c) for r in travelled[1] for c in r.code if r["__slice"] >= 0]
        assert len(asked) == len(set(asked)) <= slices * (9 * 11 + 11)
        assert bool(asked) or not held


def test_lm_scores_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string, good boolean")
    assert score(none, fit(none, F.col("good"))).collect() == []
    one = spark.createDataFrame([(1, "a b", True), (None, None, None)], none.schema)
    r = {x.doc_id: x for x in score(one, fit(none, F.col("good"))).collect()}
    assert r[1].n_words == 2 and r[1].difference == 0 and r[None].n_words == 0 and r[None].difference is None
    assert {x.doc_id: x.n_words for x in score(one, fit(one, F.col("good"), once=False), fitted=F.col("good")).collect()} == {1: 2, None: 0}


def test_urls(spark):
    urls = {
        "http://a.example.org/es/x?y": "block", "HTTP://EXAMPLE.ORG/es": "allow", "x://example.org/en/12": "block", "x://org": "allow",
        "http://notexample.org/es/": "allow", "http://B.COM/de/#f": "block", "http://b.com/DE/": "allow", "http://b.com/q?x=/casino/1": "block", "no url": "allow", None: "allow",
    }
    df = spark.createDataFrame([(i, u, "z") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: r for r in judge(df, (*HOST_RULES, Rule("block", "*/casino/*"))).collect()}
    assert [got[i].verdict for i in range(len(urls))] == list(urls.values())
    assert got[1].rule == "org/" and got[3].rule is None and got[5].host == "b.com" and got[9].host == got[9].path == ""
    assert judge(df.where("false"), HOST_RULES).collect() == []


def test_mix_meets_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    rnd = random.Random(2)
    rows = [(i, "w " * rnd.randrange(0, 60), rnd.choice(["a", "b", "b", "b", "é", None])) for i in range(900)]
    rows += [(5000, "r r r", "a")] * 7 + [(None, "n n", "b"), (None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix_sources(df).collect()
    assert len(got) == len(rows) and sorted(got, key=repr) == sorted(mix_sources(df.repartition(7)).collect(), key=repr)
    per = {}
    for r in got:
        per.setdefault(r.source, []).append(r)
        assert r.taken % max(1, r["size"]) == 0 and r.taken <= 3 * r["size"]
    sizes = {s: sum(r["size"] for r in x) for s, x in per.items()}
    weights = dict(zip(["a", "b", "é", None], [5, 2, 1, 5], strict=True))
    free, left, target = dict(weights), sum(sizes.values()), {}
    while True:
        over = [s for s in free if left * free[s] / sum(free.values()) > 3 * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = 3 * sizes[s]
        left = sum(sizes.values()) - sum(target.values())
        free = {s: w for s, w in free.items() if s not in target}
    target |= {s: left * w / sum(free.values()) for s, w in free.items()}
    for s, x in per.items():
        assert x[0].target == pytest.approx(target[s]) and x[0].source_size == sizes[s]
        assert abs(sum(r.taken for r in x) - target[s]) <= 60
    assert mix_sources(df.where("false")).collect() == []


def test_neighbours(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    ids, vectors = zip(*[(r.vec_id, list(r.embedding)) for r in table.collect()], strict=True)
    extra = [(10_000, None), (10_001, [0.0] * len(vectors[0])), (10_002, [float("nan")] * len(vectors[0])), (10_003, [None] * len(vectors[0])), (10_004, vectors[0]), (None, vectors[0])]
    odd = spark.createDataFrame(extra, "vec_id long, embedding array<float>")
    got = nearest(table.select("vec_id", "embedding").unionByName(odd), F.col("vec_id") % 20 == 0).collect()
    all_ids, v = np.array([*ids, 10_004]), np.array([*vectors, vectors[0]], float)
    hits = total = 0
    for q in {r.query_id for r in got}:
        scores = (v * v[all_ids == q][0]).sum(axis=1)
        best = [i for i in np.lexsort((all_ids, -scores)) if all_ids[i] != q][:20]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 21))
        assert all(s == pytest.approx(scores[all_ids == i][0], abs=1e-12) for _, i, s in mine)
        hits, total = hits + len({m[1] for m in mine} & {all_ids[i] for i in best}), total + 20
    assert hits / total >= 0.9
    assert nearest(odd.where("false"), F.lit(True)).collect() == []
    assert [r.vec_id for r in nearest(odd, F.lit(True)).collect()] == []


def test_pseudonyms(spark):
    text = "on 2024-02-29, 31/12/1999; 4111 1111 1111 1111, 4111-1111-1111-1112 and 123-45-6789, (017) 555-7713, 1.2.3.4 999.1.1.1 30/02/2020 a@b.co v1.2.3.4.5"
    df = spark.createDataFrame([(1, text), (1, text), (None, None), (3, ""), (4, "clean 12 text"), (5, "1 " * 4000)], "doc_id long, text string")
    rows = replace_personal(df, "key").collect()
    a, b = [r for r in rows if r.doc_id == 1]
    assert a == b and a.n_replaced == 7
    assert re.sub(r"\d", "9", re.sub(r"\S+@\S+", "@", a.text)).startswith("on 9999-99-99, 99/99/9999; 9999 9999 9999 9999, 9999-9999-9999-9999 and 999-99-9999, (999) 999-9999,")
    assert all(x in a.text for x in ("4111-1111-1111-1112", "999.1.1.1", "30/02/2020", "v1.2.3.4.5"))
    assert not any(x in a.text for x in ("2024-02-29", "4111 1111 1111 1111", "555-7713", " 1.2.3.4 ", "a@b.co"))
    card = re.search(r"\d{4} \d{4} \d{4} \d{4}", a.text)[0].replace(" ", "")
    assert sum(sum(map(int, str(int(c) * (1 + i % 2)))) for i, c in enumerate(reversed(card))) % 10 == 0
    assert {r.doc_id: r.text for r in rows if r.doc_id != 1} == {None: None, 3: "", 4: "clean 12 text", 5: "1 " * 4000}
    every = spark.range(1000).select(permuted_digits(F.lpad(F.col("id").cast("string"), 3, "0"), "key").alias("d"))
    assert every.distinct().count() == 1000 and every.where("d not rlike '^[0-9]{3}$'").count() == 0
    pairs = spark.range(91).select(feistel(F.floor(F.col("id") / 13), F.col("id") % 13, F.lit(7), F.lit(13), "key").alias("p"))
    assert pairs.distinct().count() == 91


def test_pseudonyms_next_to_other_digits(spark):
    card = "4111 1111 1111 1111"
    cases = {  # text: what must not be left of it, and what must
        f"{card} 123": (card, " 123"), "4111111111111111 123": ("4111111111111111", " 123"), "7 4111111111111111": ("4111111111111111", "7 "),
        f"2024 {card}": (card, "2024 "), f"a 2024 2025 {card}, b": (card, "a 2024 2025 "), f"{card} 12-34x": (card, "12-34x"), f"{card} 5500 0000 0000 0004": (card, " "),
        "123 555-123-4567": ("555-123-4567", "123 "), "12345 2024-05-01": ("2024-05-01", "12345 "), "+1-555-123-4567": ("555-123-4567", "+1-"), "1-555-123-4567": ("555-123-4567", "1-"),
        "at 2024-05-01T10:00:00Z": ("2024-05-01", "T10:00:00Z"), "born 1850-03-09": ("1850-03-09", "born "), "in 9999-12-31.": ("9999-12-31", "in "),
        f"{card} 10.0.0.1": ("10.0.0.1", " "), "4111-1111-1111-1112 12": ("no card", "4111-1111-1111-1112 12"), "12345-678-9012-34567 x": ("no card", "12345-678-9012-34567 x"),
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r for r in replace_personal(df, "key").collect()}
    for i, (text, (gone, left)) in enumerate(cases.items()):
        new = got[i].text
        assert gone not in new and left in new, (text, new)
        assert re.sub(r"\d", "9", new) == re.sub(r"\d", "9", text) or "10.0.0.1" in text, (text, new)
        assert got[i].n_replaced == (0 if gone == "no card" else 2 if "5500" in text or "10.0.0.1" in text else 1), (text, new)
    phones = {got[i].text[-12:] for i, t in enumerate(cases) if t.endswith("555-123-4567")}
    assert len(phones) == 1  # equal values stay linked


def test_languages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = learn(docs)
    said = identify(docs.withColumn("score_", F.lit(1)), model, ["doc_id", "lang"]).withColumn("out", held_out(F.col("doc_id"))).collect()
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in said)
    tested = [r for r in said if r.out]
    assert sum(r.lang == r.lang_pred for r in tested) / len(tested) > 0.95
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 .,"), (None, "the")], "doc_id long, text string")
    assert [r.lang_pred for r in identify(odd, model).sort("doc_id").collect()][1:] == ["und"] * 3
    nothing = learn(docs.where("false"))
    assert {r.lang_pred for r in identify(odd, nothing).collect()} == {"und"}


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").withColumns({"size": F.lit(1), "kept": F.lit("x"), "node": F.lit(2)})
    docs = docs.unionByName(docs.where("doc_id = 3")).unionByName(docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit(None).cast("string")))
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.written(stage(spark, docs, small), name)
        if name != "mixing":
            assert docs.columns == before.columns and docs.count() <= before.count()
    assert 0 < docs.count() < 3 * n and docs.groupBy("doc_id", "copy").count().where("count > 1").count() == 0


def test_language_stage_without_a_model(spark, small):
    rows = [(1, "some words"), (2, "12 ."), (3, None), (4, ""), (None, "é")]
    docs = spark.createDataFrame([(i, t, None) for i, t in rows], "doc_id long, text string, lang string")
    assert {r.text for r in corpus_pipeline.language(spark, docs, small).collect()} == {"some words", "é"}


def test_near_dedup_judges_rows_by_their_text(spark, small):
    rnd = random.Random(4)
    a, b, c, d, e = (" ".join(f"w{rnd.randrange(10**6)}" for _ in range(60)) for _ in range(5))
    rows = [(3, a, "x"), (7, a, "y"), (7, b, "y"), (7, c, "y"), (None, b.upper(), "x"), (None, d, "x"), (None, d, "z"), (5, e, "q"), (5, e, "q"), (4, e + " more", "q"), (8, "", "x"), (9, "", "x"), (None, None, "x"), (7, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = [tuple(r) for r in corpus_pipeline.near_dedup(spark, docs, small).collect()]
    some = [r for r in got if r[1] != d]
    assert sorted(some, key=repr) == sorted([rows[0], rows[2], rows[3], rows[9], *rows[10:]], key=repr)
    assert [r[:2] for r in got if r[1] == d] == [(None, d)]


def test_pipeline_of_nothing(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, small), name)
    assert docs.count() == 0


def test_unseen_words():
    from gridstone.llm.language import Model

    assert Model([], [], {}).unseen(["ab"]).shape == (1, 0)
    m = Model([("en", "the", 3)], [("en", "t", 3), ("fr", "_é", 1), ("fr", "_", 9)], {"en": 3, "fr": 1})
    t, edge, none = m.unseen(["t", "ét", "zz"])
    assert t[0] > t[1]  # one character is all that is known of it
    assert edge[1] > edge[0]  # the longer n-gram decides alone
    assert none.tolist() == [0, 0]  # the edge mark alone is no evidence
    assert m.unseen([]).shape == (0, 2)
