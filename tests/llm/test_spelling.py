"""Spelling variants, against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gridstone.llm import spelling
from gridstone.llm.spelling import check_sums, variants, vocabulary

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(rows, slip):
    n = Counter()
    for key, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, slip):
    n = counted(rows, slip)
    forms, out = {}, {}
    for w in n:
        around = sorted((x for x in n if near(w, x)), key=lambda x: (-n[x], x))
        if around and n[around[0]] >= 5 * n[w]:
            forms[w] = around[0]
        out[w] = [forms.get(w), None, n[w], len(around), n.get(forms.get(w))]
    for w in out:
        root = w
        while root in forms:
            root = forms[root]
        out[w][1] = root
    return {(w, *x) for w, x in out.items()}


def documents():
    rnd = random.Random(11)
    base = ["".join(rnd.choice("abcdeéßÀ÷") for _ in range(rnd.randrange(6, 12))) for _ in range(25)] + ["aaaaaa", "abababab", "aaabbb"]
    words = [w for i, w in enumerate(base) for _ in range(5 * rnd.choice((1, 5, 60)))]
    for w in base:
        for times in (5, 26, 130):
            for _ in range(4):
                i, c = rnd.randrange(len(w) + 1), rnd.choice("abé")
                words += [rnd.choice((w[:i] + c + w[i:], w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :]))] * times
    words += ["chained"] * 700 + ["chainedx"] * 130 + ["chainedxy"] * 25 + ["chainedxyz"] * 5
    long = "".join(rnd.choice("abc") for _ in range(30_000))
    words += [long] * 6 + [long[:17] + long[18:]] * 31
    rnd.shuffle(words)
    joint = (" ", "\n", "7", "-", "Ā", "日")
    text = lambda some: "".join((w.upper() if rnd.random() < 0.1 and w.isascii() else w) + rnd.choice(joint) for w in some)
    cuts = sorted(rnd.sample(range(len(words)), 60))
    texts = [text(words[a:b]) for a, b in zip([0, *cuts], [*cuts, len(words)], strict=True)]
    return [*enumerate(texts), (None, texts[3]), (None, None), (5, ""), (7, texts[7]), (7, texts[7])]


@pytest.mark.parametrize("slip", [0, 7])
def test_variants_equal_brute_force(spark, monkeypatch, slip):
    monkeypatch.setattr(spelling, "HELD", 50)
    rows = documents()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, word string")
    got = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in variants(df, slip=slip).collect()]
    want = brute(rows, slip)
    assert len(got) == len(set(got)) and set(got) == want
    assert sum(x[1] is not None for x in want) > 20 and (slip or ("chainedxyz", "chainedxy", "chained", 5, 1, 25) in want)


def test_words_of_one_reduced_form_and_runs_of_one_letter(spark):
    rows = [(0, " ".join(("a" * n + " ") * 5 + ("b" * n + " ") * 25 for n in range(6, 30)))]
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows, 0)


def test_first_letters_like_the_last_ones(spark):
    """Pairs are met once, also where the first letters of a word differ little from its last ones, read backwards."""
    pairs = [("cabxbaa", "cabxxbaa"), ("ccabaaaa", "caabaaaa"), ("ecgggga", "ecggega")]
    rows = [(0, " ".join(f"{a} " * 5 + f"{b} " * 30 for a, b in pairs))]
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows, 0)


def test_texts_beyond_a_slice(spark):
    rnd = random.Random(2)
    some = ["".join(rnd.choice("abcdefgh") for _ in range(7)) for _ in range(300)]
    rows = [(1, " ".join(rnd.choice(some) for _ in range(200_000))), (2, "é" * 700_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.word, r.n) for r in vocabulary(df, slip=199).collect()} == set(counted(rows, 199).items())


def test_check_sums():
    rnd = random.Random(1)
    runs = [rnd.randbytes(n) for n in (1, 2, 63, 64, 65, 300, 7, 7)]
    data = np.frombuffer(b"".join(runs), np.uint8)
    size = np.array([len(r) for r in runs])
    before = np.array([zlib.crc32(b"%d:" % i) for i in range(len(runs))], np.uint32)
    got = check_sums(before, data, np.append(0, np.cumsum(size))[:-1], size)
    assert got.tolist() == [zlib.crc32(b"%d:" % i + r) for i, r in enumerate(runs)]


def test_nothing_to_group(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert variants(empty).collect() == []
    lone = spark.createDataFrame([(1, "lonely " * 5)], empty.schema)
    assert [tuple(r) for r in variants(lone).collect()] == [("lonely", None, "lonely", 5, 0, None)]
