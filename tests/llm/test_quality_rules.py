"""Quality rules, against a plain version."""

import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from gridstone.llm import quality_rules
from gridstone.llm.quality_rules import BASE, RULES, Rule, Texts, apply_rules, cascade, ordered

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    spots = {}
    for i in range(len(words) - 4):
        spots.setdefault(tuple(words[i : i + 5]), []).append(i)
    again = {i + k for at in spots.values() if len(at) > 1 for i in at for k in range(5)}
    n, chars, symbols, dup = len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines))
    upper, lower = len(re.findall("[A-Z]", text)), len(re.findall("[a-z]", text))
    most = lambda xs: max(Counter(xs).values(), default=0)
    failed = n < 10 or 100 * len(again) > 20 * n
    bad = (
        chars < 2 * n or chars > 15 * n or 10 * symbols > n or 100 * dup > 50 * len(lines)
        or 100 * sum(bool(re.search("[A-Za-z\x80-\U0010ffff]", w)) for w in words) < 70 * n or 100 * upper > 50 * (upper + lower)
        or 100 * sum(a == b for a, b in zip(words, words[1:], strict=False)) > 30 * n or 100 * most(words) > 30 * n or 100 * most(zip(words, words[1:], strict=False)) > 20 * n
    )
    return (n, chars, symbols, dup, len(again), failed, not failed and not bad)


def texts():
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdeéßñ") for _ in range(rnd.randrange(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    line = prose(12)
    return [
        None, "", " \n\t", "one", prose(9), prose(10), prose(300), prose(40).upper(), prose(60) + " " + prose(60).upper() * 2,
        " | ".join(word() for _ in range(40)), " ".join(word() + "$$$" for _ in range(40)), "\n".join([line, "x " + line, line, line]),
        "\n".join(prose(9) for _ in range(6)) + "\n\n \n", "und " * 50, prose(10) + " " + "a b c d e f " * 3, "die der " * 30 + prose(20),
        "\x0b\x0c1 2 3 4 5 6 7 8 9 10 11", "w" * 300 + " " + prose(15), "a b 日本語 " + prose(20), "x" * 3_000_000, (prose(50) + "\n") * 3, prose(200_000),
    ]


def test_counts_and_verdicts_equal_a_plain_version(spark):
    some = texts()
    df = spark.createDataFrame([(i if i else None, t, 1) for i, t in enumerate(some)], "doc_id long, text string, kept int")
    got = {r.doc_id or 0: tuple(r[c] for c in (*BASE, "base_failed", "kept")) for r in cascade(df).collect()}
    assert got == {i: plain(t) for i, t in enumerate(some)}
    assert {False, True} == {x[-1] for x in got.values()}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é日\n\t\x0b|$A"), max_size=120), max_size=6))
def test_any_texts(some):
    data = [t.encode() for t in some]
    t = Texts(np.frombuffer(b"".join(data), np.uint8), np.append(0, np.cumsum([len(x) for x in data])).astype(np.int64))
    got = [tuple(int(getattr(t, c)[i]) for c in BASE) for i in range(len(some))]
    assert got == [plain(x)[:5] for x in some]
    assert apply_rules(t, RULES).tolist() == [plain(x)[-1] for x in some]


def test_order_and_short_circuit():
    rules = [Rule(n, None) for n in "abcd"]
    # c rejects most per second; of what it leaves, b rejects more per second than a; d rejects nothing.
    patterns = [(0b0101, 40), (0b0010, 10), (0b0100, 5), (0b0001, 6), (0, 100)]
    assert [r.name for r in ordered(rules, dict(a=2.0, b=1.0, c=1.0, d=0.1), patterns)] == ["c", "b", "a", "d"]
    seen = []
    watch = lambda name, fails: Rule(name, lambda t: seen.append((name, len(t))) or fails(t))
    words = [" ".join(f"w{i}{k}" for k in range(n)) for i, n in enumerate((12, 30, 50))]
    data = [w.encode() for w in words]
    t = Texts(np.frombuffer(b"".join(data), np.uint8), np.append(0, np.cumsum([len(x) for x in data])))
    kept = apply_rules(t, [watch("short", lambda t: t.n_words < 20), watch("long", lambda t: t.n_words > 40), watch("none", lambda t: t.top_word > 1)])
    assert kept.tolist() == [False, True, False] and seen == [("short", 3), ("long", 2), ("none", 1)]


def test_the_order_changes_no_verdict(spark, monkeypatch):
    df = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    want = sorted(map(tuple, cascade(df).collect()))
    monkeypatch.setattr(quality_rules, "ordered", lambda rules, *_: list(rules)[::-1])
    assert sorted(map(tuple, cascade(df, sample=3).collect())) == want


def test_empty_and_repeated(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_words) for r in cascade(df).collect()) == [(0, 0), (1, 2), (1, 2)]
    assert cascade(df.where("false")).collect() == []
