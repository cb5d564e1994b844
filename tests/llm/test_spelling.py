"""Spelling variants: counts, near words, forms and roots against a plain search over all pairs of words."""

import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import spelling
from strata.llm.workspace import Workspace


def one_edit(x, y):
    """Whether one inserted, deleted or replaced character turns x into y: all such words are built."""
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    return len(y) == len(x) + 1 and any(y[:i] + y[i + 1:] == x for i in range(len(y)))


def brute(docs):
    counts = {}
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] = counts.get(run, 0) + 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    forms, near = {}, {}
    for w in words:
        near[w] = [v for v in words if v != w and abs(len(v) - len(w)) < 2 and one_edit(w, v)]
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 5 * words[w]:
            forms[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        out.append((w, forms.get(w), root, n, len(near[w]), words[forms[w]] if w in forms else None))
    return sorted(out)


def run(spark, df):
    return sorted((tuple(r) for r in spelling.group_variants(Workspace(spark, "test"), df).collect()))


def corpus(seed, size=300):
    """Words of few syllables with misspellings, so that near words, anagrams and chains of forms abound."""
    pick = random.Random(seed)
    syllables = ["ent", "tion", "er", "an", "ä", "ß", "Éx", "th", "aa", "×", "re"]
    base = ["".join(pick.choice(syllables) for _ in range(pick.randint(3, 5))) for _ in range(60)]
    rows = []
    for i in range(size):
        words = []
        for _ in range(40):
            w = base[min(int(pick.expovariate(0.1)), 59)]
            roll, k = pick.random(), pick.randrange(len(w))
            w = w[:k] + w[k + 1:] if roll < 0.1 else w[:k] + "e" + w[k:] if roll < 0.2 else \
                w[:k] + "n" + w[k + 1:] if roll < 0.3 else w
            words.append(w)
        rows.append((i, pick.choice([" ", ", ", "-"]).join(words)))
    return rows


@pytest.mark.parametrize("block", [2, 16, 10 ** 6])
def test_equals_all_pairs_whatever_the_size_of_blocks(spark, monkeypatch, block):
    rows = corpus(block)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    words = spelling.count_words(df).cache()
    work = Workspace(spark, "test")
    got = sorted((r.word, r.near) for r in spelling.near_words(work, words, block).collect())
    known = [r.word for r in words.collect()]
    want = sorted((x, y) for x in known for y in known if x != y and one_edit(x, y))
    assert len(want) > 100 and got == want


def test_counts_forms_and_roots(spark):
    rows = corpus(1) + [(1000 + i, "lanterne " * 750 + "lanternex " * 148 + "lanternexy " * 28 + "lanternexyz " * 5) for i in range(1)]
    want = brute(rows)
    assert {w[0]: w[1:3] for w in want}["lanternexyz"] == ("lanternexy", "lanterne")   # a chain of three forms
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {n: F.lit("x") for n in ("word", "n", "key", "near", "form", "root", "short")})
    assert run(spark, df.repartition(7)) == want


def test_odd_rows(spark, odd):
    assert run(spark, odd) == brute([(r.doc_id, r.text) for r in odd.collect()])


def test_empty(spark, empty):
    assert run(spark, empty) == []


def test_very_long_texts_and_words(spark):
    """A text in many pieces, and words whose counts single precision does not hold."""
    long = "ab" * 5000
    rows = [(1, "stretch word " * 400_000 + "strech " * 7), (2, f"{long} {long}c {long[:-1]}c " * 6)]
    assert run(spark, spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_malformed_utf8_splits_words(spark):
    df = spark.range(5).select(F.col("id").alias("doc_id"),
                               F.expr("cast(unhex('616263646566ff6768696a6b6c') as string)").alias("text"))
    want = brute([(i, "abcdef�ghijkl") for i in range(5)])
    assert run(spark, df) == want and [w[0] for w in want] == ["abcdef", "ghijkl"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abé", min_size=6, max_size=8), min_size=2, max_size=12, unique=True))
def test_pairs_of_one_block_are_found_once_over_all_windows(words):
    raw = sorted(w.encode("latin-1") for w in words)
    for short in (6, 7, 8):
        own = [w for w in raw if len(w) in (short, short + 1)]
        found = [tuple(sorted((own[i], own[j]))) for a, b in ((0, short // 2), (short // 2, short))
                 for i, j in spelling.block_pairs(own, short, (a, b))]
        want = [(x, y) for k, x in enumerate(own) for y in own[k + 1:]
                if one_edit(x, y) and min(len(x), len(y)) == short]
        assert sorted(found) == sorted(want)
