"""Byte-level helpers and connected components against plain Python."""

import random

import numpy as np

from strata.llm import textvec as V
from strata.llm.components import connected_components


def test_words_lines_and_place_free_hashes():
    texts = [b"ab cd\x0bab", b"", b" \t", "é\x1cé x".encode(), b"cd\n\nab "]
    t = V.Texts(texts)
    starts, ends, text = t.words()
    assert [bytes(t.buf[s:e]) for s, e in zip(starts, ends)] == [w for x in texts for w in x.split()]
    assert text.tolist() == [i for i, x in enumerate(texts) for _ in x.split()]
    h = t.hashes(starts, ends)
    by_word = {}
    for s, e, v in zip(starts, ends, h.tolist()):
        assert by_word.setdefault(bytes(t.buf[s:e]), v) == v
    assert len(set(by_word.values())) == len(by_word)
    other = V.Texts([b"zzzz ab"])
    assert other.hashes(np.array([5]), np.array([7]))[0] == by_word[b"ab"]
    ls, le, lt = t.lines()
    assert [bytes(t.buf[s:e]) for s, e in zip(ls, le)] == [x for d in texts for x in d.split(b"\n")]


def test_components_equal_union_find(spark):
    random.seed(4)
    edges = [(random.randrange(60), random.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 140)]
    edges += [(200, i) for i in range(201, 260)] + [(3, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges + [(None, 1)], "a long, b long")
    assert {r.node: r.component for r in connected_components(df).collect()} == {x: find(x) for x in parent}
    assert connected_components(df.where("false")).count() == 0
