"""Near-duplicate groups against brute force; estimator; odd rows; large groups."""

import random

import numpy as np
import pytest

from strata.llm import near_dup as N
from strata.llm.textvec import Texts

from .conftest import SCHEMA, prose


def shingle_set(text):
    w = (text or "").encode().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """Group number of each row: rows with words are linked from similarity 0.8."""
    sets = [shingle_set(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and len(a & b) >= 0.8 * len(a | b):
                x, y = find(i), find(j)
                group[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(rows))]


def edited(text, n, seed):
    w = text.split()
    rng = random.Random(seed)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10 ** 6)}"
    return " ".join(w)


def case_rows():
    base, other = prose(150, 3), prose(90, 4)
    rows = [(i, edited(base, i % 9, i)) for i in range(60)] + [(100 + i, edited(other, i % 4, i)) for i in range(20)]
    rows += [(200 + i, other) for i in range(15)] + [(300, "a b c"), (301, "a b c"), (302, "a b c d e f g h"), (303, "a b c d e f g"),
             (304, " a  b\nc")]
    return rows


def partition(pairs):
    out = {}
    for key, value in pairs:
        out.setdefault(value, set()).add(key)
    return sorted(map(sorted, out.values()))


def test_groups_equal_brute_force(spark):
    rows = case_rows()
    df = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], SCHEMA)
    got = N.mark_kept(N.near_groups(df)).collect()
    want = brute(rows)
    assert partition((r.doc_id, r.component) for r in got) == partition((rows[i][0], g) for i, g in enumerate(want))
    least = {g: min(rows[i][0] for i in range(len(rows)) if want[i] == g) for g in set(want)}
    assert {r.doc_id: r.group_id for r in got} == {rows[i][0]: least[g] for i, g in enumerate(want)}
    assert sorted(r.doc_id for r in got if r.kept) == sorted(least.values())


def test_odd_rows(spark, odd, empty):
    rows = odd.collect()
    got = N.mark_kept(N.near_groups(odd)).collect()
    assert len(got) == len(rows)
    same = [r for r in got if r.n_shingles == 56]
    assert len(same) == 3 and {r.group_id for r in same} == {5} and sum(r.kept for r in same) == 1
    assert sum(r.kept for r in got) == len(rows) - 2
    kept = N.keep_one(odd)
    assert kept.columns == odd.columns and kept.count() == len(rows) - 2
    assert N.near_groups(empty).count() == 0 and N.keep_one(empty).count() == 0


def test_texts_without_words_all_stay(spark):
    df = spark.createDataFrame([(1, "", None, None, 0)] * 3 + [(None, None, None, None, None)] * 2, SCHEMA)
    assert N.keep_one(df).count() == 5


def test_registers_agree_with_the_probability_jaccard_similarity():
    rng = np.random.default_rng(3)
    agree, want = [], []
    for trial in range(40):
        shared = rng.integers(1, 2 ** 63, 60, dtype=np.uint64)
        own = [rng.integers(1, 2 ** 63, 20, dtype=np.uint64) for _ in range(2)]
        counts = [rng.integers(1, 6, 80) for _ in range(2)]
        hashes = [np.concatenate((shared, o)) for o in own]
        got = N.sketch(np.repeat([0, 1], 80), np.concatenate(hashes), np.concatenate(counts), 2)
        agree.append((got[0] == got[1]).mean())
        w = [dict(zip(h.tolist(), 1 + np.log(c))) for h, c in zip(hashes, counts)]
        keys = set(w[0]) | set(w[1])
        want.append(sum(1 / sum(max(w[0].get(j, 0) / w[0][i], w[1].get(j, 0) / w[1][i]) for j in keys) for i in shared.tolist()))
    assert abs(np.mean(agree) - np.mean(want)) < 0.02


def test_bucket_rest_finds_links_that_the_hub_misses(spark):
    """A chain of sets: neighbours are similar, the hub is similar to none of the far ones."""
    sets = {i: list(range(i * 10, i * 10 + 100)) for i in range(12)}
    payload = spark.createDataFrame(list(sets.items()), "class_id long, payload array<long>")
    members = spark.createDataFrame([(7, i, 0) for i in sets], "key long, class_id long, hub long")
    links = N.similar(spark.createDataFrame([(i, 0) for i in range(1, 12)], "a long, b long"),
                      payload.withColumnRenamed("payload", "set"), 0.8)
    assert [(r.a, r.b) for r in links.collect()] == [(1, 0)]
    got = {r.node: r.component for r in N.join_components(members, links, payload, 0.8).collect()}
    assert got == {i: 0 for i in range(12)}


@pytest.mark.parametrize("size", [(1, 1), (2, 3)])
def test_unit_sizes_do_not_change_the_result(spark, monkeypatch, size):
    monkeypatch.setattr(N, "UNIT_MINORS", size[0])
    monkeypatch.setattr(N, "UNIT_MEMBERS", size[1])
    test_bucket_rest_finds_links_that_the_hub_misses(spark)


def test_shingles_of_short_texts():
    text, hashes, counts = N.shingles([b"a b", b"", b"a  b ", b"a b a b a b a", b"x"])
    assert np.bincount(text, minlength=5).tolist() == [1, 0, 1, 2, 1]
    assert hashes[0] == hashes[1] and sorted(counts[2:4].tolist()) == [1, 2]
