"""Line deduplication against brute force; streamed buckets; odd rows."""

import random

import numpy as np

from strata.llm import line_dedup as L

from .conftest import SCHEMA, prose


def brute(rows):
    """Removed line numbers of each (doc_id, text): one occurrence of each component stays."""
    docs = sorted({(i is None, i or 0, t) for i, t in rows if t is not None})
    occurrences = {}
    for null, i, t in docs:
        for k, line in enumerate(t.split("\n")):
            if line.strip():
                occurrences.setdefault(line, []).append((null, i, t, k))
    lines = list(occurrences)
    # a shorter line is a set of its own: it equals no other
    sets = [frozenset(x[i:i + 7] for i in range(len(x) - 6)) or frozenset([x]) for x in lines]
    parent = list(range(len(lines)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(lines)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n >= 0.8 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    groups = {}
    for i, line in enumerate(lines):
        groups.setdefault(find(i), []).extend(occurrences[line])
    gone = {}
    for places in groups.values():
        for null, i, t, k in sorted(places)[1:]:
            gone.setdefault((None if null else i, t), []).append(k)
    return {(i, t): sorted(gone.get((i, t), [])) for i, t in rows}


def test_equals_brute_force(spark):
    random.seed(6)
    pool = [prose(random.randrange(5, 60), k) for k in range(25)]

    def near(line):
        c = list(line)
        for _ in range(random.randrange(3)):
            c[random.randrange(len(c))] = random.choice("xyz é")
        return "".join(c)

    rows = [(i, "\n".join(near(random.choice(pool)) if random.random() < 0.6 else prose(9, 1000 + 50 * i + k)
                          for k in range(8)) + "\nshort line\nshort line\n") for i in range(40)]
    rows += [(100 + i, pool[0] + "\n" + pool[0]) for i in range(30)]
    df = spark.createDataFrame([(i, t, None, None, len(t)) for i, t in rows], SCHEMA)
    want = brute(rows)
    by_id = {i: (t, want[(i, t)]) for i, t in rows}
    got = {r.doc_id: r.removed for r in L.duplicate_lines(df).collect()}
    assert got == {i: w for i, (_, w) in by_id.items()}
    kept = {r.doc_id: r for r in L.remove_lines(df).collect()}
    for i, (t, w) in by_id.items():
        rest = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in w)
        if w and not rest.strip():
            assert i not in kept
        else:
            assert kept[i].text == rest and kept[i].n_chars == len(rest)


def test_odd_rows(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    want = brute(rows)
    got = L.duplicate_lines(odd).collect()
    assert len(got) == len(rows)
    assert sorted(map(repr, [(r.doc_id, r.removed) for r in got])) == sorted(
        map(repr, [(i, want[(i, t)] if t is not None else []) for i, t in rows]))
    kept = L.remove_lines(odd)
    assert kept.columns == odd.columns and kept.count() == len(rows) - 1  # document 6 is a copy of 5
    assert L.duplicate_lines(empty).count() == 0 and L.remove_lines(empty).count() == 0


def test_streamed_buckets_in_pieces(spark, monkeypatch):
    random.seed(7)
    rows = [(random.randrange(40), random.randrange(30)) for _ in range(600)] + [(1000, 5)] * 4 + [(-5, -1), (-5, 3)]
    groups = {}
    for k, line in rows:
        groups.setdefault(k, set()).add(line)
    want = {k: v for k, v in groups.items() if len(v) > 1}
    for size in (1, 7, 10 ** 6):
        monkeypatch.setattr(L, "PACK_ENTRIES", size)
        packs = [(k % 3, [a for a, _ in part if a % 3 == k % 3], [b for a, b in part if a % 3 == k % 3])
                 for at in range(0, len(rows), 50) for part in [rows[at:at + 50]] for k in range(3)]
        got = {}
        for r in L.buckets_of(spark.createDataFrame(packs, "slot long, keys array<long>, lines array<long>")).collect():
            got.setdefault(r.key, []).append((r.class_id, r.hub))
        assert {k: {c for c, _ in v} for k, v in got.items()} == want
        assert all(len(v) == len(set(v)) and len({h for _, h in v}) == 1 and v[0][1] in want[k] for k, v in got.items())


def test_minima_estimate_the_similarity():
    random.seed(8)
    line = prose(60, 5)
    other = line[: len(line) // 2] + prose(12, 9) + line[len(line) // 2:]
    points = L.code_points(line + "\n" + other + "\n")
    a, b = len(line), len(line) + 1 + len(other)
    got = L.minima(L.short_hashes(points), np.array([0, a + 1]), np.array([a - 6, b - 6]))
    x, y = (set(s[i:i + 7] for i in range(len(s) - 6)) for s in (line, other))
    assert abs((got[0] == got[1]).mean() - len(x & y) / len(x | y)) < 0.2
    alone = L.minima(L.short_hashes(L.code_points(other)), np.array([0]), np.array([len(other) - 6]))
    assert (alone[0] == got[1]).all()


def test_short_lines_are_duplicates_of_equal_lines(spark):
    """Brute force without a minimum: every repeated line that isn't blank goes, however short."""
    words = ["All rights reserved.", "OK", "7", "版权所有，保留一切权利。", "Ja", "Licensed under CC BY-NC 4.0."]
    layout = ["", "---", "  ", "}", "***"]
    rows = [(i, "\n".join([words[i % 6], layout[i % 5], words[(i + 1) % 6], layout[i % 5], words[i % 6]])) for i in range(12)]
    seen, want = set(), {}
    for i, t in rows:
        want[i] = [k for k, line in enumerate(t.split("\n")) if line.strip() and (line in seen or seen.add(line))]
    df = spark.createDataFrame([(i, t, None, None, len(t)) for i, t in rows], SCHEMA)
    assert {r.doc_id: r.removed for r in L.duplicate_lines(df).collect()} == want
