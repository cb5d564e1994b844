"""Merkle manifest: leaves, proofs and verification against a tree built in plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from strata.llm import merkle
from strata.llm.workspace import Workspace

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in FIELDS))


def tree(leaves):
    """Root and, for each leaf, its steps (before, after)."""
    steps, owners, level = [[] for _ in leaves], [[i] for i in range(len(leaves))], leaves
    while len(level) > 1:
        up, up_owners = [], []
        for a in range(0, len(level), 16):
            run = level[a:a + 16]
            for j in range(len(run)):
                for i in owners[a + j]:
                    steps[i].append(("".join(run[:j]), "".join(run[j + 1:])))
            up.append(digest("".join(run)))
            up_owners.append([i for o in owners[a:a + 16] for i in o])
        level, owners = up, up_owners
    return level[0], steps


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    trees = {}
    for s, own in by.items():
        own.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[s] = tree([leaf(r) for r in own])
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    root, tops = tree([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops):
        for r, own in zip(by[s], trees[s][1]):
            steps, x = own + top, leaf(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None:
                x = leaf({**r, "text": "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"])})
            for before, after in steps:
                x = digest(before + x + after)
            out.append((r["doc_id"], leaf(r), trees[s][0], root, digest("".join(a + b for a, b in steps)), x, x == root))
    return sorted(out, key=repr)


def run(spark, tmp_path, df):
    df.write.parquet(str(tmp_path / "documents.parquet"))
    return sorted((tuple(r) for r in merkle.op13_pointer_jumping(spark, str(tmp_path)).collect()), key=repr)


@pytest.mark.parametrize("sizes", [[1], [2], [16], [17], [257], [1, 1], [1, 16, 17, 40], [300, 3, 1] + [1] * 40])
def test_proofs_equal_the_plain_tree_for_every_shape(spark, tmp_path, sizes):
    pick, rows, i = random.Random(len(sizes)), [], 0
    for s, n in enumerate(sizes):
        for _ in range(n):
            i += 1
            rows.append((pick.randrange(10 ** 9), None if s == 0 else f"é{s}", "en", i, f"Text {i} ABC"))
    got = run(spark, tmp_path, spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert got == brute([dict(zip(FIELDS, r)) for r in rows])
    assert {r[-1] for r in got} <= {True, False} and any(r[-1] for r in got) == any(r[5] == r[3] for r in got)


def test_odd_rows_nulls_ties_and_clashing_columns(spark, tmp_path, odd):
    rows = [{c: r[c] for c in FIELDS} for r in odd.collect()]
    extra = odd.withColumns({n: F.lit("x") for n in ("g", "idx", "digest", "size", "leaf", "kids", "root")})
    assert run(spark, tmp_path, extra) == brute(rows)


def test_empty_dataset(spark, tmp_path, empty):
    assert run(spark, tmp_path, empty) == []


def test_very_long_and_malformed_texts_are_hashed_whole(spark, tmp_path):
    df = spark.createDataFrame([(1, "s", "en", 1, "Ab \U0001f642")], SCHEMA).withColumn("text", F.repeat("text", 4_000_000))
    bad = spark.createDataFrame([(2, "s", "en", 1, "x")], SCHEMA).withColumn("text", F.expr("cast(X'41FF42' as string)"))
    got = {r[0]: r[1] for r in run(spark, tmp_path, df.unionByName(bad))}
    text = "Ab \U0001f642" * 4_000_000
    assert got[1] == leaf({"doc_id": 1, "source": "s", "lang": "en", "n_chars": 1, "text": text})
    assert got[2] == hashlib.sha256(b"1:21:s2:en1:13:A\xffB").hexdigest()


@pytest.mark.parametrize("key", [1, 8])
def test_long_paths_with_dealt_ancestors(spark, monkeypatch, key):
    """A fan-out of 16 needs millions of rows for four jumps; with two, 600 rows do."""
    monkeypatch.setattr(merkle, "FANOUT", 2)
    monkeypatch.setattr(merkle, "NODES_A_KEY", key)
    rows = [(i, f"s{i % 3 if i < 500 else i}", "en", i, f"T{i}") for i in range(600)]
    leaves = merkle.document_leaves(spark.createDataFrame(rows, SCHEMA))
    got = merkle.manifest(Workspace(spark, "test"), leaves, "source", ["doc_id"], ["doc_id", "seen"]).withColumn(
        "folded", merkle.fold(F.col("leaf"), F.col("steps"))).collect()
    assert sorted(r.doc_id for r in got) == list(range(600)) and len({r.root for r in got}) == 1
    assert all(r.folded == r.root for r in got) and {len(r.steps) for r in got} == {15, 7}
