"""Suffix automaton against brute force over windows; odd rows; cut spans."""

import random
import re

from strata.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(items, text):
    w = words(text)
    hit, names = set(), set()
    for name, item in items:
        i = words(item)
        size = min(13, len(i))
        wins = {tuple(i[k:k + size]) for k in range(len(i) - size + 1)} if i else set()
        for k in range(len(w) - size + 1 if i else 0):
            if tuple(w[k:k + size]) in wins:
                hit.update(range(k, k + size))
                names.add(name)
    return len(w), len(hit), sorted(names)


def test_automaton_equals_brute_force():
    random.seed(5)
    for trial in range(60):
        alphabet = ["a", "b", "c"] if trial % 2 else [f"w{i}" for i in range(12)]
        make = lambda n: " ".join(random.choice(alphabet) for _ in range(n))
        items = [(str(k), make(random.choice([0, 1, 2, 5, 12, 13, 14, 30]))) for k in range(5)]
        automaton = D.SuffixAutomaton([(n, t.encode()) for n, t in items])
        for _ in range(8):
            text = make(40)
            if random.random() < 0.5:
                text += " " + random.choice(items)[1] + " " + make(5)
            spans, names = automaton.scan(D.words_of(text.encode()))
            assert (sum(e - s for s, e in spans), sorted(names)) == brute(items, text)[1:], (items, text)
            assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_documents_with_odd_rows(spark, odd, empty):
    rows = odd.select("doc_id", "text").collect()
    items = [("7", rows[6].text[:200]), ("8", "ONE"), ("9", ""), (None, "Ünïcödé 日本語"), ("10", None)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    automaton = D.build_automaton(bench)
    got = D.scan_documents(odd, automaton).collect()
    want = [(r.doc_id, *brute([(n or "", t) for n, t in items if t is not None], r.text)) for r in rows]
    assert sorted(map(repr, [(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got])) == sorted(map(repr, want))
    assert all(r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words) for r in got)
    assert D.scan_documents(empty, automaton).count() == 0
    kept = D.remove_contamination(odd, automaton)
    assert kept.columns == odd.columns
    assert kept.count() == sum(not (h > 0 and 20 * h >= n) for _, n, h, _ in want)
    assert D.build_automaton(bench.where("false")).scan([b"a"]) == ([], set())


def test_spans_are_cut_out_of_kept_documents(spark):
    item = " ".join(f"q{i}" for i in range(15))
    text = " ".join(f"Clean{i}," for i in range(400)) + " " + item + "! end"
    docs = spark.createDataFrame([(1, text, len(text), "x")], "doc_id long, text string, n_chars long, items string")
    got = D.remove_contamination(docs, D.SuffixAutomaton([("1", item.encode())])).first()
    assert got.text == text.replace(item, "") and got.n_chars == len(got.text) and got["items"] == "x"


def test_blocks_of_items_find_what_one_automaton_finds(spark, odd, empty):
    random.seed(8)
    make = lambda n: " ".join(random.choice("abcde") for _ in range(n))
    items = [(str(k), make(random.choice([1, 3, 13, 20]))) for k in range(40)] + [("x", None), ("y", "")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    texts = [make(30) + " " + (random.choice(items)[1] or "") + " " + "zz " * random.choice([5, 600]) for _ in range(60)]
    rows = [(i // 2, t, None, None, len(t)) for i, t in enumerate(texts)]       # every doc_id twice
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, row string, n_chars long").unionByName(
        odd.select("doc_id", "text", "lang", odd.source.alias("row"), "n_chars"))
    one = [D.build_automaton(bench)]
    machines = lambda: D.automata(bench, block_chars=150)
    assert D.item_blocks(bench, 150)[1] > 3
    key = lambda r: repr((r.doc_id, r.n_words, r.n_hit, [tuple(s) for s in r.spans], list(r["items"]), r.contaminated))
    assert sorted(map(key, D.scan_documents(docs, machines()).collect())) == sorted(map(key, D.scan_documents(docs, one).collect()))
    whole, parts = (D.remove_contamination(docs, m) for m in (one, machines()))
    assert parts.columns == docs.columns and sorted(map(repr, parts.collect())) == sorted(map(repr, whole.collect()))
    assert D.scan_documents(empty, machines()).count() == 0 and D.remove_contamination(empty, machines()).count() == 0
