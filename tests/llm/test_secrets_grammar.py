"""Secret scan: base spans against a plain restatement, learned automata, added spans, odd rows."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from strata.llm import secrets_grammar as S

HEXES, UPPER = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ENGLISH = ("understanding representative constitution internationalization responsibilities telecommunications "
           "the of and a to in is was for on with as by at from that this notwithstanding misunderstandings").split()


def draw(pick, alphabet, n):
    return "".join(pick.choice(alphabet) for _ in range(n))


def brute_base(text):
    """Base spans by patterns with either case spelled out, and the filters applied afterwards."""
    text = text or ""
    words = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
                     for w in ("password", "passwd", "secret", "token", "api_?key"))
    out = []
    for kind, pattern, ok in (
            (0, rf"""(?:{words})["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 8),
            (1, "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16), (2, "[0-9a-f]+", lambda m: len(m[0]) >= 32)):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if ok(m)]
    return [f"{S.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out)]


NASTY = [
    "password=abcdefgh", "password=abcdefg", "PassWord' : 'x.y=z/+_-1", "api_key=api_key=apikey=12345678",
    "toKen = \"" + "0" * 40, "paſſword=abcdefgh toKen=abcdefgh", "AKIA", "AKIAABCDEFGHIJKL", "AKIAABCDEFGHIJK", "AKIAAKIAAKIAAKIA",
    "xAKIAx AKIA0123456789ABé", "f" * 31, "f" * 32, "f" * 200 + "g" + "0" * 33, "\U0001f642 secret:" + "ab" * 20, "secret=\ntoken=abcdefgh",
    "password" + " " * 50 + "=" + " " * 50 + "'" + "s" * 9, "tokenpassword:\tabcdefgh", "", None, "passwd=passwd=passwd=12345678 secret : =abcdefgh",
]


def corpus(n=200):
    """Documents with credentials of three sorts, numbers and prose; the same formats without a name in others."""
    pick = random.Random(5)
    rows, hidden = [], {}
    for i in range(n):
        prose = [pick.choice(ENGLISH) + (draw(pick, "0123456789", 16) if pick.random() < 0.02 else "") for _ in range(40)]
        prose += [draw(pick, "0123456789", 16)] * (i % 9 == 0)
        if i % 3 == 0:
            prose.insert(5, pick.choice([f"password={draw(pick, HEXES, 18)}", f'token = "{draw(pick, HEXES, 40)}"',
                                         "AKIA" + draw(pick, UPPER, 16)]))
        elif i % 7 == 0:
            hidden[i] = draw(pick, HEXES, 24)
            prose.insert(9, hidden[i])
        rows.append((i, " ".join(prose)))
    return rows, hidden


def run(spark, df, plain_fold=1):
    found = S.find_base(df, plain_fold).cache()
    return S.scan(found, S.sample_formats(found)).collect()


def base_only(spans):
    return [s for s in spans.split(",") if s and not s.startswith("like_")]


def test_base_spans_counts_and_digest(spark):
    rows = list(enumerate(NASTY)) + [(100 + i, (t or "") + " " + (NASTY[i - 1] or "")) for i, t in enumerate(NASTY)]
    for r in run(spark, spark.createDataFrame(rows, "doc_id long, text string").withColumns(
            {n: F.lit("x") for n in ("base", "tokens", "spans", "kind", "plain", "start")})):
        want = brute_base(dict(rows)[r.doc_id])
        assert base_only(r.spans) == want, r
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(w.startswith(k) for w in want) for k in S.KINDS)


def test_unnamed_credentials_are_added_and_prose_and_numbers_are_not(spark):
    rows, hidden = corpus()
    texts, caught = dict(rows), set()
    for r in run(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4)):
        assert base_only(r.spans) == brute_base(texts[r.doc_id])
        for span in r.spans.split(","):
            if span.startswith("like_"):
                _, a, b = span.split(":")
                assert texts[r.doc_id][int(a):int(b)] == hidden.get(r.doc_id), span
                caught.add(r.doc_id)
    assert len(caught) >= 0.9 * len(hidden) > 10, len(caught)


def test_result_does_not_depend_on_the_layout(spark):
    rows, _ = corpus(120)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, run(spark, df.repartition(1)))) == sorted(map(tuple, run(spark, df.repartition(7))))


def test_odd_rows(spark, odd, empty):
    got = run(spark, odd)
    assert sorted(map(repr, (r.doc_id for r in got))) == sorted(map(repr, (r.doc_id for r in odd.collect())))
    assert run(spark, empty) == []


def test_malformed_and_very_long_texts(spark):
    text = "mot é " * 3_000_000 + "secret=abcdefgh1 " + "A" * 1_000_000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string").unionByName(
        spark.createDataFrame([(2,)], "doc_id long").withColumn("text", F.expr("cast(unhex('61ff746f6b656e3d3132333435363738') as string)")))
    got = {r.doc_id: r for r in run(spark, df)}
    assert base_only(got[1].spans) == ["assign:18000000:18000016"]
    assert base_only(got[2].spans) == ["assign:2:16"]


# ----------------------------------------------------------------------------------------------------- the automata

def plain_score(a, value):
    """Mean log-likelihood by the definition: a product over the path."""
    state, p = 0, 0.0
    for c in value:
        n, to = a.edges[state].get(c, (0, state))
        p += math.log((n + S.SMOOTHING / S._SYMBOLS) / (a.passes[state] + S.SMOOTHING))
        state = to
    p += math.log((a.stops[state] + S.SMOOTHING / S._SYMBOLS) / (a.passes[state] + S.SMOOTHING))
    return p / (len(value) + 1)


@pytest.mark.parametrize("seed", range(5))
def test_automaton_keeps_counts_and_every_string_has_its_path(seed):
    pick = random.Random(seed)
    values = ["AKIA" + draw(pick, UPPER, 16) for _ in range(150)] + [draw(pick, "ab", pick.randint(0, 6)) for _ in range(100)]
    a = S.learn(values)
    into = [0] * len(a.passes)
    for state, edges in enumerate(a.edges):
        assert a.passes[state] == a.stops[state] + sum(n for n, _ in edges.values())
        for n, to in edges.values():
            into[to] += n
    assert into[0] + len(values) == a.passes[0] and into[1:] == a.passes[1:] and sum(a.stops) == len(values)
    for v in values[:20] + ["", "zzz", "AKIA1"]:
        assert a.score(v) == pytest.approx(plain_score(a, v))


def test_fixed_prefix_stays_a_chain_and_the_tail_becomes_a_loop():
    pick = random.Random(1)
    a = S.learn(["AKIA" + draw(pick, UPPER, 16) for _ in range(300)])
    state = 0
    for c in "AKIA":
        assert list(a.edges[state]) == [c]
        state = a.edges[state][c][1]
    assert len(a.passes) < 12 and len(a.edges[state]) == 32
    good, bad = "AKIA" + draw(pick, UPPER, 16), draw(pick, UPPER, 20)
    assert a.score(good) > a.score(bad) + 0.5


def test_a_known_language_is_learned():
    """Strings (ab)^n: two states, whatever their number."""
    a = S.learn(["ab" * n for n in range(1, 9) for _ in range(40)])
    assert all(set(e) <= {"a", "b"} and len(e) <= 1 for e in a.edges)
    assert a.score("ab" * 5) > a.score("aabb") + 1
