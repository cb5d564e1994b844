"""Base counts against brute force; distances, guards and odd rows."""

import math
import random

import numpy as np

from strata.llm import quality_rules as Q
from strata.llm.textvec import Texts


def brute(text):
    text = text or ""
    b = text.encode()
    words = b.split()
    chars = sum(1 for c in text if c not in " \t\n\x0b\x0c\r")
    lines = [x for x in b.split(b"\n") if x.split()]
    wins = {}
    for i in range(len(words) - 7):
        wins.setdefault(tuple(words[i:i + 8]), []).append(i)
    hit = {k for at in wins.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
    n = len(words)
    return (n, chars, sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), n < 20 or 100 * len(hit) > 30 * n)


def test_base_counts(spark, odd, empty):
    random.seed(3)
    texts = [r.text for r in odd.collect()] + [" ".join(random.choice("ab") for _ in range(random.randrange(80))) for _ in range(30)]
    texts += ["x y\nx y\n\n\n#*$ <b>\nx y \n\x1cz z", "w " * 40, "a b c d e f g h " * 2 + "\n"]
    rows = [(i, t, "kept") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    got = {r.doc_id: r for r in Q.judge(df, []).collect()}
    for i, t, _ in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(t), t
        assert r.kept == (not r.base_failed) and r.class_distance is None
    assert Q.judge(empty, []).count() == 0 and Q.learn_references(empty) == []


def test_distance_is_jensen_shannon():
    p, q = np.array([[3.0, 1.0, 0.0]]), np.array([1.0, 1.0, 2.0])
    a, b = p[0] / 4, q / 4
    m = (a + b) / 2
    kl = lambda x: sum(u * math.log2(u / v) for u, v in zip(x, m) if u > 0)
    assert abs(Q.js_distance(p, q)[0] - math.sqrt((kl(a) + kl(b)) / 2)) < 1e-12
    assert Q.js_distance(np.array([[1.0, 0.0]]), np.array([0.0, 5.0]))[0] == 1.0
    assert Q.js_distance(np.array([[2.0, 2.0]]), np.array([1.0, 1.0]))[0] == 0.0


def test_references_hold_exactly_the_common_words(spark):
    rows = [(i, "the of " * 30 + f"rare{i} word{i % 50}", "en") for i in range(200)] + [(900 + i, "le la " * 9, "fr") for i in range(9)]
    refs = {r.lang: r for r in Q.learn_references(spark.createDataFrame(rows, "doc_id long, text string, lang string"))}
    text = Texts([b"the of le la"])
    s, e, _ = text.words()
    h = text.hashes(s, e).view(np.int64).tolist()
    assert sorted(refs) == ["en", "fr"]
    assert refs["en"].word_hashes.tolist() == sorted(h[:2]) and refs["fr"].word_hashes.tolist() == sorted(h[2:])
    assert refs["en"].word_counts.tolist() == [6000, 6000, 400] and refs["fr"].word_counts.tolist() == [81, 81, 0]


def test_odd_script_goes_and_plain_text_stays_and_short_text_is_guarded(spark):
    plain = [(i, "the cat sat of the mat and of " * 3 + f"then word{i} came in by the door of it", "en") for i in range(300)]
    junk = [(1000, " ".join(f"{c}{i}%%$$" for i, c in enumerate("abcdefghij" * 9)), None), (1001, "the " + "%$ " * 25, None)]
    df = spark.createDataFrame(plain + junk, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in Q.judge(df, Q.learn_references(df)).collect()}
    assert all(got[i].kept for i, *_ in plain if not got[i].base_failed) and not got[1000].kept
    assert got[1001].word_distance is None  # too few words for the test


def test_clean_documents_are_kept_on_the_test_table(spark):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    rows = Q.op1_js_divergence(spark, d).join(labels, "doc_id").where("NOT base_failed").groupBy("quality").avg(
        "n_words").count()
    assert rows == 2
    kept = {r.quality: r.share for r in Q.op1_js_divergence(spark, d).join(labels, "doc_id").where("NOT base_failed")
            .selectExpr("quality", "CAST(kept AS INT) AS k").groupBy("quality").agg({"k": "avg"})
            .withColumnRenamed("avg(k)", "share").collect()}
    assert kept[1] > 0.97 and kept[0] < 0.2


def test_clean_texts_of_rare_languages_are_kept(spark):
    """Four documents of one language beside many of another, and 300 languages with one document each."""
    plain = [(i, " ".join(f"the cat sat word{(i * j) % 50} of" for j in range(30)), "en") for i in range(60)]
    other = lambda k, n: " ".join(f"{'äöyk'[k % 4]}lla{k}n vaikka{j} tuo{j * k}" for j in range(n))
    rare = [(1000 + k, other(k, 25 + k % 3), "fi") for k in range(4)]
    many = [(2000 + k, other(k + 9, 25), f"x{k}") for k in range(300)]
    df = spark.createDataFrame(plain + rare + many, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in Q.judge(df, Q.learn_references(df)).collect()}
    for i, *_ in rare + many:
        assert got[i].word_distance is None and got[i].kept == (not got[i].base_failed)
    assert any(got[i].kept for i, *_ in rare) and got[3].word_distance is not None
    unknown = Q.judge(df.drop("lang"), Q.learn_references(df)).where("doc_id = 1001").first()
    assert unknown.word_distance is not None      # without a tag a text is judged


def brute_distance(p, q):
    total_p, total_q = sum(p.values()) or 1, sum(q.values()) or 1
    d = 0.0
    for k in p.keys() | q.keys():
        a, b = p.get(k, 0) / total_p, q.get(k, 0) / total_q
        m = (a + b) / 2
        d += (a * math.log2(a / m) if a else 0) + (b * math.log2(b / m) if b else 0)
    return math.sqrt(max(d, 0) / 2)


def test_distances_and_verdict_equal_plain_histograms(spark):
    """The two distances and ``kept`` against dictionaries of counts in plain Python."""
    random.seed(4)
    vocabulary = {"en": ["the", "of", "and", "cat", "Dog,", "7"], "ru": ["и", "в", "на", "кот", "дом."]}
    rows = []
    for i in range(80):
        lang = random.choice(["en", "ru"])
        words = [random.choice(vocabulary[lang]) if random.random() < 0.8 else f"w{random.randrange(10 ** 6)}" for _ in range(random.choice([30, 80, 200]))]
        rows.append((i, " ".join(words), lang if i % 5 else None))
    rows += [(90, "%$#! 99 " * 50, None), (91, "ДОМ %% " * 40, None), (92, "", "en"), (93, None, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")

    def classes(text):
        out = {}
        for c in text.encode().decode("utf-8"):
            k = Q.CLASSES[int(Q._CLASS_OF[c.encode()[0]])]
            out[k] = out.get(k, 0) + 1
        return out

    refs = {}
    for lang in vocabulary:
        own = [t for _, t, tag in rows if tag == lang and t is not None]
        words = [w for t in own for w in t.split()]
        counts = {w: words.count(w) for w in set(words)}
        common = {w: n for w, n in counts.items() if n >= Q.MIN_SHARE * len(words)}
        hist = {}
        for t in own:
            for k, n in classes(t).items():
                hist[k] = hist.get(k, 0) + n
        refs[lang] = (hist, {**common, None: len(words) - sum(common.values())})
    n_judged = 0
    for r in Q.judge(df, Q.learn_references(df)).collect():
        text = next(t for i, t, _ in rows if i == r.doc_id) or ""
        words, hist = text.split(), classes(text)
        by_class = min(brute_distance(hist, c) for c, _ in refs.values())
        by_word = []
        for _, ref in refs.values():
            own = {}
            for w in words:
                k = w if w in ref and w is not None else None
                own[k] = own.get(k, 0) + 1
            by_word.append(brute_distance(own, ref))
        by_word, kept = min(by_word), not r.base_failed
        if sum(hist.values()) >= Q.MIN_CHARS:
            assert abs(r.class_distance - by_class) < 1e-9
            kept = kept and by_class <= Q.MAX_CLASS_DISTANCE
        else:
            assert r.class_distance is None
        if len(words) >= Q.MIN_WORDS:
            assert abs(r.word_distance - by_word) < 1e-9
            kept = kept and by_word <= Q.WORD_DISTANCE_BASE + Q.WORD_DISTANCE_SLACK / math.sqrt(len(words))
            n_judged += 1
        else:
            assert r.word_distance is None
        assert r.kept == kept, r
    assert n_judged > 40
