"""Language, quality and toxicity: held-out accuracy on the test tables, contracts, odd rows."""

import math
import re
import zlib

import numpy as np
import pytest
import zstandard

from strata.llm import compress_lang as C
from strata.llm import ordinal_toxicity as O
from strata.llm import sampling
from strata.llm import subword_quality as Q

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def held(i, fold, rest):
    return i is not None and zlib.crc32(str(i).encode()) % fold == rest


def test_language_held_out_accuracy(spark, tables):
    rows = C.op4_zstd_dictionaries(spark, SF).join(tables[0].select("doc_id", "lang", "n_chars"), "doc_id").collect()
    assert all(r.held_out == held(r.doc_id, 4, 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    test = [r for r in rows if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in test]) > 0.985
    long = [r for r in test if r.n_chars > 200]
    assert np.mean([r.rejected for r in long]) < 0.005


def test_language_learns_nothing_from_held_out_rows(spark):
    rows = [(i, f"le chat est dans la maison {i} " * 5, "xx" if held(i, 4, 2) else "fr") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(C.learn_dictionaries(df)) == ["fr"]


def test_language_odd_rows(spark, odd, empty):
    dictionaries = {"en": b"the words of a row without an id and one more " * 9, "ru": "текст и слова на языке ".encode() * 9}
    got = C.identify(odd, dictionaries).collect()
    texts = odd.select("doc_id", "text").collect()
    assert len(got) == len(texts)
    assert sorted((r.doc_id or -1, r.lang_pred == "und") for r in got) == sorted(
        (t.doc_id or -1, not any(c.isalpha() for c in t.text or "")) for t in texts)
    no_letter = {1, 2, 3, 8}
    assert all(r.lang_pred == "und" and r.rejected and r.score == 0 for r in got if r.doc_id in no_letter)
    assert all(r.lang_pred != "und" for r in got if r.doc_id in (4, 5, 6, 7, 9))
    assert not any(r.held_out for r in got if r.doc_id is None)
    kept = C.keep_identified(odd, dictionaries)
    assert kept.columns == odd.columns and kept.count() == sum(not r.rejected for r in got)
    assert all(r.lang_pred == "und" for r in C.identify(odd, {}).collect())
    assert C.identify(empty, dictionaries).count() == 0 and C.learn_dictionaries(empty) == {}
    assert {r.margin for r in C.identify(odd.where("doc_id = 9"), {"en": b"the"}).collect()} == {None}


def test_ties_are_rejected(spark):
    df = spark.createDataFrame([(1, "some words in no language")], "doc_id long, text string")
    same = b"some words in no language, and others " * 5
    r = C.identify(df, {"a": same, "b": same}).first()
    assert (r.lang_pred, r.margin, r.rejected, r.score) == ("a", 0.0, True, 0.0)


def test_quality_held_out_accuracy(spark, tables):
    rows = Q.op7_subword_embeddings(spark, SF).join(tables[1], "doc_id").collect()
    assert all(r.held_out == held(r.doc_id, 3, 1) and r.predicted == int(r.score >= 0.5) for r in rows)
    test = [r for r in rows if r.held_out]
    for label in (0, 1):
        assert np.mean([r.predicted == label for r in test if r.quality == label]) > 0.95


def test_folded_scores_equal_the_network():
    rng = np.random.default_rng(1)
    m = Q.Model(rng.normal(size=(Q.BUCKETS, 4)), rng.normal(size=(4, 3)), rng.normal(size=3), (0, 1, 5))
    texts = [b"one two two", b"", "été".encode()]
    got = m.probabilities(Q.Texts(texts), m.folded())
    for t, p in zip(texts, got):
        bucket, _ = Q.features(Q.Texts([t]))
        logits = (m.vectors[bucket].mean(axis=0) @ m.weights if len(bucket) else 0) + m.bias
        e = np.exp(logits - np.max(logits))
        assert np.allclose(p, e / e.sum(), atol=1e-5)


def test_features_stay_inside_a_text():
    alone = [sorted(Q.features(Q.Texts([t]))[0].tolist()) for t in (b"ab cd", b"", b"cd cd")]
    bucket, text = Q.features(Q.Texts([b"ab cd", b"", b"cd cd"]))
    assert [sorted(bucket[text == k].tolist()) for k in range(3)] == alone


def test_toxicity_held_out(spark, tables):
    rows = O.op10_cumulative_link(spark, SF).join(tables[1].withColumnRenamed("toxic", "label"), "doc_id").collect()
    test = [r for r in rows if r.held_out]
    assert all(r.held_out == held(r.doc_id, O.FOLD, O.HELD) for r in rows)
    assert np.mean([r.toxic for r in test if r.label == 1]) > 0.8
    assert np.mean([r.toxic for r in test if r.label == 0]) < 0.02
    assert all(0 <= r.severity <= 3 and r.toxic == (r.score >= 0.5) for r in rows)
    by_grade = [np.mean([r.severity for r in rows if r.grade == g]) for g in range(4)]
    assert by_grade == sorted(by_grade)


def test_cumulative_link_shares_weights_and_orders_thresholds():
    rng = np.random.default_rng(2)
    words = [f"sign{k}" for k in range(6)]
    texts, grades = [], []
    for _ in range(600):
        g = int(rng.integers(0, 4))
        texts.append(" ".join(["plain", "text"] + [words[int(rng.integers(6))] for _ in range(2 * g)]).encode())
        grades.append(g)
    model = O.train(O.word_counts(texts), np.array(grades))
    assert (np.diff(model.thresholds) > 0).all()
    over = model.exceed(texts)
    assert (np.diff(over, axis=1) <= 0).all()
    severity = over.sum(axis=1)
    means = [severity[np.array(grades) == g].mean() for g in range(4)]
    assert means == sorted(means) and means[0] < 0.5 and means[3] > 2


@pytest.mark.parametrize("module, columns", [(Q, ("score",)), (O, ("severity", "score"))])
def test_odd_rows_labels_and_missing_models(spark, odd, empty, module, columns):
    labels = spark.createDataFrame([(5, 1, 1), (6, 0, 0), (9, 0, 0), (7, 1, 1), (4, None, None), (None, 1, 1), (77, 0, 1), (5, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    model = module.fit(odd, labels)
    for m in (model, None):
        got = module.score(odd, m).collect()
        assert len(got) == odd.count()
        assert all(np.isfinite(r[c]) for r in got for c in columns)
    assert module.score(empty, model).count() == 0
    assert module.fit(empty, labels) is None and module.fit(odd, labels.where("false")) is None
    blank = {r.doc_id: r for r in module.score(odd, model).collect() if r.doc_id in (1, 2)}
    assert blank[1][columns[-1]] == blank[2][columns[-1]]


def test_sample_is_bounded_and_takes_small_groups_whole(spark):
    keys = spark.range(4000).selectExpr("CAST(id % 8 = 0 AS INT) AS g", "xxhash64(id) AS h")
    got = {r.g: r["count"] for r in sampling.lowest_hashes(keys, "g", 600).groupBy("g").count().collect()}
    assert got[1] == 500 and abs(got[0] - 600) < 120


def test_short_texts_are_measured_finer_than_a_byte(spark, tables):
    short = tables[0].where("char_length(text) < 30 AND text RLIKE '\\\\p{L}'")
    rows = C.identify(short, C.learn_dictionaries(tables[0])).join(short.select("doc_id", "lang", "n_chars"), "doc_id").collect()
    assert len(rows) >= 50
    assert np.mean([r.rejected for r in rows]) < 0.05
    assert np.mean([r.lang == r.lang_pred for r in rows if r.n_chars >= 10]) > 0.85


def test_a_text_without_evidence_is_not_rejected():
    coder = C.Coder({"en": b"the words of a row without an id and one more " * 9, "fr": b"le chat est dans la maison du village " * 9})
    for text in ("Zq!", "日本語のテキスト", "日本"):
        found = coder.predict(text)
        assert found[1:] == (0.0, None) and not C._rejected(found, C.MIN_MARGIN)
        assert found[0] == coder.langs[int(np.argmin(coder.fine_sizes(text.lower())[0]))]
    assert [coder.predict(t)[0] for t in ("a row without", "dans la maison")] == ["en", "fr"]


def brute_sizes(dictionaries, text):
    """Size of a text under each dictionary: block after block, each by an encoder of its own."""
    out = {}
    for lang, content in dictionaries.items():
        total = 0
        for at in range(0, len(text), 1024):
            parameters = zstandard.ZstdCompressionParameters.from_level(
                3, source_size=1024, dict_size=len(content), strategy=zstandard.STRATEGY_BTOPT, min_match=3, write_checksum=0,
                write_content_size=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
            coder = zstandard.ZstdCompressor(
                dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=parameters)
            total += len(coder.compress(text[at:at + 1024]))
        out[lang] = total
    return out


def test_language_equals_the_smallest_size(spark, tables):
    """Every column of the query against sizes and the smallest of them, in plain Python."""
    docs = tables[0].where("doc_id % 40 = 0").union(spark.createDataFrame(
        [(-1, "s", "en", "²½ ① Ⅷ ₂ 12", 10), (-2, "s", "en", None, 0), (-3, "s", "en", "²½ a", 4)], tables[0].schema))
    dictionaries = C.learn_dictionaries(tables[0])
    texts = {r.doc_id: r.text for r in docs.collect()}
    n = 0
    for r in C.identify(docs, dictionaries).collect():
        text = texts[r.doc_id] or ""
        if not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        sizes = brute_sizes(dictionaries, text.lower().encode())
        if min(sizes.values()) >= 100:
            order = sorted(sizes, key=lambda k: (sizes[k], k))
            margin = (sizes[order[1]] - sizes[order[0]]) / sizes[order[0]]
            assert (r.lang_pred, r.margin, r.rejected) == (order[0], margin, margin < 0.01)
            assert r.score == pytest.approx(np.tanh(margin / 0.05))
            n += 1
    assert n > 200 and {-1, -2, -3} <= set(texts)


def test_three_hundred_languages(spark):
    word = lambda k, i: "".join(chr(0x4E00 + 40 * k + (7 * i + 3 * j * j) % 40) for j in range(4))
    text = lambda k, i: " ".join(word(k, i + j) for j in range(60))
    rows = [(1000 * i + k, text(k, i), f"l{k:03d}") for k in range(300) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    dictionaries = C.learn_dictionaries(df, full_languages=50)
    learned = {lang for i, _, lang in rows if not held(i, 4, 2)}
    assert set(dictionaries) == learned and max(map(len, dictionaries.values())) <= C.DICT_BYTES // 6 + 1
    some = df.where("doc_id % 1000 % 10 = 0")
    got = C.identify(some, dictionaries).join(some, "doc_id").where(C.F.col("lang").isin(*learned)).collect()
    assert len(got) > 80 and all(r.lang == r.lang_pred and not r.rejected for r in got)


def brute_features(text):
    """Counts of all features of a text by the definition, one by one."""
    words = text.split()
    one = lambda w: int(Q.Texts([w]).hashes(np.array([0]), np.array([len(w)]))[0] % Q.BUCKETS)
    counts = {}
    for b in [one(w) for w in words] + [Q.DOUBLED for a, b in zip(words, words[1:]) if a == b]:
        counts[b] = counts.get(b, 0) + 1
    folded = bytes(32 if c in b" \t\n\v\f\r" else c for c in text)
    for size in Q.NGRAMS:
        for i in range(len(folded) - size + 1):
            packed = int.from_bytes(bytes([size]) + folded[i:i + size])
            b = int(Q.mix64(np.array([packed], dtype=np.uint64))[0] % Q.BUCKETS)
            counts[b] = counts.get(b, 0) + 1
    return counts


def test_quality_scores_equal_plain_arithmetic(spark):
    """All columns of the query: features one by one, their mean, a softmax in plain Python."""
    rng = np.random.default_rng(3)
    texts = ["one two two\tthree", "", None, "été\n\nété", "x", "a b c d e f g " * 9]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "no id", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    m = Q.Model(rng.normal(size=(Q.BUCKETS, 2)).astype(np.float32), np.eye(2, dtype=np.float32), np.array([0.1, -0.2], dtype=np.float32), (0, 1))
    got = {r.doc_id: r for r in Q.score(df, m).collect()}
    for i, t, _ in rows:
        counts = brute_features((t or "").encode())
        total = max(sum(counts.values()), 1)
        logits = [sum(n * float(m.vectors[b, k]) for b, n in counts.items()) / total + float(m.bias[k]) for k in (0, 1)]
        p = np.exp(logits[1]) / (np.exp(logits[0]) + np.exp(logits[1]))
        assert got[i].score == pytest.approx(p, abs=1e-5)
        assert (got[i].held_out, got[i].predicted) == (held(i, 3, 1), int(p >= 0.5))


def test_toxicity_scores_equal_plain_sums(spark):
    """All columns of the query: words one by one, weights added up, a sigmoid for each threshold."""
    texts = ["Bad bad, worse! good", "", None, "worst", "ünï bad123 BAD", "bad " * 500]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "bad")]
    names = {}
    for word in ("bad", "worse", "worst", "bad123"):
        _, bucket, _, _ = O.word_counts([word.encode()])
        names[word] = set(bucket.tolist())
    weights = np.zeros(O.BUCKETS)
    for k, b in enumerate(sorted(set().union(*names.values()))):
        weights[b] = 0.4 + 0.1 * k
    m = O.Model(weights, np.array([0.5, 1.5, 2.5]))
    for r in O.score(spark.createDataFrame(rows, "doc_id long, text string"), m).collect():
        text = next(t for i, t in rows if i == r.doc_id) or ""
        folded = "".join(c.lower() if c.isascii() else c for c in text)
        words = re.findall("[0-9a-z\x80-\U0010ffff]+", folded)
        counts = {}
        for w in words:
            for b in O.word_counts([w.encode()])[1].tolist():     # the word and its beginnings, alone
                counts[b] = counts.get(b, 0) + 1
        latent = sum(math.log2(1 + n) * weights[b] for b, n in counts.items())
        over = [1 / (1 + math.exp(t - latent)) if words else 0.0 for t in m.thresholds]
        assert r.severity == pytest.approx(sum(over)) and r.score == pytest.approx(over[0])
        edges = [1.0, *over, 0.0]
        shares = [a - b for a, b in zip(edges, edges[1:])]
        assert (r.grade, r.toxic, r.held_out) == (shares.index(max(shares)), over[0] >= 0.5, held(r.doc_id, O.FOLD, O.HELD))
