"""Very long texts in bounded memory, and texts that are not UTF-8."""

import random
import subprocess
import sys
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import compress_lang, decontaminate, line_dedup, near_dup, ordinal_toxicity, quality_rules, sentencepiece_trie
from strata.llm import subword_quality, textvec, warc

PIECE = 4096


def long_text(seed, n=40_000):
    pick = random.Random(seed)
    words = [f"w{k}" for k in range(300)] + ["é", "日本", "#$", "%", "two two", "x" * 5000]
    return "".join(pick.choice(words) + pick.choice([" ", " ", " ", "\n", "\t", "\n\n"]) for _ in range(n)).encode()


def test_pieces_join_to_the_text_and_cut_no_word():
    text = long_text(1)
    parts = list(textvec.pieces(text, PIECE))
    assert b"".join(parts) == text and [w for p in parts for w in p.split()] == text.split()
    assert max(map(len, parts)) <= 2 * PIECE + 5001 and list(textvec.pieces(b"", PIECE)) == [b""]
    whole = textvec.Texts([text])
    assert (textvec.word_hashes([b"a b", text, b""], PIECE)[0][2:] == whole.hashes(*whole.words()[:2])).all()


def test_quality_rules_count_the_same_in_pieces():
    text = long_text(2) + b"a b c d e f g h " * 3 + b"\n" + b"z" * 30_000 + b" " + b"y " * 9000
    whole, parts = quality_rules._base_counts(quality_rules.Texts([text])), quality_rules._long_counts(text, PIECE)
    for name in whole:
        if name != "_text":
            assert np.array_equal(whole[name], parts[name]), name


def test_features_and_words_are_the_same_in_pieces(monkeypatch):
    text = long_text(3)
    bucket, _ = subword_quality.features(subword_quality.Texts([text]))
    assert np.array_equal(np.bincount(bucket, minlength=subword_quality.BUCKETS), subword_quality.feature_counts(text, PIECE))
    whole = ordinal_toxicity._batch_counts([text], 3)
    monkeypatch.setattr(textvec, "MAX_BATCH_BYTES", PIECE)
    assert all(np.array_equal(a, b) for a, b in zip(whole, ordinal_toxicity._long_counts(text, 3)))
    one, two = near_dup.shingles([text]), near_dup.shingles([text, b"a b c d e f"])
    mine = two[0] == 0
    assert sorted(zip(one[1].tolist(), one[2].tolist())) == sorted(zip(two[1][mine].tolist(), two[2][mine].tolist()))


@pytest.mark.parametrize("work", [
    "q._long_counts(text); q.learn_references",
    "s.Model(np.zeros((s.BUCKETS, 2), np.float32), np.eye(2, dtype=np.float32), np.zeros(2, np.float32), (0, 1))"
    ".long_probabilities(text, np.zeros((s.BUCKETS, 2), np.float32))",
    "o.word_counts([text])",
    "t, h, c = n.shingles([text]); n.sketch(t, h, c, 1)",
])
def test_a_text_of_64_mb_takes_less_than_a_gigabyte(work):
    code = textwrap.dedent(f"""
        import resource, numpy as np
        from strata.llm import quality_rules as q, subword_quality as s, ordinal_toxicity as o, near_dup as n
        words = [b"word%d" % k for k in range(5000)]
        text = b" ".join(words[(7919 * i + i // 977) % 5000] for i in range(8_000_000))
        assert len(text) > 64 << 20
        before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
        resource.setrlimit(resource.RLIMIT_AS, (4 << 30, 4 << 30))
        {work}
        assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - 65536 < 1 << 20, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    """)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-1500:]


@pytest.fixture(scope="module")
def malformed(spark):
    """Broken sequences at the start, in the middle and at the end, beside sound rows."""
    raw = ["ff", "61ff6220c3", "e282", "746865ff20636174206f6e20746865206d6174c3", "74686520636174206f6e20746865206d6174"]
    rows = [(i, bytearray.fromhex(h)) for i, h in enumerate(raw)]
    return spark.createDataFrame(rows, "doc_id long, b binary").select(
        "doc_id", F.col("b").cast("string").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"),
        F.lit(1).cast("long").alias("n_chars")), {i: bytes(b).decode("utf-8", "replace") for i, b in rows}


def test_malformed_texts_are_read_with_replacement_characters(spark, malformed):
    df, texts = malformed
    sound = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("lang", F.lit("en"))
    rows = lambda d: sorted(map(repr, d.collect()))
    dictionaries = compress_lang.learn_dictionaries(df)
    assert dictionaries == compress_lang.learn_dictionaries(sound) or set(dictionaries) == {"en"}
    two = {"en": b"the cat on the mat " * 9, "fr": b"le chat dans la maison " * 9}
    assert rows(compress_lang.identify(df, two)) == rows(compress_lang.identify(sound, two))
    model = sentencepiece_trie.read_model()
    assert rows(sentencepiece_trie.encode_documents(df, model)) == rows(sentencepiece_trie.encode_documents(sound, model))


def test_malformed_pages_are_stored_with_replacement_characters(spark, malformed, tmp_path):
    df, texts = malformed
    pages = df.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"))
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: r.payload_bytes for r in warc.op5_chunked_records(spark, str(tmp_path)).collect()}
    assert got == {i: len(t.encode()) for i, t in texts.items()}


def test_other_operators_survive_malformed_texts(spark, malformed):
    df, texts = malformed
    machine = decontaminate.SuffixAutomaton([("1", b"on the mat and more of it"), ("2", b"cat")])
    assert decontaminate.scan_documents(df, machine).count() == len(texts)
    assert decontaminate.remove_contamination(df, machine).count() <= len(texts)
    assert quality_rules.judge(df, quality_rules.learn_references(df)).count() == len(texts)
    assert line_dedup.duplicate_lines(df).count() == len(texts)
    assert near_dup.keep_one(df).count() <= len(texts)
    assert subword_quality.score(df, None).count() == ordinal_toxicity.score(df, None).count() == len(texts)
