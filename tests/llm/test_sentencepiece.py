"""Encoding against the reference library (BPE) and brute force (unigram); decoding; odd rows."""

import itertools
import random

import pyarrow.parquet as pq
import pytest
import sentencepiece

from strata.llm import sentencepiece_trie as S


@pytest.fixture(scope="module")
def content():
    return S.read_model()


@pytest.fixture(scope="module")
def library(content):
    return sentencepiece.SentencePieceProcessor(model_proto=content)


ODD = ["", " a", "a  b", "a\nb\tc ", "  x ", "é́ ﬁ №", "a\xa0b", "\x00a", "a ", "      indented   text", "日本語 текст 🙂🙂",
       "</s> <s> <unk> <0x41>", "x" * 300, " " * 50, "aaaaabaaaab" * 20, "The Theory of the thing"]


def test_bpe_equals_the_library(content, library):
    model = S.Model(content)
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist()[:300] + ODD
    random.seed(1)
    texts += ["".join(random.choice("abehtion s▁\n") for _ in range(40)).replace("▁", "") for _ in range(200)]
    got = model.encode(texts)
    assert got == library.encode(texts)
    assert [model.decode(i) for i in got] == texts
    assert [model.decode(library.encode(t)) for t in ODD] == [library.decode(library.encode(t)) for t in ODD]


def test_unigram_takes_the_best_path():
    random.seed(2)
    pieces = [("<unk>", 0.0, 2)] + [(c, -3.0 - k / 7, 1) for k, c in enumerate("▁abc")]
    for n in (2, 3):
        for p in itertools.product("abc", repeat=n):
            if random.random() < 0.6:
                pieces.append(("".join(p), -random.uniform(2, 9), 1))
    model = S.Model.of(pieces, S.UNIGRAM)
    score = {p: s for p, s, t in pieces if t == 1}
    for _ in range(60):
        word = "▁" + "".join(random.choice("abcz") for _ in range(random.randrange(8)))
        best = {0: 0.0}
        for e in range(1, len(word) + 1):
            best[e] = max([best[e - 1] + model.floor] + [best[s] + score[word[s:e]] for s in range(e) if word[s:e] in score])
        ids = model.encode_words([word, word[:3], "▁abcab"])[word]
        cost = sum(model.floor if i == 0 else model.score[i] for i in ids)
        assert abs(cost - best[len(word)]) < 1e-9
        assert "".join("?" if i == 0 else pieces[i][0] for i in ids) == word.replace("z", "?")


def test_documents_with_odd_rows(spark, odd, empty, content, library):
    got = S.encode_documents(odd, content)
    want = [(r.doc_id, library.encode(r.text or ""), r.text is not None) for r in odd.collect()]
    assert sorted(map(repr, [(r.doc_id, r.input_ids, r.round_trip) for r in got.collect()])) == sorted(map(repr, want))
    assert S.encode_documents(empty, content).count() == 0
    back = S.decode_documents(got, content).collect()
    assert sorted(map(repr, [(r.doc_id, r.text) for r in back])) == sorted(map(repr, [(r.doc_id, r.text or "") for r in odd.collect()]))
    mark = spark.createDataFrame([(1, "a ▁ b")], "doc_id long, text string")
    assert not S.encode_documents(mark, content).first().round_trip


def test_a_small_word_table_gives_the_same(content, library, monkeypatch):
    monkeypatch.setattr(S, "CACHE_WORDS", 3)
    model, cache = S.Model(content), {}
    for t in ODD:
        assert model.encode([t, t], cache) == [library.encode(t)] * 2
