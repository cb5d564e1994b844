"""The pipeline against its operators run step by step in plain Python (brute force) on a small corpus."""

import sentencepiece

import corpus_pipeline as P
from strata.llm import compress_lang, sentencepiece_trie
from strata.llm.line_dedup import MIN_CHARS

from .conftest import SCHEMA, prose
from .test_decontaminate import brute as contamination
from .test_line_dedup import brute as line_brute
from .test_near_dup import brute as near_brute
from .test_near_dup import edited


def write(spark, scratch, rows, items):
    df = spark.createDataFrame([(i, t, lang, None, None if t is None else len(t)) for i, t, lang in rows], SCHEMA)
    df.write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    return df


def test_stages_are_as_dealt():
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontaminate", "tokenize"]


def test_run_equals_brute_force(spark, scratch):
    german = "der die das und nicht mit sich auf ist eine von dem zu werden".split()
    rows = [(i, prose(80, i), "en") for i in range(30)]
    rows += [(100 + i, " ".join(german[(k * 7 + i * k) % 14] for k in range(80)) + f" {i}", "de") for i in range(30)]
    rows += [(200, "12 34 !!", "en"), (201, None, "en"), (202, "", None), (None, prose(50, 77), None)]
    rows += [(210 + i, "\n".join(edited(prose(28, 300 + k), 0 if i == 0 else 1, 10 * i + k)[:MIN_CHARS * 9] for k in range(3))
              + f"\nend {i}", "en") for i in range(5)]
    rows += [(220, prose(80, 1), "en"), (221, prose(80, 1), "en")]
    item = prose(20, 55)
    rows += [(230, item + " " + prose(20, 56), "en"), (231, prose(500, 57) + " " + item, "en")]
    items = [(1, item), (2, None), (3, prose(5, 999))]
    df = write(spark, scratch, rows, items)

    coder = compress_lang.Coder(compress_lang.learn_dictionaries(df))
    kept = [(i, t) for i, t, _ in rows if not compress_lang._rejected(coder.predict(t), compress_lang.MIN_MARGIN)]
    gone = line_brute(kept)
    after = []
    for i, t in kept:
        rest = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[(i, t)])
        if not gone[(i, t)] or rest.strip():
            after.append((i, rest))
    group = near_brute(after)
    best = {}
    for (i, t), g in zip(after, group):
        best[g] = min(best.get(g, (True, 0, "")), (i is None, i or 0, t)) if g in best else (i is None, i or 0, t)
    stay = [(None if n else i, t) for n, i, t in best.values()]
    model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_trie.read_model())
    want = []
    for i, t in stay:
        n, hit, _ = contamination([(str(k), x) for k, x in items if x], t)
        if hit and 20 * hit >= n:
            continue
        want.append((i, model.encode(t.replace(item, "") if hit else t)))
    got = [(r.doc_id, r.input_ids) for r in P.run(spark, scratch).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert {230, 201, 202, 200, 221} & {i for i, _ in got} == set() and 231 in {i for i, _ in got}


def test_each_stage_keeps_the_columns_and_takes_an_empty_table(spark, scratch, odd, empty):
    write(spark, scratch, [(1, "x", "en")], [(1, "one two three")])
    for docs in (empty, odd):
        for name, stage in P.STAGES[:-1]:
            got = stage(spark, docs, scratch)
            assert got.columns == docs.columns, name
            assert got.count() <= docs.count()
        assert P.tokenize(spark, docs, scratch).count() == docs.count()
