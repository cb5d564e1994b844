"""Quality rules by distribution divergence.

A document's character-class histogram and common-word histogram are compared with the references of each language by
Jensen-Shannon distance (base 2, 0 to 1).  The references are counted over all documents that carry a language tag.
A document is measured against its nearest reference, so a missing or wrong tag doesn't matter.  Each test has guards:
texts too short for a stable histogram are not judged by it, nor are documents tagged with a language that has no
reference, because the other languages' references say nothing about them.

Common words of a language are the words that make up at least ``MIN_SHARE`` of its words.  There are at most
1 / MIN_SHARE of them, so the references have a bound that doesn't grow with the data.  They are found exactly, in two
passes: the first counts words by hash cell in two fixed tables, and a word of that share lies in a cell of that share
in both; the second counts the words that lie in such cells.

Scale: three map-only passes over the texts with tiny aggregates between them; nothing but counts is shuffled.  Long
texts are read in pieces that end between words or lines, so memory follows the words of one text, not its bytes; only a
single word or line of many megabytes is held whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.textvec import MAX_BATCH_BYTES, SPACE_BYTES, Texts, mix64, pieces, slices, utf8, windows

#: share of a language's words from which a word is common
MIN_SHARE = 0.002
#: hash cells of each of the two tables of the first pass
CELLS = 2048
#: languages that give references: the most frequent ones, each with so many documents at least.  A document of another
#: language is not judged by the distances, so the bounds cost a test and never a document
MAX_LANGUAGES, MIN_REFERENCE_DOCS = 1000, 5
#: guards: a histogram of fewer characters or words than this is not judged
MIN_CHARS, MIN_WORDS = 200, 60
#: verdict limits of the two distances; a sample of n words strays from its source by about 1 / sqrt(n), which the limit
#: of the word distance allows for: limit = base + slack / sqrt(n)
MAX_CLASS_DISTANCE = 0.29
WORD_DISTANCE_BASE, WORD_DISTANCE_SLACK = 0.20, 1.55
REPEAT_WIDTH = 8

# ---- fixed values: character classes by (first) byte ----
CLASSES = ["lower", "upper", "digit", "blank", "newline", "sentence", "symbol", "other_ascii", "latin", "script", "wide"]
SYMBOLS = b"#*$%&|<>"


def _class_table() -> np.ndarray:
    table = np.full(256, CLASSES.index("other_ascii"), dtype=np.int64)
    for name, members in (("lower", range(0x61, 0x7B)), ("upper", range(0x41, 0x5B)), ("digit", range(0x30, 0x3A)),
                          ("blank", b" \t"), ("newline", b"\n\r"), ("sentence", b".,;:!?'\"()-"), ("symbol", SYMBOLS),
                          ("latin", range(0xC2, 0xCB)), ("script", range(0xCB, 0xE0)), ("wide", range(0xE0, 0x100))):
        table[list(members)] = CLASSES.index(name)
    table[0x80:0xC0] = -1  # inside a character
    return table


_CLASS_OF = _class_table()
_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(SYMBOLS)] = True


def class_histogram(texts: Texts) -> np.ndarray:
    """Characters of each class in each text (texts x classes); separators between texts don't count."""
    classes = _CLASS_OF[texts.buf]
    text = np.repeat(np.arange(texts.n), texts.ends + 1 - texts.starts)
    classes[texts.ends] = -1
    seen = classes >= 0
    return np.bincount(text[seen] * len(CLASSES) + classes[seen],
                       minlength=texts.n * len(CLASSES)).reshape(texts.n, len(CLASSES))


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (square root of the divergence, base 2) of each row of counts ``p`` to counts ``q``."""
    p = p / np.maximum(p.sum(axis=1, keepdims=True), 1)
    q = np.broadcast_to(q / max(q.sum(), 1), p.shape)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        part = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return np.sqrt(np.clip(part.sum(axis=1) / 2, 0, 1))


@dataclass(frozen=True)
class Reference:
    """Histograms of one language: character classes, and (hash, count) of its common words plus all other words."""
    lang: str
    classes: np.ndarray
    word_hashes: np.ndarray  # ascending
    word_counts: np.ndarray  # one more than hashes: the last is all other words


def _langs(batch: pa.RecordBatch) -> tuple[np.ndarray, list[str]]:
    """Number of each row's language (-1: null) and the names."""
    encoded = batch.column("lang").cast(pa.string()).dictionary_encode()
    return encoded.indices.fill_null(-1).to_numpy(zero_copy_only=False), encoded.dictionary.to_pylist()


def _lang_pieces(whole: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[str], np.ndarray, Texts]]:
    """Texts of a batch, a bounded number of bytes at a time: (language numbers, names, whether a text begins here, texts)."""
    for batch in slices(whole, "text"):
        numbers, names = _langs(batch)
        texts = utf8(batch.column("text"))
        if batch.num_rows > 1:
            yield numbers, names, np.ones(len(texts), dtype=bool), Texts(texts)
            continue
        for i, piece in enumerate(pieces(texts[0])):
            yield numbers, names, np.array([i == 0]), Texts([piece])


def _cells(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell of each word hash in either table."""
    return ((hashes >> np.uint64(8)) % np.uint64(CELLS)).astype(np.int64), \
        ((hashes >> np.uint64(36)) % np.uint64(CELLS)).astype(np.int64)


def learn_references(documents: DataFrame, min_share: float = MIN_SHARE, max_languages: int = MAX_LANGUAGES,
                     min_docs: int = MIN_REFERENCE_DOCS) -> list[Reference]:
    """References of the languages tagged in documents (text, lang); null texts and null tags don't take part."""
    tagged = documents.select("text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    spark = documents.sparkSession

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per language: class counts, documents, words, and words in each hash cell of two tables."""
        sums: dict[str, np.ndarray] = {}
        for whole in batches:
            for numbers, names, begins, texts in _lang_pieces(whole):
                histogram = class_histogram(texts)
                starts, ends, text = texts.words()
                hashes, lang = texts.hashes(starts, ends), numbers[text]
                for k, name in enumerate(names):
                    total = sums.setdefault(name, np.zeros(len(CLASSES) + 2 + 2 * CELLS, dtype=np.int64))
                    own, rows = hashes[lang == k], numbers == k
                    total[:len(CLASSES)] += histogram[rows].sum(axis=0)
                    total[len(CLASSES):len(CLASSES) + 2] += (rows & begins).sum(), len(own)
                    for table, cells in enumerate(_cells(own)):
                        at = len(CLASSES) + 2 + table * CELLS
                        total[at:at + CELLS] += np.bincount(cells, minlength=CELLS)
        for name, total in sums.items():
            keys = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys)), pa.array(keys), pa.array(total[keys])],
                                             names=["lang", "key", "n"])

    docs_key, words_key, first_cell = len(CLASSES), len(CLASSES) + 1, len(CLASSES) + 2
    surveyed = tagged.mapInArrow(survey, "lang string, key long, n long").groupBy("lang", "key").agg(
        F.sum("n").alias("n"))
    # of a fixed number of cells only the classes, the totals and the heavy cells, 1 / min_share of a table, go on
    by_lang = surveyed.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("key", "n"))).alias("cells"))
    heavy_only = F.map_filter("cells", lambda k, n: (k < first_cell) | (
        n >= F.lit(min_share) * F.coalesce(F.element_at("cells", words_key), F.lit(0))))
    rows = (by_lang.where(F.element_at("cells", docs_key) >= min_docs)
            .orderBy(F.desc(F.element_at("cells", docs_key)), "lang").limit(max_languages)
            .select("lang", heavy_only.alias("cells")).collect())
    langs = {r["lang"]: r["cells"] for r in rows}
    heavy = {lang: np.array([[c.get(first_cell + t * CELLS + k, 0) >= min_share * c.get(words_key, 0)
                              for k in range(CELLS)] for t in range(2)]) for lang, c in langs.items()}
    shipped = spark.sparkContext.broadcast(heavy)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for numbers, names, _, texts in _lang_pieces(whole):
                starts, ends, text = texts.words()
                hashes, lang = texts.hashes(starts, ends), numbers[text]
                for k, name in enumerate(names):
                    if name in shipped.value:
                        own = hashes[lang == k]
                        one, two = _cells(own)
                        flags = shipped.value[name]
                        keys, n = np.unique(own[flags[0][one] & flags[1][two]].view(np.int64), return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name] * len(keys), pa.string()), pa.array(keys), pa.array(n.astype(np.int64))],
                            names=["lang", "key", "n"])

    words: dict[str, list[tuple[int, int]]] = {lang: [] for lang in langs}
    if langs:
        least = F.create_map(*[F.lit(x) for lang, c in langs.items() for x in (lang, min_share * c.get(words_key, 0))])
        counted = (tagged.mapInArrow(count, "lang string, key long, n long").groupBy("lang", "key")
                   .agg(F.sum("n").alias("n")).where(F.col("n") >= F.element_at(least, F.col("lang"))))
        for r in counted.collect():  # 1 / min_share words of each language at most
            words[r["lang"]].append((r["key"], r["n"]))
    out = []
    for lang, cells in sorted(langs.items()):
        common = sorted(words[lang])
        rest = cells.get(words_key, 0) - sum(n for _, n in common)
        out.append(Reference(lang, np.array([cells.get(k, 0) for k in range(len(CLASSES))], dtype=float),
                             np.array([h for h, _ in common], dtype=np.int64),
                             np.array([n for _, n in common] + [rest], dtype=float)))
    return out


def _repeated(hashes: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Words of each text that lie in a window which its text has twice or more."""
    at, grams = windows(hashes, text, REPEAT_WIDTH)
    grams ^= mix64(text[at].astype(np.uint64))  # equal windows of one text only
    ordered = np.sort(grams)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    del ordered
    if not len(twice):
        return np.zeros(n, dtype=np.int64)
    place = np.searchsorted(twice, grams)
    place[place == len(twice)] = 0
    begins = at[twice[place] == grams]
    change = np.zeros(len(text) + 1, dtype=np.int32)
    np.add.at(change, begins, 1)
    np.add.at(change, begins + REPEAT_WIDTH, -1)
    return np.bincount(text[np.cumsum(change[:-1], dtype=np.int32) > 0], minlength=n)


def _base_counts(texts: Texts) -> dict[str, np.ndarray]:
    starts, ends, text = texts.words()
    n_words = np.bincount(text, minlength=texts.n)
    characters = (texts.buf & 0xC0) != 0x80
    word_chars = texts.per_text(characters & ~SPACE_BYTES[texts.buf])
    word_hashes = texts.hashes(starts, ends)

    line_starts, line_ends, line_text = texts.lines()
    words_before = np.concatenate(([0], np.cumsum(~SPACE_BYTES[texts.buf])))
    full = words_before[line_ends] > words_before[line_starts]
    line_text = line_text[full]
    keyed = texts.hashes(line_starts[full], line_ends[full]) ^ mix64(line_text.astype(np.uint64))
    _, first = np.unique(keyed, return_index=True)
    n_dup = np.bincount(line_text, minlength=texts.n) - np.bincount(line_text[first], minlength=texts.n)
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": texts.per_text(_IS_SYMBOL[texts.buf]),
            "n_dup_lines": n_dup, "n_repeat_words": _repeated(word_hashes, text, texts.n),
            "_classes": class_histogram(texts), "_text": text, "_hashes": word_hashes.view(np.int64)}


def _line_pieces(text: bytes, size: int) -> Iterator[bytes]:
    """Whole lines of a text, about ``size`` bytes at a time."""
    start = 0
    while len(text) - start > 2 * size and (cut := text.find(b"\n", start + size)) >= 0:
        yield text[start:cut]
        start = cut + 1
    yield text[start:]


def _long_counts(text: bytes, size: int = MAX_BATCH_BYTES) -> dict[str, np.ndarray]:
    """``_base_counts`` of one long text, from its pieces."""
    sums = {"word_chars": 0, "n_symbols": 0, "_classes": 0}
    hashes, lines, n_lines = [], [], 0
    for piece in pieces(text, size):
        own = Texts([piece])
        starts, ends, _ = own.words()
        hashes.append(own.hashes(starts, ends))
        sums["word_chars"] += own.per_text((own.buf & 0xC0) != 0x80) - own.per_text(SPACE_BYTES[own.buf])
        sums["n_symbols"] += own.per_text(_IS_SYMBOL[own.buf])
        sums["_classes"] += class_histogram(own)
    for piece in _line_pieces(text, size):
        if len(piece) > 4 * size:     # with a line that is very long, and like no shorter one: hashed on its own
            parts = piece.split(b"\n")
            lines.append(np.array([int.from_bytes(hashlib.blake2b(p, digest_size=8).digest()) for p in parts
                                   if len(p) > 4 * size and p.strip(b" \t\v\f\r")], dtype=np.uint64))
            piece = b"\n".join(p for p in parts if len(p) <= 4 * size)
        own = Texts([piece])
        starts, ends, _ = own.lines()
        before = np.concatenate(([0], np.cumsum(~SPACE_BYTES[own.buf], dtype=np.int32)))
        full = before[ends] > before[starts]
        lines.append(own.hashes(starts[full], ends[full]))
    words, own_lines = np.concatenate(hashes), np.concatenate(lines)
    owner = np.zeros(len(words), dtype=np.int8)
    return {"n_words": np.array([len(words)]), "word_chars": sums["word_chars"], "n_symbols": sums["n_symbols"],
            "n_dup_lines": np.array([len(own_lines) - len(np.unique(own_lines))]),
            "n_repeat_words": _repeated(words, owner, 1), "_classes": sums["_classes"], "_text": owner,
            "_hashes": words.view(np.int64)}


#: words that are looked up at a time
_WORD_STRIDE = 1 << 20


def _word_distance(hashes: np.ndarray, text: np.ndarray, n_words: np.ndarray, ref: Reference) -> np.ndarray:
    known = len(ref.word_hashes)
    if not known:
        return np.zeros(len(n_words))
    counts = np.zeros((len(n_words), known + 1))
    for low in range(0, len(hashes), _WORD_STRIDE):
        own, owner = hashes[low:low + _WORD_STRIDE], text[low:low + _WORD_STRIDE]
        at = np.searchsorted(ref.word_hashes, own)
        at[at == known] = 0
        hit = ref.word_hashes[at] == own
        counts[:, :known] += np.bincount(owner[hit].astype(np.int64) * known + at[hit],
                                         minlength=len(n_words) * known).reshape(-1, known)
    counts[:, known] = n_words - counts[:, :known].sum(axis=1)
    return js_distance(counts, ref.word_counts)


def judge(documents: DataFrame, references: list[Reference], max_class: float = MAX_CLASS_DISTANCE,
          word_base: float = WORD_DISTANCE_BASE, word_slack: float = WORD_DISTANCE_SLACK) -> DataFrame:
    """Counts and verdict of each document (doc_id, text).

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance,
    word_distance (null where the text is too short for the test, or its tag or the corpus has no reference), kept.
    The tag is in ``lang``, if there is such a column; a null tag doesn't keep a text from being judged.
    Defined cases: a null text has no words, so it fails the base rule; repeated rows each get a row; an empty table
    gives an empty result; without references only the base rules judge; other columns may have any name.
    """
    shipped = documents.sparkSession.sparkContext.broadcast(references)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = shipped.value
        known = pa.array([r.lang for r in refs], pa.string())
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = utf8(batch.column("text"))
                long = len(texts) == 1 and len(texts[0]) > 2 * MAX_BATCH_BYTES
                base = _long_counts(texts[0]) if long else _base_counts(Texts(texts))
                text, hashes, histogram = (base.pop(n) for n in ("_text", "_hashes", "_classes"))
                n_words = base["n_words"]
                tag = batch.column("lang").cast(pa.string())
                foreign = pc.and_(tag.is_valid(), pc.invert(pc.is_in(tag, value_set=known))).to_numpy(zero_copy_only=False)
                failed = (n_words < 20) | (100 * base["n_repeat_words"] > 30 * n_words)
                if refs:
                    by_class = np.min([js_distance(histogram, r.classes) for r in refs], axis=0)
                    by_word = np.min([_word_distance(hashes, text, n_words, r) for r in refs], axis=0)
                else:
                    by_class = by_word = np.zeros(len(texts))
                no_class = (histogram.sum(axis=1) < MIN_CHARS) | foreign | (not refs)
                no_word = (n_words < MIN_WORDS) | foreign | (not refs)
                limit = word_base + word_slack / np.sqrt(np.maximum(n_words, 1))
                kept = ~failed & (no_class | (by_class <= max_class)) & (no_word | (by_word <= limit))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *(pa.array(c.astype(np.int64)) for c in base.values()), pa.array(failed),
                     pa.array(by_class, mask=no_class), pa.array(by_word, mask=no_word), pa.array(kept)],
                    names=["doc_id", *base, "base_failed", "class_distance", "word_distance", "kept"])

    tag = F.col("lang") if "lang" in documents.columns else F.lit(None)
    return documents.select("doc_id", "text", tag.cast("string").alias("lang")).mapInArrow(
        score, f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, n_words long, word_chars long, "
               "n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, class_distance double, "
               "word_distance double, kept boolean")


def op1_js_divergence(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judge(documents, learn_references(documents))
