"""Language identification by compression.

For each language a zstandard raw-content dictionary holds text of that language; a document is encoded with every
dictionary and belongs to the language with the smallest output.  Texts are encoded in blocks with a fresh context
each, so that a long text is measured against the dictionaries and not against itself.  The margin between the best
and the second language, relative to the size, says how sure the answer is; narrow ones are rejected.  Sizes are whole
bytes, and the encoder stores a text as it is where that is about as small; so a text of which one byte is more than the
least margin is encoded from several offsets behind a pad that makes the encoder compress, and the sizes are added up.
One on which no dictionary saves a byte even so is too short for the measure and is not rejected by it.

Scale: the dictionaries are built from a bounded sample.  Every language gets one; ``SAMPLE_DOCS`` texts and ``DICT_BYTES``
a language are for up to ``FULL_LANGUAGES`` of them, more share the total, down to ``LEAST_DOCS`` and ``LEAST_BYTES``.
Prediction is a map-only pass over whole texts, block by block.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.sampling import lowest_hashes, remainder
from strata.llm.textvec import decoded, utf8

#: sample bounds: texts of each language and bytes of a dictionary, for how many languages these are, and the least of both
SAMPLE_DOCS, DICT_BYTES, FULL_LANGUAGES = 400, 112 << 10, 200
LEAST_DOCS, LEAST_BYTES = 20, 4 << 10
#: bytes of a block that is encoded with a fresh context
BLOCK_BYTES = 1 << 10
#: shortest match of the encoder: short ones catch the syllables of unknown words
MIN_MATCH = 3
#: a document is rejected where the runner-up needs less than this share more than the best language
MIN_MARGIN = 0.01
#: short texts: offsets (in characters) they are encoded from, and what goes before them
OFFSETS, PAD = 16, bytes(64)
#: margin at which the score is about 0.76
SCORE_MARGIN = 0.05
UNDETERMINED = "und"

# Word characters other than digits and underscores; not all are letters: numerals like the roman ones are among them.
_MAYBE_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Whether a text has a character of one of the letter categories."""
    return any(m.group().isalpha() for m in _MAYBE_LETTER.finditer(text))


def learn_dictionaries(documents: DataFrame, fold: int = 4, held: int = 2, sample_docs: int = SAMPLE_DOCS,
                       dict_bytes: int = DICT_BYTES, full_languages: int = FULL_LANGUAGES) -> dict[str, bytes]:
    """Dictionary content of each language, from rows (doc_id, text, lang) outside the held-out fold.

    The sample of a language is about ``sample_docs`` different texts, those with the lowest text hashes; a dictionary takes an
    equal share of bytes from each, up to ``dict_bytes``.  Null texts and languages don't take part.
    """
    held_out = F.coalesce(remainder(F.col("doc_id"), fold) == held, F.lit(False))
    rows = (documents.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
            .where((F.length("text") > 0) & F.col("lang").isNotNull() & ~held_out))
    keyed = rows.select("lang", F.xxhash64("text").alias("h"))
    part = max(1.0, rows.select("lang").distinct().count() / full_languages)
    sample_docs, dict_bytes = max(LEAST_DOCS, int(sample_docs / part)), max(LEAST_BYTES, int(dict_bytes / part))
    chosen = lowest_hashes(keyed.distinct(), "lang", sample_docs).select(
        F.col("lang").alias("s_lang"), F.col("h").alias("s_hash"))
    # sample_docs keys a language, SAMPLE_DOCS * FULL_LANGUAGES in all where LEAST_DOCS doesn't make it more
    sample = (rows.withColumn("h", F.xxhash64("text"))
              .join(F.broadcast(chosen), (F.col("lang") == F.col("s_lang")) & (F.col("h") == F.col("s_hash")))
              .select("lang", "h", "text"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces of each text that go into the dictionary (rows of one language may come from many tasks)."""
        share = max(dict_bytes // sample_docs, 256)
        for batch in batches:
            pieces = [_piece(t, share) for t in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("h"), pa.array(pieces, pa.binary())],
                                             names=["lang", "h", "piece"])

    out: dict[str, dict[int, bytes]] = {}
    for r in sample.mapInArrow(build, "lang string, h long, piece binary").dropDuplicates(["lang", "h"]).collect():
        out.setdefault(r["lang"], {})[r["h"]] = bytes(r["piece"])
    # few texts: the pieces are short of the dictionary size, which does no harm
    return {lang: b"\n".join(p for _, p in sorted(pieces.items()))[:dict_bytes] for lang, pieces in sorted(out.items())}


def _piece(text: bytes, share: int) -> bytes:
    """A stretch of ``share`` bytes from a place in the text that depends on the text alone."""
    text = fold(text)
    start = zlib.crc32(text) % max(len(text) - share + 1, 1)
    return text[start:start + share]


def fold(text: bytes) -> bytes:
    """Lower case, so that headings and shouting count as their language."""
    return text.decode("utf-8", "replace").lower().encode()


class Coder:
    """Encoders of all languages; sizes of texts in each."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        self._coders = []
        for lang in self.langs:
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            parameters = zstandard.ZstdCompressionParameters.from_level(
                3, source_size=BLOCK_BYTES, dict_size=len(dictionaries[lang]), strategy=zstandard.STRATEGY_BTOPT,
                min_match=MIN_MATCH, write_checksum=0, write_content_size=0, write_dict_id=0,
                format=zstandard.FORMAT_ZSTD1_MAGICLESS)
            self._coders.append(zstandard.ZstdCompressor(dict_data=content, compression_params=parameters))
        # the pad in each language, and an encoder that knows no language
        self._pads = self.sizes(PAD)
        self._plain = zstandard.ZstdCompressor(compression_params=zstandard.ZstdCompressionParameters.from_level(
            3, source_size=BLOCK_BYTES, strategy=zstandard.STRATEGY_BTOPT, min_match=MIN_MATCH, write_checksum=0,
            write_content_size=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS))

    def fine_sizes(self, text: str) -> tuple[np.ndarray, bool]:
        """Sizes of a short text added up over its first offsets, without the pad; and whether a dictionary saves a byte."""
        padded = f" {text} "
        parts = [PAD + padded[i:].encode() for i in range(min(len(padded) - 1, OFFSETS))]
        sizes = sum(self.sizes(p) for p in parts)
        plain = sum(len(self._plain.compress(p[i:i + BLOCK_BYTES])) for p in parts for i in range(0, len(p), BLOCK_BYTES))
        return sizes - len(parts) * self._pads, bool(sizes.min() < plain)

    def sizes(self, text: bytes) -> np.ndarray:
        blocks = [text[i:i + BLOCK_BYTES] for i in range(0, len(text), BLOCK_BYTES)]
        return np.array([sum(len(c.compress(b)) for b in blocks) for c in self._coders], dtype=np.int64)

    def predict(self, text: str | None) -> tuple[str, float, float | None]:
        """(language, score, margin); no language without a letter, no margin where there is nothing to compare."""
        if not text or not self.langs or not has_letter(text):
            return UNDETERMINED, 0.0, None
        if len(self.langs) == 1:
            return self.langs[0], 1.0, None
        sizes = self.sizes(text.lower().encode())
        if sizes.min() * MIN_MARGIN < 1:
            sizes, told = self.fine_sizes(text.lower())
            if not told:     # the smallest size all the same, but no measure of how sure it is
                return self.langs[int(np.argmin(sizes))], 0.0, None
        order = np.argsort(sizes, kind="stable")
        best, second = sizes[order[0]], sizes[order[1]]
        margin = float(second - best) / max(float(best), 1.0)
        return self.langs[order[0]], float(np.tanh(margin / SCORE_MARGIN)), margin


def identify(documents: DataFrame, dictionaries: dict[str, bytes], fold: int = 4, held: int = 2,
             min_margin: float = MIN_MARGIN) -> DataFrame:
    """Language of every whole text: (doc_id, held_out, lang_pred, score, margin, rejected).

    ``lang_pred`` is a learned language, or ``und`` for a null text, a text without a letter, or no languages at all.
    ``rejected`` marks ``und`` and margins below ``min_margin`` (ties among them; of equals the first name wins).
    With one language there is nothing to compare and no margin, nor where a text is so short that no dictionary saves a
    byte on it: the smallest size with score 0, not rejected.  Malformed UTF-8 is read as U+FFFD, which is no letter.  Repeated rows each get a row, a null doc_id is not
    held out, an empty table gives an empty result, and other columns may have any name.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    predict = _predictor(documents, dictionaries)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in predict(batches):
            lang, score, margin = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(margin, pa.float64()), pa.array([_rejected(f, min_margin) for f in found], pa.bool_())],
                names=["doc_id", "lang_pred", "score", "margin", "rejected"])

    found = documents.select("doc_id", "text").mapInArrow(
        apply, f"doc_id {kind}, lang_pred string, score double, margin double, rejected boolean")
    return found.select("doc_id", F.coalesce(remainder(F.col("doc_id"), fold) == held, F.lit(False)).alias("held_out"),
                        "lang_pred", "score", "margin", "rejected")


def keep_identified(documents: DataFrame, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN) -> DataFrame:
    """The rows whose language is not rejected, with all their columns as they are."""
    predict = _predictor(documents, dictionaries)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in predict(batches):
            yield batch.filter(pa.array([not _rejected(f, min_margin) for f in found], pa.bool_()))

    return documents.mapInArrow(apply, documents.schema)


def _rejected(found: tuple[str, float, float | None], min_margin: float) -> bool:
    return found[0] == UNDETERMINED or (found[2] is not None and found[2] < min_margin)


def _predictor(documents: DataFrame, dictionaries: dict[str, bytes]):
    shipped = documents.sparkSession.sparkContext.broadcast(dictionaries)

    def predict(batches: Iterator[pa.RecordBatch]):
        coder = Coder(shipped.value)
        for batch in batches:
            yield batch, [coder.predict(t) for t in decoded(batch.column("text"))]

    return predict


def op4_zstd_dictionaries(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(documents, learn_dictionaries(documents))
