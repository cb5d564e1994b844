"""SentencePiece encoding and decoding with a shared-prefix Viterbi search.

A text is marked as the model does (a blank becomes U+2581, one is put in front) and cut before each run of marks.
The distinct marked words of a batch are sorted, which lays them out as a trie in depth-first order: the forward table
of a word is that of its predecessor up to their common prefix, so each shared prefix is searched once.

The forward value at a place depends on the kind of model:

* unigram: the best sum of piece scores of a path to that place (classical Viterbi);
* BPE: the last piece of the encoding of the prefix.  A path is valid if each of its neighbouring pieces is a pair that
  the merges leave apart, and exactly one valid path leads to each place, so the search is a Viterbi over 0 / -inf scores
  of pairs.  Its result is the merge result, piece by piece (the tests compare it with the reference library).

Pieces never hold a mark behind another character (checked when a model is read), so words are independent.

Scale: a map-only pass over whole texts; a task keeps the model, one batch, and a bounded table of words seen before.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.textvec import decoded, slices

MARK = "▁"
UNIGRAM, BPE = 1, 2
#: kinds of pieces in a model file (fixed values of the format)
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE, _UNUSED = 1, 2, 3, 4, 6, 5
#: words, and pairs of pieces, that a worker remembers from batch to batch (about 80 MB together)
CACHE_WORDS, KNOWN_PAIRS = 300_000, 200_000
#: more than any piece number
_PAIR = 1 << 24
#: default model (a parameter everywhere)
MODEL_NAME = "piece_bpe_32k.model"

_WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class Model:
    """Pieces and scores of a SentencePiece model file, and the search for a marked word."""

    def __init__(self, content: bytes):
        from sentencepiece import sentencepiece_model_pb2
        proto = sentencepiece_model_pb2.ModelProto.FromString(content)
        self.kind = proto.trainer_spec.model_type
        self.dummy_prefix = proto.normalizer_spec.add_dummy_prefix
        if proto.normalizer_spec.precompiled_charsmap or proto.normalizer_spec.remove_extra_whitespaces \
                or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models with identity normalisation and marks in front are supported")
        self._setup([(p.piece, p.score, p.type) for p in proto.pieces])

    @classmethod
    def of(cls, pieces: list[tuple[str, float, int]], kind: int, dummy_prefix: bool = True) -> Model:
        """A model from (piece, score, type) rows."""
        self = cls.__new__(cls)
        self.kind, self.dummy_prefix = kind, dummy_prefix
        self._setup(pieces)
        return self

    def _setup(self, pieces: list[tuple[str, float, int]]) -> None:
        self.pieces = pieces
        self.unknown = next((i for i, (_, _, t) in enumerate(pieces) if t == _UNKNOWN), 0)
        self.bytes = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(pieces) if t == _BYTE}
        self.ids = {p: i for i, (p, _, t) in enumerate(pieces) if t in (_NORMAL, _USER)}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece holds a mark behind another character")
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError(f"models of type {self.kind} are not supported")
        self.score = [s for _, s, _ in pieces]
        # what each piece stands for in a decoded text
        self.shown = [bytes([int(p[3:5], 16)]) if t == _BYTE else b"" if t == _CONTROL else " \u2047 ".encode()
                      if t == _UNKNOWN else p.replace(MARK, " ").encode() for p, _, t in pieces]
        self.size = [len(p) for p, _, _ in pieces]
        self._apart: dict[int, bool] = {}
        # all pieces that end at a place, longest first
        self.matches = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            # a piece that the merges of its own text don't make never comes up in an encoding
            if self.kind == UNIGRAM or self._merge(piece) == [piece]:
                self.matches.add_word(piece, i)
        self.matches.make_automaton()
        self.floor = min((self.score[i] for i in self.ids.values()), default=0.0) - 10.0

    # -- BPE: which neighbours do the merges leave apart? -------------------------------------------------------

    def _merge(self, text: str) -> list[str]:
        """Merge result of a short text (used for single pieces, to see how they are put together)."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                piece = self.ids.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or self.score[piece] > best):
                    best, at = self.score[piece], i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _text(self, symbol: int) -> str:
        return self.pieces[symbol][0] if symbol >= 0 else chr(-1 - symbol)

    def apart(self, left: int, right: int) -> bool:
        """Do the merges of the two pieces' joint text end in exactly these two?"""
        a, b = self._text(left), self._text(right)
        found = self._merge(a + b) == [a, b]
        if len(self._apart) >= KNOWN_PAIRS:
            self._apart.clear()
        self._apart[left * _PAIR + right] = found
        return found

    # -- search ----------------------------------------------------------------------------------------------

    def encode_words(self, words: list[str]) -> dict[str, list[int]]:
        """Piece numbers of distinct marked words, searched in trie order."""
        out: dict[str, list[int]] = {}
        search = self._search_bpe if self.kind == BPE else self._search_unigram
        # forward value, start of the last piece, last piece; for each prefix of the word at hand
        table: list[tuple] = [(0.0, 0, None)]
        before = ""
        for word in sorted(words):
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del table[shared + 1:]
            search(word, shared, table)
            out[word] = self._back(word, table)
            before = word
        return out

    def _search_unigram(self, word: str, shared: int, table: list[tuple]) -> None:
        """Best score of a path to each new place; a step over one character as unknown costs the floor."""
        for last, piece in self.matches.iter(word):
            if last < shared:
                continue
            while len(table) <= last + 1:
                table.append((table[-1][0] + self.floor, len(table) - 1, None))
            start = last + 1 - self.size[piece]
            value = table[start][0] + self.score[piece]
            if value > table[last + 1][0]:
                table[last + 1] = (value, start, piece)
        while len(table) <= len(word):
            table.append((table[-1][0] + self.floor, len(table) - 1, None))

    def _search_bpe(self, word: str, shared: int, table: list[tuple]) -> None:
        """The only piece that may end at each new place, given the last pieces of all prefixes."""
        apart, size, filled = self._apart, self.size, shared
        for last, piece in self.matches.iter(word):
            if last < filled:  # shared, or its piece is found
                continue
            while filled < last:  # characters that are no piece
                table.append((0.0, filled, -1 - ord(word[filled])))
                filled += 1
            start = last + 1 - size[piece]
            if start:
                left = table[start][2]
                fits = apart.get(left * _PAIR + piece)
                if fits is None:
                    fits = self.apart(left, piece)
                if not fits:
                    continue
            table.append((0.0, start, piece))
            filled += 1
        while filled < len(word):
            table.append((0.0, filled, -1 - ord(word[filled])))
            filled += 1

    def _back(self, word: str, table: list[tuple]) -> list[int]:
        ids: list[int] = []
        at = len(word)
        while at:
            _, start, piece = table[at]
            if piece is None or piece < 0:
                ids.extend(reversed(self._fallback(word[start:at])))
            else:
                ids.append(piece)
            at = start
        ids.reverse()
        return ids

    def _fallback(self, character: str) -> list[int]:
        """Byte pieces of a character that is no piece, or the unknown piece."""
        if len(self.bytes) < 256:
            return [self.unknown]
        return [self.bytes[b] for b in character.encode()]

    def mark(self, text: str) -> str:
        if not text:
            return ""
        marked = text.replace(" ", MARK)
        return MARK + marked if self.dummy_prefix else marked

    def encode_arrays(self, texts: list[str], cache: dict[str, bytes] | None = None) -> list[np.ndarray]:
        """Piece numbers of whole texts (int32 arrays); ``cache`` is the word table, filled on the way."""
        cut = [_WORDS.findall(self.mark(t)) for t in texts]
        known = cache if cache is not None else {}
        if len(known) > CACHE_WORDS:
            known.clear()
        fresh = set(itertools.chain.from_iterable(cut)).difference(known)
        for word, ids in self.encode_words(list(fresh)).items():
            known[word] = array("i", ids).tobytes()
        return [np.frombuffer(b"".join([known[w] for w in words]), dtype=np.int32) for words in cut]

    def encode(self, texts: list[str], cache: dict[str, bytes] | None = None) -> list[list[int]]:
        return [ids.tolist() for ids in self.encode_arrays(texts, cache)]

    def decode(self, ids: list[int]) -> str:
        """Text of piece numbers: byte pieces are joined, marks become blanks, the blank put in front goes."""
        shown = self.shown
        text = b"".join([shown[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


_LOADED: dict[bytes, tuple[Model, dict[str, bytes]]] = {}


def loaded(content: bytes) -> tuple[Model, dict[str, bytes]]:
    """Model and word table of this worker process (made once, used by all its tasks)."""
    key = hashlib.sha256(content).digest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Model(content), {}
    return _LOADED[key]


def default_model_path() -> str:
    """Place of the installed public model file."""
    import public_tokenizers
    return public_tokenizers.path(MODEL_NAME)


def encode_documents(documents: DataFrame, model: bytes) -> DataFrame:
    """Piece numbers of every whole text: (doc_id, input_ids array<int>, n_tokens, round_trip).

    ``round_trip`` says whether decoding gives the text back (a text that holds U+2581 itself does not).  Defined
    cases: null and empty texts have no tokens, and a null one no round trip; malformed UTF-8 is read as U+FFFD; repeated rows each get a row; an empty
    table gives an empty result; other columns may have any name.
    """
    shipped = documents.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, cache = loaded(shipped.value)
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = decoded(batch.column("text"))
                ids = m.encode_arrays([t or "" for t in texts], cache)
                back = [t is not None and m.decode(i.tolist()) == t for t, i in zip(texts, ids, strict=True)]
                size = np.array([len(i) for i in ids], dtype=np.int64)
                ends = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids))),
                     pa.array(size), pa.array(back, pa.bool_())],
                    names=["doc_id", "input_ids", "n_tokens", "round_trip"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        apply, f"doc_id {kind}, input_ids array<int>, n_tokens long, round_trip boolean")


def decode_documents(encoded: DataFrame, model: bytes) -> DataFrame:
    """Text of each row of piece numbers: (doc_id, text); a null array gives a null text."""
    shipped = encoded.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, _ = loaded(shipped.value)
        for batch in batches:
            texts = [None if i is None else m.decode(i) for i in batch.column("input_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "input_ids").mapInArrow(apply, f"doc_id {kind}, text string")


def read_model(path: str | None = None) -> bytes:
    with open(path or default_model_path(), "rb") as f:
        return f.read()


def op2_shared_prefix_viterbi(spark, sf_dir: str) -> DataFrame:
    encoded = encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), read_model())
    return encoded.select("doc_id", "n_tokens",
                          F.sha2(F.array_join(F.transform("input_ids", lambda i: i.cast("string")), " "), 256)
                          .alias("ids_sha256"), "round_trip")
