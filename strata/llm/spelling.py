"""Spelling variants: near words by blocked Gram matrices, each word's form, and the root that forms lead to.

Words come from maximal runs of Latin letters, counted over all documents.  Two words are near if one inserted, deleted or
replaced character turns one into the other.  A word's form is its most frequent near word, if that is frequent enough
beside it; its root is what remains when forms are followed to the end.

Near words.  A word is the vector of its letter counts.  For two words one edit apart the squared distance of these
vectors is 1 (insertion) or 2 (replacement), so within a block of words the product of the count matrix with itself (the
Gram matrix) gives all candidates: pairs with |x|^2 + |y|^2 - 2 x.y <= 2 whose lengths differ by one at most.  An exact
comparison follows.  Block L holds the words of length L and, for insertions, those of length L + 1.

Large blocks.  A block of more than ``BLOCK_WORDS`` words is split by where the edit is: in the first or in the second half
of the shorter word.  Outside the half that has the edit both words agree, so the rest of the word is the key of the new,
smaller block; the half is the block's window, which is halved again while blocks are too large.  A word enters both
halves, so no pair is lost: an edit is in one window of every generation, and of the windows that could have it only the
one with the leftmost place reports the pair, so that it is reported once.  In the end a window is one character, and a
block holds words that agree in everything else, so its size is bounded by the alphabet.

Scale.  Texts are counted a batch at a time in the tasks, and only (word, count) pairs are shuffled.  Blocks are cut by
Spark: every generation is a count by key and a join with it, and words that are alone in their block leave.  Products work
on blocks of bounded size, in slices.  Forms are followed by pointer jumping over the table of words.

Odd rows.  A null or empty text has no words; a null doc_id counts as an empty string in the hash of the deletion rule;
repeated rows count twice.  Ties between near words of equal frequency go to the smallest in code-point order.  A text is
read in pieces that end between words, so memory follows one text, not its words.  Malformed UTF-8 is read as U+FFFD,
which is no letter.  No documents give no rows.  Columns other than doc_id and text, whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.sql import CRC_TABLE, crc32, lower_az
from strata.llm.textvec import slices, utf8
from strata.llm.workspace import Workspace

#: fixed values: what a word is, how often one is spoilt, and when a frequent near word is its form
MIN_CHARS, MIN_COUNT, SPOIL_FOLD, FORM_RATIO = 6, 5, 199, 5
#: words of a block at most, unless its window is a single character
BLOCK_WORDS = 512
#: different words of a task that are kept before their counts go out
TASK_WORDS = 200_000
#: bytes of a text that are split into words at a time
PIECE_BYTES = 1 << 20
#: numbers in a slice of a Gram matrix
SLICE_CELLS = 1 << 20
#: words up to this length have products that single precision holds exactly
_SINGLE_CHARS = 2000

# A word character in Latin-1 stands for itself (A-Z for a-z); every other byte is a blank.
_LETTERS = np.full(256, 0x20, dtype=np.uint8)
_LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTERS[0xC0:0x100] = np.arange(0xC0, 0x100)
_TO_WORDS = _LETTERS.tobytes()
# columns of the count matrix: a-z, then the letters from U+00C0 on
_COLUMN = np.zeros(256, dtype=np.int64)
_COLUMN[0x61:0x7B] = np.arange(26)
_COLUMN[0xC0:0x100] = 26 + np.arange(64)
_COLUMNS = 90


def _runs(text: bytes) -> Iterator[list[bytes]]:
    """Lower-cased letter runs of a text in Latin-1, a piece at a time."""
    plain = text.decode("utf-8", "replace").encode("latin-1", "replace").translate(_TO_WORDS)
    start = 0
    while start < len(plain):
        cut = plain.find(b" ", start + PIECE_BYTES) if len(plain) > start + PIECE_BYTES else -1
        end = cut if cut >= 0 else len(plain)
        yield plain[start:end].split()
        start = end + 1


def _utf8_of(word: bytes) -> bytes:
    return word if word.isascii() else word.decode("latin-1").encode()


def text_words(doc_id: str | None, text: bytes) -> Counter:
    """Words of one document (Latin-1 bytes) and their counts, after the deletion rule."""
    runs: Counter = Counter()
    for piece in _runs(text):
        runs.update(piece)
    start, out = zlib.crc32(f"{doc_id or ''}:".encode()), Counter()
    for run, n in runs.items():
        if len(run) < MIN_CHARS:
            continue
        h = zlib.crc32(_utf8_of(run), start)
        if h % SPOIL_FOLD == 0:
            k = h % len(run)
            run = run[:k] + run[k + 1:]
            if len(run) < MIN_CHARS:
                continue
        out[run] += n
    return out


def count_words(documents: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of all documents, for words with at least ``min_count`` occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in total], pa.string()),
                                              pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for part in slices(batch, "text"):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), utf8(part.column("text"))):
                    total.update(text_words(doc_id, text))
                    if len(total) > TASK_WORDS:
                        yield flush()
        yield flush()

    rows = documents.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return (rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


def letter_counts(words: list[bytes]) -> np.ndarray:
    """Letter counts of words in Latin-1: one row per word."""
    codes = np.frombuffer(b"".join(words), dtype=np.uint8)
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    counts = np.bincount(row * _COLUMNS + _COLUMN[codes], minlength=len(words) * _COLUMNS).reshape(len(words), _COLUMNS)
    exact_in_single = max(map(len, words)) <= _SINGLE_CHARS
    return counts.astype(np.float32 if exact_in_single else np.float64)


def edit_place(x: bytes, y: bytes) -> int:
    """First place of the one edit between ``x`` and the equally long or one longer ``y``; -1 if it isn't just one."""
    if x == y:
        return -1
    p = next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), len(x))
    rest = x[p + 1:] if len(x) == len(y) else x[p:]
    return p if rest == y[p + 1:] else -1


def block_pairs(words: list[bytes], short: int, window: tuple[int, int]) -> Iterator[tuple[int, int]]:
    """Near pairs (i, j) of a block whose edit starts in the window; ``short`` is the length of the shorter words.

    Pairs have one word of length ``short`` at least; two longer ones belong to the next block.
    """
    if len(words) < 2:
        return
    counts = letter_counts(words)
    squares = np.einsum("ij,ij->i", counts, counts)
    is_short = np.array([len(w) == short for w in words])
    rows = np.flatnonzero(is_short)
    step = max(1, SLICE_CELLS // len(words))
    for a in range(0, len(rows), step):
        own = rows[a:a + step]
        distance = squares[own, None] + squares[None, :] - 2 * (counts[own] @ counts.T)
        at, other = np.nonzero(distance <= 2)
        at = own[at]
        # two short words: each pair once; a short and a long word: as they are
        keep = (at != other) & (~is_short[other] | (at < other))
        for i, j in zip(at[keep].tolist(), other[keep].tolist()):
            p = edit_place(words[i], words[j])
            if p >= 0 and window[0] <= min(p, short - 1) < window[1]:
                yield i, j


def _block_key() -> Column:
    """What the words of a block have in common: length, window, and all of the word outside the window."""
    after = F.col("stop") + 1 + (F.length("word") - F.col("short"))
    return F.concat_ws(":", "short", "start", "stop", F.substring(F.col("word"), F.lit(1), F.col("start")),
                       F.substring(F.col("word"), after, F.length("word")))


def cut_blocks(work: Workspace, words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Rows (key, short, start, stop, word, n) of blocks with two words or more, one of them of the block's length."""
    length = F.length("word")
    rows = words.select(F.explode(F.array(length, length - 1)).alias("short"), "word", "n").where(
        F.col("short") >= MIN_CHARS).select("short", F.lit(0).alias("start"), F.col("short").alias("stop"), "word", "n")
    done = []
    while True:
        keyed = work.write(rows.withColumn("key", _block_key()), "blocks")
        sizes = keyed.groupBy(F.col("key").alias("s_key")).agg(
            F.count(F.lit(1)).alias("size"), F.max((F.length("word") == F.col("short")).cast("int")).alias("has_short"))
        held = work.write(keyed.join(sizes.where("size > 1 and has_short = 1"), F.col("key") == F.col("s_key"))
                          .withColumn("large", (F.col("size") > block_words) & (F.col("stop") - F.col("start") > 1))
                          .select("key", "short", "start", "stop", "word", "n", "large"), "blocks")
        work.drop(keyed)
        done.append(held.where("not large").drop("large"))
        if held.where("large").isEmpty():
            break
        middle = F.floor((F.col("start") + F.col("stop")) / 2).cast("int")
        halves = F.explode(F.array(F.struct(F.col("start").alias("a"), middle.alias("b")),
                                   F.struct(middle.alias("a"), F.col("stop").alias("b"))))
        rows = held.where("large").select("short", halves.alias("half"), "word", "n").select(
            "short", F.col("half.a").alias("start"), F.col("half.b").alias("stop"), "word", "n")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


_BLOCK_COLUMNS = ("key", "short", "start", "stop", "word", "n")
_LINK_SCHEMA = "word string, near string, near_n long"


def near_words(work: Workspace, words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, near, near_n): every near pair of the words (word, n), in both directions, once each."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []   # the rows of the block that may go on in the next batch

        def blocks(rows: pa.Table, last: bool) -> pa.RecordBatch:
            key, short, start, stop, word, n = (rows.column(c).to_pylist() for c in _BLOCK_COLUMNS)
            cuts = [0, *[i for i in range(1, len(key)) if key[i] != key[i - 1]], len(key)]
            left, right = [], []
            for a, b in zip(cuts, cuts[1:] if last else cuts[1:-1]):
                own = [w.encode("latin-1") for w in word[a:b]]
                for i, j in block_pairs(own, short[a], (start[a], stop[a])):
                    left += (a + i, a + j)
                    right += (a + j, a + i)
            held[:] = [] if last else rows.slice(cuts[-2]).to_batches()
            return pa.RecordBatch.from_arrays([
                pa.array([word[i] for i in left], pa.string()), pa.array([word[i] for i in right], pa.string()),
                pa.array([n[i] for i in right], pa.int64())], names=["word", "near", "near_n"])

        for batch in batches:
            if batch.num_rows:
                yield blocks(pa.Table.from_batches([*held, batch]), last=False)
        if held:
            yield blocks(pa.Table.from_batches(held), last=True)

    rows = cut_blocks(work, words, block_words).select(*_BLOCK_COLUMNS)
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(links, _LINK_SCHEMA)


def roots(work: Workspace, forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form (word, form): forms are followed until a word has none.

    A form is more frequent than its word, so there are no cycles, and the distance doubles with every join.
    """
    table = work.write(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = table.select(F.col("word").alias("a_word"), F.col("root").alias("a_root"))
        further = work.write(table.join(ahead, F.col("root") == F.col("a_word"), "left").select(
            "word", F.coalesce("a_root", "root").alias("root"), F.col("a_root").isNotNull().alias("moved")), "roots")
        work.drop(table)
        table = further
        if table.where("moved").isEmpty():
            return table.select("word", "root")


def group_variants(work: Workspace, documents: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words of the documents."""
    words = work.write(count_words(documents), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near")))
    near = near_words(work, words).groupBy(F.col("word").alias("w")).agg(
        F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    frequent = -F.col("best.minus") >= FORM_RATIO * F.col("n")
    table = work.write(words.join(near, F.col("word") == F.col("w"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(frequent, F.col("best.near")).alias("form"),
        F.when(frequent, -F.col("best.minus")).alias("form_n")), "forms")
    ends = roots(work, table.where("form is not null")).withColumnRenamed("word", "r_word")
    return table.join(ends, F.col("word") == F.col("r_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_blocked_gram(spark, sf_dir: str) -> DataFrame:
    return group_variants(Workspace(spark, "spelling"), spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: near pairs by the words without one character: an insertion meets the longer word there, a replacement both words
OP11_SQL = rf"""
WITH RECURSIVE {CRC_TABLE}, runs AS (
  SELECT doc, run, count(*) AS n FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS doc,
      unnest(regexp_extract_all({lower_az("text")}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= {MIN_CHARS} GROUP BY ALL
), hashed AS (
  SELECT run, n, {crc32("doc || ':' || run")} AS h FROM runs, crc
), words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % {SPOIL_FOLD} = 0
      THEN run[1:(h % length(run))::BIGINT] || run[(h % length(run))::BIGINT + 2:] ELSE run END AS word FROM hashed)
  WHERE length(word) >= {MIN_CHARS} GROUP BY word HAVING sum(n) >= {MIN_COUNT}
), cut AS MATERIALIZED (
  SELECT word, i, word[1:i - 1] || word[i + 1:] AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), links AS MATERIALIZED (
  SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT rest, cut.word FROM cut JOIN words ON words.word = rest
  UNION SELECT cut.word, rest FROM cut JOIN words ON words.word = rest
), best AS (
  SELECT l.word, count(*) AS n_near, max(w.n) AS top, arg_min(near, (-w.n, near)) AS near
  FROM links l JOIN words w ON w.word = l.near GROUP BY l.word
), forms AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= {FORM_RATIO} * n THEN near END AS form,
    CASE WHEN top >= {FORM_RATIO} * n THEN top END AS form_n
  FROM words LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS at, form AS next FROM forms
  UNION ALL SELECT chain.word, forms.word, forms.form FROM chain JOIN forms ON forms.word = chain.next
)
SELECT forms.word, forms.form, chain.at AS root, n, n_near, form_n
FROM forms JOIN chain ON chain.word = forms.word AND chain.next IS NULL
"""
