"""Benchmark decontamination with a generalised suffix automaton over the words of the test items.

The items are dealt into blocks of about ``BLOCK_CHARS`` characters, one for most benchmarks.  The automaton of a block is
built on the driver and shipped to the tasks.  Training texts stream through it word by word; the state carries the length
of the longest suffix of the words read so far that occurs in some item.  A word is *hit* when it lies in an occurrence of a
window: 13 consecutive item words, or a whole item of fewer words.

Scale: one map-only pass over the documents for each block, no shuffle with one block; with several, the spans of a document
are brought together by its row.  Memory per task is one automaton plus one batch of texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.components import materialize
from strata.llm.textvec import slices, utf8

WINDOW = 13
#: a document is contaminated from one hit word in this many
COVERAGE = 20
#: characters of the items of a block: an automaton takes about 150 bytes of memory a character (measured on random words:
#: 208 MB for 1.4 million characters), and there is one at a time in the driver and one in every task
BLOCK_CHARS = 1_000_000

# bytes of a word after lower-casing A-Z: digits, a-z and everything beyond ASCII; all others separate words
_FOLD = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A
              or b >= 0x80 else 0x20 for b in range(256))
_WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def words_of(text: bytes) -> list[bytes]:
    """Normalised words of a UTF-8 text."""
    return text.translate(_FOLD).split()


class SuffixAutomaton:
    """Generalised suffix automaton over word numbers, with the items whose windows end in each state.

    ``items_at[state]`` is non-empty for the state that holds a window (the length-13 suffix, or a whole shorter
    item); ``windows[state]`` lists (length, window state) of all windows that are suffixes of the state's strings.
    """

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        texts = [(item, [self.vocab.setdefault(w, len(self.vocab)) for w in words_of(text)]) for item, text in items]
        for _, word_ids in texts:
            last = 0
            for w in word_ids:
                last = self._extend(last, w)
        self.items_at: dict[int, list[str]] = {}
        short: dict[int, int] = {}
        found: dict[int, set[str]] = {}
        for item, word_ids in texts:
            if not word_ids:
                continue
            size = min(window, len(word_ids))
            state = matched = 0
            for w in word_ids:
                state, matched = self.next[state][w], matched + 1
                while self.len[self.link[state]] >= size:
                    state = self.link[state]
                    matched = self.len[state]
                if matched >= size:
                    found.setdefault(state, set()).add(item)
                    if size < window:
                        short[state] = size
        self.items_at = {s: sorted(v) for s, v in found.items()}
        self.windows: list[tuple[tuple[int, int], ...]] = [()] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.len.__getitem__):
            own: tuple[tuple[int, int], ...] = self.windows[self.link[s]]
            if s in short:
                own += ((short[s], s),)
            if self.len[s] >= window > self.len[self.link[s]] and s in self.items_at:
                own += ((window, s),)
            self.windows[s] = own

    def _extend(self, last: int, w: int) -> int:
        at = self.next[last].get(w)
        if at is not None:  # the prefix is known from an earlier item
            return at if self.len[at] == self.len[last] + 1 else self._clone(last, w, at)
        new = len(self.next)
        self.next.append({})
        self.len.append(self.len[last] + 1)
        self.link.append(0)
        p = last
        while p != -1 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p != -1:
            at = self.next[p][w]
            self.link[new] = at if self.len[at] == self.len[p] + 1 else self._clone(p, w, at)
        return new

    def _clone(self, p: int, w: int, at: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[at]))
        self.len.append(self.len[p] + 1)
        self.link.append(self.link[at])
        self.link[at] = copy
        while p != -1 and self.next[p].get(w) == at:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges [start, end) in window occurrences (merged, in order) and the items they belong to."""
        step, link, length, windows = self.next, self.link, self.len, self.windows
        spans: list[tuple[int, int]] = []
        reached: set[int] = set()
        state = matched = 0
        for i, w in enumerate(map(self.vocab.get, words)):
            if w is None:
                state = matched = 0
                continue
            to = step[state].get(w)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = step[state].get(w)
            if to is None:
                matched = 0
                continue
            state, matched = to, matched + 1
            if windows[state]:
                longest = 0
                for size, at in windows[state]:
                    if size <= matched:
                        reached.add(at)
                        longest = max(longest, size)
                if longest:
                    start = i + 1 - longest
                    while spans and spans[-1][1] >= start:
                        start = min(start, spans.pop()[0])
                    spans.append((start, i + 1))
        return spans, {item for s in reached for item in self.items_at[s]}


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> tuple[DataFrame, int]:
    """Different items (item_id, text, block) of a benchmark, dealt by hash into blocks of about ``block_chars``
    characters, and the number of blocks; null texts are no items.  An item that is larger is a large block."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where(F.col("text").isNotNull()).distinct()
    size = items.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    blocks = max(1, -(-size // block_chars))
    return items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), blocks


def automata(benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> Iterator[SuffixAutomaton]:
    """The automaton of each block of the items, one after the other; items without words have no windows."""
    items, blocks = item_blocks(benchmark, block_chars)
    for block in range(blocks):
        rows = items.where(F.col("block") == block).select("item_id", "text").collect()     # about block_chars characters
        yield SuffixAutomaton([(r["item_id"] or "", r["text"].encode("utf-8", "replace")) for r in rows], window)


def build_automaton(benchmark: DataFrame, window: int = WINDOW) -> SuffixAutomaton:
    """Automaton of all items as one block, for a benchmark that is known to be small."""
    return next(automata(benchmark, window, 1 << 62))


_SPANS = "array<struct<start: long, end: long>>"
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _scan(rows: DataFrame, key: str, automaton: SuffixAutomaton) -> DataFrame:
    """(key, n_words, spans, items) of rows (key, text)."""
    shipped = rows.sparkSession.sparkContext.broadcast(automaton)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shipped.value
        for whole in batches:
            for batch in slices(whole, "text"):
                n_words, spans, items = [], [], []
                for text in utf8(batch.column("text")):
                    words = words_of(text)
                    found, names = machine.scan(words)
                    n_words.append(len(words))
                    spans.append([{"start": s, "end": e} for s, e in found])
                    items.append(sorted(names))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key), pa.array(n_words, pa.int64()), pa.array(spans, _ARROW_SPANS),
                     pa.array(items, pa.list_(pa.string()))], names=[key, "n_words", "spans", "items"])

    return rows.select(key, "text").mapInArrow(
        scan, f"{key} {rows.schema[key].dataType.simpleString()}, n_words long, spans {_SPANS}, items array<string>")


def _joined_spans(spans: Column) -> Column:
    """Overlapping and touching ranges of all blocks as one list of ranges, in order."""
    def add(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        grown = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= s["start"]), grown).otherwise(
            F.concat(done, F.array(s)))
    return F.aggregate(F.array_sort(spans), F.array().cast(_SPANS), add)


def _hits(rows: DataFrame, key: str, machines: Iterable[SuffixAutomaton]) -> DataFrame:
    """(key, n_words, n_hit, spans, items, contaminated) of rows (key, text) whose keys differ if there are several blocks."""
    parts = [_scan(rows, key, m) for m in machines]
    found = parts[0]
    if len(parts) > 1:
        for p in parts[1:]:
            found = found.unionByName(p)
        found = found.groupBy(key).agg(
            F.max("n_words").alias("n_words"), _joined_spans(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(key, "n_words", n_hit.alias("n_hit"), "spans", "items").withColumn(
        "contaminated", (F.col("n_hit") > 0) & (COVERAGE * F.col("n_hit") >= F.col("n_words")))


Machines = SuffixAutomaton | Iterable[SuffixAutomaton]


def _taken(machines: Machines) -> tuple[SuffixAutomaton | None, Iterator[SuffixAutomaton]]:
    """The automaton, if it is only one, or None and all of them, which need not be in memory together."""
    if isinstance(machines, SuffixAutomaton):
        return machines, iter(())
    rest = iter(machines)
    first, second = next(rest), next(rest, None)
    return (first, iter(())) if second is None else (None, chain((first, second), rest))


def scan_documents(documents: DataFrame, machines: Machines) -> DataFrame:
    """One row per document: n_words, hit word spans, items hit, coverage verdict.

    Columns: doc_id, n_words, n_hit, spans (array of word ranges, end exclusive), items (sorted), contaminated.
    ``machines`` is the automaton of the items or those of their blocks (``automata``).  With several blocks the rows are numbered and
    written first, so that what the blocks find in a row comes together however often its doc_id occurs.
    Defined cases: a null or empty text has no words and is clean; repeated rows each get a row; only doc_id and text
    are read, so other columns may have any name; an empty table gives an empty result.  Bytes that are no UTF-8 are
    word characters like all beyond ASCII.
    """
    only, several = _taken(machines)
    if only:
        return _hits(documents, "doc_id", (only,))
    rows = materialize(documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "numbered")
    found = _hits(rows, "row", several).withColumnRenamed("row", "f_row")
    return rows.select("row", "doc_id").join(found, F.col("row") == F.col("f_row")).drop("row", "f_row")


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the given word ranges (each from its first word to the end of its last)."""
    at = [m.span() for m in _WORD.finditer(text)]
    edges = [0, *(x for s, e in spans for x in (at[s][0], at[e - 1][1])), len(text)]
    return "".join(text[a:b] for a, b in zip(edges[0::2], edges[1::2], strict=True))


def remove_contamination(documents: DataFrame, machines: Machines) -> DataFrame:
    """Documents without benchmark text: contaminated ones go, and the others lose their hit spans.

    Rows keep all their columns; where a text changes, ``n_chars`` (if it is there) follows it, and malformed UTF-8
    becomes U+FFFD.  Null and empty texts have no hits and stay, repeated rows are treated alike, and an empty table
    gives an empty result.
    """
    only, several = _taken(machines)
    names = documents.columns
    if only is None:
        # the row travels as one column beside what the blocks have found in it
        rows = materialize(documents.select(
            F.monotonically_increasing_id().alias("row"), "text",
            F.struct(*(F.col(f"`{n}`") for n in names)).alias("whole")), "numbered")
        found = _hits(rows, "row", several).where("n_hit > 0").withColumnRenamed("row", "f_row")
        joined = rows.join(found, F.col("row") == F.col("f_row"), "left").where(
            ~F.coalesce("contaminated", F.lit(False))).select("text", "whole", "spans")

        def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in slices(whole, "text"):
                    ranges = [[(s["start"], s["end"]) for s in v or ()] for v in batch.column("spans").to_pylist()]
                    rest = [cut_spans(t.decode("utf-8", "replace"), r) if r else None
                            for t, r in zip(utf8(batch.column("text")), ranges, strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column("whole"), pa.array(rest, pa.string())], names=["whole", "rest"])

        cut = joined.mapInArrow(cut_rows, f"whole {rows.schema['whole'].dataType.simpleString()}, rest string")
        put = {n: F.col("whole")[n] for n in names}
        if "n_chars" in put:
            put["n_chars"] = F.coalesce(F.char_length("rest").cast(documents.schema["n_chars"].dataType), put["n_chars"])
        put["text"] = F.coalesce("rest", put["text"])
        return cut.select(*(c.alias(n) for n, c in put.items()))
    shipped = documents.sparkSession.sparkContext.broadcast(only)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shipped.value
        for whole in batches:
            for batch in slices(whole, "text"):
                keep, changed = np.ones(batch.num_rows, dtype=bool), {}
                for i, text in enumerate(utf8(batch.column("text"))):
                    words = words_of(text)
                    found, _ = machine.scan(words)
                    hit = sum(e - s for s, e in found)
                    if hit:
                        keep[i] = COVERAGE * hit < len(words)
                        if keep[i]:
                            changed[i] = cut_spans(text.decode("utf-8", "replace"), found)
                columns = {n: batch.column(n) for n in names}
                if changed:
                    rows = np.array(sorted(changed))
                    mask = np.zeros(batch.num_rows, dtype=bool)
                    mask[rows] = True
                    put = lambda col, new: pc.replace_with_mask(
                        col, pa.array(mask), pa.array(new, col.type))
                    columns["text"] = put(columns["text"], [changed[i] for i in rows])
                    if "n_chars" in columns:
                        columns["n_chars"] = put(columns["n_chars"], [len(changed[i]) for i in rows])
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=names).filter(pa.array(keep))

    return documents.mapInArrow(clean, documents.schema)


def op6_suffix_automaton(spark, sf_dir: str) -> DataFrame:
    machines = automata(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    found = scan_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), machines)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.col("items"), ","), 256).alias("items_sha256"), "contaminated")


OP6_SQL = r"""
WITH items AS (
  SELECT item_id::VARCHAR AS item_id,
    regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
          AS lower_az FROM benchmark)
), item_windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size,
    array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)
), docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
          AS lower_az FROM documents)
), doc_windows AS (
  SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM docs, (SELECT DISTINCT size FROM item_windows) WHERE len(w) >= size)
), occurrences AS (
  SELECT d.r, d.i, d.size, t.item_id FROM doc_windows d JOIN item_windows t ON d.size = t.size AND d.win = t.win
), hits AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT r, unnest(range(i, i + size)) AS p FROM occurrences) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM occurrences) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""
