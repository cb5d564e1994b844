"""Fuzzy line deduplication over a corpus: MinHash of character shingles, banding, exact verification, union-find.

Every line that isn't blank takes part.  Equal lines are one node, whatever their length; lines of fewer than ``MIN_CHARS``
characters have no shingle, so they are duplicates of equal lines only.  Each longer distinct line of a batch gets ``BANDS``
x ``ROWS`` minima of its seven-character shingles; lines that share a band key form a bucket, and each member of a bucket is paired with its hub, the smallest line hash.  Pairs are verified by
the exact Jaccard similarity of their shingle sets; what a bucket then still holds in several components is compared in
full, in bounded units (``near_dup.link_rest``).  One occurrence of each component stays: the first by doc_id, then by
line number.

Scale: texts are read by Spark and never gathered; the band keys are shuffled once, packed, and streamed, so that a
bucket of any size takes constant memory; only texts of lines in shared buckets are kept for verification.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from strata.llm.components import materialize
from strata.llm.near_dup import join_components
from strata.llm.textvec import decoded, mix64, slices

SHINGLE_CHARS, THRESHOLD = 7, 0.8
#: a line of fewer characters has no shingle: it is compared as a whole only
MIN_CHARS = SHINGLE_CHARS
#: a pair at the threshold shares a band with probability 1 - (1 - 0.8 ** 5) ** 14 = 0.996
BANDS, ROWS = 14, 5
#: entries (band key and line) of a slot, about, and of a pack that a task gathers before it hands it on
SLOT_ENTRIES, PACK_ENTRIES = 2_000_000, 1_000_000
#: characters whose minima are taken at a time (keeps the work in the processor's cache)
_STRIDE = 1 << 15

_RANDOM = mix64(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64))
_WEIGHTS = (mix64(np.arange(1001, 1001 + SHINGLE_CHARS, dtype=np.uint64)) | np.uint64(1)).astype(np.uint32)
_FLIPS, _FACTORS = _RANDOM[::2].astype(np.uint32), (_RANDOM[1::2] | np.uint64(1)).astype(np.uint32)


def shingle_hashes(points: np.ndarray) -> np.ndarray:
    """64-bit hash of the character shingle that starts at each code point (shorter by SHINGLE_CHARS - 1)."""
    n = max(len(points) - SHINGLE_CHARS + 1, 0)
    out = np.empty(n, dtype=np.uint64)
    for at in range(0, n, _STRIDE):
        to = out[at:at + _STRIDE]
        to[:] = points[at:at + len(to)]
        for j in range(1, SHINGLE_CHARS):
            to *= np.uint64(0x9E3779B97F4A7C15)
            to += points[at + j:at + j + len(to)]
        to[:] = mix64(to)
    return out


def short_hashes(points: np.ndarray) -> np.ndarray:
    """32-bit hash of the character shingle that starts at each code point, for the minima."""
    n = max(len(points) - SHINGLE_CHARS + 1, 0)
    out, part = np.empty(n, dtype=np.uint32), np.empty(_STRIDE, dtype=np.uint32)
    for at in range(0, n, _STRIDE):
        to = out[at:at + _STRIDE]
        term = part[:len(to)]
        np.multiply(points[at:at + len(to)], _WEIGHTS[0], out=to)
        for j in range(1, SHINGLE_CHARS):
            np.multiply(points[at + j:at + j + len(to)], _WEIGHTS[j], out=term)
            to += term
        for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
            np.right_shift(to, np.uint32(shift), out=term)
            to ^= term
            to *= np.uint32(factor)
    return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def minima(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Minima of each hash function over each range of shingles (ranges x BANDS * ROWS); ranges are in order."""
    out = np.empty((BANDS * ROWS, len(starts)), dtype=np.uint32)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + _STRIDE, side="right")))
        lo, hi = starts[first], ends[last - 1]
        part, values = hashes[lo:hi], np.zeros(hi - lo + 1, dtype=np.uint32)
        # ranges with the gaps between them (shingles across a line end belong to none)
        edges = np.stack((starts[first:last], ends[first:last]), axis=1).ravel() - lo
        for k in range(BANDS * ROWS):
            np.bitwise_xor(part, _FLIPS[k], out=values[:-1])
            np.multiply(values[:-1], _FACTORS[k], out=values[:-1])
            out[k, first:last] = np.minimum.reduceat(values, edges)[::2]
        first = last
    return out.T


def band_keys(values: np.ndarray) -> np.ndarray:
    """Key of each band (lines x BANDS); keys of different bands differ."""
    parts = values.reshape(len(values), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(mix64(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(values), BANDS)).copy()
    for j in range(ROWS):
        keys = mix64(keys ^ parts[:, :, j]) * np.uint64(0x9E3779B97F4A7C15)
    return keys.view(np.int64)


def line_hashes(text: Column) -> Column:
    """Hash of each line of a text, null for lines that don't take part; null for a null text."""
    return F.transform(F.split(text, "\n", -1), lambda s: F.when(s.rlike(r"\S"), F.xxhash64(s)))


def _packed_bands(documents: DataFrame, slots: int) -> DataFrame:
    """(slot, keys, lines): band keys and lines of the distinct lines of a batch, packed by slot (key modulo ``slots``).

    Packing spares the shuffle a row for each band of each line.
    """
    def pack(keys: list[np.ndarray], lines: list[np.ndarray]) -> pa.RecordBatch:
        key, line = np.concatenate(keys), np.concatenate(lines)
        slot = (key.view(np.uint64) % np.uint64(slots)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        slot, key, line = slot[order], key[order], line[order]
        edges = np.concatenate(([0], np.flatnonzero(np.diff(slot)) + 1, [len(slot)]))
        ends = pa.array(edges, pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(slot[edges[:-1]]), pa.ListArray.from_arrays(ends, pa.array(key)),
             pa.ListArray.from_arrays(ends, pa.array(line))], names=["slot", "keys", "lines"])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, lines, held = [], [], 0
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = decoded(batch.column("text"))
                points = code_points("\n".join(texts) + "\n")
                ends = np.flatnonzero(points == 0x0A)
                starts = np.concatenate(([0], ends[:-1] + 1))
                found = batch.column("lines").flatten()
                part = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False) & (ends - starts >= MIN_CHARS))
                numbers = found.take(pa.array(part)).to_numpy()
                _, first = np.unique(numbers, return_index=True)
                first.sort()
                at = part[first]
                if not len(at):
                    continue
                own = band_keys(minima(short_hashes(points), starts[at], ends[at] - SHINGLE_CHARS + 1))
                keys.append(own.ravel())
                lines.append(np.repeat(numbers[first], BANDS))
                held += own.size
                if held > PACK_ENTRIES:
                    yield pack(keys, lines)
                    keys, lines, held = [], [], 0
        if held:
            yield pack(keys, lines)

    return (documents.where(F.length("text") >= MIN_CHARS).select("text", line_hashes(F.col("text")).alias("lines"))
            .mapInArrow(apply, "slot long, keys array<long>, lines array<long>"))


class Buckets:
    """Buckets of one slot, fed in pieces: knows each key's hub (the line that came first) and whether it was given out.

    The state is one entry for each different key of the slot, however often a key occurs.
    """

    def __init__(self):
        self.keys = np.zeros(0, dtype=np.int64)
        self.hubs = np.zeros(0, dtype=np.int64)
        self.shown = np.zeros(0, dtype=bool)

    def add(self, keys: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """New members (key, line, hub) of buckets with two or more lines; a line may be given again."""
        order = np.lexsort((lines, keys))
        keys, lines = keys[order], lines[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        names = keys[first]
        at = np.searchsorted(self.keys, names)
        at[at == len(self.keys)] = 0
        known = self.keys[at] == names if len(self.keys) else np.zeros(len(names), dtype=bool)
        hubs = np.where(known, self.hubs[at] if len(self.keys) else 0, lines[first])
        shown = np.where(known, self.shown[at] if len(self.keys) else False, False)
        group = np.cumsum(np.concatenate(([0], (keys[1:] != keys[:-1]).astype(np.int64))))
        other = lines != hubs[group]
        opened = ~shown & (np.bincount(group[other], minlength=len(names)) > 0)
        k = np.concatenate((names[opened], keys[other]))
        c = np.concatenate((hubs[opened], lines[other]))
        h = np.concatenate((hubs[opened], hubs[group[other]]))
        self.shown[at[known & opened]] = True
        fresh = ~known
        merged = np.concatenate((self.keys, names[fresh]))
        order = np.argsort(merged, kind="stable")
        self.keys = merged[order]
        self.hubs = np.concatenate((self.hubs, hubs[fresh]))[order]
        self.shown = np.concatenate((self.shown, opened[fresh]))[order]
        return k, c, h


def buckets_of(packed: DataFrame, slots: int = 1) -> DataFrame:
    """(key, class_id, hub) for the lines of all buckets with two or more distinct lines, from (slot, keys, lines)."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, state, keys, lines, held = None, Buckets(), [], [], 0

        def feed() -> Iterator[pa.RecordBatch]:
            if keys:
                found = state.add(np.concatenate(keys), np.concatenate(lines))
                if len(found[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(a) for a in found], names=["key", "class_id", "hub"])

        for batch in batches:
            key_lists, line_lists = batch.column("keys"), batch.column("lines")
            for i, own in enumerate(batch.column("slot").to_pylist()):
                if own != slot or held > PACK_ENTRIES:
                    yield from feed()
                    keys, lines, held = [], [], 0
                    if own != slot:
                        slot, state = own, Buckets()
                if len(key_lists[i].values):
                    keys.append(key_lists[i].values.to_numpy())
                    lines.append(line_lists[i].values.to_numpy())
                    held += len(keys[-1])
        yield from feed()

    # the number of tasks follows that of the slots, which have a bounded size, and not the session's width
    return packed.repartition(2 * slots, "slot").sortWithinPartitions("slot").mapInArrow(
        apply, "key long, class_id long, hub long").distinct()


def line_sets(lines: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each line."""
    texts = lines.to_pylist()
    starts = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts]))).astype(np.int64)
    hashes = shingle_hashes(code_points("\n".join(texts) + "\n" * SHINGLE_CHARS))[:starts[-1]]
    ends = np.maximum(starts[:-1], starts[1:] - SHINGLE_CHARS)  # shingles across a line end belong to none
    for a, b in zip(starts[:-1].tolist(), ends.tolist(), strict=True):
        hashes[a:b].sort()
    # what differs from its left neighbour, and every line's first
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = hashes[1:] != hashes[:-1]
    fresh[starts[:-1][ends > starts[:-1]]] = True
    return [hashes[a:b][fresh[a:b]] for a, b in zip(starts[:-1].tolist(), ends.tolist(), strict=True)]


def similar_lines(pairs: DataFrame, payload: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of lines whose shingle sets have the Jaccard similarity ``threshold`` or more."""
    one = payload.select(F.col("class_id").alias("a"), F.col("payload").alias("text_a"))
    two = payload.select(F.col("class_id").alias("b"), F.col("payload").alias("text_b"))
    both = pairs.join(one, "a").join(two, "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text_a"):
                # the join brings the pairs of a line together: its set is made once
                names, number = np.unique(batch.column("b").to_numpy(), return_inverse=True)
                first = np.zeros(len(names), dtype=np.int64)
                first[number[::-1]] = np.arange(len(number))[::-1]
                theirs = line_sets(batch.column("text_b").take(pa.array(first)))
                keep = np.zeros(batch.num_rows, dtype=bool)
                for i, own in enumerate(line_sets(batch.column("text_a"))):
                    other = theirs[number[i]]
                    total = len(own) + len(other)
                    if min(len(own), len(other)) >= threshold * max(len(own), len(other)):
                        common = len(np.intersect1d(own, other, assume_unique=True))
                        keep[i] = common >= threshold * (total - common)
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(verify, "a long, b long")


def _distinct_lines(documents: DataFrame) -> DataFrame:
    """(class_id, payload): hash and text of the lines that have shingles; a task gives each out once or a few times."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[int] = set()
        for whole in batches:
            for batch in slices(whole, "text"):
                numbers, texts = [], []
                for text, lines in zip(decoded(batch.column("text")),
                                       batch.column("lines").to_pylist(), strict=True):
                    for number, line in zip(lines, text.split("\n"), strict=True):
                        if number is not None and len(line) >= MIN_CHARS and number not in given:
                            given.add(number)
                            numbers.append(number)
                            texts.append(line)
                if len(given) > 200_000:
                    given.clear()
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(texts, pa.string())],
                                                 names=["class_id", "payload"])

    return (documents.where(F.length("text") >= MIN_CHARS).select("text", line_hashes(F.col("text")).alias("lines"))
            .mapInArrow(apply, "class_id long, payload string"))


def _order(documents: DataFrame) -> Column:
    """Order of documents by doc_id as a 64-bit number; a null comes last."""
    kind = documents.schema["doc_id"].dataType
    number = F.col("doc_id").cast("long") if isinstance(kind, IntegralType) else F.xxhash64("doc_id")
    return F.when(F.col("doc_id").isNull(), F.lit((1 << 63) - 1)).otherwise(number)


def duplicate_lines(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Lines to remove from each document: (doc_id, text_hash, n_lines, removed array<int>), one row per row.

    Documents are known by (doc_id, hash of the text), so repeated rows are one document, which keeps and loses the same
    lines in each row.  Line numbers start at 0.  Defined cases: a null text has no lines, an empty one has one line; a
    null doc_id comes after all others; blank lines always stay; malformed UTF-8 is read as U+FFFD; an empty table gives an empty result; only doc_id and
    text are read, so other columns may have any name.
    """
    docs = materialize(documents.select("doc_id", F.xxhash64("text").alias("text_hash"),
                                        line_hashes(F.col("text")).alias("lines")), "occurrences")
    n_lines = docs.agg(F.sum(F.size(F.filter("lines", lambda x: x.isNotNull())).cast("long"))).first()[0] or 0
    slots = 1 + max(n_lines, 0) * BANDS // SLOT_ENTRIES
    found = materialize(buckets_of(_packed_bands(documents, slots), slots), "buckets")
    # one hub for all buckets of a family, as far as possible: the smallest line, so that pairs repeat and fall together
    hubs = found.groupBy("key").agg(F.min("class_id").alias("least")).withColumnRenamed("key", "h_key")
    members = materialize(found.join(hubs, F.col("key") == F.col("h_key"))
                          .select("key", "class_id", F.col("least").alias("hub")), "members")
    wanted = members.select(F.col("class_id").alias("w_line")).distinct()
    found = _distinct_lines(documents).join(wanted, F.col("class_id") == F.col("w_line"), "left_semi")
    payload = materialize(found.groupBy("class_id").agg(F.min("payload").alias("payload")), "lines")
    pairs = members.where(F.col("class_id") != F.col("hub")).select(
        F.col("class_id").alias("a"), F.col("hub").alias("b")).distinct()
    links = materialize(similar_lines(pairs, payload, threshold), "links")
    labels = join_components(members, links, payload, threshold, line_sets)
    at = (docs.select("doc_id", "text_hash", _order(documents).alias("place"), F.posexplode("lines").alias("line_no", "line"))
          .where(F.col("line").isNotNull()))
    # the first document of each line, then of each component; only lines of components with several occurrences
    # meet the occurrences again
    by_line = at.groupBy("line").agg(F.min("place").alias("line_first"), F.count("*").alias("n"))
    placed = materialize(by_line.join(labels, F.col("line") == F.col("node"), "left").select(
        "line", "line_first", "n", F.coalesce("component", "line").alias("component"))
        .where(F.col("node").isNotNull() | (F.col("n") > 1)), "places")
    # written, so that the join by component is one of two exchanges, which adaptive execution splits
    first = materialize(placed.groupBy("component").agg(F.min("line_first").alias("first"), F.sum("n").alias("all")).where(
        F.col("all") > 1).select(F.col("component").alias("f_component"), "first"), "firsts")
    shared = materialize(placed.join(first, F.col("component") == F.col("f_component")).select(
        F.col("line").alias("s_line"), "component", "first"), "shared")
    hits = materialize(at.join(shared, F.col("line") == F.col("s_line")).select(
        "doc_id", "text_hash", "line_no", "component", (F.col("place") == F.col("first")).alias("in_first")), "hits")
    # the occurrence that stays: in the first document (the smaller text hash, should a doc_id have two texts) the
    # first line; written, so that the join below is one of two exchanges, which adaptive execution splits
    stays = materialize(
        hits.where("in_first").groupBy("component", "text_hash").agg(F.min("line_no").alias("line_no"))
        .groupBy("component").agg(F.min("text_hash").alias("k_hash"), F.min_by("line_no", "text_hash").alias("k_line"))
        .withColumnRenamed("component", "k_component"), "stays")
    kept = F.col("in_first") & (F.col("text_hash") == F.col("k_hash")) & (F.col("line_no") == F.col("k_line"))
    gone = (hits.join(stays, F.col("component") == F.col("k_component")).where(~kept)
            .groupBy(F.col("doc_id").alias("g_doc"), F.col("text_hash").alias("g_hash"))
            .agg(F.array_sort(F.collect_set("line_no")).alias("removed")))
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("g_doc")) & (F.col("text_hash") == F.col("g_hash")),
                     "left").select(
        "doc_id", "text_hash", F.coalesce(F.size("lines"), F.lit(0)).alias("n_lines"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def remove_lines(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without their duplicate lines, with all their columns.

    Where a text changes, ``n_chars`` (if it is there) follows it; a document of which no text is left goes.
    """
    found = materialize(duplicate_lines(documents, threshold).where(F.size("removed") > 0), "removed")
    gone = found.groupBy("doc_id", "text_hash").agg(F.first("removed").alias("removed")).withColumnsRenamed(
        {"doc_id": "g_doc", "text_hash": "g_hash"})
    # the row travels as one column, so its own names can't meet the ones used here
    packed = documents.select(F.struct(*(F.col(f"`{n}`") for n in documents.columns)).alias("row"),
                              F.col("doc_id").alias("p_doc"), F.xxhash64("text").alias("p_hash"))
    text, changed = F.col("row")["text"], F.col("removed").isNotNull()
    rest = F.array_join(F.filter(F.split(text, "\n", -1), lambda s, i: ~F.array_contains("removed", i)), "\n")
    joined = (packed.join(gone, F.col("p_doc").eqNullSafe(F.col("g_doc")) & (F.col("p_hash") == F.col("g_hash")), "left")
              .withColumn("rest", F.when(changed, rest)).where(~changed | F.col("rest").rlike(r"\S")))
    put = {n: F.col("row")[n] for n in documents.columns}
    put["text"] = F.when(changed, F.col("rest")).otherwise(text)
    if "n_chars" in put:
        put["n_chars"] = F.when(changed, F.char_length("rest").cast(documents.schema["n_chars"].dataType)).otherwise(
            put["n_chars"])
    return joined.select(*(c.alias(n) for n, c in put.items()))


def op9_line_minhash(spark, sf_dir: str) -> DataFrame:
    found = duplicate_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"),
                        F.size("removed").cast("long").alias("n_removed"),
                        F.array_join(F.transform("removed", lambda i: i.cast("string")), ",").alias("removed_lines"))
