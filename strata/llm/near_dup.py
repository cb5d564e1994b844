"""Near-duplicate documents by ProbMinHash, banding, exact verification and connected components.

1. Sketch.  A document is its distinct five-word shingles, each weighted by 1 + ln(count).  ProbMinHash: every shingle
   is a Poisson process whose rate is its weight; each arrival hits one of ``REGISTERS`` registers at random, and a
   register keeps the shingle that hit it first.  Arrivals of a shingle come in order of time, so it is done as soon as
   its next one is later than the last register's (early termination).  Two documents agree in a register with their
   probability Jaccard similarity, which for equal weights is the Jaccard similarity of the shingle sets.
2. Classes.  Documents with equal shingle sets are one class, represented by one row; copies go no further.
3. Banding.  ``BANDS`` bands of ``ROWS`` registers; classes that share a band key are candidates.  A bucket of any size
   gives one pair for each member: with its hub, the member that shares most band keys with others.
4. Verification.  The exact Jaccard similarity of the shingle sets, ``THRESHOLD`` or more; components of the links.
5. The rest.  Where a bucket still holds several components, every member outside the hub's component is compared with
   all members of the bucket, exactly, in units of bounded size.  So no link inside a bucket is lost, and a bucket of
   thousands of copies of one text costs a pass over its members, not its pairs.

Nothing is collected to the driver; tables between the steps are written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from strata.llm.components import connected_components, materialize
from strata.llm.textvec import mix64, slices, utf8, windows, word_hashes

SHINGLE_WORDS, THRESHOLD = 5, 0.8
#: a pair at the threshold shares a band with probability 1 - (1 - 0.8 ** 5) ** 24 = 0.9999
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
#: a set of fewer shingles is within the threshold of none but itself
MIN_SHINGLES = 4
#: members of a unit of the last step, on either side
UNIT_MINORS, UNIT_MEMBERS = 128, 512


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: (text number, 64-bit hash, count), in order of the text.

    A text of one to four words is one shingle, its word sequence; one without words has none.
    """
    words, text = word_hashes(texts)
    at, grams = windows(words, text, SHINGLE_WORDS)
    owner = text[at]
    del at
    n_words = np.bincount(text, minlength=len(texts))
    for width in range(1, SHINGLE_WORDS):
        few = np.flatnonzero(n_words == width)
        if len(few):
            mine = np.isin(text, few)
            own_at, own = windows(words[mine], text[mine], width)
            owner, grams = np.concatenate((owner, text[mine][own_at])), np.concatenate((grams, own))
    if len(texts) == 1:
        del words, text, owner
        grams.sort()
        first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])) if len(grams) else grams)
        return np.zeros(len(first), dtype=np.int64), grams[first], np.diff(np.concatenate((first, [len(grams)])))
    # one sort: equal shingles of one text are equal values, others differ
    salt = mix64(owner.astype(np.uint64) + np.uint64(1))
    _, first, count = np.unique(grams ^ salt, return_index=True, return_counts=True)
    order = np.argsort(owner[first], kind="stable")
    return owner[first][order], grams[first][order], count[order]


def _arrival(hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k-th step of each process: exponential waiting time and the register that is hit."""
    bits = mix64(hashes + np.uint64((2 * k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    wait = -np.log1p(-((bits >> np.uint64(11)).astype(np.float64) * 2.0 ** -53))
    hit = mix64(bits ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(REGISTERS)
    return wait, hit.astype(np.int64)


def sketch(text: np.ndarray, hashes: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """ProbMinHash registers of ``n`` texts (n x REGISTERS shingle hashes; 0 for a text without shingles)."""
    first = np.full(n * REGISTERS, np.inf)
    kept = np.zeros(n * REGISTERS, dtype=np.uint64)
    rate = 1 + np.log(counts)
    time = np.zeros(len(hashes))
    k = 0
    while len(hashes):
        wait, hit = _arrival(hashes, k)
        time = time + wait / rate
        slot = text * REGISTERS + hit
        np.minimum.at(first, slot, time)
        won = first[slot] == time
        kept[slot[won]] = hashes[won]
        last = first.reshape(n, REGISTERS).max(axis=1)
        on = time < last[text]
        text, hashes, rate, time = text[on], hashes[on], rate[on], time[on]
        k += 1
    return kept.reshape(n, REGISTERS)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """Key of each band (texts x BANDS); keys of different bands differ."""
    parts = registers.reshape(len(registers), BANDS, ROWS)
    keys = np.broadcast_to(mix64(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(registers), BANDS)).copy()
    for j in range(ROWS):
        keys = mix64(keys ^ parts[:, :, j]) * np.uint64(0x9E3779B97F4A7C15)
    return keys.view(np.int64)


def _set_hash(text: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and size of each text's shingle set."""
    total, size = np.zeros(n, dtype=np.uint64), np.bincount(text, minlength=n)
    np.add.at(total, text, mix64(hashes))
    return mix64(total ^ size.astype(np.uint64)).view(np.int64), size


def sketch_documents(documents: DataFrame) -> DataFrame:
    """One row per document: (row_id, doc_id, text_hash, class_hash, n_shingles, bands).

    ``row_id`` is unique once the table is written.  Texts without words have a null class; ``bands`` is null for fewer
    than ``MIN_SHINGLES`` shingles.
    """
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                n = batch.num_rows
                text, hashes, counts = shingles(utf8(batch.column("text")))
                classes, size = _set_hash(text, hashes, n)
                # one sketch for each class of the batch
                _, first, same = np.unique(classes, return_index=True, return_inverse=True)
                chosen = np.full(n, -1)
                chosen[first] = np.arange(len(first))
                chosen[size < MIN_SHINGLES] = -1
                use = chosen[text] >= 0
                keys = band_keys(sketch(chosen[text[use]], hashes[use], counts[use], len(first)))[same]
                bands = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * BANDS, keys.ravel(),
                                                 mask=pa.array(size < MIN_SHINGLES))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("row_id", "doc_id", "text_hash")), pa.array(classes, mask=size == 0),
                     pa.array(size.astype(np.int64)), bands],
                    names=["row_id", "doc_id", "text_hash", "class_hash", "n_shingles", "bands"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select(F.monotonically_increasing_id().alias("row_id"), "doc_id",
                            F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        apply, f"row_id long, doc_id {kind}, text_hash long, class_hash long, n_shingles long, bands array<long>")


def _class_shingles(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """Shingle sets (class_id, set array<long>) of the wanted classes, from the text of their representative."""
    keys = wanted.select("class_id", F.col("doc_id").alias("w_doc"), F.col("text_hash").alias("w_hash"))
    texts = documents.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    found = texts.join(keys, F.col("doc_id").eqNullSafe(F.col("w_doc")) & (F.col("text_hash") == F.col("w_hash")))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                text, hashes, _ = shingles(utf8(batch.column("text")))
                ends = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=batch.num_rows))))
                sets = pa.ListArray.from_arrays(ends.astype(np.int32), hashes.view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column("class_id"), sets], names=["class_id", "set"])

    return found.select("class_id", "text").mapInArrow(apply, "class_id long, set array<long>")


def similar(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets have the Jaccard similarity ``threshold`` or more."""
    one = sets.select(F.col("class_id").alias("a"), F.col("set").alias("set_a"))
    two = sets.select(F.col("class_id").alias("b"), F.col("set").alias("set_b"))
    both = pairs.join(one, "a").join(two, "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    return both.where(common >= F.lit(threshold) * (F.size("set_a") + F.size("set_b") - common)).select("a", "b")


def sorted_sets(column: pa.Array) -> list[np.ndarray]:
    return [np.sort(v.values.to_numpy(zero_copy_only=False)) for v in column]


def link_rest(buckets: DataFrame, payload: DataFrame, threshold: float,
              to_sets: Callable[[pa.Array], list[np.ndarray]] = sorted_sets) -> DataFrame:
    """Links across the components of a bucket: (component a, component b) pairs that join them.

    ``buckets`` has (key, class_id, component, main): ``main`` is the component of the bucket's hub.  Each member outside
    it meets all members, in units of ``UNIT_MINORS`` x ``UNIT_MEMBERS``.  ``payload`` is a table (class_id, payload),
    and ``to_sets`` makes the sorted shingle sets of a column of payloads.
    """
    minor = F.col("component") != F.col("main")
    counts = buckets.groupBy("key").agg(F.sum(minor.cast("long")).alias("n_minors"), F.count("*").alias("n"))
    sized = buckets.join(counts.where("n > 2").withColumnRenamed("key", "c_key"), F.col("key") == F.col("c_key"))
    blocks = lambda n, size: F.greatest(F.ceil(F.col(n) / F.lit(size)), F.lit(1)).cast("int")
    # a member's block follows from its number, so blocks fill evenly without ranking the bucket
    spot = F.xxhash64("class_id")
    sized = (sized.withColumn("minor_blocks", blocks("n_minors", UNIT_MINORS))
             .withColumn("member_blocks", blocks("n", UNIT_MEMBERS)))
    as_minor = sized.where(minor).select(
        "key", F.pmod(spot, "minor_blocks").cast("int").alias("x"),
        F.explode(F.sequence(F.lit(0), F.col("member_blocks") - 1)).alias("y"), "class_id", "component",
        F.lit(0).alias("side"))
    as_member = sized.select(
        "key", F.explode(F.sequence(F.lit(0), F.col("minor_blocks") - 1)).alias("x"),
        F.pmod(spot, "member_blocks").cast("int").alias("y"), "class_id", "component", F.lit(1).alias("side"))
    units = as_minor.unionByName(as_member).join(payload, "class_id")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, minors, members = None, [], []
        for batch in batches:
            out: set[tuple[int, int]] = set()
            own_sets = to_sets(batch.column("payload"))
            rows = zip(*(batch.column(c).to_pylist() for c in ("key", "x", "y", "side", "component")), strict=True)
            for i, (key, x, y, side, component) in enumerate(rows):
                if (key, x, y) != current:
                    out |= link_unit(minors, members, threshold)
                    current, minors, members = (key, x, y), [], []
                (members if side else minors).append((component, own_sets[i]))
            if out:
                yield _pairs(out)
        if out := link_unit(minors, members, threshold):
            yield _pairs(out)

    return (units.select("key", "x", "y", "side", "component", "payload").repartition("key", "x", "y")
            .sortWithinPartitions("key", "x", "y", "side").mapInArrow(link, "a long, b long"))


def _pairs(found: set[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*sorted(found), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def link_unit(minors: list[tuple[int, np.ndarray]], members: list[tuple[int, np.ndarray]],
              threshold: float) -> set[tuple[int, int]]:
    """Pairs of components with a link between a minor's and a member's set (component number, sorted set)."""
    found: set[tuple[int, int]] = set()
    if not minors or not members:
        return found
    if len(minors) * len(members) <= 32:
        for c, own in minors:
            for d, other in members:
                small, large = sorted((len(own), len(other)))
                if c != d and small >= threshold * large:
                    common = len(np.intersect1d(own, other, assume_unique=True))
                    if common >= threshold * (small + large - common):
                        found.add((min(c, d), max(c, d)))
        return found
    component = np.array([c for c, _ in members])
    size = np.array([len(s) for _, s in members])
    owner = np.repeat(np.arange(len(members)), size)
    values = np.concatenate([s for _, s in members])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    for c, own in minors:
        lo, hi = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
        spans = hi - lo
        at = np.repeat(lo - np.concatenate(([0], np.cumsum(spans)[:-1])), spans) + np.arange(spans.sum())
        common = np.bincount(owner[at], minlength=len(members))
        linked = (common >= threshold * (len(own) + size - common)) & (component != c)
        found.update((min(c, d), max(c, d)) for d in component[linked].tolist())
    return found


def join_components(members: DataFrame, links: DataFrame, payload: DataFrame, threshold: float,
                    to_sets: Callable[[pa.Array], list[np.ndarray]] = sorted_sets) -> DataFrame:
    """Components (node, component) of all links inside the buckets ``members`` (key, class_id, hub).

    ``links`` (a, b) are the verified pairs of members and hubs; buckets that these leave in several components go
    through ``link_rest``.
    """
    labels = connected_components(links)
    own = labels.select(F.col("node").alias("l_node"), F.col("component").alias("l_component"))
    placed = members.join(own, F.col("class_id") == F.col("l_node"), "left").select(
        "key", "class_id", "hub", F.coalesce("l_component", "class_id").alias("component"))
    main = placed.where(F.col("class_id") == F.col("hub")).select(
        F.col("key").alias("m_key"), F.col("component").alias("main"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                      F.count("*").alias("n"), F.sum(F.xxhash64("class_id", "hub").cast("decimal(38,0)"))
                                      .alias("same")).where("lo < hi AND n > 2")
    # buckets of different bands often hold the very same classes: one of them is enough
    alike = mixed.groupBy("n", "lo", "hi", "same").agg(F.min("key").alias("x_key"))
    open_buckets = (placed.join(alike.select("x_key"), F.col("key") == F.col("x_key"), "left_semi")
                    .join(main, F.col("key") == F.col("m_key")).select("key", "class_id", "component", "main"))
    merged = connected_components(link_rest(open_buckets, payload, threshold, to_sets))
    joined = merged.select(F.col("node").alias("j_node"), F.col("component").alias("j_component"))
    return labels.join(joined, F.col("component") == F.col("j_node"), "left").select(
        "node", F.coalesce("j_component", "component").alias("component")).unionByName(
        joined.join(labels.select("node"), F.col("j_node") == F.col("node"), "left_anti").select(
            F.col("j_node").alias("node"), F.col("j_component").alias("component")))


def near_groups(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Near-duplicate group of each document: (row_id, doc_id, text_hash, class_id, n_shingles, component, n_links).

    Documents of one ``component`` are connected by links of similarity ``threshold`` or more; ``class_id`` stands for
    the documents with the same shingle set, and ``n_links`` counts the verified links of the class to its bucket hubs.
    Defined cases: texts without words (null, empty, blank) are never linked, each is its own component; repeated
    rows are copies of each other; null doc_ids are ordinary rows; an empty table gives an empty result; only doc_id and
    text are read, so other columns may have any name.
    """
    rows = materialize(sketch_documents(documents), "sketches")
    # classes and their representatives
    first = rows.where(F.col("class_hash").isNotNull()).groupBy("class_hash", "n_shingles").agg(
        F.min("row_id").alias("class_id"))
    chosen = first.select(F.col("class_id").alias("row_id"))
    classes = materialize(rows.join(chosen, "row_id").where(F.col("bands").isNotNull())
                          .select(F.col("row_id").alias("class_id"), "doc_id", "text_hash", "bands"), "classes")
    # buckets of two or more classes, and how many neighbours each class has over all its buckets
    banded = classes.select("class_id", F.explode("bands").alias("key"))
    full = banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").withColumnRenamed("key", "f_key")
    buckets = materialize(banded.join(full, F.col("key") == F.col("f_key")).select("key", "class_id", "n"), "buckets")
    reach = buckets.groupBy("class_id").agg(F.sum("n").alias("reach"))
    # reach, then the smaller class, in one number: a fixed-width order for a hash-aggregated maximum
    order = F.expr("CAST(reach AS DECIMAL(17,0)) * CAST(10000000000000000000 AS DECIMAL(20,0)) - class_id")
    hubs = buckets.join(reach, "class_id").groupBy("key").agg(F.max_by("class_id", order).alias("hub")).select(
        F.col("key").alias("h_key"), "hub")
    members = materialize(buckets.join(hubs, F.col("key") == F.col("h_key")).select("key", "class_id", "hub"), "members")
    wanted = members.select("class_id").distinct()
    sets = materialize(_class_shingles(documents, classes.join(wanted, "class_id")), "sets")
    pairs = members.where(F.col("class_id") != F.col("hub")).select(
        F.col("class_id").alias("a"), F.col("hub").alias("b")).distinct()
    links = materialize(similar(pairs, sets, threshold), "links")
    final = join_components(members, links, sets.withColumnRenamed("set", "payload"), threshold)
    linked = links.select(F.explode(F.array("a", "b")).alias("n_node")).groupBy("n_node").agg(
        F.count("*").alias("n_links"))
    by_class = (first.join(final, F.col("class_id") == F.col("node"), "left")
                .join(linked, F.col("class_id") == F.col("n_node"), "left")
                .select(F.col("class_hash").alias("k_hash"), F.col("n_shingles").alias("k_size"), "class_id",
                        F.coalesce("component", "class_id").alias("component"),
                        F.coalesce("n_links", F.lit(0)).alias("n_links")))
    return rows.join(by_class, (F.col("class_hash") == F.col("k_hash")) & (F.col("n_shingles") == F.col("k_size")),
                     "left").select("row_id", "doc_id", "text_hash", F.coalesce("class_id", "row_id").alias("class_id"),
                                    "n_shingles", F.coalesce("component", "row_id").alias("component"),
                                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without near copies: of each group the row with the smallest doc_id stays, with all its columns.

    A null doc_id counts as larger than all others; of several rows with the smallest one stays.
    """
    groups = materialize(mark_kept(materialize(near_groups(documents, threshold), "groups")), "marked")
    kept = groups.where("kept").select(F.col("doc_id").alias("k_doc"), F.col("text_hash").alias("k_hash")).distinct()
    # the row travels as one column, so its own names can't meet the ones used here
    packed = documents.select(F.struct(*(F.col(f"`{n}`") for n in documents.columns)).alias("row"),
                              F.col("doc_id").alias("p_doc"), F.xxhash64("text").alias("p_hash"))
    found = packed.join(kept, F.col("p_doc").eqNullSafe(F.col("k_doc")) & (F.col("p_hash") == F.col("k_hash")),
                        "left_semi")
    # rows that are equal in doc_id and text: one stays, or all where the text has no words
    again = groups.where(F.col("n_shingles") > 0).groupBy("doc_id", "text_hash").count().where("count > 1")
    if not again.isEmpty():
        worded = F.coalesce(F.col("row")["text"].rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
        found = found.where(~worded).unionByName(found.where(worded).dropDuplicates(["p_doc", "p_hash"]))
    return found.select("row.*")


def mark_kept(groups: DataFrame) -> DataFrame:
    """Adds group_id (the smallest doc_id of the component) and kept (its one row that stays)."""
    by_doc = groups.groupBy("component", "doc_id").agg(F.min("row_id").alias("row"))
    order = F.col("doc_id")
    if isinstance(groups.schema["doc_id"].dataType, IntegralType):  # a null comes last
        order = F.coalesce(order.cast("decimal(20,0)"), F.lit("9999999999999999999").cast("decimal(20,0)"))
    # a doc_id comes once in a component here, so the order has no ties; written first, so that the join below is a join
    # of two exchanges, which adaptive execution splits where a component is large
    best = materialize(by_doc.groupBy("component").agg(
        F.min("doc_id").alias("group_id"), F.coalesce(F.min_by("row", order), F.min("row")).alias("stays"))
        .withColumnRenamed("component", "g_component"), "kept")
    return (groups.join(best, F.col("component") == F.col("g_component"))
            .withColumn("kept", F.col("row_id") == F.col("stays")).drop("g_component", "stays"))


def op3_probminhash(spark, sf_dir: str) -> DataFrame:
    groups = mark_kept(materialize(near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet")), "groups"))
    return groups.select("doc_id", "group_id", "kept", "n_shingles", "n_links")
