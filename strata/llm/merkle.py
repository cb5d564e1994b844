"""Merkle manifest of a dataset, with proofs found by pointer jumping.

Every row is a leaf: the SHA-256 of its fields, each as its UTF-8 length, a colon and its value (``-`` for null).  The
leaves of a source, in the order of their doc_id, form a tree: while several nodes remain, every 16 consecutive ones (the
last run may have fewer, even one) become their hash.  What remains is the subroot of the source.  The subroots, ordered
by source (null first, then by UTF-8 bytes), form a tree in the same way, and its top is the root of the dataset.

Proofs.  A node starts with a pointer to its parent and a segment of one step, which holds the digests of its siblings
before and after it.  A self-join replaces each pointer by the pointer of the node it points to and appends that node's
segment, so that the distance doubles each time; after log2(height) joins each segment reaches the root.  Only inner
nodes take part, one for 16 leaves: a leaf shares the path of its run from the parent on, and gets its own step from the
run's digests, which the parent's row holds.

Scale.  Places inside a source come from a range-sorted table: the number of the row in its partition, plus the rows of
the same source in earlier partitions, which is a table of one row per partition and source.  So a source of any size is
sorted by all tasks.  A run has 16 digests at most.  Near the top many nodes point to few ancestors; from a distance of
four on, the ancestors are dealt in copies and the nodes over these copies by their place, so that no join key has more
than about 4,096 nodes.  The levels of a tree are a loop of log16(rows) steps on the driver, which sees two numbers.

Odd rows.  Null fields are ``-``; a null doc_id comes first in its source.  Rows with equal source and doc_id are leaves
of their own, ordered by their digests.  A source with one row has its leaf as subroot; a dataset with one source has its
subroot as root.  An empty dataset gives no rows.  Texts of any length are hashed whole, in the JVM; malformed UTF-8 is
hashed as it is.  Extra columns, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.sampling import remainder
from strata.llm.sql import CRC_TABLE, crc32, lower_az
from strata.llm.workspace import Workspace

#: fixed values: nodes of a run, and the fields of a leaf, in their order
FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: one document in so many is tampered with in the query's self-test
TAMPER_FOLD = 5
#: nodes that may share a join key when the pointers jump
NODES_A_KEY = FANOUT ** 3

_TOP = "2"   # the tree over the subroots; the groups of sources start with 0 (null) or 1
_STEP = "struct<before:string,after:string>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    """A field as it is hashed: ``-`` for null, else length in bytes, colon, value."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(**changed: Column) -> Column:
    """Digest of a document's row; ``changed`` puts other values in the place of fields."""
    return F.sha2(F.concat(*[field(changed.get(c, F.col(c))) for c in FIELDS]), 256)


def _joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def _node_digest(kids: Column) -> Column:
    return F.sha2(_joined(kids["digest"]), 256)


def _step(kids: Column, at: Column) -> Column:
    """Digests of the siblings before and after the ``at``-th (from 0) of a run."""
    return F.struct(_joined(F.slice(kids["digest"], F.lit(1), at)).alias("before"),
                    _joined(F.slice(kids["digest"], at + 2, F.lit(FANOUT))).alias("after"))


def proof_text(steps: Column) -> Column:
    """All digests of a proof, from the leaf to the root, those of a step from left to right."""
    return _joined(F.transform(steps, lambda s: F.concat(s["before"], s["after"])))


def fold(leaf: Column, steps: Column) -> Column:
    """The root that follows from a leaf and its proof."""
    return F.aggregate(steps, leaf, lambda below, s: F.sha2(F.concat(s["before"], below, s["after"]), 256))


def ranked(work: Workspace, rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with ``idx``, their place in group ``g`` (from 0) by ``order``, and ``size``, the rows of the group."""
    placed = work.write(rows.repartitionByRange("g", order[0]).sortWithinPartitions("g", *order)
                        .withColumn("at", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("at", 33)   # the upper bits of these numbers are the partition's
    runs = placed.groupBy(part.alias("s_part"), F.col("g").alias("s_g")).agg(
        F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy("s_g").orderBy("s_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("s_part", "s_g", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
                       F.sum("n").over(Window.partitionBy("s_g")).alias("size"))
    return (placed.join(runs, (part == F.col("s_part")) & (F.col("g") == F.col("s_g")))
            .select(*rows.columns, (F.col("at") - F.col("first") + F.col("before")).alias("idx"), "size"))


def _runs(rows: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per run of 16 consecutive nodes: the digest of their parent, its place and level size, and the nodes."""
    kid = F.struct("idx", "digest", *carry)
    grouped = rows.groupBy("g", F.floor(F.col("idx") / FANOUT).cast("long").alias("idx")).agg(
        F.array_sort(F.collect_list(kid)).alias("kids"), F.max("size").alias("below"))
    # a node that is alone on its level is the top already
    return grouped.select("g", "idx", "kids", F.ceil(F.col("below") / FANOUT).cast("long").alias("size"),
                          F.when(F.col("below") == 1, F.col("kids")[0]["digest"]).otherwise(
                              _node_digest(F.col("kids"))).alias("digest"), (F.col("below") == 1).alias("lone"))


_KEY = "struct<g:string,level:int,idx:bigint>"


def _key(g, level, idx) -> Column:
    return F.struct(F.col(g).alias("g") if isinstance(g, str) else g.alias("g"), F.lit(level).cast("int").alias("level"),
                    F.col(idx).alias("idx")).cast(_KEY)


def _node(node: Column, up: Column, steps: Column, subroot: Column, root: Column, top: bool) -> list[Column]:
    return [node.alias("node"), up.cast(_KEY).alias("up"), steps.cast(f"array<{_STEP}>").alias("steps"),
            subroot.cast("string").alias("subroot"), root.cast("string").alias("root"), F.lit(top).alias("high")]


@dataclass
class _Tree:
    home: DataFrame           # runs of leaves (level 1)
    inner: list[DataFrame]    # nodes above the leaves and below the tops, with their first segment
    tops: DataFrame           # (g, level, digest): one row per group
    height: int


def _grow(work: Workspace, leaves: DataFrame, carry: tuple[str, ...], high: bool) -> _Tree:
    """All levels of the trees of ``leaves`` (g, idx, size, digest, carry columns); one table is written per level."""
    home = work.write(_runs(leaves, carry), "runs")
    largest = home.agg(F.max("size")).first()[0] or 0
    inner, tops, current, level = [], [], home.select("g", "idx", "size", "digest"), 1
    while largest > 1:
        up = work.write(_runs(current.where("size > 1")), "runs")
        tops.append(current.where("size = 1").select("g", F.lit(level).alias("level"), "digest"))
        kids = up.select("g", F.col("idx").alias("run"), "kids", F.posexplode("kids").alias("pos", "kid")).select(
            "g", "run", "kids", "pos", F.col("kid.idx").alias("idx"))
        inner.append(kids.select(*_node(_key("g", level, "idx"), _key("g", level + 1, "run"),
                                        F.array(_step(F.col("kids"), F.col("pos"))), F.lit(None), F.lit(None), high)))
        current, level, largest = up.select("g", "idx", "size", "digest"), level + 1, -(-largest // FANOUT)
    tops.append(current.where("size = 1").select("g", F.lit(level).alias("level"), "digest"))
    every = tops[0]
    for t in tops[1:]:
        every = every.unionByName(t)
    return _Tree(home, inner, every, level)


def jump(work: Workspace, nodes: DataFrame, height: int) -> DataFrame:
    """Double the distance of every pointer until all segments reach the root."""
    distance = 1
    while distance < height:
        pointed = nodes.where((F.col("node.level") > distance) | F.col("high"))
        copies = F.lit(1).cast("long")
        if distance > 3:
            most = -(-nodes.where("up is not null").count() // NODES_A_KEY)
            copies = F.lit(max(1, min(FANOUT ** (distance - 3), most))).cast("long")
        far = pointed.select(F.col("node").alias("f_node"), F.col("up").alias("f_up"), F.col("steps").alias("f_steps"),
                             F.col("subroot").alias("f_subroot"), F.col("root").alias("f_root"),
                             F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)).alias("f_copy"))
        copy = F.pmod(F.xxhash64(F.floor(F.col("node.idx") / NODES_A_KEY)), copies)
        joined = nodes.join(far, (F.col("up") == F.col("f_node")) & (copy == F.col("f_copy")), "left").select(
            "node", F.col("f_up").alias("up"),
            F.when(F.col("f_steps").isNull(), F.col("steps")).otherwise(F.concat("steps", "f_steps")).alias("steps"),
            F.coalesce("subroot", "f_subroot").alias("subroot"), F.coalesce("root", "f_root").alias("root"), "high")
        nodes, before = work.write(joined, "jumped"), nodes
        if distance > 1:
            work.drop(before)
        distance *= 2
    return nodes


def manifest(work: Workspace, leaves: DataFrame, group: str, order: list[str], carry: list[str]) -> DataFrame:
    """Leaf proofs of a dataset: (carry columns, leaf, subroot, root, steps).

    ``leaves`` has a ``digest`` column, the ``group`` column (a source), the columns of ``order`` and those of ``carry``,
    which come back with their leaf.  ``steps`` holds the siblings before and after, from the leaf's run to the root.
    """
    g = F.when(F.col(group).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(group).cast("string")))
    names = {c: f"c_{c}" for c in carry}
    rows = work.write(leaves.select(g.alias("g"), F.col("digest"), *[F.col(c).alias(f"o_{c}") for c in order],
                                    *[F.col(c).alias(n) for c, n in names.items()]), "leaves")
    low = _grow(work, ranked(work, rows, [*[f"o_{c}" for c in order], "digest"]), tuple(names.values()), False)
    subroots = low.tops.select(F.lit(_TOP).alias("g"), F.col("g").alias("source"), "level", "digest")
    top_leaves = ranked(work, subroots, ["source"])
    high = _grow(work, top_leaves, ("source", "level"), True)

    # the subroots, which stand between the two trees
    kids = high.home.select("idx", "kids", "lone", F.posexplode("kids").alias("pos", "kid"))
    subs = kids.select(*_node(
        F.struct(F.col("kid.source").alias("g"), F.col("kid.level").alias("level"), F.lit(0).cast("long").alias("idx")).cast(_KEY),
        F.when(~F.col("lone"), _key(F.lit(_TOP), 1, "idx")),
        F.when(F.col("lone"), F.array().cast(f"array<{_STEP}>")).otherwise(F.array(_step(F.col("kids"), F.col("pos")))),
        F.col("kid.digest"), F.when(F.col("lone"), F.col("kid.digest")), True))
    root = high.tops.select(*_node(_key("g", 0, "level"), F.lit(None), F.array(), F.lit(None), F.col("digest"), True)) \
        .withColumn("node", F.struct(F.lit(_TOP).alias("g"), F.col("node.idx").cast("int").alias("level"),
                                     F.lit(0).cast("long").alias("idx")).cast(_KEY))
    nodes = subs.unionByName(root)
    for t in (*low.inner, *high.inner):
        nodes = nodes.unionByName(t)
    paths = jump(work, work.write(nodes, "nodes"), low.height + high.height)

    path = paths.where("node.level = 1").select(F.col("node.g").alias("p_g"), F.col("node.idx").alias("p_idx"), "steps",
                                                "subroot", "root")
    found = low.home.join(path, (F.col("g") == F.col("p_g")) & (F.col("idx") == F.col("p_idx"))).select(
        "kids", "lone", "steps", "subroot", "root", F.posexplode("kids").alias("pos", "kid"))
    steps = F.when(F.col("lone"), F.col("steps")).otherwise(
        F.concat(F.array(_step(F.col("kids"), F.col("pos"))), F.col("steps")))
    return found.select(*[F.col(f"kid.{n}").alias(c) for c, n in names.items()], F.col("kid.digest").alias("leaf"),
                        "subroot", "root", steps.alias("steps"))


def document_leaves(documents: DataFrame) -> DataFrame:
    """(doc_id, source, digest, seen): the leaf of each document, and the leaf that a tampered copy of it would have.

    The copy has A-Z in lower case where ``TAMPER_FOLD`` divides the crc32 of its doc_id; other rows are as they were.
    """
    tampered = F.when(remainder(F.col("doc_id"), TAMPER_FOLD) == 0,
                      leaf_digest(text=F.translate("text", _UPPER, _LOWER)))
    return documents.select("doc_id", "source", leaf_digest().alias("digest"), tampered.alias("seen"))


def op13_pointer_jumping(spark, sf_dir: str) -> DataFrame:
    """Manifest of ``documents`` and its check against a copy in which some rows have been changed."""
    work = Workspace(spark, "merkle")
    leaves = document_leaves(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    proofs = manifest(work, leaves, "source", ["doc_id"], ["doc_id", "seen"])
    folded = fold(F.coalesce("seen", "leaf"), F.col("steps"))
    return proofs.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("steps")), 256).alias("proof_sha256"),
                         folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_field(value: str) -> str:
    text = f"({value})::VARCHAR"
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(f"({_sql_field(text if c == 'text' else c)})" for c in FIELDS) + ")"


def _sql_levels(name: str, height: int) -> str:
    """CTEs name1.. of the levels above ``name0`` (g, idx, size, digest): a group stops growing at one node."""
    return "".join(f""", {name}{k} AS (
  SELECT g, idx // {FANOUT} AS idx, any_value((size + {FANOUT - 1}) // {FANOUT}) AS size,
    sha256(string_agg(digest, '' ORDER BY idx)) AS digest
  FROM {name}{k - 1} WHERE size > 1 GROUP BY g, idx // {FANOUT})""" for k in range(1, height + 1))


def _sql_siblings(name: str, k: int) -> str:
    """For every node of a level that has a parent: the digests before and after it in its run, joined."""
    run = f"(PARTITION BY g, idx // {FANOUT} ORDER BY idx ROWS BETWEEN"
    return f""", {name}{k}_s AS (
  SELECT g, idx,
    coalesce(string_agg(digest, '') OVER {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(digest, '') OVER {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k} WHERE size > 1)"""


#: levels that the statement spells out: 16 ** 5 documents of a source, 16 ** 3 sources
_LOW, _HIGH = 5, 3


def _sql_fold(name: str, k: int, source: str, group: str, place: str) -> str:
    """One step up: where the node has siblings' digests, the proof grows and the folded digest is hashed with them."""
    return f""", {name}{k + 1}_p AS (
  SELECT p.* EXCLUDE (proof, folded), p.proof || coalesce(s.l || s.r, '') AS proof,
    CASE WHEN s.g IS NULL THEN p.folded ELSE sha256(s.l || p.folded || s.r) END AS folded
  FROM {source} p LEFT JOIN {name}{k}_s s ON s.g = p.{group} AND s.idx = p.{place} // {FANOUT ** k})"""


OP13_SQL = f"""
WITH {CRC_TABLE}, rows AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS g, {_sql_leaf('text')} AS digest,
    CASE WHEN doc_id IS NOT NULL AND {crc32("doc_id::VARCHAR")} % {TAMPER_FOLD} = 0
      THEN {_sql_leaf(lower_az('text'))} ELSE {_sql_leaf('text')} END AS seen
  FROM documents, crc
), low0 AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx,
    count(*) OVER (PARTITION BY g) AS size FROM rows
){_sql_levels('low', _LOW)}, high0 AS (
  SELECT '{_TOP}' AS g, g AS source, digest, row_number() OVER (ORDER BY encode(g)) - 1 AS idx, count(*) OVER () AS size
  FROM ({' UNION ALL '.join(f'SELECT g, digest FROM low{k} WHERE size = 1' for k in range(_LOW + 1))})
){_sql_levels('high', _HIGH)}, top AS (
  {' UNION ALL '.join(f'SELECT digest FROM high{k} WHERE size = 1' for k in range(_HIGH + 1))}
){''.join(_sql_siblings('low', k) for k in range(_LOW))}{''.join(_sql_siblings('high', k) for k in range(_HIGH))}
, low0_p AS (
  SELECT low0.doc_id, low0.digest AS leaf, low0.g, low0.idx, high0.digest AS subroot, '{_TOP}' AS top_g,
    high0.idx AS top_idx, '' AS proof, low0.seen AS folded
  FROM low0 JOIN high0 ON high0.source = low0.g
){''.join(_sql_fold('low', k, f'low{k}_p', 'g', 'idx') for k in range(_LOW))}
{''.join(_sql_fold('high', k, f'low{_LOW}_p' if k == 0 else f'high{k}_p', 'top_g', 'top_idx') for k in range(_HIGH))}
SELECT doc_id, leaf, subroot, top.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
  folded = top.digest AS verified
FROM high{_HIGH}_p, top
"""
