"""Connected components of a distributed graph (union-find by hooking and pointer jumping)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import scratch_path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later steps start from it, lost tasks too."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Component of every node that has an edge: (node, component), the component being its smallest node.

    Each round hooks every node to its smallest neighbour and replaces the edges' ends by the roots found so far
    (pointer jumping); edges inside a component go, so the graph shrinks by at least half a round.  Joins are by node
    and carry two numbers a row, so a node with very many edges is a skewed join, which adaptive execution splits.
    Self-loops and repeated edges are fine; an edge with a null end is ignored; no edges give an empty result.
    """
    spark = edges.sparkSession
    pair = edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
    left = materialize(pair.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("lo") < F.col("hi"))).distinct(),
                       "edges")
    kind = edges.schema[a].dataType.simpleString()
    labels = spark.createDataFrame([], f"node {kind}, component {kind}")
    while not left.isEmpty():
        # every node of the graph points to its smallest neighbour, or to itself where it is smaller than all
        both = left.select(F.col("lo").alias("node"), F.col("hi").alias("to")).unionByName(
            left.select(F.col("hi").alias("node"), F.col("lo").alias("to")))
        parents = materialize(both.groupBy("node").agg(F.min("to").alias("up"))
                              .select("node", F.least("node", "up").alias("up")), "parents")
        # pointers only lead downwards; jump until each points to a root
        while True:
            ups = parents.select(F.col("node").alias("u_node"), F.col("up").alias("u_up"))
            jumped = materialize(parents.join(ups, F.col("up") == F.col("u_node"))
                                 .select("node", F.col("u_up").alias("up"), (F.col("u_up") != F.col("up")).alias("moved")),
                                 "parents")
            parents = jumped.select("node", "up")
            if jumped.where("moved").isEmpty():
                break
        root = parents.select(F.col("node").alias("r_node"), F.col("up").alias("root"))
        # nodes of earlier rounds follow their root; new nodes enter
        followed = labels.join(root, F.col("component") == F.col("r_node"), "left").select(
            "node", F.coalesce("root", "component").alias("component"))
        entered = root.select(F.col("r_node").alias("node"), F.col("root").alias("component")).join(
            labels.select("node"), "node", "left_anti")
        labels = materialize(followed.unionByName(entered), "labels")
        one = left.join(root, F.col("lo") == F.col("r_node")).select(F.col("root").alias("x"), "hi")
        two = one.join(root, F.col("hi") == F.col("r_node")).select("x", F.col("root").alias("y"))
        left = materialize(two.where(F.col("x") != F.col("y")).select(
            F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi")).distinct(), "edges")
    return labels
