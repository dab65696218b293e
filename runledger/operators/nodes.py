"""Node paths of a log: the tree, existence, and types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.path import ancestors, depth, is_path, name, parent
from ..functions.predicate import as_day


def paths(log: DataFrame, query_date=None) -> DataFrame:
    """Distinct node paths that the log names, on one day or at all."""
    rows = log.filter(F.col("node_path").isNotNull())
    if query_date is not None:
        rows = rows.filter(F.col("record_date") == as_day(query_date))
    return rows.select("node_path").distinct()


def node_tree(log: DataFrame, query_date=None) -> DataFrame:
    """Edges ``path, parent, name, depth, is_leaf`` of the named paths and all that enclose them."""
    named = paths(log, query_date).filter(is_path(F.col("node_path")) & (F.col("node_path") != "/"))
    every = named.select(F.explode(ancestors(F.col("node_path"), include_self=True)).alias("path")).distinct()
    inner = every.select(parent(F.col("path")).alias("path")).distinct().withColumn("inner", F.lit(True))
    p = F.col("path")
    return every.join(inner, "path", "left").select(
        "path", parent(p).alias("parent"), name(p).alias("name"), depth(p).cast("bigint").alias("depth"), F.col("inner").isNull().alias("is_leaf")
    )


def nested_trees(edges: DataFrame) -> DataFrame:
    """``suite, n_nodes, n_leaves, document`` of a tree of edges (:func:`node_tree`): one nested JSON document a suite.

    A node is ``{"name", "nodes", "leaves", "children"}``: how many nodes and leaves it has with itself, and its children by name. The
    deepest level is made first, then each level takes up the one below it: a round a level, whose rows are
    grouped by parent, so a task holds one node's children.
    """
    deepest = edges.agg(F.max("depth")).first()[0] or 0
    quoted = F.to_json(F.struct(F.col("name").alias("name")))
    head = F.concat(F.substr(quoted, F.lit(1), F.length(quoted) - 1), F.lit(',"nodes":'))
    rows = edges.select("path", "parent", "name", "depth", head.alias("head"))
    below = None
    for level in range(deepest, 0, -1):
        mine = rows.filter(F.col("depth") == level)
        if below is None:
            taken = mine.select("*", F.lit(None).cast("string").alias("inside"), F.lit(0).cast("bigint").alias("nodes"), F.lit(0).cast("bigint").alias("leaves"))
        else:
            children = F.transform(F.array_sort(F.collect_list(F.struct("name", "document"))), lambda c: c["document"])
            sums = below.groupBy(F.col("parent").alias("path")).agg(
                F.array_join(children, ",").alias("inside"), F.sum("n_nodes").alias("nodes"), F.sum("n_leaves").alias("leaves")
            )
            taken = mine.join(sums, "path", "left").fillna(0, ["nodes", "leaves"])
        n_nodes, n_leaves = F.col("nodes") + 1, F.when(F.col("inside").isNull(), F.lit(1)).otherwise(F.col("leaves")).cast("bigint")
        document = F.concat("head", n_nodes.cast("string"), F.lit(',"leaves":'), n_leaves.cast("string"), F.lit(',"children":['), F.coalesce("inside", F.lit("")), F.lit("]}"))
        below = taken.select("path", "parent", "name", n_nodes.alias("n_nodes"), n_leaves.alias("n_leaves"), document.alias("document"))
    if below is None:
        below = rows.select("path", "parent", "name", F.lit(0).cast("bigint").alias("n_nodes"), F.lit(0).cast("bigint").alias("n_leaves"), "head").withColumnRenamed("head", "document")
    return below.select(F.col("path").alias("suite"), "n_nodes", "n_leaves", "document")


def node_exists(log: DataFrame, asked: DataFrame) -> DataFrame:
    """``node_path, present`` for each asked path; present means named in the log itself."""
    there = paths(log).withColumn("there", F.lit(True))
    return asked.select("node_path").distinct().join(there, "node_path", "left").select("node_path", F.col("there").isNotNull().alias("present"))


def node_types(log: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """``node_path, node_type``: root, unknown, suite, family, non-task or task, tested in this order.

    A path that only encloses others is not present, so unknown. A family has a named path below it
    whose next segment does not start with ``alias``; the same path may count for one
    enclosing path and not for another.
    """
    named = paths(log)
    asked = (named if asked is None else asked).select("node_path").distinct()
    # For every enclosing path keep the segment that leads down to the named one.
    up = named.select("node_path", F.posexplode(ancestors(F.col("node_path"))).alias("i", "top"))
    below = F.get(F.split("node_path", "/", -1), F.col("i") + 2)
    parents = up.filter(~F.coalesce(below.startswith("alias"), F.lit(False))).select(F.col("top").alias("node_path")).distinct()
    p = F.col("node_path")
    known = asked.join(named.withColumn("named", F.lit(True)), "node_path", "left").join(parents.withColumn("above", F.lit(True)), "node_path", "left")
    kind = (
        F.when(p == "/", "root")
        .when(F.col("named").isNull() | ~is_path(p), "unknown")
        .when(depth(p) == 1, "suite")
        .when(F.col("above"), "family")
        .when(p.contains(":"), "non-task")
        .otherwise("task")
    )
    return known.select("node_path", kind.alias("node_type"))
