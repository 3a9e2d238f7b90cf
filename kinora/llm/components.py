"""Connected components of a table of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinora.session import materialize


def _near(links: DataFrame) -> DataFrame:
    """Per node its smallest and largest neighbour."""
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); a component's name is its
    smallest node.

    Each round points a node's larger neighbours at the smallest node near it, then the
    node and its smaller neighbours at the smallest of these.  It ends when every node
    either has larger neighbours only or one neighbour, a smaller one.  Rounds work on
    the links alone and write them to the shared folder; their number grows with the
    logarithm of a component's width.  A hub's neighbours are reduced behind a partial
    aggregate, and adaptive execution splits its join."""
    links = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while not _near(links).where("low < u and low <> high").isEmpty():
        low = _near(links).select("u", F.least("low", "u").alias("m"))
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = materialize(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        links = materialize(large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .unionAll(low.select("u", F.col("m").alias("v")))
                            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    return _near(links).select(F.col("u").alias("node"), F.least("u", "low").alias("component"))
