"""Connected components by contraction with random priorities.

Each round every node takes the neighbour (or itself) of the smallest priority, a hash of node
and round, as its new name, and edges are renamed; fresh priorities keep long chains from
contracting one link at a time, so the rounds grow with the logarithm of the nodes. Minima
combine on the map side, so a node with very many links does no harm. Each round is written to
the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import Shelf


def components(edges: DataFrame, shelf: Shelf) -> DataFrame:
    """(node, component) for each node of the edges (a, b), a and b being longs; `component`
    is one of the component's nodes. Self-links and repeated links do no harm."""
    links = edges.filter("a <> b").select("a", "b").distinct()
    links = shelf.put(links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links-0")
    names = shelf.put(links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct(), "names-0")
    number = 0
    while not links.isEmpty():
        number += 1
        rank = lambda column: F.struct(F.xxhash64(F.lit(number), column).alias("p"), column.alias("name"))  # noqa: E731, B023
        hooked = shelf.put(
            links.groupBy("a")
            .agg(F.min(rank(F.col("b"))).alias("best"))
            .select("a", F.least("best", rank(F.col("a"))).getField("name").alias("to")),
            f"hooks-{number}",
        )
        renamed = names.join(hooked, names["component"] == hooked["a"], "left").select(
            "node", F.coalesce("to", "component").alias("component")
        )
        names_before, links_before = f"names-{number - 1}", f"links-{number - 1}"
        names = shelf.put(renamed, f"names-{number}")
        left = links.join(hooked, "a").select(F.col("to").alias("a"), "b")
        both = left.join(hooked.select(F.col("a").alias("b"), F.col("to").alias("to_b")), "b")
        links = shelf.put(both.filter("a <> to_b").select("a", F.col("to_b").alias("b")).distinct(), f"links-{number}")
        shelf.drop(names_before, links_before, f"hooks-{number}")
    return names
