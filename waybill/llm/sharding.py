"""Sharding by longest processing time: groups of equal texts, largest first, each to the
shard that is least loaded so far, found by a heap.

The heap needs sizes in order, not groups: groups of one size are a run, and a run of m groups is dealt
to the shards as m single ones would be, in one step per run. The driver holds one row per distinct
size; as different sizes add up to no more than the corpus, there are at most the square root of twice
its bytes. Groups are numbered by size with prefix sums, so a group finds its shard from its
place in its run. No group is gathered with others and none is treated unlike the rest.

Defined cases: a null text is the empty text, of size 1. Null and repeated ids are rows like
any other. Equal texts stay together even when they outweigh a fair shard. An empty table
gives no rows. Other columns are left out."""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import Shelf, pick, text_or_empty
from waybill.operators.numbering import with_row_numbers
from waybill.operators.skew import split_join

SINGLY = 256


def deal_run(loads: list[int], size: int, groups: int) -> list[int]:
    """How many of `groups` groups of one size each shard gets, each going to the least loaded shard, the
    lower number first among equals. `loads` is brought up to date.

    Shard s would take its groups at loads[s], loads[s] + size, ...; dealing takes the smallest of these."""
    counts = [0] * len(loads)
    left = groups
    if left > SINGLY:  # all below the highest load that does not take too many, found by halving
        low, high = min(loads), min(loads) + size * groups + 1
        below = lambda top: sum(max(0, -(-(top - load) // size)) for load in loads)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if below(middle) <= left else (low, middle - 1)
        counts = [max(0, -(-(low - load) // size)) for load in loads]
        left -= sum(counts)
    heap = [(load + n * size, shard) for shard, (load, n) in enumerate(zip(loads, counts))]
    heapq.heapify(heap)
    for _ in range(left):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        counts[shard] += 1
    for shard, n in enumerate(counts):
        loads[shard] += n * size
    return counts


def deal_runs(runs: pa.Table, shards: int) -> pa.Table:
    """size, first and ends for runs (size, groups) in falling order of size: the number of the run's first
    group, and per shard where its part of the run ends."""
    loads, first, firsts, ends = [0] * shards, 0, [], []
    for size, groups in zip(runs.column("size").to_pylist(), runs.column("groups").to_pylist()):
        firsts.append(first)
        end, parts = 0, []
        for n in deal_run(loads, size, groups):
            end += n
            parts.append(end)
        ends.append(parts)
        first += groups
    return pa.table(
        {"size": runs.column("size"), "first": pa.array(firsts, pa.int64()), "ends": pa.array(ends, pa.list_(pa.int64()))}
    )


def shard_documents(df: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot; sizes of shards are near equal."""
    spark = df.sparkSession
    shelf = Shelf(spark, "shards")
    text = text_or_empty()
    rows = shelf.put(
        pick(df, "doc_id", "text").select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("k1"),
            F.xxhash64(F.lit("group"), text).alias("k2"),
        ),
        "rows",
    )
    groups = shelf.put(
        rows.groupBy("k1", "k2").agg(F.sum("size").alias("group_size"), F.count("*").alias("n")), "groups"
    )
    runs = groups.groupBy(F.col("group_size").alias("size")).agg(F.count("*").alias("groups")).orderBy(F.desc("size"))
    dealt = spark.createDataFrame(deal_runs(runs.toArrow(), shards)).select(
        F.col("size").alias("group_size"), "first", "ends", F.element_at("ends", -1).alias("groups")
    )
    dealt = shelf.put(dealt, "dealt")
    numbered = with_row_numbers(groups, [F.desc("group_size"), F.col("k1"), F.col("k2")], "number", lambda x: shelf.put(x, "by-size"))
    placed = shelf.put(
        split_join(numbered, dealt.drop("groups"), ["group_size"], counts=dealt, n="groups").select(
            "k1", "k2", "n", F.size(F.filter("ends", lambda end: end <= F.col("number") - F.col("first"))).alias("shard")
        ),
        "placed",
    )
    # copies of one text may be a large part of all rows
    sharded = split_join(rows, placed.drop("n"), ["k1", "k2"], counts=placed, deal_by=F.col("row"))
    sharded = shelf.put(sharded.select("doc_id", "size", "text_crc32", "shard", "k1", "k2"), "sharded")
    return with_slots(sharded, shelf)


def with_slots(sharded: DataFrame, shelf: Shelf) -> DataFrame:
    """Slots without gaps in each shard, from numbers over all rows by shard; no shard is one task's."""
    order = [F.col(c) for c in ("shard", "doc_id", "k1", "k2")]
    numbered = with_row_numbers(sharded, order, "number", lambda df: shelf.put(df, "by-shard"))
    starts = numbered.groupBy("shard").agg(F.min("number").alias("start"))  # one row per shard
    return numbered.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("number") - F.col("start")).alias("slot")
    )
