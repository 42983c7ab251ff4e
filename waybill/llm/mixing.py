"""Mixing sources to target weights by Pareto order sampling.

Targets: sources in order of name weigh by their turn; a share of all words is given out by weight, no
source gets more than `most` times its words, and what that leaves over goes to the others by weight
until none is above.

Copies: within a source a document is to be taken e times. e is one number for all documents but very long
ones, whose weight counts `long_from` words only, so that a few of them do not make up the sample; no e is
above `most`. All documents get floor(e) whole copies for certain. What is left of the target is filled by
a sample in which a document is included with probability e - floor(e): documents are ranked by the odds
of a uniform random number divided by their inclusion odds (Pareto order sampling), and the first ones
are taken until the words are full. So the size of the sample is fixed, in words; of the document
that crosses the line only the first words are taken.

The random number is a hash of seed, id and text, so reruns agree. A source may hold most of the corpus: its
ranks fall into buckets of even width, sums per bucket tell which bucket the line crosses, and only the rows
of that bucket are put in order. Levels of the fill are found in a few rounds over one row per source, or
per source and size.

Defined cases: null text has size 0 and is never taken; a null source is a source of its own, last in order.
Rows that repeat are rows like any other; which of equal rows is taken does not show. A corpus without words
has targets of 0. An empty table gives no rows. Other columns are left out."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.common import NON_SPACES, Shelf, pick, text_or_empty
from waybill.operators.lookup import measured
from waybill.operators.numbering import with_row_numbers
from waybill.operators.skew import split_join

ROWS_PER_BUCKET = 20_000
UNIFORM_BITS = 52


def word_count() -> Column:
    """Runs of other than ASCII white space. Every run becomes one letter; a long text makes no list."""
    marked = F.regexp_replace(text_or_empty(), NON_SPACES + "+", "x")
    return F.octet_length(F.translate(marked, " \t\n\x0b\x0c\r", "")).cast("long")


def uniform(seed: int) -> Column:
    """A number strictly between 0 and 1 from a digest of seed, id and text."""
    keyed = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text_or_empty())
    upper = F.conv(F.substring(F.md5(keyed.cast("binary")), 1, UNIFORM_BITS // 4), 16, 10).cast("long")
    return (upper + F.lit(0.5)) * F.lit(2.0**-UNIFORM_BITS)


def fill_levels(items: DataFrame, totals: DataFrame, key: str, shelf: Shelf, label: str) -> DataFrame:
    """key, level: the level at which items of `weight` and `cap` hold the key's `total`, each taking weight
    times level but no more than its cap.

    Each round gives what full items cannot hold to the others, so levels only rise, and ends when no
    item fills up any more. A key whose items are all full keeps its last level. `items` and `totals`
    are stored tables; `totals` has one row per key."""
    none = F.lit(0.0)
    levels = totals.select(key, "total", F.lit(None).cast("double").alias("level"), F.lit(-1).cast("long").alias("full"))
    round_, full = 0, -1
    while True:
        at_cap = F.coalesce(F.col("weight") * F.col("level") >= F.col("cap"), F.lit(False))
        sums = (
            items.join(levels.select(key, "level"), key)
            .groupBy(key)
            .agg(
                F.sum(F.when(at_cap, F.col("cap")).otherwise(none)).alias("held"),
                F.sum(F.when(at_cap, none).otherwise(F.col("weight"))).alias("open"),
                F.sum(F.when(at_cap, 1).otherwise(0)).alias("full"),
            )
        )
        level = F.when(F.col("open") > 0, (F.col("total") - F.col("held")) / F.col("open")).otherwise(F.col("level"))
        levels = shelf.put(
            levels.drop("full").join(sums, key).select(key, "total", level.alias("level"), "full"), f"{label}-{round_}"
        )
        now = levels.agg(F.sum("full")).first()[0] or 0
        if now == full:
            return levels.select(key, "level")
        round_, full = round_ + 1, now


def targets_of(sources: DataFrame, weights: Sequence[float], share: float, most: float, shelf: Shelf) -> DataFrame:
    """key, source_size, docs, target from key, source, source_size, docs."""
    named = with_row_numbers(sources, [F.col("source").asc_nulls_last()], "turn", lambda df: shelf.put(df, "sources"))
    weight = F.array(*(F.lit(float(w)) for w in weights))[F.col("turn") % len(weights)]
    items = shelf.put(
        named.select(
            F.lit(0).alias("all"),
            "key",
            "source_size",
            "docs",
            weight.alias("weight"),
            (F.col("source_size") * F.lit(float(most))).alias("cap"),
        ),
        "weights",
    )
    totals = items.groupBy("all").agg((F.sum("source_size") * F.lit(share)).alias("total"))
    level = fill_levels(items, shelf.put(totals, "total"), "all", shelf, "target").first()
    target = F.least(F.col("weight") * F.lit(level["level"] if level else 0.0), F.col("cap"))
    return items.select("key", "source_size", "docs", target.alias("target"))


def copies(level: Column, size: Column, long_from: int, most: float) -> Column:
    """How often a document is to be taken."""
    return F.least(level * F.least(size, F.lit(long_from)) / size, F.lit(float(most)))


def mix(
    df: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    long_from: int = 4096,
    seed: int = 0,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Per row: doc_id, size, source_size, target and taken, the words that the mix takes."""
    shelf = Shelf(df.sparkSession, "mixing")
    docs = shelf.put(
        pick(df, "doc_id", "text", "source").select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "source",
            F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key"),
            word_count().alias("size"),
            uniform(seed).alias("u"),
        ),
        "docs",
    )
    sources = docs.groupBy("key", "source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    targets = shelf.put(targets_of(shelf.put(sources, "by-name"), weights, share, most, shelf), "targets")

    # one row per source and size is enough to find how often documents are to be taken
    size = F.col("size")
    sizes = shelf.put(
        docs.filter("size > 0")
        .groupBy("key", "size")
        .agg(F.count("*").alias("n"))
        .withColumn("weight", (F.least(size, F.lit(long_from)) * F.col("n")).cast("double"))
        .withColumn("cap", (size * F.col("n") * most).cast("double")),
        "sizes",
    )
    levels = fill_levels(sizes, targets.select("key", F.col("target").alias("total")), "key", shelf, "copies")
    e = copies(F.col("level"), size, long_from, most)
    certain = (
        sizes.join(levels, "key")
        .groupBy("key")
        .agg(
            F.sum(F.floor(e) * size * F.col("n")).alias("certain"),
            F.sum(F.when(e > F.floor(e), size * F.col("n"))).alias("at_stake"),
        )
    )
    left_over = F.greatest(F.floor(F.col("target") + 0.5) - F.col("certain"), F.lit(0))
    # the usual inclusion odds of a source, by which ranks are spread evenly over the buckets
    usual = F.least(F.greatest(F.col("left") / F.col("at_stake"), F.lit(1e-6)), F.lit(1 - 1e-6))
    plan = shelf.put(
        targets.join(levels, "key", "left")
        .join(certain, "key", "left")
        .withColumn("left", F.coalesce(left_over, F.lit(0)))
        .withColumn("odds", F.coalesce(usual / (1 - usual), F.lit(1.0))),
        "plan",
    )
    known = measured(plan, "key")
    if known.broadcastable:
        rated = docs.join(F.broadcast(plan), "key")
    else:
        rated = split_join(docs, plan, ["key"], counts=plan, n="docs", deal_by=F.col("row"))

    most_docs = plan.agg(F.max("docs")).first()[0] or 1
    buckets = max(1, math.ceil(most_docs / rows_per_bucket))
    rank = F.col("u") / (1 - F.col("u")) / (F.col("chance") / (1 - F.col("chance")))
    spread = F.col("rank") * F.col("odds") / (1 + F.col("rank") * F.col("odds"))
    ranked = shelf.put(
        rated.withColumn("e", F.when(size > 0, e).otherwise(0.0))
        .withColumn("whole", F.floor("e"))
        .withColumn("chance", F.col("e") - F.col("whole"))
        .withColumn("rank", F.when(F.col("chance") > 0, rank))
        .withColumn("bucket", F.least(F.floor(spread * buckets), F.lit(buckets - 1)))
        .select("row", "doc_id", "key", "size", "source_size", "target", "docs", "left", "whole", "rank", "bucket"),
        "ranked",
    )
    in_order = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    crossed = shelf.put(
        ranked.filter("rank IS NOT NULL")
        .groupBy("key", "bucket", "left")
        .agg(F.sum("size").alias("words"))
        .withColumn("before", F.coalesce(F.sum("words").over(in_order), F.lit(0)))
        .filter("before < left AND before + words >= left")
        .select("key", F.col("bucket").alias("line"), "before"),
        "crossed",
    )
    if known.broadcastable:
        placed = ranked.join(F.broadcast(crossed), "key", "left")  # at most one row per source
    else:
        placed = split_join(ranked, crossed, ["key"], "left", counts=plan, n="docs", deal_by=F.col("row"))
    # where nothing is crossed, the sample takes all there is to take, or nothing
    rest = F.when(F.col("rank").isNull() | (F.col("left") == 0), 0).when(
        F.col("line").isNull() | (F.col("bucket") < F.col("line")), size
    )
    on_line = F.coalesce(F.col("rank").isNotNull() & (F.col("bucket") == F.col("line")), F.lit(False))
    earlier = Window.partitionBy("key").orderBy("rank", "doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    full = F.col("left") - F.col("before") - F.coalesce(F.sum("size").over(earlier), F.lit(0))
    sampled = placed.filter(on_line).withColumn("extra", F.greatest(F.least(size, full), F.lit(0)))
    others = placed.filter(~on_line).withColumn("extra", F.coalesce(rest, F.lit(0)))
    return sampled.unionByName(others).select(
        "doc_id", "size", "source_size", "target", (F.col("whole") * size + F.col("extra")).cast("long").alias("taken")
    )
