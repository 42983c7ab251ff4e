"""Exact deduplication by distributed MSD radix partitioning.

All texts start in one group. A round cuts the next bytes off every text still in play and
splits each group by them; the bytes themselves are the key, so no digest decides equality. A
group of one is done, and so is a group whose texts have ended: its texts are equal. Few texts
share their first bytes and fewer the next, so the width of the cut grows with the round, and
a text of n bytes takes part in O(log n) rounds. Counting combines on the map side; when the rows
are told their new group, those of a hot group are dealt over several tasks.

Texts are equal when identical after replacing each run of ASCII white space by one space.

Defined cases: a null text is the empty text. Of equal texts the row with the smallest id
stays; null ids come last, and among rows of one id one stays. keep_id is null only where all
ids of the group are. An empty table gives no rows. Other columns are left out unless asked for
with `carry`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import SPACES, Shelf, pick, text_or_empty
from waybill.operators.skew import split_join

FIRST_WIDTH = 64
GROWTH = 16


def radix_groups(df: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 and the columns in
    `carry`, which must not have one of these names but may be "text"."""
    spark = df.sparkSession
    shelf = Shelf(spark, "radix")
    docs = pick(df, *dict.fromkeys(("doc_id", "text", *carry)))
    body = F.regexp_replace(text_or_empty(), SPACES + "+", " ").cast("binary")
    staged = shelf.put(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "text",
            F.sha2(body, 256).alias("text_sha256"),
            *(F.col(c).alias(f"carried_{c}") for c in carry if c not in ("doc_id", "text")),
        ),
        "staged",
    )
    playing = staged.select("row", "doc_id", F.lit(0).cast("long").alias("grp"), body.alias("body"))
    width, rounds, done = FIRST_WIDTH, [], []
    while True:
        cut = F.substring("body", 1, width)
        ended = F.octet_length("body") <= width
        keyed = playing.select(
            "row",
            "doc_id",
            "grp",
            cut.alias("cut"),
            ended.alias("ended"),
            F.expr(f"substring(body, {width + 1})").alias("body"),
        )
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
        groups = shelf.put(
            keyed.groupBy("grp", "cut", "ended")
            .agg(F.count("*").alias("group_size"), first.alias("keep"))
            .filter("group_size > 1"),
            f"groups-{len(rounds)}",
        )
        name = f"round-{len(rounds)}"
        told = split_join(
            keyed, groups, ["grp", "cut", "ended"], counts=groups, n="group_size", deal_by=F.col("row")
        )
        split = shelf.put(
            told.select("row", "doc_id", F.col("keep.row").alias("grp"), "body", "ended", "group_size", "keep"), name
        )
        done.append(
            split.filter("ended").select(
                "row", F.col("keep.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("keep.row")).alias("kept")
            )
        )
        rounds.append(name)
        playing = split.filter("NOT ended").select("row", "doc_id", "grp", "body")
        if playing.isEmpty():
            break
        width *= GROWTH
    found = done[0]
    for part in done[1:]:
        found = found.unionAll(part)
    alone = F.col("group_size").isNull()
    # a shuffle at every size: what is joined to the texts grows with them
    return staged.join(found.hint("merge"), "row", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce("kept", F.lit(True)).alias("kept"),
        "text_sha256",
        *(F.col(c if c == "text" else f"carried_{c}").alias(c) for c in carry if c != "doc_id"),
    )
