"""SimHash near-duplicates through a hierarchical index in Gray order.

Fingerprints of equal value are one entry. Entries are sorted by Gray rank, in which
neighbours differ in few bits, and cut into leaves of up to LEAF entries. A node of the index
keeps the bits that all its entries share, as a mask and their values. Two nodes are compared
by these alone first: if the shared masked patterns differ in more than `distance` bits, no pair
below them links and the whole group is pruned. What is left goes down a level (top nodes of
LEAF entries, then GROUP, then single fingerprints), each level adding the differences that its
longer patterns show.

At the top the nodes are rows: a node meets others over the prefixes within `distance` bits of
its own, an equi-join. The prefix grows with the logarithm of the entries, so node sizes stay
as they are. Pairs of nodes are solved in tasks of their own, which return links that span what
they found, not all pairs; components of all links follow. Tasks are sized by the entries that
their pairs hold and compare, so that many small nodes do not make many tasks. No list of fingerprints reaches
the driver.

Defined cases: a null text is the empty text; texts without words have fingerprint zero and
link like any other. The component id is the smallest id of the component, null only if all
its ids are null. Repeated rows are rows like any other. An empty table gives no rows. Other
columns are left out."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import WORD, UPPER_TO_LOWER, Shelf, pick, text_chunks
from waybill.llm.components import components

LEAF = 8192
GROUP = 64
MOST_PREFIX_BITS = 24
# what a task that links nodes has at most: pairs, entries read, pairs of entries compared
PAIRS_PER_TASK = 512
ENTRIES_PER_TASK = 64 * LEAF
CELLS_PER_TASK = 4 * LEAF**2
SEED = 42


def fingerprint(text: str, shingle: int) -> int:
    """Bit i is 1 if set in over half the hashes of the word shingles."""
    words = WORD.findall(text.translate(UPPER_TO_LOWER))
    if not words:
        return 0
    joined = " ".join(words).encode()
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.flatnonzero(np.frombuffer(joined + b" ", np.uint8) == 32).tolist()
    starts = [0, *(e + 1 for e in ends[: len(words) - shingle])]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :])), np.uint64, len(starts)
    )
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 255):  # a byte holds the count of 255 rows
        bits = np.unpackbits(hashes[at : at + 255].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_rows(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_chunks(batch):
            prints = np.array([fingerprint(t or "", shingle) for t in part.column("text").to_pylist()], np.uint64)
            carried = [part.column(i) for i in range(part.num_columns) if part.schema.names[i] != "text"]
            names = [n for n in part.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*carried, pa.array(prints.view(np.int64))], [*names, "fp"])


def gray_rank(prints: np.ndarray) -> np.ndarray:
    """Place of each code word in the order of the reflected Gray code."""
    rank = prints.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def shared_bits(prints: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the bits that the entries of each group agree in, and their values."""
    every, some = np.bitwise_and.reduceat(prints, starts), np.bitwise_or.reduceat(prints, starts)
    return ~(every ^ some), every


def build_leaves(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Nodes from a partition that is sorted by Gray rank: runs of one prefix, cut at LEAF."""
    shift = np.uint64(64 - bits) if bits else None

    def node(prints: np.ndarray) -> tuple:
        mask, value = shared_bits(prints, np.array([0]))
        prefix = int(prints[0] >> shift) if bits else 0
        shared = int(mask.view(np.int64)[0]), int(value.view(np.int64)[0])
        return prefix, int(prints[0].view(np.int64)), *shared, len(prints), prints.tobytes()

    def rows(prints: np.ndarray, final: bool) -> tuple[list[tuple], np.ndarray]:
        prefixes = prints >> shift if bits else np.zeros(len(prints), np.uint64)
        out, at = [], 0
        while at < len(prints):
            same = int(np.searchsorted(prefixes[at:] != prefixes[at], True)) if prefixes[-1] != prefixes[at] else len(prints) - at
            end = at + min(same, LEAF)
            if end == len(prints) and not final and end - at < LEAF:
                break
            out.append(node(prints[at:end]))
            at = end
        return out, prints[at:]

    def table(found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*found), kinds)], ["prefix", "node", "mask", "value", "n", "prints"]
        )

    rest = np.zeros(0, np.uint64)
    for batch in batches:
        prints = np.asarray(batch.column("fp")).view(np.uint64)
        found, rest = rows(np.concatenate([rest, prints]), False)
        if found:
            yield table(found)
    found, _ = rows(rest, True)
    if found:
        yield table(found)


def spanning_links(a: np.ndarray, b: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links between entries of two leaves (or one with itself) that connect whatever pairs
    within `distance` connect. Groups whose shared patterns differ by more are skipped."""
    same = len(a) == len(b) and bool((a == b).all())
    prints = a if same else np.concatenate([a, b])
    label, shift = np.arange(len(prints)), 0 if same else len(a)
    starts_a, starts_b = np.arange(0, len(a), GROUP), np.arange(0, len(b), GROUP)
    (mask_a, value_a), (mask_b, value_b) = shared_bits(a, starts_a), shared_bits(b, starts_b)
    links = []
    for i, start in enumerate(starts_a):
        apart = np.bitwise_count((value_b ^ value_a[i]) & mask_b & mask_a[i])
        left = np.flatnonzero(apart <= distance)
        if same:
            left = left[left >= i]
        if not len(left):
            continue
        places = (left[:, None] * GROUP + np.arange(GROUP)).ravel()
        places = places[places < len(b)]
        rows = a[start : start + GROUP]
        near = np.bitwise_count(rows[:, None] ^ b[places][None, :]) <= distance
        near &= label[start : start + len(rows), None] != label[places + shift][None, :]
        for r in np.flatnonzero(near.any(axis=1)):
            x = start + r
            others = places[near[r]] + shift
            labels, first = np.unique(label[others], return_index=True)
            for other, at in zip(labels, first):
                if label[x] != other:
                    links.append((int(prints[x]), int(prints[others[at]])))
                    label[label == other] = label[x]
    return links


def link_leaves(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for left, right in zip(batch.column("left"), batch.column("right")):
            a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (left, right))
            links = np.array(spanning_links(a, b, distance), np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(links[:, 0].copy()), pa.array(links[:, 1].copy())], ["a", "b"])


def near_masks(bits: int, distance: int) -> list[int]:
    """All masks of `bits` bits with up to `distance` ones; their number is bounded by the bits."""
    return [sum(1 << i for i in chosen) for k in range(min(bits, distance) + 1) for chosen in combinations(range(bits), k)]


def link_tasks(pairs: int, entries: int | None, cells: float | None) -> int:
    """Tasks for so many pairs of nodes, the entries in them and the pairs of entries to compare."""
    return max(1, math.ceil(max(pairs / PAIRS_PER_TASK, (entries or 0) / ENTRIES_PER_TASK, (cells or 0) / CELLS_PER_TASK)))


def link_fingerprints(prints: DataFrame, distance: int, shelf: Shelf) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints `fp` within `distance` bits."""
    n = prints.count()
    bits = max(0, min(MOST_PREFIX_BITS, round(math.log2(max(1, n) / LEAF))))

    @F.pandas_udf("long")
    def rank(fp):
        import pandas as pd

        # flip the top bit so that signed order is the order of unsigned ranks
        ranks = gray_rank(fp.to_numpy().view(np.uint64)) ^ np.uint64(1 << 63)
        return pd.Series(ranks.view(np.int64))

    tasks = max(1, math.ceil(n / (16 * LEAF)))
    leaves = shelf.put(
        prints.withColumn("rank", rank("fp"))
        .repartitionByRange(tasks, "rank")
        .sortWithinPartitions("rank")
        .select("fp")
        .mapInArrow(lambda it: build_leaves(it, bits), "prefix long, node long, mask long, value long, n long, prints binary"),
        "leaves",
    )
    summary = leaves.select("prefix", "node", "mask", "value", "n")
    one = summary.select(*(F.col(c).alias(f"l_{c}") for c in summary.columns))
    reached = one.withColumn("flip", F.explode(F.lit(near_masks(bits, distance))))
    pairs = (
        reached.withColumn("prefix", F.col("l_prefix").bitwiseXOR(F.col("flip")))
        .join(summary, "prefix")
        .filter("l_node <= node")
        .filter(f"bit_count((l_value ^ value) & l_mask & mask) <= {distance}")
        .select("l_node", "node", "l_n", "n")
    )
    pairs = shelf.put(pairs, "pairs")
    spread = link_tasks(*pairs.agg(F.count("*"), F.sum(F.col("l_n") + F.col("n")), F.sum(F.expr("double(l_n) * n"))).first())
    payload = leaves.select("node", "prints")
    joined = (
        pairs.select("l_node", "node").join(payload.select(F.col("node").alias("l_node"), F.col("prints").alias("left")), "l_node")
        .join(payload.withColumnRenamed("prints", "right"), "node")
        .select("node", "l_node", "left", "right")
        .repartition(spread, "node", "l_node")
        .select("left", "right")
    )
    return joined.mapInArrow(lambda it: link_leaves(it, distance), "a long, b long")


def near_duplicates(df: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row per input row: doc_id, fingerprint, component_id."""
    shelf = Shelf(df.sparkSession, "simhash")
    return _grouped(_fingerprinted(pick(df, "doc_id", "text"), shingle, shelf), distance, shelf).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """The rows, all columns, of the smallest id per component; one of them if the id repeats."""
    shelf = Shelf(docs.sparkSession, "simhash")
    numbered = shelf.put(docs.withColumn("_row", F.monotonically_increasing_id()), "docs")
    rows = _fingerprinted(numbered.select("doc_id", "text", "_row"), shingle, shelf)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).getField("_row")
    kept = shelf.put(_grouped(rows, distance, shelf).groupBy("component").agg(first.alias("_row")).select("_row"), "kept")
    return numbered.join(kept.hint("merge"), "_row", "left_semi").drop("_row")


def _fingerprinted(docs: DataFrame, shingle: int, shelf: Shelf) -> DataFrame:
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.drop("text").schema)
    return shelf.put(docs.mapInArrow(lambda it: fingerprint_rows(it, shingle), f"{kinds}, fp long"), "rows")


def _grouped(rows: DataFrame, distance: int, shelf: Shelf) -> DataFrame:
    """Adds component and component_id."""
    prints = shelf.put(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    links = shelf.put(link_fingerprints(prints.select("fp"), distance, shelf), "found")
    names = components(links, shelf)
    grouped = prints.join(names, prints["fp"] == names["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = grouped.join(least, "component").select("fp", "component", "component_id")
    return rows.join(ids, "fp")
