"""Source divergence audit by count-level bitmaps.

A language keeps the terms that occur in enough of its documents. Over these, every group (a source
within a language) has a smoothed term distribution in integers, and two groups diverge by the sum of
the absolute differences. A group's difference to another at a term depends on the two counts only, so
per group and count a bitset says which terms have this count there. AND and popcount of two
bitsets give the number of terms in the joint cell of two counts, which is multiplied by the
difference of that cell; counts of equal probability are one level. A group's terms of count zero are the
complement of all its bitsets.

Bitsets are kept as words of 64 terms. Terms are numbered by language and falling frequency, so the terms of
a word have similar counts and a group has few levels in it. Words are dealt into chunks, and sources into
tiles, so that a task compares at most two tiles over one chunk; what it returns is one partial sum
per pair of sources. So no task holds a language, and the pairs are those of the result.

Counting: terms are counted per task in a dictionary of bounded size before they are shuffled; one shuffle by
language and term serves the counts per group, the document frequency and the totals of the language. Terms
are numbered within range partitions, without a global window.

Defined cases: null text, language and source count as ''. Every row is a document. A group without
kept terms diverges like any other, with count zero everywhere; a language without kept terms has pairs of
value 0. A language with one source has no pairs. An empty table gives no rows. Other columns are left
out."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.common import Shelf, pick, text_chunks

#: ASCII letters in lower case and all bytes beyond ASCII stay, everything else parts terms.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))
SEGMENT = 1 << 20
ENTRIES_HELD = 400_000
ROWS_OUT = 50_000
ONE = 1_000_000_000
PSEUDO = 5
BITMAPS_PER_CHUNK = 20_000
SOURCES_PER_TILE = 64


def term_parts(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, about SEGMENT bytes at a time."""
    parted, start = text.encode().translate(TERM_BYTES), 0
    while start < len(parted):
        stop = parted.find(b" ", start + SEGMENT)
        stop = len(parted) if stop < 0 else stop
        yield parted[start:stop].split()
        start = stop


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, n, docs: occurrences and documents, counted as far as memory allows, and one
    row without a term for each group."""
    names = ["lang", "source", "term", "n", "docs"]
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (times, docs) in held.items():
            rows = [(None, 0, 0), *((term.decode(), n, docs[term]) for term, n in times.items())]
            for i in range(0, len(rows), ROWS_OUT):
                part = rows[i : i + ROWS_OUT]
                terms, n, in_docs = zip(*part)
                columns = [[lang] * len(part), [source] * len(part), terms, n, in_docs]
                kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
        held.clear()

    for batch in batches:
        for part in text_chunks(batch):
            for lang, source, text in zip(*(part.column(c).to_pylist() for c in ("lang", "source", "text"))):
                times, docs = held.setdefault((lang or "", source or ""), (Counter(), Counter()))
                distinct: set[bytes] = set()
                for terms in term_parts(text or ""):
                    times.update(terms)
                    distinct.update(terms)
                docs.update(distinct)
            if sum(len(times) for times, _ in held.values()) > ENTRIES_HELD:
                yield from flush()
    yield from flush()


def probability(n: str, total: str, terms: str) -> Column:
    """1 + floor(ONE * (n + PSEUDO) / (total + PSEUDO * terms)), exactly; NULL without terms."""
    above = f"CAST({n} + {PSEUDO} AS DECIMAL(20, 0)) * CAST({ONE} AS DECIMAL(10, 0))"
    below = f"CAST(nullif({total} + {PSEUDO} * {terms}, 0) AS DECIMAL(20, 0))"
    return F.expr(f"1 + ({above}) div {below}")


def levels_of(words: np.ndarray, p: np.ndarray, mask: np.uint64, p_none: int) -> tuple[np.ndarray, np.ndarray]:
    """A group's bitsets in one word with the complement as its level of count zero."""
    none = mask & ~np.bitwise_or.reduce(words) if len(words) else mask
    return np.append(words, none), np.append(p, p_none)


def compare_tiles(key: tuple, table: pa.Table) -> pa.Table:
    """Partial sums for all pairs of a source of one tile and a source of the other, over a chunk."""
    lang, _, low, high = (k.as_py() for k in key)
    sources, tiles, blocks = (table.column(c).to_pylist() for c in ("source", "tile", "block"))
    p, words = table.column("p").to_numpy(), table.column("word").to_numpy().view(np.uint64)
    known = sorted((tile != low, source, int(p[i])) for i, (source, tile) in enumerate(zip(sources, tiles)) if blocks[i] is None)
    split = sum(not other for other, _, _ in known)
    masks = {block: words[i] for i, block in enumerate(blocks) if sources[i] is None}
    cells: dict[int, dict[str, list[int]]] = {block: {} for block in masks}
    for i, (source, block) in enumerate(zip(sources, blocks)):
        if source is not None and block is not None:
            cells[block].setdefault(source, []).append(i)
    values = np.zeros((len(known), len(known)), np.int64)
    for block, mask in masks.items() if split else ():
        levels = []
        for _, source, p_none in known:
            at = cells[block].get(source, [])
            levels.append(levels_of(words[at], p[at], mask, p_none))
        sizes = [len(w) for w, _ in levels]
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
        all_words, all_p = (np.concatenate(parts) for parts in zip(*levels))
        for i, (own_words, own_p) in enumerate(levels[:split]):
            rest = i + 1 if low == high else split
            if rest == len(known):
                continue
            begin = starts[rest]
            joint = np.bitwise_count(own_words[:, None] & all_words[None, begin:]).astype(np.int64)
            summed = (joint * np.abs(own_p[:, None] - all_p[None, begin:])).sum(axis=0)
            values[i, rest:] += np.add.reduceat(summed, starts[rest:] - begin)
    found = [
        (*sorted((known[i][1], known[j][1])), values[i, j])
        for i in range(split)
        for j in range(i + 1 if low == high else split, len(known))
    ]
    first, second, sums = zip(*found) if found else ((), (), ())
    columns = ([lang] * len(found), first, second, sums)
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "a", "b", "value"])


def pair_sums(bitmaps: DataFrame, masks: DataFrame, groups: DataFrame, chunks: int, tiles: int) -> DataFrame:
    """lang, a, b, value for each pair a < b of a language's sources."""
    tile = F.pmod(F.xxhash64("source"), F.lit(tiles)).cast("int")
    chunk = F.pmod(F.xxhash64("block"), F.lit(chunks)).cast("int")
    every_tile = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))
    nothing = F.lit(0).cast("long")
    cells = bitmaps.select("lang", "source", tile.alias("tile"), "block", chunk.alias("chunk"), "p", "word")
    members = groups.select(
        "lang",
        "source",
        tile.alias("tile"),
        F.lit(None).cast("long").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
        F.coalesce("p_none", nothing).alias("p"),
        nothing.alias("word"),
    )
    in_pairs = cells.unionByName(members).withColumn("other", every_tile)
    whole = masks.select(
        "lang",
        F.lit(None).cast("string").alias("source"),
        every_tile.alias("tile"),
        "block",
        chunk.alias("chunk"),
        nothing.alias("p"),
        "word",
    ).withColumn("other", F.explode(F.sequence(F.col("tile"), F.lit(tiles - 1))))
    return (
        in_pairs.unionByName(whole)
        .withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")})
        .drop("other")
        .groupBy("lang", "chunk", "low", "high")
        .applyInArrow(compare_tiles, "lang string, a string, b string, value long")
        .groupBy("lang", "a", "b")
        .agg(F.sum("value").alias("value"))
    )


def audit(df: DataFrame, least_documents: int = 30, top_terms: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source is from the others of its language
    (`pair`), and its most over-represented terms against the language (`term`)."""
    spark = df.sparkSession
    shelf = Shelf(spark, "divergence")
    counted = pick(df, "text", "lang", "source").mapInArrow(
        count_terms, "lang string, source string, term string, n long, docs long"
    )
    # dealt by language and term once: the sums per group, too, need no other shuffle
    of_term = Window.partitionBy("lang", "term")
    kept = shelf.put(
        counted.repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .select("lang", "term", "source", "n", F.sum("docs").over(of_term).alias("in_docs"), F.sum("n").over(of_term).alias("lang_n"))
        .filter((F.col("in_docs") >= least_documents) | F.col("term").isNull())
        .drop("in_docs"),
        "kept",
    )
    cells = kept.filter("term IS NOT NULL")
    numbered = shelf.put(
        cells.groupBy("lang", "term")
        .agg(F.first("lang_n").alias("lang_n"))
        .repartitionByRange("lang", F.desc("lang_n"), "term")
        .sortWithinPartitions("lang", F.desc("lang_n"), "term")
        .select("lang", "term", "lang_n", F.monotonically_increasing_id().alias("id")),
        "terms",
    )
    langs = numbered.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    groups = shelf.put(
        totals.join(langs, "lang", "left")
        .withColumns({"terms": F.coalesce("terms", zero), "lang_total": F.coalesce("lang_total", zero)})
        .withColumn("p_none", probability("0", "total", "terms")),
        "groups",
    )
    rated = shelf.put(
        cells.join(numbered.select("lang", "term", "id"), ["lang", "term"])
        .join(groups.drop("p_none"), ["lang", "source"])
        .select(
            "lang",
            "source",
            "term",
            F.shiftright("id", 6).alias("block"),
            F.expr("shiftleft(1L, CAST(id & 63 AS INT))").alias("bit"),
            probability("n", "total", "terms").alias("p"),
            probability("lang_n", "lang_total", "terms").alias("q"),
        ),
        "rated",
    )
    bitmaps = shelf.put(rated.groupBy("lang", "source", "block", "p").agg(F.bit_or("bit").alias("word")), "bitmaps")
    masks = bitmaps.groupBy("lang", "block").agg(F.bit_or("word").alias("word"))
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    chunks = max(1, math.ceil(bitmaps.count() / BITMAPS_PER_CHUNK))
    sums = pair_sums(bitmaps, masks, groups, chunks, max(1, math.ceil(most / SOURCES_PER_TILE)))
    ordered = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    both_ways = F.explode(
        F.array(*(F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in (("a", "b"), ("b", "a"))))
    )
    pairs = sums.select("lang", both_ways.alias("pair"), "value").select(
        "lang", "pair.source", F.lit("pair").alias("part"), "pair.item", "value"
    )
    terms = rated.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")
    )
    rank = F.row_number().over(ordered)
    return pairs.withColumn("rank", rank).unionByName(
        terms.withColumn("rank", rank).filter(F.col("rank") <= top_terms)
    )
