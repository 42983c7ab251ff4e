"""Line deduplication over levelled sorted runs of line hashes.

A run is a table (h1, h2, n), bucketed and sorted by hash: in how many documents of its batches a line
occurs. Every batch of documents gives one run at level 0. Its lines, counted by one shuffle into the
buckets of the runs, merge-anti-join the runs there are and leave out what these already settle, i.e. show
in `threshold` documents; then its own run is added. As soon as a level holds `fan_in` runs they are
compacted: merged into one run of the next level. All runs have the same buckets, so anti-joins and merges
shuffle no run again. A line is thus rewritten once per level, and a batch compares itself with few
runs. In the end one merge of all runs names the frequent lines, and a second pass drops these from all
documents; the rows of a very common line are dealt over tasks.

There are as many batches as documents ask for, `docs_per_batch` each; a batch is a folder of its own, so
none reads the lines of another.

Hashes have 128 bits and are computed from a line's key: the line stripped of ASCII white
space with A-Z lower-cased. Lines with an empty key are never dropped while `least_length` is
at least 1.

Defined cases: a null or empty text is one empty line. Every row is a document, so a repeated
row counts again; a null id is an id like any other. Rows equal in id and text get equal
results. An empty table gives no rows. Other columns are left out."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import SPACE_CHARS, Shelf, pick, text_chunks
from waybill.operators.skew import split_join

ASCII_SPACES = SPACE_CHARS.encode()


class LineRuns:
    """The runs, level by level. They are tables of the session's catalog while they are needed."""

    def __init__(self, shelf: Shelf, threshold: int, fan_in: int):
        self.shelf, self.threshold, self.fan_in = shelf, threshold, fan_in
        self.spark = shelf.spark
        # a shuffle by hash then deals lines into the buckets themselves
        self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, DataFrame]]] = [[]]
        self.made = 0

    def _table(self, name: str) -> str:
        return f"{self.shelf.root.rsplit('/', 1)[-1]}_{name}".replace("-", "_")

    def _write(self, counts: DataFrame, level: int) -> None:
        self.made += 1
        name = f"run-{level}-{self.made}"
        writer = counts.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
        writer.option("compression", "zstd").option("path", f"{self.shelf.root}/{name}").saveAsTable(self._table(name))
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append((name, self.spark.table(self._table(name))))

    def _drop(self, runs: list[tuple[str, DataFrame]]) -> None:
        for name, _ in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(name)}")
            self.shelf.drop(name)

    def merged(self, runs: list[tuple[str, DataFrame]]) -> DataFrame:
        """One run from several, bucket by bucket."""
        together = runs[0][1]
        for _, run in runs[1:]:
            both = together.join(run.withColumnRenamed("n", "more").hint("merge"), ["h1", "h2"], "full")
            sum_ = F.coalesce("n", F.lit(0)) + F.coalesce("more", F.lit(0))
            together = both.select("h1", "h2", sum_.cast("long").alias("n"))
        return together

    def runs(self) -> list[tuple[str, DataFrame]]:
        return [run for level in self.levels for run in level]

    def unsettled(self, lines: DataFrame) -> DataFrame:
        """h1, h2, n of the batch's lines that no run settles."""
        counts = lines.groupBy("h1", "h2").agg(F.count("*").alias("n"))
        for _, run in self.runs():
            settled = run.filter(F.col("n") >= self.threshold).select("h1", "h2")
            counts = counts.join(settled.hint("merge"), ["h1", "h2"], "left_anti")
        return counts

    def add(self, lines: DataFrame) -> None:
        """A batch: (h1, h2), once per document that has the line."""
        self._write(self.unsettled(lines), 0)
        level = 0
        while len(self.levels[level]) >= self.fan_in:
            full, self.levels[level] = self.levels[level], []
            self._write(self.merged(full), level + 1)
            self._drop(full)
            level += 1

    def frequent(self) -> DataFrame:
        """h1, h2, n of the lines in `threshold` documents or more, stored; the runs go."""
        found = self.shelf.put(self.merged(self.runs()).filter(F.col("n") >= self.threshold), "frequent")
        self._drop(self.runs())
        self.levels = [[]]
        return found


def hash_lines(batches: Iterator[pa.RecordBatch], least_length: int) -> Iterator[pa.RecordBatch]:
    """One row per line that has a key of `least_length` code points: the document's row hash,
    the line's number and hash, and whether the document has this line for the first time."""
    names = ["r1", "r2", "pos", "h1", "h2", "first"]
    for batch in batches:
        for part in text_chunks(batch):
            out: list[list] = [[] for _ in names]
            for r1, r2, text in zip(*(part.column(c).to_pylist() for c in ("r1", "r2", "text"))):
                seen = set()
                for pos, line in enumerate((text or "").encode().split(b"\n")):
                    key = line.strip(ASCII_SPACES).lower()
                    if len(key) < least_length or len(key.decode()) < least_length:
                        continue
                    digest = xxhash.xxh3_128_digest(key)
                    for column, value in zip(
                        out,
                        (
                            r1,
                            r2,
                            pos,
                            int.from_bytes(digest[:8], "little", signed=True),
                            int.from_bytes(digest[8:], "little", signed=True),
                            digest not in seen,
                        ),
                    ):
                        column.append(value)
                    seen.add(digest)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)


def drop_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_chunks(batch):
            n_lines, n_dropped, kept, digests = [], [], [], []
            for text, dropped in zip(part.column("text").to_pylist(), part.column("dropped").to_pylist()):
                lines = (text or "").split("\n")
                n_lines.append(len(lines))
                gone = set(dropped or ())
                n_dropped.append(len(gone))
                rest = "\n".join(line for i, line in enumerate(lines) if i not in gone) if gone else text or ""
                kept.append(rest)
                digests.append(hashlib.sha256(rest.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(n_lines, pa.int64()),
                    pa.array(n_dropped, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(kept, pa.string()),
                ],
                ["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept"],
            )


def dedup_lines(
    df: DataFrame,
    threshold: int = 10,
    least_length: int = 1,
    docs_per_batch: int = 1_000_000,
    least_batches: int = 4,
    fan_in: int = 2,
) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256, kept: texts without the lines that occur in
    `threshold` documents or more. Documents go in batches by hash, `least_batches` at least."""
    spark = df.sparkSession
    shelf = Shelf(spark, "lines")
    batches = max(least_batches, -(-df.count() // docs_per_batch))
    docs = pick(df, "doc_id", "text").select(
        "doc_id",
        "text",
        F.xxhash64("doc_id", "text").alias("r1"),
        F.xxhash64("text", "doc_id", F.lit(1)).alias("r2"),
    )
    hashed = docs.select("r1", "r2", "text").mapInArrow(
        lambda it: hash_lines(it, least_length),
        "r1 long, r2 long, pos int, h1 long, h2 long, first boolean",
    )
    dealt = hashed.withColumn("batch", F.pmod("r2", F.lit(batches)).cast("int"))
    dealt.write.option("compression", "zstd").partitionBy("batch").parquet(f"{shelf.root}/lines")
    lines = spark.read.schema(dealt.schema).parquet(f"{shelf.root}/lines")
    runs = LineRuns(shelf, threshold, fan_in)
    for batch in range(batches):
        runs.add(lines.filter((F.col("batch") == batch) & F.col("first")).select("h1", "h2"))
    frequent = runs.frequent()
    place = F.xxhash64("r1", "r2", "pos")
    dropped = (
        split_join(lines, frequent.select("h1", "h2"), ["h1", "h2"], "left_semi", counts=frequent, deal_by=place)
        .groupBy("r1", "r2")
        .agg(F.collect_set("pos").alias("dropped"))
    )
    return (
        docs.join(dropped, ["r1", "r2"], "left")
        .select("doc_id", "text", "dropped")
        .mapInArrow(
            drop_lines,
            f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_lines long, n_dropped long, "
            "kept_sha256 string, kept string",
        )
    )
