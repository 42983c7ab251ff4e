"""Exact top-k by inner product: a Voronoi kNN join.

Largest inner products are nearest neighbours once every data vector x gets one more coordinate
sqrt(M^2 - |x|^2), M being the largest length, and every query a zero. Pivots (a bounded,
hash-ordered pick of the vectors; they steer the work, never the result) divide queries and
data into cells. Summaries per cell, namely the radius of the queries and the k+1 shortest
distances of different ids of the data to the pivot, give a distance within which every query of a cell surely
has k neighbours. By the triangle inequality a cell of queries then needs only those data whose
distance to their own pivot lies in a range; blocks of data (runs by distance to the pivot)
outside of it are not copied to it. A task takes one block of queries and its blocks of data, the nearest
first, with a matrix product each, and keeps the k best so far; a block that is farther from the queries'
pivot than their k-th best permits is passed by. So what a task returns is k rows per query.

Blocks hold up to BLOCK vectors whatever the cell, so a cell with a third of all vectors, or
one vector that is everywhere, is many blocks. Where there are fewer blocks of queries than tasks, the data
of each are dealt over several tasks, as they are where the data are more than one task should read. The driver sees pivots and summaries only: at
most `most_pivots` cells.

Defined cases: vectors that are null or have null or non-finite components take no part, nor
do rows without an id. Vectors of unequal length are filled up with zeros. Rows that have the
query's id are its own and no candidates. Repeated rows are candidates each. Scores are computed in whole
numbers of any size where long ones might not hold them; a score beyond a long is the largest or smallest
long. A component whose 64-fold is no finite number any more counts as non-finite. An empty table gives no
rows. Other columns are left out."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.common import Shelf, pick

BLOCK = 4096
QUERIES_AT_ONCE = 256
#: Data that one block of queries meets in one task.
BYTES_PER_PART = 64 << 20
SCALE = 64
#: Components below this are stored in four bytes.
SMALL = 1 << 31
LEAST_LONG, MOST_LONG = -(1 << 63), (1 << 63) - 1


def quantize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that take part: id, whole-number components as bytes, their number, squared length."""
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for vec_id, values in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist()):
            if vec_id is None or values is None or any(v is None for v in values):
                continue
            x = np.asarray(values, np.float64)
            if not np.isfinite(x).all():
                continue
            with np.errstate(over="ignore"):
                x = np.floor(SCALE * x)
                square = float(x @ x)
            if not np.isfinite(x).all():
                continue
            stored = x.astype("<i4" if np.abs(x).max(initial=0) < SMALL else "<f8")
            for column, value in zip(out, (vec_id, stored.tobytes(), len(x), square)):
                column.append(value)
        kinds = [pa.int64(), pa.binary(), pa.int32(), pa.float64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(out, kinds)], ["vec_id", "x", "dim", "square"]
        )


def matrix(blobs: list[bytes], dims: list[int], dim: int) -> np.ndarray:
    """One vector per row, filled up with zeros."""
    out = np.zeros((len(blobs), dim), np.float64)
    for row, blob, n in zip(out, blobs, dims):
        row[:n] = np.frombuffer(blob, "<i4" if len(blob) == 4 * n else "<f8")
    return out


class Cells:
    """Pivots in the space with one more coordinate."""

    def __init__(self, pivots: np.ndarray, most_square: float):
        self.most_square = most_square
        self.pivots = self.raised(pivots, True)
        self.squares = (self.pivots**2).sum(axis=1)

    def raised(self, x: np.ndarray, data: bool) -> np.ndarray:
        gap = np.sqrt(np.maximum(self.most_square - (x**2).sum(axis=1), 0)) if data else np.zeros(len(x))
        return np.concatenate([x, gap[:, None]], axis=1)

    def nearest(self, x: np.ndarray, data: bool) -> tuple[np.ndarray, np.ndarray]:
        x = self.raised(x, data)
        squared = (x**2).sum(axis=1)[:, None] - 2 * (x @ self.pivots.T) + self.squares
        cell = squared.argmin(axis=1)
        return cell, np.sqrt(np.maximum(squared[np.arange(len(x)), cell], 0))

    def apart(self) -> np.ndarray:
        gap = self.pivots[:, None, :] - self.pivots[None, :, :]
        return np.sqrt((gap**2).sum(axis=2))


def assign(batches: Iterator[pa.RecordBatch], cells: Cells, dim: int, data: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        cell, dist = cells.nearest(matrix(batch.column("x").to_pylist(), batch.column("dim").to_pylist(), dim), data)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("row", "vec_id", "x", "dim")), pa.array(cell, pa.int32()), pa.array(dist)],
            ["row", "vec_id", "x", "dim", "cell", "dist"],
        )


def blocks(batches: Iterator[pa.RecordBatch], dim: int, size: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell and distance, packed: runs of one cell of at most `size` rows."""
    for batch in batches:
        cell = np.asarray(batch.column("cell"))
        at = 0
        while at < len(cell):
            end = min(at + size, int(np.searchsorted(cell, cell[at], side="right")))
            part = batch.slice(at, end - at)
            x = matrix(part.column("x").to_pylist(), part.column("dim").to_pylist(), dim)
            dist = np.asarray(part.column("dist"))
            most = np.abs(x).max(initial=0)
            kind = np.dtype("i1" if most < 128 else "<i4" if most < SMALL else "<f8")
            fields = {
                "cell": pa.array([int(cell[at])], pa.int32()),
                "near": pa.array([float(dist[0])]),
                "far": pa.array([float(dist[-1])]),
                "rows": pa.array([np.asarray(part.column("row")).astype("<i8").tobytes()]),
                "ids": pa.array([np.asarray(part.column("vec_id")).astype("<i8").tobytes()]),
                "width": pa.array([kind.itemsize], pa.int32()),
                "values": pa.array([x.astype(kind).tobytes()]),
            }
            yield pa.RecordBatch.from_arrays(list(fields.values()), list(fields))
            at = end


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    left = np.arange(len(scores))
    if len(scores) > k:
        left = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return left[np.lexsort((ids[left], -scores[left]))][:k]


def vectors_of(values: bytes, width: int, dim: int, kind: str) -> np.ndarray:
    """Whole numbers as floats, longs or, where those might not hold the scores, numbers of any size."""
    x = np.frombuffer(values, {1: "i1", 4: "<i4", 8: "<f8"}[width]).reshape(-1, dim)
    if kind == "any":
        return np.array([[int(v) for v in row] for row in x.tolist()], object).reshape(-1, dim)
    return x.astype(kind)


def scores_of(queries: np.ndarray, data: np.ndarray, kind: str) -> np.ndarray:
    scores = queries @ data.T
    return np.clip(scores, LEAST_LONG, MOST_LONG).astype(np.int64) if kind == "any" else scores.astype(np.int64)


class Asked:
    """A block of queries with the k best of each so far."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, kind: str):
        self.rows, self.ids, self.vectors, self.k, self.kind = rows, ids, vectors, k, kind
        self.found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(ids)
        self.square = float((vectors.astype(np.float64) ** 2).sum(axis=1).max(initial=0))

    def farthest(self, most_square: float) -> float:
        """All neighbours still wanted are within this distance of their query."""
        if any(len(scores) < self.k for scores, _ in self.found):
            return math.inf
        least = float(min(scores[-1] for scores, _ in self.found))
        # |q - x|^2 = |q|^2 + M^2 - 2 q.x in the space with one more coordinate
        within = math.sqrt(max(self.square + most_square - 2 * least, 0.0))
        return within + 1e-6 * (1 + within)

    def take(self, ids: np.ndarray, data: np.ndarray) -> None:
        for start in range(0, len(self.ids), QUERIES_AT_ONCE):
            scores = scores_of(self.vectors[start : start + QUERIES_AT_ONCE], data, self.kind)
            for i, row in enumerate(scores, start):
                old_scores, old_ids = self.found[i]
                wanted = ids != self.ids[i]
                if len(old_scores) == self.k:
                    wanted &= row >= old_scores[-1]
                others = np.flatnonzero(wanted)
                if not len(others):
                    continue
                others = others[best(row[others], ids[others], self.k)]
                all_scores, all_ids = np.append(old_scores, row[others]), np.append(old_ids, ids[others])
                kept = best(all_scores, all_ids, self.k)
                self.found[i] = all_scores[kept], all_ids[kept]

    def rows_out(self) -> pa.RecordBatch:
        sizes = [len(scores) for scores, _ in self.found]
        columns = [
            np.repeat(self.rows, sizes),
            np.repeat(self.ids, sizes),
            np.concatenate([ids for _, ids in self.found]),
            np.concatenate([scores for scores, _ in self.found]),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["row", "query_id", "vec_id", "score"])


def solve(batches: Iterator[pa.RecordBatch], dim: int, k: int, kind: str, most_square: float) -> Iterator[pa.RecordBatch]:
    """Rows by block of queries and part: first the queries, then blocks of data by falling nearness."""
    asked, at = None, None
    for batch in batches:
        for i in range(batch.num_rows):
            (row,) = batch.slice(i, 1).to_pylist()
            if (row["asked"], row["part"]) != at:
                if asked:
                    yield asked.rows_out()
                asked, at = None, (row["asked"], row["part"])
            ids = np.frombuffer(row["ids"], "<i8")
            if row["rows"] is not None:
                vectors = vectors_of(row["values"], row["width"], dim, kind)
                asked = Asked(np.frombuffer(row["rows"], "<i8"), ids, vectors, k, kind)
            elif not row["gap"] > asked.farthest(most_square):
                asked.take(ids, vectors_of(row["values"], row["width"], dim, kind))
    if asked:
        yield asked.rows_out()


def needed(
    cells: Cells, radius: dict[int, float], shortest: dict[int, list[float]], k: int, ids: dict[int, list[int]] | None = None
) -> list[tuple]:
    """(query cell, data cell, least, most, apart, radius): the distances to the data pivot that matter, that
    between the pivots, and the radius of the queries.

    `ids` are those of the data in `shortest`; without them every entry is an id of its own."""
    apart = cells.apart()
    pairs = []
    cell = np.repeat(list(shortest), [len(ds) for ds in shortest.values()]).astype(np.int64)
    dist = np.array([d for ds in shortest.values() for d in ds], np.float64)
    owner = np.array([x for j in shortest for x in ids[j]], np.int64) if ids else np.arange(len(dist))
    for i, r in radius.items():
        reach = r + apart[i, cell] + dist
        order = np.argsort(reach, kind="stable")
        reach = reach[order][np.sort(np.unique(owner[order], return_index=True)[1])]
        # k+1 ids with a row within this distance of every query of the cell, one of them perhaps its own
        within = float(reach[k]) if len(reach) > k else math.inf
        within += 1e-6 * (1 + within)
        for j in shortest:
            pairs.append((i, j, float(apart[i, j] - r - within), float(apart[i, j] + r + within), float(apart[i, j]), float(r)))
    return pairs


def top_k(df: DataFrame, modulus: int = 20, k: int = 20, most_pivots: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score. Queries: ids divisible by `modulus`."""
    spark = df.sparkSession
    shelf = Shelf(spark, "knn")
    source = pick(df, "vec_id", "embedding").select(F.col("vec_id").cast("long"), "embedding")
    quantized = source.mapInArrow(quantize, "vec_id long, x binary, dim int, square double")
    vectors = shelf.put(quantized.withColumn("row", F.monotonically_increasing_id()), "vectors")
    n, dim, most_square = vectors.agg(F.count("*"), F.max("dim"), F.max("square")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not n:
        return empty
    n_pivots = min(most_pivots, max(1, math.ceil(math.sqrt(n) / 8)))
    if not math.isfinite(most_square * 4):
        n_pivots, most_square = 1, math.inf  # distances say nothing: one cell, compared with all data
    picked = vectors.select("x", "dim", F.xxhash64("vec_id", "row").alias("h")).orderBy("h").limit(n_pivots).collect()
    cells = Cells(matrix([bytes(r["x"]) for r in picked], [r["dim"] for r in picked], dim), most_square)
    kind = "row long, vec_id long, x binary, dim int, cell int, dist double"
    base = vectors.select("row", "vec_id", "x", "dim")
    data = shelf.put(base.mapInArrow(lambda it: assign(it, cells, dim, True), kind), "data")
    queries = shelf.put(
        base.filter(F.col("vec_id") % modulus == 0).mapInArrow(lambda it: assign(it, cells, dim, False), kind), "queries"
    )
    radius = {r["cell"]: r["r"] for r in queries.groupBy("cell").agg(F.max("dist").alias("r")).collect()}
    # a query's own rows are none of its neighbours, however many they are, so ids are counted and not rows
    nth = F.row_number().over(Window.partitionBy("cell").orderBy("dist", "vec_id"))
    by_id = data.groupBy("cell", "vec_id").agg(F.min("dist").alias("dist"))
    shortest: dict[int, list[float]] = {}
    ids: dict[int, list[int]] = {}
    for r in by_id.select("cell", "vec_id", "dist", nth.alias("nth")).filter(F.col("nth") <= k + 1).collect():
        shortest.setdefault(r["cell"], []).append(r["dist"])
        ids.setdefault(r["cell"], []).append(r["vec_id"])
    if not radius:
        return empty
    pairs = spark.createDataFrame(needed(cells, radius, shortest, k, ids), "q_cell int, cell int, least double, most double, apart double, radius double")

    def packed(rows: DataFrame, count: int, size: int) -> DataFrame:
        ordered = rows.repartitionByRange(max(1, math.ceil(count / (4 * BLOCK))), "cell", "dist", "vec_id", "row")
        return ordered.sortWithinPartitions("cell", "dist", "vec_id", "row").mapInArrow(
            lambda it: blocks(it, dim, size),
            "cell int, near double, far double, rows binary, ids binary, width int, values binary",
        )

    data_blocks = shelf.put(packed(data, n, BLOCK), "data-blocks").drop("rows")
    query_blocks = shelf.put(
        packed(queries, n // modulus, BLOCK // 4).withColumn("asked", F.monotonically_increasing_id()), "query-blocks"
    )
    # few blocks of queries: the data of each go to several tasks
    tasks = 2 * spark.sparkContext.defaultParallelism
    parts = max(1, math.ceil(tasks / max(1, query_blocks.count())), math.ceil(n * dim * 4 / BYTES_PER_PART))
    # one block of queries meets the blocks of data it needs, and no others; payloads join last
    gap = F.greatest(F.col("near") - F.col("apart") - F.col("radius"), F.col("apart") - F.col("radius") - F.col("far"), F.lit(0.0))
    wanted = (
        F.broadcast(pairs)  # at most most_pivots squared rows
        .join(query_blocks.select("asked", F.col("cell").alias("q_cell")), "q_cell")
        .join(data_blocks, "cell")
        .filter("NOT (near > most OR far < least)")
        .select(
            "asked",
            F.pmod(F.xxhash64("cell", "near", "ids"), F.lit(parts)).cast("int").alias("part"),
            gap.alias("gap"),
            F.lit(None).cast("binary").alias("rows"),
            "ids",
            "width",
            "values",
        )
    )
    asked = query_blocks.select(
        "asked",
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
        F.lit(-1.0).alias("gap"),
        "rows",
        "ids",
        "width",
        "values",
    )
    work = (
        asked.unionByName(wanted)
        .repartition(max(tasks, query_blocks.count() * parts), "asked", "part")
        .sortWithinPartitions("asked", "part", "gap")
    )
    bound = dim * max(1.0, most_square)
    numbers = "float64" if bound < 1 << 53 else "int64" if bound < 1 << 62 else "any"
    found = work.mapInArrow(
        lambda it: solve(it, dim, k, numbers, most_square), "row long, query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
