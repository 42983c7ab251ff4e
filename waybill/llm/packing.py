"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of tokens; each window (a sequence of `length` tokens) serves all
queues in turn, each with its target share of the window, and what a queue is owed in
fractions of a token, or got too early, is carried to the next window. Shares are the shares
of the corpus, so all queues end together and every token is packed. The `own_queues` - 1 sources with
most rows have a queue each; the others, however many, share the last one, in which their documents
stand in the order in which a round-robin over these sources has them due: a document whose middle
is at a share x of its source's tokens comes at x.

Carried deficits are not handed from task to task. Token j of a queue of T_s tokens falls due
at the time (j + 1/2) / T_s, and the first n tokens of the output are the n that fall due first,
larger queues first at the same time. So what queue s was served is a function of n alone that
never falls, for any number of queues, and any partition can begin at any window with the
exact deficits of that point. Driver and tasks hold one number per queue, of `own_queues` at most.

Plan: one pass tokenizes and stages ids with each document's place in its queue within the
task; sums per task and queue give the offsets; a second pass cuts. Texts never move.

Defined cases: a null or empty text is the end id alone. Null ids and repeated rows are rows
like any other; a null source is a queue of its own. An empty table gives no rows. Other
columns are left out."""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.common import SPACE_CHARS, Shelf, pick, text_chunks, worker_cache
from waybill.operators.numbering import with_running_sums

WORDS_KEPT = 500_000
CORES_KEPT = 600_000
ENDINGS = ".,;:!?"
# fixed values: how a tokenizer that may be asked word by word normalises and splits, as it describes itself
WORDWISE_NORMALIZER = r'Sequence(normalizers=[NFC(), Replace(pattern=Regex("\s+"), content=" "), Lowercase()])'
WORDWISE_SPLIT = (
    r"""Sequence(pretokenizers=[Split(pattern=Regex("'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"), """
    "behavior=Removed, invert=True), ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=False)])"
)
BROADCAST_ROWS = 200_000
WINDOWS_PER_BLOCK = 256
CELLS_PER_BLOCK = 1 << 15
OWN_QUEUES = 1024


class Cores(dict):
    """Ids of what stands between white space and punctuation, as bytes; encoded when asked for
    the first time. Emptied when it is full."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        # the letters that stand for bytes in the vocabulary: printable ones for themselves
        self.letters = {b: b for b in plain} | {b: 256 + i for i, b in enumerate(others)}

    def __missing__(self, core: str) -> bytes:
        if core.isalpha() and (core.isascii() or max(core) < "\u0130"):
            # composed lower-case letters are one piece before the merges
            low = core.encode().decode("latin-1").translate(self.letters)
            ids = [token.id for token in self.tokenize(low)]
        else:
            ids = self.tokenizer.encode(core, add_special_tokens=False).ids
        if len(self) >= CORES_KEPT:
            self.clear()
        found = self[core] = array("I", ids).tobytes()
        return found


class Words(dict):
    """Ids of words. A word is its core, in lower case as the tokenizer does it, and punctuation."""

    def __init__(self, path: str):
        self.cores = Cores(path)

    def __missing__(self, word: str) -> bytes:
        cores = self.cores
        if "<|" in word:  # strings of special tokens
            found = cores[word]
        else:
            low = word.lower() if word.isascii() or max(word) < "\u0130" else word
            core = low.rstrip(ENDINGS)
            parted = core[-1:].isalnum() and core[-1] < "\u0130"  # later letters may become several
            found = cores[core] + cores[low[len(core) :]] if parted else cores[low]
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = found
        return found


def wordwise(tokenizer) -> bool:
    """Whether a text's ids are those of its words, as `Words` takes them apart."""
    return (
        str(tokenizer.normalizer) == WORDWISE_NORMALIZER
        and str(tokenizer.pre_tokenizer) == WORDWISE_SPLIT
        and tokenizer.model.end_of_word_suffix == "</w>"
    )


def token_bytes(path: str):
    """A function from texts to their ids as little-endian 32-bit numbers.

    A tokenizer that drops white space, never joins what white space separates, and splits letters
    from punctuation is asked for unknown words only. Any other encodes whole texts."""
    held = worker_cache("packing " + path)
    if not held:
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        held["whole"] = None if wordwise(whole) else whole
        held["words"] = Words(path)
    if held["whole"]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark owns the cores
        encode_all = held["whole"].encode_batch
        return lambda texts: [array("I", e.ids).tobytes() for e in encode_all(texts, add_special_tokens=False)]
    look_up = held["words"].__getitem__

    def encode(texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            if text.isascii() and "<|" not in text:
                text = text.lower()  # fewer words to know; the tokenizer does the same
            for space in SPACE_CHARS[1:]:
                text = text.replace(space, " ")
            out.append(b"".join(map(look_up, text.split(" "))))
        return out

    return encode


def stage_ids(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int, queue_of: dict
) -> Iterator[pa.RecordBatch]:
    task, encode, end = TaskContext.get().partitionId(), token_bytes(path), np.array([end_id], "<u4").tobytes()
    rest, so_far = len(queue_of), {}
    for batch in batches:
        for part in text_chunks(batch):
            blobs = [b + end for b in encode([t or "" for t in part.column("text").to_pylist()])]
            queues, starts, counts, shared = [], [], [], []
            for source, blob in zip(part.column("source").to_pylist(), blobs):
                queue = queue_of.get(source, rest)
                n = len(blob) // 4
                queues.append(queue)
                starts.append(so_far.get(queue, 0))
                counts.append(n)
                shared.append(None if queue < rest else "" if source is None else f"={source}")
                so_far[queue] = so_far.get(queue, 0) + n
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([task] * len(blobs), pa.int32()),
                    pa.array(queues, pa.int32()),
                    part.column("doc_id"),
                    pa.array(starts, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(blobs, pa.binary()),
                    pa.array(shared, pa.string()),
                ],
                ["task", "queue", "doc_id", "local_start", "doc_tokens", "ids", "shared"],
            )


class RoundRobin:
    """Which tokens of which queue each window holds. Queues are served by falling size."""

    def __init__(self, totals: dict[int, int], length: int):
        self.order = sorted(totals, key=lambda q: (-totals[q], q))
        self.place = {q: i for i, q in enumerate(self.order)}
        self.total, self.length = sum(totals.values()), length
        self.sizes = np.array([totals[q] for q in self.order], np.int64)
        # arrays of a block have a row per window and a column per queue
        self.per_block = max(1, min(WINDOWS_PER_BLOCK, CELLS_PER_BLOCK // max(1, len(totals))))
        self.blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def due(self, time: np.ndarray) -> np.ndarray:
        """Tokens of each queue that fall due up to each time; never fewer at a later time."""
        return np.minimum(np.floor(time[:, None] * self.sizes + 0.5).astype(np.int64), self.sizes)

    def served(self, n: np.ndarray) -> np.ndarray:
        """Tokens of each queue among the first n; rows add up to n."""
        n, queues = np.asarray(n, np.int64), len(self.sizes) + 1
        low, high = np.maximum(n - queues, 0) / self.total * (1 - 1e-12), np.minimum((n + queues) / self.total, 1.0) * (1 + 1e-12)
        low, high = np.where(self.due(low).sum(axis=1) <= n, low, 0.0), np.where(self.due(high).sum(axis=1) > n, high, 1.0)
        # the last time (low) up to which no more than n tokens fall due, and the next one (high)
        while True:
            middle = (low + high) / 2
            if ((middle <= low) | (middle >= high)).all():
                break
            fits = self.due(middle).sum(axis=1) <= n
            low, high = np.where(fits, middle, low), np.where(fits, high, middle)
        served = self.due(low)
        room = self.due(high) - served  # due at one time: the larger queues first
        left = (n - served.sum(axis=1))[:, None]
        return served + np.minimum(np.maximum(left - (np.cumsum(room, axis=1) - room), 0), room)

    def block(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Of a block of windows: tokens served before each window and after the last, and
        where each queue begins in each window."""
        if number not in self.blocks:
            if len(self.blocks) * self.per_block * len(self.sizes) > 64 * CELLS_PER_BLOCK:
                self.blocks.clear()
            first = number * self.per_block
            ends = np.arange(first, first + self.per_block + 1, dtype=np.int64) * self.length
            served = self.served(np.minimum(ends, self.total))
            taken = np.diff(served, axis=0)
            self.blocks[number] = served, np.cumsum(taken, axis=1) - taken
        return self.blocks[number]

    def windows(self, queue: int, start: int, count: int) -> Iterator[tuple[int, int, int, int]]:
        """(window, offset, position, length) of each piece of tokens [start, start + count)."""
        i, at, end = self.place[queue], start, start + count
        number = int(int(start) * self.total // int(self.sizes[i])) // self.length // self.per_block
        while number and self.block(number)[0][0, i] > at:
            number -= 1
        while at < end:
            served, begins = self.block(number)
            column = served[:, i]
            if column[-1] <= at:
                number += 1
                continue
            w = int(np.searchsorted(column, at, side="right")) - 1
            while at < end and w < self.per_block:
                stop = min(end, int(column[w + 1]))
                if stop > at:
                    yield number * self.per_block + w, int(begins[w, i]) + at - int(column[w]), at, stop - at
                    at = stop
                w += 1
            number += 1


def cut(batches: Iterator[pa.RecordBatch], totals: dict[int, int], length: int) -> Iterator[pa.RecordBatch]:
    robin = RoundRobin(totals, length)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    for batch in batches:
        for part in text_chunks(batch, "ids"):
            out: list[list] = [[] for _ in names]
            columns = (part.column(c).to_pylist() for c in ("doc_id", "queue", "position", "doc_tokens", "ids"))
            for doc, queue, position, n, ids in zip(*columns):
                for window, offset, at, size in robin.windows(queue, position, n):
                    start = at - position
                    crc = zlib.crc32(ids[4 * start : 4 * (start + size)])
                    for column, value in zip(out, (doc, start, size, crc, n, window, offset)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], part.schema.field("doc_id").type), *(pa.array(c, pa.int64()) for c in out[1:])],
                names,
            )


def shared_positions(staged: DataFrame, shelf: Shelf) -> DataFrame:
    """task, local_start and position of the documents in the shared queue."""
    rows = staged.filter("shared IS NOT NULL").select("task", "local_start", "doc_tokens", "shared")
    totals = rows.groupBy("shared").agg(F.sum("doc_tokens").alias("total"))
    # none of these sources has more than an equal part of what the large ones leave
    earlier = Window.partitionBy("shared").orderBy("task", "local_start").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("doc_tokens").over(earlier), F.lit(0))
    due = (F.col("before") + F.col("doc_tokens") / 2) / F.col("total")
    timed = rows.withColumn("before", before).join(totals, "shared").select("task", "local_start", "doc_tokens", due.alias("due"))
    order = [F.col(c) for c in ("due", "task", "local_start")]
    return with_running_sums(timed, order, "doc_tokens", "position", lambda x: shelf.put(x, "due")).select(
        "task", "local_start", "position"
    )


def pack(
    df: DataFrame, tokenizer: str | None = None, length: int = 2048, end_id: int = 1, own_queues: int = OWN_QUEUES
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    spark = df.sparkSession
    shelf = Shelf(spark, "packing")
    docs = pick(df, "doc_id", "text", "source")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    by_rows = docs.groupBy("source").count().orderBy(F.desc("count"), "source")
    largest = by_rows.limit(own_queues).collect()
    some_share = len(largest) == own_queues
    queue_of = {row["source"]: i for i, row in enumerate(largest[: own_queues - 1])}
    staged = shelf.put(
        docs.select("doc_id", "text", "source").mapInArrow(
            lambda it: stage_ids(it, path, end_id, queue_of),
            f"task int, queue int, doc_id {id_type}, local_start long, doc_tokens long, ids binary, shared string",
        ),
        "ids",
    )
    sums = shelf.put(staged.groupBy("task", "queue").agg(F.sum("doc_tokens").alias("n")), "sums")
    totals = {r["queue"]: r["n"] for r in sums.groupBy("queue").agg(F.sum("n").alias("n")).collect()}
    earlier = Window.partitionBy("queue").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("task", "queue", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    if sums.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    own = staged.filter("shared IS NULL") if some_share else staged
    placed = own.join(offsets, ["task", "queue"]).select(
        "doc_id", "queue", (F.col("offset") + F.col("local_start")).alias("position"), "doc_tokens", "ids"
    )
    if some_share:
        together = staged.filter("shared IS NOT NULL").join(shared_positions(staged, shelf), ["task", "local_start"])
        placed = placed.unionByName(together.select("doc_id", "queue", "position", "doc_tokens", "ids"))
    return placed.mapInArrow(
        lambda it: cut(it, totals, length),
        f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
