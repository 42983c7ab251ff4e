"""SentencePiece encoding by Gumbel top-k sampling without replacement, and decoding.

All segmentations of a text into pieces form a lattice; a segmentation's probability is the
product of its pieces' weights over the sum of all. Every one has its log-probability plus a
Gumbel variate, and the k largest are a sample without replacement. A perturbed A* search finds
them without listing any others: a set of segmentations has as bound the largest perturbed value
in it, drawn exactly from its total weight, which backward sums over the lattice give. The best
set is popped, its best member read off, and the rest split by the place where they first leave
that member; each part draws its own bound below that of the member. So every pop yields a new
segmentation, in falling order of perturbed value. With kappa the (k+1)th value, a segmentation
of probability p has the inclusion score 1 - exp(-p / exp(kappa)); its inverse weighs it in
estimates.

No piece joins what a space or line break separates, so the lattice of a text is a chain of word
lattices. Those of new words are built together and kept for the texts to come, and words of many
texts walk theirs in step. Random numbers are hashes of seed, row key, draw and place: neither partitions
nor batches matter.

A merge model has ranks instead of weights; a piece of rank r then weighs 1 / (r + 2.7) (Zipf).
Characters without a piece become their UTF-8 bytes.

Defined cases: a null or empty text has one segmentation, of no pieces. Texts with fewer than k
segmentations give all of them, with inclusion 1. A null id is seeded as empty text; equal ids
draw equal numbers, so repeated rows give equal results. An empty table gives no rows. The
model writes a space as U+2581; a text that has this character itself decodes to spaces. Other
columns are left out."""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from waybill.llm.common import pick, text_chunks, worker_cache

SPACE = "▁"
UNITS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
CHUNK = 1 << 20
#: Lattices are built for so many units at a time, and begun anew beyond so many edges.
UNITS_AT_ONCE = 50_000
EDGES_KEPT = 3_000_000
ALL_BITS = (1 << 64) - 1
GRID = 1 << 24
SLOT_BITS = 21
SLOT_SHIFT = np.uint64(64 - SLOT_BITS)
PRIME = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """A model's pieces with log weights, and a table of the hashes of all their beginnings."""

    def __init__(self, path: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        sp = self.processor
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        found = {
            sp.id_to_piece(i): i
            for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))
        }
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in found):
            raise ValueError("a piece of this model joins words")
        scores = np.array([sp.get_score(i) for i in range(sp.get_piece_size())])
        ranks = np.array([-scores[i] for i in found.values()])
        self.weight = np.full(len(scores), -math.inf)
        if (ranks == ranks.astype(int)).all() and ranks.min() >= 0:  # a merge model
            self.weight[list(found.values())] = -np.log(ranks + 2.7) - math.log((1 / (ranks + 2.7)).sum())
        else:
            self.weight[list(found.values())] = scores[list(found.values())]
        self.byte_weight = float(self.weight[list(found.values())].min())
        self.longest = max(map(len, found))
        starts = {p[:n]: -1 for p in found for n in range(1, len(p) + 1)} | found
        hashes = np.array([self._hash(p) for p in starts], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], np.array(list(starts.values()), np.int64)[order]
        if (np.diff(self.hashes) == 0).any():
            raise ValueError("two beginnings of pieces share a hash")
        slots = (self.hashes * PRIME) >> SLOT_SHIFT
        self.table = np.full(1 << SLOT_BITS, -1, np.int32)
        self.table[slots] = np.arange(len(slots))
        taken, times = np.unique(slots, return_counts=True)
        self.table[taken[times > 1]] = -2  # more than one: to be searched for

    def find(self, h: np.ndarray) -> np.ndarray:
        """Places of hashes among those of the beginnings, -1 for others."""
        place = self.table[(h * PRIME) >> SLOT_SHIFT]
        shared = np.flatnonzero(place == -2)
        if len(shared):
            place[shared] = np.minimum(np.searchsorted(self.hashes, h[shared]), len(self.hashes) - 1)
        return np.where(self.hashes[np.maximum(place, 0)] == h, place, -1)

    @staticmethod
    def _hash(text: str) -> int:
        h = 0
        for c in text:
            h = (h * int(PRIME) + ord(c) + 1) % (1 << 64)
        return h


class Numbers(dict):
    """Units to numbers in the order in which they are first asked for."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        self.new.append(unit)
        self[unit] = number = len(self)
        return number


class Lattices:
    """The lattices of some distinct words, side by side. Nodes are places between characters,
    edges pieces (or characters without one: -1 - code point), sorted by their first node.

    Words are added as texts ask for their `numbers`; a process keeps them for the texts to come."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.numbers = pieces, Numbers()
        self.buffers: dict[str, np.ndarray] = {}
        self.first = self.last = self.source = self.target = self.id = np.zeros(0, np.int64)
        self.log_p = self.log_rest = self.ladder = np.zeros(0)
        self.first_edge = self.degree = np.zeros(0, np.int64)

    def words(self, units: list[str]) -> np.ndarray:
        return np.fromiter(map(self.numbers.__getitem__, units), np.int64, len(units))

    def grow(self) -> None:
        """Build the lattices of units that were numbered since."""
        new, self.numbers.new = self.numbers.new, []
        for i in range(0, len(new), UNITS_AT_ONCE):
            built = Built(new[i : i + UNITS_AT_ONCE], self.pieces)
            nodes, edges = len(self.degree), len(self.id)
            for name in ("first", "last", "source", "target", "ladder"):
                self._append(name, getattr(built, name) + nodes)
            self._append("first_edge", built.first_edge + edges)
            for name in ("id", "log_p", "log_rest", "degree"):
                self._append(name, getattr(built, name))

    def _append(self, name: str, values: np.ndarray) -> None:
        """Arrays are the used part of buffers with some room, so that words cost what they are."""
        used, buffer = len(getattr(self, name)), self.buffers.get(name)
        needed = used + len(values)
        if buffer is None or needed > len(buffer):
            buffer = np.empty(needed + needed // 4, values.dtype)
            buffer[:used] = getattr(self, name)
            self.buffers[name] = buffer
        buffer[used:needed] = values
        setattr(self, name, buffer[:needed])

    def drawn_edges(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The edge of each node on whose step of the ladder u falls. Nodes have few edges, and the last
        step is above any u, so each is climbed from its first step."""
        edge, wanted = self.first_edge[node], node + u
        climbing = np.flatnonzero(self.ladder[edge] <= wanted)
        while len(climbing):
            edge[climbing] += 1
            climbing = climbing[self.ladder[edge[climbing]] <= wanted[climbing]]
        return edge

    def walk(self, node: np.ndarray, last: np.ndarray, base: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From each node to the end of its word: the edges, one walk after the other, and
        their number. `base` is the first node of the word."""
        node = node.copy()
        alive = np.flatnonzero(node != last)
        steps = []
        while len(alive):
            here = node[alive]
            h = mixed(seed[alive] + (here - base[alive]).astype(np.uint64) * PRIME)
            u = (2 * (h >> np.uint64(41)) + np.uint64(1)).astype(np.float64) / GRID
            edge = self.drawn_edges(here, u)
            steps.append((alive, edge))
            node[alive] = self.target[edge]
            alive = alive[node[alive] != last[alive]]
        count = np.zeros(len(node), np.int64)
        for walkers, _ in steps:
            count[walkers] += 1
        out = np.empty(int(count.sum()), np.int64)
        place = np.cumsum(count) - count
        for i, (walkers, edge) in enumerate(steps):
            out[place[walkers] + i] = edge
        return out, count


class Built:
    """The lattices of some units, numbered from 0."""

    def __init__(self, units: list[str], pieces: Pieces):
        sizes = np.array([len(u) for u in units], np.int64)
        codes = np.frombuffer("".join(units).encode("utf-32-le"), "<u4").astype(np.uint64)
        unit = np.repeat(np.arange(len(units)), sizes)
        stop = np.repeat(np.cumsum(sizes), sizes)
        self.first = np.cumsum(sizes) - sizes + np.arange(len(units))
        self.last = self.first + sizes
        at, h = np.arange(len(codes)), np.zeros(len(codes), np.uint64)
        starts, lengths, ids = [], [], []
        for n in range(1, pieces.longest + 1):
            inside = at + n <= stop[at]
            at, h = at[inside], h[inside]
            h = h * PRIME + codes[at + n - 1] + np.uint64(1)
            place = pieces.find(h)
            known = place >= 0
            piece = np.where(known, pieces.ids[place], -1)
            if n == 1:  # every character can stand alone
                piece_or_bytes = np.where(piece >= 0, piece, -1 - codes.astype(np.int64))
                starts.append(at)
                ids.append(piece_or_bytes)
                lengths.append(np.ones(len(at), np.int64))
            else:
                hit = piece >= 0
                starts.append(at[hit])
                ids.append(piece[hit])
                lengths.append(np.full(int(hit.sum()), n))
            at, h = at[known], h[known]
        start, self.id, length = (np.concatenate(x) for x in (starts, ids, lengths))
        order = np.argsort(start, kind="stable")
        start, self.id, length = start[order], self.id[order], length[order]
        self.source = start + unit[start]
        self.target = self.source + length
        weight = np.where(self.id >= 0, pieces.weight[np.maximum(self.id, 0)], 0.0)
        alone = self.id < 0
        code = -1 - self.id[alone]
        weight[alone] = pieces.byte_weight * (1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))
        self._weigh(weight, stop[start] - start)

    def _weigh(self, weight: np.ndarray, to_end: np.ndarray) -> None:
        """Backward sums, the conditional log-probability of each edge at its node, and a
        ladder (node + cumulative probability) to draw edges from."""
        n_nodes = int(self.last[-1]) + 1 if len(self.last) else 0
        backward = np.zeros(n_nodes)
        most = int(to_end.max(initial=0))
        # places in short words are sorted by their digits
        order = np.argsort(to_end.astype(np.uint16) if most < 1 << 16 else to_end, kind="stable")
        bounds = np.searchsorted(to_end[order], np.arange(1, most + 2))
        for a, b in zip(bounds, bounds[1:]):
            edges = order[a:b]
            if len(edges):
                source = self.source[edges]
                heads = np.flatnonzero(np.append(True, source[1:] != source[:-1]))
                backward[source[heads]] = np.logaddexp.reduceat(weight[edges] + backward[self.target[edges]], heads)
        self.log_p = np.minimum(weight + backward[self.target] - backward[self.source], 0.0)
        heads = np.flatnonzero(np.append(True, self.source[1:] != self.source[:-1])) if len(self.source) else np.zeros(0, int)
        self.first_edge = np.zeros(n_nodes, np.int64)
        self.first_edge[self.source[heads]] = heads
        p = np.exp(self.log_p)
        with np.errstate(divide="ignore"):  # a place without alternatives has no mass
            self.log_rest = np.log1p(-np.minimum(p, 1.0))
        total = np.cumsum(p)
        sizes = np.diff(np.append(heads, len(p)))
        before = np.repeat(np.append(0, total)[heads], sizes)
        within = (total - before) / np.repeat(np.add.reduceat(p, heads) if len(heads) else p, sizes)
        within = np.minimum(np.rint(within * (GRID // 2)) * 2 / GRID, 1.0)
        tails = np.append(heads, len(p))[1:] - 1
        within[tails] = 1.0
        self.ladder = self.source + within
        self.degree = np.zeros(n_nodes, np.int64)
        self.degree[self.source[heads]] = sizes


def mixed(h: np.ndarray) -> np.ndarray:
    """A well-mixed hash of whole numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def mixed_one(h: int) -> int:
    """The same of one number."""
    h &= ALL_BITS
    h = (h ^ (h >> 30)) * 0xBF58476D1CE4E5B9 & ALL_BITS
    h = (h ^ (h >> 27)) * 0x94D049BB133111EB & ALL_BITS
    return h ^ (h >> 31)


def uniform(seed: int, *parts: int) -> float:
    """Between 0 and 1, both excluded."""
    for part in parts:
        seed = mixed_one(seed + (part + 1) * int(PRIME))
    return (float(seed >> 12) + 0.5) / (1 << 52)


def gumbel(u):
    return -np.log(-np.log(u))


class Draw:
    """A drawn segmentation: its edges, the word each belongs to, and its perturbed value."""

    __slots__ = ("edges", "words", "value", "leaves", "barred")

    def __init__(self, edges, words, value, leaves=0, barred=()):
        self.edges, self.words, self.value = edges, words, value
        self.leaves, self.barred = leaves, barred  # where it left another draw; edges not allowed there


class Search:
    """The search for one text. `heap` holds sets of segmentations by falling bound: those that
    agree with `draw` before place j and take none of the `barred` edges there."""

    def __init__(self, seed: int, k: int):
        self.seed, self.k, self.heap, self.draws = seed, k, [], []

    def add(self, draw: Draw, lattices: Lattices, number: int) -> None:
        """Split what is left of the set `draw` came from, and keep the parts that can matter."""
        self.draws.append(draw)
        p = lattices.log_p[draw.edges]
        before = np.cumsum(p) - p
        at = draw.leaves
        rest = lattices.log_rest[draw.edges[at:]]
        barred = (*draw.barred, int(draw.edges[at])) if len(p) > at else ()
        if draw.barred:
            left = 1 - math.fsum(math.exp(lattices.log_p[e]) for e in barred)
            rest[0] = math.log(left) if left > 1e-12 else -math.inf
        mass = before[at:] + rest
        key = mixed_one(self.seed + (number + 1) * int(PRIME))
        h = mixed(np.uint64(key) + np.arange(len(mass)).astype(np.uint64) * PRIME)
        noise = gumbel(((h >> np.uint64(12)).astype(np.float64) + 0.5) / (1 << 52)) + mass
        bound = draw.value - np.logaddexp(0.0, draw.value - noise)
        wanted = self.k + 1 - len(self.draws)
        if len(bound) <= wanted:
            top = range(len(bound))
        elif wanted == 1:  # after the last draw only kappa is needed
            top = [int(bound.argmax())]
        else:
            top = np.argpartition(-bound, wanted - 1)[:wanted]
        for j in top:
            if bound[j] > -math.inf:
                heapq.heappush(self.heap, (-float(bound[j]), number, at + int(j), barred if j == 0 else (int(draw.edges[at + j]),)))

    def pop(self):
        value, number, place, barred = heapq.heappop(self.heap)
        return -value, number, place, barred

    def kappa(self) -> float:
        return -self.heap[0][0] if self.heap else -math.inf


def sample_texts(
    texts: list[str], seeds: list[int], pieces: Pieces, k: int, known: Lattices | None = None
) -> tuple[Lattices, list[Search]]:
    """The k draws of each text, all texts walking in step. Words that `known` lacks are added to it."""
    lattices = Lattices(pieces) if known is None else known
    words = [lattices.words(UNITS.findall(SPACE + t.replace(" ", SPACE)) if t else []) for t in texts]
    lattices.grow()
    searches = [Search(seed, k) for seed in seeds]

    def drawn(todo: list[tuple]) -> None:
        """todo: (text, prefix edges, prefix words, first word to walk, node or -1, value, leaves, barred)"""
        parts = [words[i][w:] for i, _, _, w, *_ in todo]
        sizes = np.array([len(p) for p in parts])
        word = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        node, last = lattices.first[word], lattices.last[word]
        base, heads = node, np.cumsum(sizes) - sizes
        node = node.copy()
        for head, size, t in zip(heads, sizes, todo):
            if t[4] >= 0 and size:
                node[head] = t[4]
        number = np.concatenate([np.arange(t[3], t[3] + n) for t, n in zip(todo, sizes)]) if parts else word
        key = np.array([uniform_key(searches[t[0]].seed, len(searches[t[0]].draws)) for t in todo], np.uint64)
        seed = mixed(np.repeat(key, sizes) + number.astype(np.uint64) * PRIME)
        edges, count = lattices.walk(node, last, base, seed)
        owner = np.repeat(number, count)
        ends = np.cumsum(np.add.reduceat(np.append(count, 0), heads) * (sizes > 0)) if len(todo) else []
        begin = 0
        for t, end in zip(todo, ends):
            i, prefix, prefix_words, _, _, value, leaves, barred = t
            draw = Draw(
                np.concatenate([prefix, edges[begin:end]]), np.concatenate([prefix_words, owner[begin:end]]), value, leaves, barred
            )
            searches[i].add(draw, lattices, len(searches[i].draws))
            begin = end

    none = np.zeros(0, np.int64)
    drawn([(i, none, none, 0, -1, float(gumbel(uniform(s.seed, 0))), 0, ()) for i, s in enumerate(searches)])
    for _ in range(1, k):
        todo = []
        for i, search in enumerate(searches):
            if not search.heap:
                continue
            value, number, place, barred = search.pop()
            old = search.draws[number]
            node = int(lattices.source[old.edges[place]])
            first = int(lattices.first_edge[node])
            free = [e for e in range(first, first + int(lattices.degree[node])) if e not in barred]
            p = np.exp(lattices.log_p[free])
            u = uniform(search.seed, 1, len(search.draws)) * p.sum()
            edge = free[min(int(np.searchsorted(np.cumsum(p), u, side="right")), len(free) - 1)]
            todo.append(
                (
                    i,
                    np.append(old.edges[:place], edge),
                    np.append(old.words[:place], old.words[place]),
                    int(old.words[place]),
                    int(lattices.target[edge]),
                    value,
                    place,
                    barred,
                )
            )
        if todo:
            drawn(todo)
    return lattices, searches


def uniform_key(seed: int, draw: int) -> int:
    return mixed_one(seed + (draw + 7) * int(PRIME))


def piece_ids(edges: np.ndarray, lattices: Lattices, pieces: Pieces) -> np.ndarray:
    """Ids of the pieces; characters without a piece become bytes."""
    ids = lattices.id[edges]
    alone = np.flatnonzero(ids < 0)
    if len(alone):
        codes = -1 - ids[alone]
        if (codes == codes[0]).all():  # mostly line feeds
            codes, which = codes[:1], np.zeros(len(alone), np.int64)
        else:
            codes, which = np.unique(codes, return_inverse=True)
        spelt = [[pieces.bytes[b] for b in chr(code).encode()] for code in codes.tolist()]
        size, counts = np.array([len(x) for x in spelt])[which], np.ones(len(ids), np.int64)
        counts[alone] = size
        place = (np.cumsum(counts) - counts)[alone]
        ids = np.repeat(ids, counts)
        for i in range(int(size.max())):
            there = size > i
            ids[place[there] + i] = np.array([x[i] if len(x) > i else -1 for x in spelt])[which[there]]
    return ids.astype(np.int32)


def pieces_of(path: str) -> Pieces:
    held = worker_cache("segmentation " + path)
    if not held:
        held["pieces"] = Pieces(path)
    return held["pieces"]


def sample_rows(batches: Iterator[pa.RecordBatch], path: str, k: int, seed: int) -> Iterator[pa.RecordBatch]:
    pieces = pieces_of(path)
    held = worker_cache("lattices " + path)
    for batch in batches:
        for part in text_chunks(batch, size=CHUNK):
            if "known" not in held or len(held["known"].id) > EDGES_KEPT:
                held["known"] = Lattices(pieces)
            texts = [t or "" for t in part.column("text").to_pylist()]
            seeds = [xxhash.xxh64_intdigest("" if d is None else str(d), seed) for d in part.column("doc_id").to_pylist()]
            lattices, searches = sample_texts(texts, seeds, pieces, k, held["known"])
            row, rank, values, logs, inclusion, ids = [], [], [], [], [], []
            for i, search in enumerate(searches):
                kappa = search.kappa()
                for n, draw in enumerate(search.draws):
                    log_p = float(lattices.log_p[draw.edges].sum())
                    row.append(i)
                    rank.append(n + 1)
                    values.append(draw.value)
                    logs.append(log_p)
                    gap = min(log_p - kappa, 700.0) if kappa > -math.inf else 700.0
                    inclusion.append(-math.expm1(-math.exp(gap)))
                    ids.append(piece_ids(draw.edges, lattices, pieces))
            ends = np.cumsum([0, *(len(x) for x in ids)])
            flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(row, pa.int64())),
                    pa.array(rank, pa.int32()),
                    pa.array(values, pa.float64()),
                    pa.array(logs, pa.float64()),
                    pa.array(inclusion, pa.float64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat),
                ],
                ["doc_id", "rank", "perturbed", "log_prob", "inclusion", "ids"],
            )


def encode(df: DataFrame, model: str | None = None, k: int = 2, seed: int = 0) -> DataFrame:
    """Up to k rows per document: doc_id, rank, perturbed, log_prob, inclusion, ids."""
    path = model or public_tokenizers.path("piece_bpe_32k.model")
    docs = pick(df, "doc_id", "text")
    return docs.mapInArrow(
        lambda it: sample_rows(it, path, k, seed),
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, rank int, perturbed double, log_prob double, "
        "inclusion double, ids array<int>",
    )


def decode(df: DataFrame, model: str | None = None) -> DataFrame:
    """The rows with `ids` replaced by `text`; null ids give the empty text."""
    path = model or public_tokenizers.path("piece_bpe_32k.model")
    kept = [f for f in df.schema if f.name != "ids"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = pieces_of(path).processor
        for batch in batches:
            texts = processor.decode([x or [] for x in batch.column("ids").to_pylist()])
            rest = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(texts, pa.string())], [*(f.name for f in kept), "text"])

    return df.mapInArrow(rows, f"{kinds}, text string" if kinds else "text string")
