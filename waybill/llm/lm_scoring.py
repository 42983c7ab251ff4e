"""Scoring by online logistic context mixing.

A text is coded bit by bit: its UTF-8 bytes, then an end byte. For every bit several predictors
look up counts under a hash of the last 1, 2, 3, 4, 6 and 16 bytes of the word at hand (a word
begins after each white-space byte, with a marker for how the one before it ended), the longer
ones together with the last letter beyond ASCII that the text has shown. Their
log-odds are mixed by weights; a gate (how many contexts are known, which bit of the byte)
selects the weight set. The mix is refined by an adaptive map from (gate, mixed log-odds) to
what followed in training. log10 of the product of all bits is the score.

Words repeat, so learning goes over the words of the training texts with their counts, counted
by one shuffle over all training texts; the number of counted words grows with the corpus.
1. Context counts: every task adds up its words in fixed-size tables, tables are summed. Every
   word teaches every order; the tables do not grow, so slots of long contexts are shared.
2. Weights and map: one online pass per task, each word predicted as if it had been seen once
   less than it was; tasks' results are averaged by the bits they saw.
3. All texts are scored. The most frequent words are scored once and go to all tasks with their
   scores, about `hot_units` of them; a process scores the others where it meets them, once for
   about HELD_TEXT bytes of text, and keeps the scores of those it met lately.

A bit's contexts are within its word, so bytes after the same beginning of a word are counted,
learned from or scored once for all words at hand that begin so.

The base score needs every token's count. About `hot_tokens` of the most frequent ones go to all
tasks, the others are joined by shuffle. Which these are is decided by how many tokens have each
count; the driver gets them in packed arrays, 16 bytes a token.

Defined cases: a null or empty text is the end token alone. A null id counts as the empty text
in the split, so it is in training. Repeated rows are learned and scored each. Without training
rows all counts are 0. Other columns are left out."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import SPACE_CHARS, Shelf, id_remainder, pick, text_chunks, worker_cache

END = b"\xff"  # in no UTF-8 text
UNIT = re.compile(rb"[^\x20\x09-\x0D]*[\x20\x09-\x0D]|[^\x20\x09-\x0D]+")
ENDS = SPACE_CHARS.encode() + END
ORDERS = (1, 2, 3, 4, 6, 16)
BITS = (16, 18, 20, 22, 23, 23)  # log2 of the slots per order
FIRST_SLOT = tuple(int(x) for x in np.cumsum([0, *(1 << b for b in BITS)]))
SLOTS = FIRST_SLOT[-1]
SLOTS_PER_BLOCK = 8192
STATES = 16
COUNTED_TOGETHER = ((0, 1, 2, 3), (4,), (5,))  # of about the same size
GATES = (len(ORDERS) + 1) * 8
BUCKETS = 33
DELTA = 0.4
UNITS_HELD = 500_000
BYTES_AT_ONCE = 1 << 17
SHARED_BYTES = 1 << 21  # of words whose common beginnings are looked for
HELD_TEXT = 1 << 23
NODES_AT_ONCE = 1 << 14
MIX, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def units_of(text: str | None) -> list[bytes]:
    """Words, each with the white-space byte or the end byte after it."""
    return UNIT.findall((text or "").encode() + END)


def marks_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every unit of some texts what came before it, and which text it is of. data: the texts' bytes,
    each with END.

    A mark holds how the unit before ended (0 at the beginning of a text) and a state: a hash of the
    last letter beyond ASCII that the text has shown, which tells apart languages, of which a text has
    one as a rule."""
    closing = data[ends]
    last_of_text = closing == END[0]
    text = np.cumsum(last_of_text) - last_of_text
    first = np.concatenate([[0], np.flatnonzero(last_of_text)[:-1] + 1])
    kinds = np.full(256, 4, np.uint8)
    kinds[[c for c in range(256) if c >= 128 or bytes((c,)).isalnum()]] = 2
    kinds[list(b".!?")] = 3
    ending = np.where(closing == 10, 1, np.where(ends > starts, kinds[data[ends - 1]], 3)).astype(np.int64)

    leads = np.flatnonzero((data >= 0xC0) & (data < 0xFF))  # first bytes of letters beyond ASCII
    b = [np.take(data, leads + i, mode="clip").astype(np.int64) & (63 if i else 255) for i in range(4)]
    two, three = (b[0] & 31) << 6 | b[1], (b[0] & 15) << 12 | b[1] << 6 | b[2]
    code = np.where(b[0] < 0xE0, two, np.where(b[0] < 0xF0, three, (b[0] & 7) << 18 | b[1] << 12 | b[2] << 6 | b[3]))
    states = np.concatenate([[0], 1 + code % (STATES - 1)])
    places = np.concatenate([[-1], leads])
    seen = np.searchsorted(leads, starts)
    state = np.where(places[seen] >= starts[first][text], states[seen], 0)
    marks = np.concatenate([[0], ending[:-1] * STATES]) + state
    marks[first] = 0
    return marks, text


def behind_marks(marks, data, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units one after another, each behind its mark, and their sizes with that."""
    sizes = np.asarray(lengths, np.int64) + 1
    starts = np.cumsum(sizes) - sizes
    flat = np.empty(int(sizes.sum()), np.uint8)
    own = np.ones(len(flat), bool)
    own[starts] = False
    flat[starts] = marks
    flat[own] = np.frombuffer(data, np.uint8)
    return flat, sizes


def keys_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The units of all texts in order, each behind its mark, and which text each is of."""
    raw = texts.fill_null("").cast(pa.binary()).to_pylist()
    joined = END.join(raw) + END
    data = np.frombuffer(joined, np.uint8)
    is_end = np.zeros(256, bool)
    is_end[list(ENDS)] = True
    ends = np.flatnonzero(is_end[data])
    starts = np.concatenate([[0], ends[:-1] + 1])
    marks, text = marks_of(data, starts, ends)
    flat, sizes = behind_marks(marks, joined, ends - starts + 1)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    keys = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
    return keys.dictionary_encode(), text


def bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of binaries without nulls, one after another, and where each begins and ends."""
    words = words.cast(pa.large_binary())
    _, offsets, data = words.buffers()
    if data is None or not len(words):
        return np.zeros(0, np.uint8), np.zeros(len(words) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def token_of(unit: bytes) -> bytes:
    return unit.rstrip(ENDS).lower()


def count_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_chunks(batch, size=HELD_TEXT):
            keys, _ = keys_of(part.column("text"))
            flat, offsets = bytes_of(keys.dictionary)
            own = np.ones(len(flat), bool)
            own[offsets[:-1]] = False
            places = (offsets - np.arange(len(offsets))).astype(np.int32)
            units = [None, pa.py_buffer(places), pa.py_buffer(flat[own])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(flat[offsets[:-1]].astype(np.int32)),
                    pa.Array.from_buffers(pa.binary(), len(offsets) - 1, units),
                    pa.array(np.bincount(keys.indices.to_numpy(), minlength=len(offsets) - 1).astype(np.int64)),
                ],
                ["mark", "unit", "n"],
            )


def count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens = [token_of(u) for u in batch.column("unit").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.binary()), batch.column("n")], ["token", "n"])


def context_hashes(flat: np.ndarray, at: np.ndarray, depth: np.ndarray, state: np.ndarray, wanted: tuple[int, ...]) -> list[np.ndarray]:
    """For the bytes at some places, hashes of their contexts of the wanted orders."""
    hashes, h, inside = [], np.zeros(len(at), np.uint64), np.arange(len(at))
    for k in range(1, max(wanted) + 1):
        inside = inside[depth[inside] >= k]
        if len(inside):
            rows = inside if len(inside) < len(at) else slice(None)
            longer = (h[rows] + (flat[at[rows] - k].astype(np.uint64) + np.uint64(1))) * STEP
            h[rows] = longer ^ (longer >> np.uint64(29))
        if k in wanted:
            salt = np.array([k], np.uint64) * MIX
            hashes.append(h + salt if k < 3 else h + salt * (state + np.uint64(1)))
    return hashes


def bits_of(flat, at, depth, state, wanted: tuple[int, ...] = ORDERS) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Each of the eight bits of the bytes at some places, with its slots in the wanted orders' tables."""
    value = flat[at].astype(np.uint64)
    hashes = context_hashes(flat, at, depth, state, wanted)
    sizes = [bits for k, bits in zip(ORDERS, BITS) if k in wanted]
    for t in range(8):
        node = (np.uint64(1 << t) | (value >> np.uint64(8 - t))) * MIX
        slots = [(((h ^ node) * STEP) >> np.uint64(64 - bits)).view(np.int64) for h, bits in zip(hashes, sizes)]
        yield ((value >> np.uint64(7 - t)) & np.uint64(1)).astype(np.int8), slots


class Bits:
    """The bits of some units, with the slots of their contexts of the wanted orders."""

    def __init__(self, marks: list[int], units: list[bytes], wanted: tuple[int, ...] = ORDERS):
        flat, sizes = behind_marks(marks, b"".join(units), np.array([len(u) for u in units]))
        depth = depths(sizes)
        at = np.flatnonzero(depth > 0)
        state = (np.repeat(np.array(marks, np.uint64), sizes) % np.uint64(STATES))[at]
        self.unit = np.repeat(np.arange(len(units)), sizes - 1)
        first = [x for k, x in zip(ORDERS, FIRST_SLOT) if k in wanted]
        both = list(bits_of(flat, at, depth[at], state, wanted))
        self.bit = [bit for bit, _ in both]
        self.slots = [[s + x for s, x in zip(slots, first)] for _, slots in both]


def depths(sizes: np.ndarray) -> np.ndarray:
    return np.arange(int(sizes.sum()), dtype=np.int32) - np.repeat((np.cumsum(sizes) - sizes).astype(np.int32), sizes)


class Nodes:
    """The bytes of units that lie behind their marks; those after the same mark and beginning are one
    node. of: the node of each byte, unit: its unit. at, depth, state: of a node."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        starts, depth = np.cumsum(sizes) - sizes, depths(sizes)
        sums = np.random.default_rng(1).integers(0, 1 << 64, 256, np.uint64)[flat]
        sums *= np.cumprod(np.full(int(sizes.max(initial=1)), STEP))[depth]
        before = -sums[starts]
        np.cumsum(sums, out=sums)
        before += sums[starts]
        sums -= np.repeat(before, sizes)
        inner = np.flatnonzero(depth > 0)
        beginning = sums[inner]
        del sums
        order = np.argsort(beginning)
        beginning = beginning[order]
        new = np.concatenate([[True], beginning[1:] != beginning[:-1]])[: len(order)]
        del beginning
        self.of = np.empty(len(order), np.int32)
        self.of[order] = np.cumsum(new, dtype=np.int32) - 1
        chosen = inner[order[new]]
        self.flat, self.at, self.depth = flat, chosen, depth[chosen]
        self.state = (flat[chosen - self.depth] % STATES).astype(np.uint64)
        self.unit = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes - 1)

    def slices(self) -> Iterator[slice]:
        for a in range(0, len(self.at), NODES_AT_ONCE):
            yield slice(a, a + NODES_AT_ONCE)

    def bits(self, part: slice = slice(None), wanted: tuple[int, ...] = ORDERS):  # noqa: B008
        return bits_of(self.flat, self.at[part], self.depth[part], self.state[part], wanted)


def groups_of_units(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of units with about `most` bytes."""
    start = held = 0
    for i, length in enumerate(lengths):
        if held and held + length > most:
            yield start, i
            start, held = i, 0
        held += length
    if start < len(lengths):
        yield start, len(lengths)


def cut_long(mark: int, unit: bytes) -> list[tuple[int, bytes]]:
    """Units beyond the size of a group are coded in parts, so that no array follows a text."""
    if len(unit) <= BYTES_AT_ONCE:
        return [(mark, unit)]
    return [(mark if not i else 5 * STATES, unit[i : i + BYTES_AT_ONCE]) for i in range(0, len(unit), BYTES_AT_ONCE)]


def context_counts(batches: Iterator[pa.RecordBatch], *ats: int) -> Iterator[pa.RecordBatch]:
    """Zeros and ones seen per slot of some orders by this task, as blocks of the slots that were hit."""
    tables = [np.zeros((2, 1 << BITS[at]), np.float32) for at in ats]
    wanted = tuple(ORDERS[at] for at in ats)
    for flat, sizes, n in layouts(batches):
        nodes = Nodes(flat, sizes)
        weight = np.bincount(nodes.of, n[nodes.unit], len(nodes.at)).astype(np.float32)
        for part in nodes.slices():
            for bit, found in nodes.bits(part, wanted):
                for table, slots in zip(tables, found):
                    np.add.at(table.reshape(-1), slots + table.shape[1] * bit.astype(np.int64), weight[part])
    for at, table in zip(ats, tables):
        yield from hit_blocks(table, FIRST_SLOT[at])


def hit_blocks(table: np.ndarray, first: int) -> Iterator[pa.RecordBatch]:
    slots = table.shape[1]
    for block in range(slots // SLOTS_PER_BLOCK):
        part = table[:, block * SLOTS_PER_BLOCK : (block + 1) * SLOTS_PER_BLOCK]
        hit = np.flatnonzero(part.any(axis=0)).astype("<u2")
        if len(hit):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([first // SLOTS_PER_BLOCK + block], pa.int32()),
                    pa.array([hit.tobytes()]),
                    pa.array([part[:, hit].astype("<f4").tobytes()]),
                ],
                ["block", "hit", "counts"],
            )


def rows_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units one after another, each behind its mark, their sizes with that, and their counts."""
    data, offsets = bytes_of(batch.column("unit"))
    marks, n, lengths = batch.column("mark").to_numpy(), batch.column("n").to_numpy(), np.diff(offsets)
    if lengths.max(initial=0) > BYTES_AT_ONCE:
        units = batch.column("unit").to_pylist()
        pieces = [(m, u, count) for mark, unit, count in zip(marks.tolist(), units, n) for m, u in cut_long(mark, unit)]
        marks, units, n = zip(*pieces)
        data, lengths = b"".join(units), np.array([len(u) for u in units])
    return *behind_marks(marks, data, lengths), np.array(n, np.float32)


def layouts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """As `rows_of`, for several batches at once, until they hold about SHARED_BYTES."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for batch in batches:
        held.append(rows_of(batch))
        if sum(len(flat) for flat, _, _ in held) >= SHARED_BYTES:
            yield tuple(map(np.concatenate, zip(*held)))
            held.clear()
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def sum_block(table: pa.Table) -> pa.Table:
    """The sum of one block over the tasks, in a byte each: see COUNTS."""
    total = np.zeros((2, SLOTS_PER_BLOCK), np.float64)
    for hit, counts in zip(table.column("hit").to_pylist(), table.column("counts").to_pylist()):
        where = np.frombuffer(hit, "<u2")
        total[:, where] += np.frombuffer(counts, "<f4").reshape(2, -1)
    small = np.searchsorted(COUNTS, total * (1 + 1e-6), side="right").astype(np.uint8) - np.uint8(1)
    return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int32()), "counts": pa.array([small.tobytes()])})


def counts_table(blocks) -> np.ndarray:
    """Per slot the byte for the ones, then the byte for the zeros."""
    out = np.zeros(math.ceil(SLOTS / SLOTS_PER_BLOCK) * SLOTS_PER_BLOCK, np.uint16)
    for row in blocks:
        at = row["block"] * SLOTS_PER_BLOCK
        zeros, ones = np.frombuffer(bytes(row["counts"]), np.uint8).reshape(2, -1).astype(np.uint16)
        out[at : at + SLOTS_PER_BLOCK] = ones << 8 | zeros
    return out


def log_odds_of(counts: np.ndarray) -> np.ndarray:
    """Log-odds per slot, zero where nothing was seen; in halves to spare memory and caches."""
    out = np.empty(len(counts), np.float16)
    for at in range(0, len(out), 1 << 20):
        both = counts[at : at + (1 << 20)]
        out[at : at + (1 << 20)] = LOGS[both >> 8] - LOGS[both & 255]
    return out


#: The counts that a byte stands for: small ones exactly, larger ones within six per cent.
COUNTS = np.concatenate([np.arange(64), np.round(64 * 1.06 ** np.arange(192))]).astype(np.float32)
LOGS = np.log(COUNTS + DELTA).astype(np.float32)


def gate_of(inputs: list[np.ndarray], t: int) -> np.ndarray:
    known = np.zeros(len(inputs[0]), np.int8)
    for x in inputs:
        known += x != 0
    return known.astype(np.int64) * 8 + t


def mixed(inputs: list[np.ndarray], gate: np.ndarray, weights: np.ndarray) -> np.ndarray:
    out = np.zeros(len(gate), np.float32)
    for k, x in enumerate(inputs):
        out += weights[k][gate] * x
    return np.clip(out, -12, 12)


def refined(odds: np.ndarray, gate: np.ndarray, refine: np.ndarray) -> np.ndarray:
    """Probability of a one: the mean of the mix and of what the map says about it."""
    p = 1 / (1 + np.exp(-odds))
    p = (p + refine[gate * BUCKETS + bucket_of(odds)]) / 2
    return np.clip(p, 1 / 65536, 1 - 1 / 65536)


def bucket_of(odds: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(odds, -8, 8) * 2).astype(np.int64) + 16


def odds_without_one() -> np.ndarray:
    """By a bit and a slot's two bytes: the log-odds as if the bit had been seen once less there."""
    ones, zeros = np.repeat(COUNTS, 256), np.tile(COUNTS, 256)
    less = lambda counts, by: np.maximum(counts - np.float32(by), 0) + np.float32(DELTA)
    return np.concatenate([np.log(less(ones, bit) / less(zeros, 1 - bit)) for bit in (0, 1)])


def learn_mixing(batches: Iterator[pa.RecordBatch], counts) -> Iterator[pa.RecordBatch]:
    """Online: after each group of units the weights follow the gradient of the coding cost,
    scaled by its curvature. Returns weights and map sums with the number of bits per gate."""
    tables = [counts.value[first : first + (1 << bits)] for first, bits in zip(FIRST_SLOT, BITS)]
    odds_of = odds_without_one()
    weights = np.full((len(ORDERS), GATES), 0.35, np.float32)
    seen = np.zeros(GATES)
    sums = np.zeros((2, GATES * BUCKETS))
    for batch in batches:
        flat, sizes, n = rows_of(batch)
        ends = np.cumsum(sizes)
        for a, b in groups_of_units((sizes - 1).tolist(), BYTES_AT_ONCE):
            nodes = Nodes(flat[ends[a] - sizes[a] : ends[b - 1]], sizes[a:b])
            weight = np.bincount(nodes.of, n[a:b][nodes.unit], len(nodes.at))
            for t, (bit, found) in enumerate(nodes.bits()):
                of_bit = bit.astype(np.int64) << 16
                inputs = [odds_of[table[slots] + of_bit] for table, slots in zip(tables, found)]
                gate = gate_of(inputs, t)
                odds = mixed(inputs, gate, weights)
                p = 1 / (1 + np.exp(-odds.astype(np.float64)))
                error, curve = weight * (bit - p), weight * p * (1 - p)
                curve += 0.01 * weight
                for k, x in enumerate(x.astype(np.float64) for x in inputs):
                    pull = np.bincount(gate, error * x, GATES)
                    bend = np.bincount(gate, curve * x * x, GATES) + 1.0
                    weights[k] = np.clip(weights[k] + 0.15 * pull / bend, -0.5, 2.0)
                seen += np.bincount(gate, weight, GATES)
                place = gate * BUCKETS + bucket_of(odds)
                sums[0] += np.bincount(place, weight * (1 - bit), GATES * BUCKETS)
                sums[1] += np.bincount(place, weight * bit, GATES * BUCKETS)
    fields = [pa.array([x.astype("<f8").tobytes()]) for x in (weights, seen, sums)]
    yield pa.RecordBatch.from_arrays(fields, ["weights", "seen", "sums"])


def joined_mixing(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """Weights averaged by bits seen, and the map as probabilities."""
    load = lambda r, c, shape: np.frombuffer(bytes(r[c]), "<f8").reshape(shape)
    seen = sum((load(r, "seen", GATES) for r in rows), np.zeros(GATES))
    total = sum((load(r, "weights", (-1, GATES)) * load(r, "seen", GATES) for r in rows), np.zeros((len(ORDERS), GATES)))
    weights = np.where(seen > 0, total / np.maximum(seen, 1), 0.35).astype(np.float32)
    zeros, ones = sum((load(r, "sums", (2, -1)) for r in rows), np.zeros((2, GATES * BUCKETS)))
    prior = np.tile(1 / (1 + np.exp(-(np.arange(BUCKETS) - 16) / 2)), GATES)
    return weights, ((ones + 8 * prior) / (zeros + ones + 8)).astype(np.float32)


def node_scores(nodes: Nodes, log_odds: np.ndarray, weights: np.ndarray, refine: np.ndarray) -> np.ndarray:
    """log10 probability of each node's byte after what comes before it."""
    tables = [log_odds[first : first + (1 << bits)].view(np.uint16) for first, bits in zip(FIRST_SLOT, BITS)]
    halves = np.arange(1 << 16, dtype=np.uint16).view(np.float16).astype(np.float32)
    out = np.zeros(len(nodes.at))
    for part in nodes.slices():
        total = out[part]
        for t, (bit, found) in enumerate(nodes.bits(part)):
            inputs = [halves[table[slots]] for table, slots in zip(tables, found)]
            gate = gate_of(inputs, t)
            p = refined(mixed(inputs, gate, weights), gate, refine)
            total += np.log10(np.where(bit == 1, p, 1 - p))
    return out


def laid_scores(flat: np.ndarray, sizes: np.ndarray, log_odds: np.ndarray, weights: np.ndarray, refine: np.ndarray) -> np.ndarray:
    """log10 probability of each unit; the units lie one after another, behind their marks."""
    out, ends = [np.zeros(0)], np.cumsum(sizes)
    for a, b in groups_of_units((sizes - 1).tolist(), SHARED_BYTES):
        nodes = Nodes(flat[ends[a] - sizes[a] : ends[b - 1]], sizes[a:b])
        out.append(np.bincount(nodes.unit, node_scores(nodes, log_odds, weights, refine)[nodes.of], b - a))
    return np.concatenate(out)


def unit_scores(marks: list[int], units: list[bytes], log_odds: np.ndarray, weights: np.ndarray, refine: np.ndarray) -> np.ndarray:
    """log10 probability of each unit."""
    return laid_scores(*behind_marks(marks, b"".join(units), np.array([len(u) for u in units])), log_odds, weights, refine)


def key_scores(keys: pa.Array, model: tuple) -> np.ndarray:
    """log10 probability of each unit; a key is a mark and a unit."""
    flat, offsets = bytes_of(keys)
    sizes = np.diff(offsets)
    if sizes.max(initial=0) <= BYTES_AT_ONCE + 1:
        return laid_scores(flat, sizes, *model)
    pieces = [cut_long(key[0], key[1:]) for key in keys.to_pylist()]
    values = unit_scores([m for ps in pieces for m, _ in ps], [u for ps in pieces for _, u in ps], *model)
    return np.bincount(np.repeat(np.arange(len(pieces)), [len(ps) for ps in pieces]), values, len(pieces))


def words_in(data: bytes, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    return [data[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


def digests_of(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w, 42) for w in words], np.uint64)  # as Spark's xxhash64


def score_hot_units(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """Digests and scores of many units in two arrays a row."""
    for batch in batches:
        units, offsets = bytes_of(batch.column("unit"))
        flat, sizes = behind_marks(batch.column("mark").to_numpy(), units, np.diff(offsets))
        ends = np.cumsum(sizes)
        keys = words_in(flat.tobytes(), ends - sizes, ends)
        fields = digests_of(keys).astype("<u8"), key_scores(pa.array(keys, pa.large_binary()), model.value).astype("<f8")
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()]) for x in fields], ["digests", "scores"])


def looked_up(digests: np.ndarray, known: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which digests are among the known ones, which are in order, and their values (else 0)."""
    if not len(known):
        return np.zeros(len(digests), bool), np.zeros(len(digests))
    at = np.minimum(np.searchsorted(known, digests), len(known) - 1)
    found = known[at] == digests
    return found, np.where(found, values[at], 0.0)


def score_rows(batches: Iterator[pa.RecordBatch], model, hot, name: str, hot_units=None) -> Iterator[pa.RecordBatch]:
    """Per row: tokens, known ones and sum of log10(c + 1) among the hot tokens, the score, the
    bytes, and the tokens that are not hot."""
    none = np.zeros(0, np.uint64), np.zeros(0)
    held = worker_cache("lm scores")
    if held.get("name") != name:
        held.clear()
        held |= {"name": name, "units": none}
    hashes, log_counts = hot.value
    ready = hot_units.value if hot_units else none
    log_of_end = float(log_counts[-1])  # the end token's entry is the last
    for batch in batches:
        for part in text_chunks(batch, size=HELD_TEXT):
            keys, text = keys_of(part.column("text"))
            codes, (flat, offsets) = keys.indices.to_numpy(), bytes_of(keys.dictionary)
            data = flat.tobytes()
            digests = digests_of(words_in(data, offsets[:-1], offsets[1:]))
            is_ready, scores = looked_up(digests, *ready)
            is_held, lately = looked_up(digests, *held["units"])
            scores += np.where(is_ready, 0.0, lately)
            new = np.flatnonzero(~(is_ready | is_held))
            scores[new] = key_scores(keys.dictionary.take(pa.array(new)), model.value)
            # what comes again among as many words stays
            room = len(held["units"][0]) + len(new) <= UNITS_HELD
            kept = (np.concatenate([x, y[new]]) if room else y[~is_ready] for x, y in zip(held["units"], (digests, scores)))
            lately, values = kept
            order = np.argsort(lately)
            held["units"] = lately[order], values[order]

            tokens = words_in(data.lower(), offsets[:-1] + 1, offsets[1:] - 1)
            is_token = np.diff(offsets) > 2  # more than a mark and an end
            is_hot, logs = looked_up(digests_of(tokens), hashes, log_counts)
            is_rare = is_token & ~is_hot
            pool = pa.array([tokens[i] for i in np.flatnonzero(is_rare).tolist()], pa.binary())
            rare = is_rare[codes]
            n = len(part)
            sums = lambda x: np.bincount(text, x[codes], n)
            n_tokens = sums(is_token).astype(np.int64) + 1
            n_rare = np.bincount(text[rare], minlength=n)
            offsets = np.concatenate([[0], np.cumsum(n_rare)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("held_out"),
                    pa.array(n_tokens),
                    pa.array(n_tokens - 1 - n_rare + (log_of_end > 0)),
                    pa.array(sums(np.where(is_token, logs, 0.0)) + log_of_end),
                    pa.array(sums(scores)),
                    pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pool.take(pa.array((np.cumsum(is_rare) - 1)[codes[rare]]))),
                ],
                ["doc_id", "held_out", "n_tokens", "hot_known", "hot_logs", "score", "bytes", "rare"],
            )


def hottest(hashed: DataFrame, most: int) -> DataFrame:
    """About `most` rows (n, digest) of the highest n: of those at the last n a share, by digest."""
    left, least, room, ties = most, 0, 0, 1
    # different counts add up to the corpus' words at most, so there are few of them
    for row in hashed.groupBy("n").agg(F.count("*").alias("tokens")).orderBy(F.desc("n")).toLocalIterator():
        if row["tokens"] > left:
            least, room, ties = row["n"], left, row["tokens"]
            break
        left -= row["tokens"]
    return hashed.filter((F.col("n") > least) | ((F.col("n") == least) & (F.pmod("digest", F.lit(ties)) < room)))


def pack_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests and counts of many rows in two arrays a row."""
    for batch in batches:
        fields = [pa.array([np.asarray(batch.column(c)).astype("<i8").tobytes()]) for c in ("digest", "n")]
        yield pa.RecordBatch.from_arrays(fields, ["digests", "counts"])


def unpacked(rows: list, *columns: str) -> tuple[np.ndarray, np.ndarray]:
    """Digests in order, and the values of each."""
    load = lambda c, kind: np.concatenate([np.zeros(0, kind), *(np.frombuffer(r[c], kind) for r in rows)])
    digests, values = (load(c, kind) for c, kind in zip(columns, ("<u8", "<f8")))
    order = np.argsort(digests)
    return digests[order], values[order]


def hot_table(hashed: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Digests in order, and log10(n + 1) of each."""
    packed = hottest(hashed, most).select("digest", "n").mapInArrow(pack_tokens, "digests binary, counts binary").collect()
    load = lambda c: np.concatenate([np.zeros(0, "<i8"), *(np.frombuffer(r[c], "<i8") for r in packed)])
    digests = load("digests").view(np.uint64)
    order = np.argsort(digests)
    return digests[order], np.log10(load("counts").astype(np.float64) + 1)[order]


def score(
    df: DataFrame,
    modulus: int = 7,
    held_out: int = 2,
    hot_tokens: int = 1 << 19,
    units_per_task: int = 250_000,
    units_per_count: int = 2_000_000,
    hot_units: int = 1 << 20,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Weights are learned from `units_per_task` words a task; contexts are counted some orders at a time, from
    `units_per_count` words a task, as every task's tables are to be shipped and summed."""
    spark = df.sparkSession
    shelf = Shelf(spark, "lm")
    docs = pick(df, "doc_id", "text").select("doc_id", (id_remainder(modulus) == held_out).alias("held_out"), "text")
    training = docs.filter("NOT held_out")
    units = shelf.put(
        training.select("text")
        .mapInArrow(count_units, "mark int, unit binary, n long")
        .groupBy("mark", "unit")
        .agg(F.sum("n").alias("n")),
        "units",
    )
    tokens = shelf.put(
        units.select("unit", "n").mapInArrow(count_tokens, "token binary, n long").filter("octet_length(token) > 0")
        .groupBy("token").agg(F.sum("n").alias("n")),
        "tokens",
    )
    n_words, n_distinct = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n_texts, n_units = training.count(), units.count()
    n_all, n_distinct = n_words + n_texts, n_distinct + (n_texts > 0)

    # the same order whenever it is read, so that the online pass gives the same weights
    whole = units.repartition(max(1, math.ceil(n_units / units_per_task)), F.xxhash64("mark", "unit"))
    whole = whole.sortWithinPartitions(F.xxhash64("unit"), "mark", "unit")
    counted = units.coalesce(max(1, math.ceil(n_units / units_per_count)))
    of_orders = [
        counted.mapInArrow(lambda it, ats=ats: context_counts(it, *ats), "block int, hit binary, counts binary")
        for ats in COUNTED_TOGETHER
    ]
    blocks = reduce(DataFrame.unionAll, of_orders).groupBy("block").applyInArrow(sum_block, "block int, counts binary")
    sc = spark.sparkContext
    counts = counts_table(shelf.put(blocks, "blocks").toLocalIterator())  # of a fixed size
    log_odds = log_odds_of(counts)
    shared = sc.broadcast(counts)
    del counts
    mixing = whole.mapInArrow(lambda it: learn_mixing(it, shared), "weights binary, seen binary, sums binary").collect()
    shared.destroy()
    model = sc.broadcast((log_odds, *joined_mixing(mixing)))
    del log_odds

    digests, logs = hot_table(tokens.select("n", F.xxhash64("token").alias("digest")), hot_tokens)
    hot = sc.broadcast((digests, np.append(logs, math.log10(n_texts + 1))))

    hashed = units.withColumn("digest", F.xxhash64("mark", "unit"))
    schema = "digests binary, scores binary"
    known = hottest(hashed, hot_units).select("mark", "unit").mapInArrow(lambda it: score_hot_units(it, model), schema)
    ready = sc.broadcast(unpacked(known.collect(), "digests", "scores"))

    kind = docs.schema["doc_id"].dataType.simpleString()
    name = shelf.root
    scored = docs.mapInArrow(
        lambda it: score_rows(it, model, hot, name, ready),
        f"doc_id {kind}, held_out boolean, n_tokens long, hot_known long, hot_logs double, score double, "
        "bytes long, rare array<binary>",
    )
    scored = shelf.put(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    shelf.drop("units", "blocks")
    rest = scored.select("row", F.explode("rare").alias("token")).groupBy("row", "token").agg(F.count("*").alias("times"))
    rest = (
        rest.join(tokens, "token")
        .groupBy("row")
        .agg(F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_logs"))
    )
    n_known = F.col("hot_known") + F.coalesce("rare_known", F.lit(0))
    logs = F.col("hot_logs") + F.coalesce("rare_logs", F.lit(0.0))
    return scored.drop("rare").join(rest, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        n_known.alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * math.log10(n_all + n_distinct + 1)).alias("base_score"),
        "score",
        (-F.col("score") / math.log10(2) / F.greatest("bytes", F.lit(1))).alias("bits_per_byte"),
    )
