"""Cross-tokenizer alignment: which ids of one tokenizer cover the same bytes as which of another.

Of each text, both tokenizations' cumulative byte ends go into dictionaries from end to index. The
intersection of the two key sets, sorted, are the places where tokens of both end; it slices both id
lists into groups, and each group's links are all its pairs of an A and a B token.

Neither tokenizer joins anything across the border of certain units (a word with the space before it,
a line feed before a letter, punctuation after a word). So such a border ends tokens of both, groups
never cross it, and a unit is tokenized and aligned once per process, however many texts have it.
Whether the B vocabulary permits this is looked up when it is loaded; texts with other white space, and
texts whose bytes do not come back from every unit, are tokenized and aligned whole.

Over the corpus, an id pair's count is the number of documents that hold it linked, and a pair is best
where no pair of the same A id has a higher count. Each text leaves its distinct pairs with the number
of their links; counting them combines on the map side. The most frequent pairs, at most `hot_pairs`,
then travel to all tasks, so that no hot pair is a shuffle key; all others are joined by shuffle.

Defined cases: a text that is null or empty, or whose tokens' bytes differ from space + text (such as
one with U+2581, which B takes for a space), has no tokens: zeros and an empty groups_sha256. Every row
is a document; repeated rows count again, and a null id is an id like any other. An empty table gives no
rows. Other columns are left out."""

from __future__ import annotations

import hashlib
import os
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from itertools import accumulate, count

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import Shelf, pick, text_chunks, worker_cache

#: Units kept are this many since the last change of generation, and those of the generation before.
UNITS_KEPT = 300_000
#: From so many links on a group's tokens are counted first.
MANY_LINKS = 64
#: Longer units are not kept.
UNIT_LENGTH = 64
SEGMENT = 1 << 20
HOT_PAIRS = 1 << 19
B_SPACE = "▁"
LETTERS = "a-zA-ZÀ-ÖØ-öø-ɏ"
ENDINGS = ".,;:!?"
#: What one unit is, tried in this order, in texts whose white space is spaces and line feeds.
WORD_UNIT = rf" ?[{LETTERS}]+(?=[{ENDINGS}\n]| \S)|"
UNITS = r"\n(?=\S)| ?\S+|\s+\S+|\s+"
OTHER_SPACE = re.compile("[^\\S \n]|[\x1c-\x1f]")
SAFE_CUT = re.compile(r"(?<=\S)(?= \S)")

#: n_a, n_b, n_groups, n_links, the groups as text, pairs, and their links unless there is one of each
Aligned = tuple[int, int, int, int, str, tuple[int, ...], tuple[int, ...] | None]


def aligned(a_ids: Sequence[int], a_ends: Iterable[int], b_ids: Sequence[int], b_ends: Iterable[int]) -> Aligned:
    """Ids and byte ends of both sides to groups and links."""
    in_a, in_b = dict(zip(a_ends, count(1))), dict(zip(b_ends, count(1)))
    shown, pairs, n_links, a, b = [], [], 0, 0, 0
    links: dict[int, int] = {}
    for end in sorted(in_a.keys() & in_b.keys()):
        next_a, next_b = in_a[end], in_b[end]
        if next_a - a == next_b - b == 1:
            shown.append(f"{a_ids[a]}|{b_ids[b]}")
            pairs.append(a_ids[a] << 32 | b_ids[b])
            n_links += 1
        else:
            left, right = a_ids[a:next_a], b_ids[b:next_b]
            shown.append(f"{','.join(map(str, left))}|{','.join(map(str, right))}")
            n_links += len(left) * len(right)
            if len(left) * len(right) < MANY_LINKS:
                pairs += [x << 32 | y for x in left for y in right]
            else:  # a group of many equal tokens has few distinct pairs
                times_right = Counter(right).items()
                for x, n in Counter(left).items():
                    for y, m in times_right:
                        links[x << 32 | y] = links.get(x << 32 | y, 0) + n * m
        a, b = next_a, next_b
    if links or len(set(pairs)) < len(pairs):
        for pair in pairs:
            links[pair] = links.get(pair, 0) + 1
        return len(a_ids), len(b_ids), len(shown), n_links, ";".join(shown), tuple(links), tuple(links.values())
    return len(a_ids), len(b_ids), len(shown), n_links, ";".join(shown), tuple(pairs), None


class Aligner:
    """Both tokenizers, and the alignments of units seen so far."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark owns the cores
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letter_of = {b: chr(b) for b in plain}
        self.letter_of |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}
        byte_of = {letter: b for b, letter in self.letter_of.items()}
        # only with this pre-tokenizer, which makes a word one piece, may words skip it
        plain_words = str(self.a.pre_tokenizer).startswith("ByteLevel(add_prefix_space=False") and self.a.normalizer is None
        self.is_word = re.compile(f" ?[{LETTERS}]+" if plain_words else r"(?!)").fullmatch
        special = {token.content for token in self.a.get_added_tokens_decoder().values()}
        self.a_bytes = {
            i: bytes(byte_of[c] for c in token) if token not in special else b"" for token, i in self.a.get_vocab().items()
        }
        self.b = SentencePieceProcessor(model_file=b_path)
        b_size = range(self.b.get_piece_size())
        pieces = [self.b.id_to_piece(i) for i in b_size]
        self.b_bytes = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(B_SPACE, " ").encode()
            for i, piece in enumerate(pieces)
        ]
        ordinary = [p for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        self.splits = not any(B_SPACE in p.lstrip(B_SPACE) or "\n" in p or " " in p for p in ordinary)
        joined = re.compile(f"[{LETTERS}][{ENDINGS}]")
        self.unit = re.compile((UNITS if any(map(joined.search, ordinary)) else WORD_UNIT + UNITS))
        self.known: dict[str, Aligned | None] = {}
        self.before: dict[str, Aligned | None] = {}

    def _align(self, a_ids: list[int], b_ids: list[int], expected: bytes) -> Aligned | None:
        a_tokens, b_tokens = [self.a_bytes[i] for i in a_ids], [self.b_bytes[i] for i in b_ids]
        if b"".join(a_tokens) != expected or b"".join(b_tokens) != expected:
            return None
        return aligned(a_ids, accumulate(map(len, a_tokens)), b_ids, accumulate(map(len, b_tokens)))

    def whole(self, text: str) -> Aligned | None:
        """The alignment of space + text; None where bytes are lost."""
        a_ids = self.a.encode(" " + text, add_special_tokens=False).ids
        return self._align(a_ids, self.b.encode(text), (" " + text).encode())

    def _a_ids(self, units: list[str]) -> list[list[int]]:
        """A word is one piece before A's merges, so it goes to the merges as the letters of its bytes."""
        words = list(map(self.is_word, units))
        others = iter(self.a.encode_batch([u for u, word in zip(units, words) if not word], add_special_tokens=False))
        merged, letter_of = self.a.model.tokenize, self.letter_of
        return [
            [t.id for t in merged(u.encode().decode("latin-1").translate(letter_of))] if word else next(others).ids
            for u, word in zip(units, words)
        ]

    def learn(self, units: list[str]) -> None:
        """Align units. B sets a space before its text, so it gets a line feed before the unit;
        both come back as tokens of their own and are taken off."""
        b = self.b.encode(["\n" + u for u in units], num_threads=1)
        for unit, a_ids, b_ids in zip(units, self._a_ids(units), b):
            apart = [self.b_bytes[i] for i in b_ids[:2]] == [b" ", b"\n"]
            self.known[unit] = self._align(a_ids, b_ids[2:], unit.encode()) if apart else None

    def segments(self, text: str) -> Iterator[list[str]]:
        """The units of space + text, about SEGMENT characters at a time."""
        text, start = " " + text, 0
        while start < len(text):
            cut = SAFE_CUT.search(text, start + SEGMENT) if len(text) - start > SEGMENT else None
            stop = cut.start() if cut else len(text)
            yield self.unit.findall(text, start, stop)
            start = stop

    def by_units(self, text: str) -> tuple | None:
        """Totals, digest and pairs of one text from its units; None where a unit loses bytes."""
        n_a = n_b = n_groups = n_links = 0
        pairs: dict[int, int] = {}
        digest = hashlib.sha256()
        known, first = self.known, True
        for units in self.segments(text):
            found = Counter(units)
            new = []
            for unit in found:
                if unit not in known:
                    if unit in self.before:
                        known[unit] = self.before[unit]
                    else:
                        new.append(unit)
            if new:
                self.learn(new)
            for unit, times in found.items():
                entry = known[unit]
                if entry is None:
                    self._forget(new)
                    return None
                n_a += times * entry[0]
                n_b += times * entry[1]
                n_groups += times * entry[2]
                n_links += times * entry[3]
                if entry[6] is None:
                    for code in entry[5]:
                        pairs[code] = pairs.get(code, 0) + times
                else:
                    for code, links in zip(entry[5], entry[6]):
                        pairs[code] = pairs.get(code, 0) + times * links
            digest.update(("" if first else ";").encode() + ";".join([known[u][4] for u in units]).encode())
            first = False
            self._forget(new)
            known = self.known
        return n_a, n_b, n_groups, n_links, digest.hexdigest(), pairs

    def _forget(self, new: list[str]) -> None:
        for unit in new:
            if len(unit) > UNIT_LENGTH:
                del self.known[unit]
        if len(self.known) > UNITS_KEPT:
            self.known, self.before = {}, self.known

    def __call__(self, text: str | None) -> tuple:
        if not text:
            return 0, 0, 0, 0, "", {}
        found = None
        if self.splits and not OTHER_SPACE.search(text):
            found = self.by_units(text)
        if found is None:
            entry = self.whole(text)
            if entry is None:
                return 0, 0, 0, 0, "", {}
            links = entry[6] or [1] * len(entry[5])
            found = (*entry[:4], hashlib.sha256(entry[4].encode()).hexdigest(), dict(zip(entry[5], links)))
        return found


def align_texts(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[pa.RecordBatch]:
    held = worker_cache(f"alignment {a_path} {b_path}")
    if not held:
        held["aligner"] = Aligner(a_path, b_path)
    aligner = held["aligner"]
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    for batch in batches:
        for part in text_chunks(batch):
            found = [aligner(text) for text in part.column("text").to_pylist()]
            columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(4)]
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    *columns,
                    pa.array([f[4] for f in found], pa.string()),
                    pa.array([list(f[5]) for f in found], lists),
                    pa.array([list(f[5].values()) for f in found], lists),
                ],
                ["doc_id", *numbers, "groups_sha256", "pairs", "links"],
            )


def rated_pairs(staged: DataFrame) -> DataFrame:
    """pair, n (documents that hold it) and best, over all documents."""
    counts = staged.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    return counts.withColumn("a", F.shiftright("pair", 32))


def align(
    df: DataFrame, a_path: str | None = None, b_path: str | None = None, hot_pairs: int = HOT_PAIRS
) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = df.sparkSession
    shelf = Shelf(spark, "alignment")
    a_path = a_path or public_tokenizers.path("byte_bpe_50k.json")
    b_path = b_path or public_tokenizers.path("piece_bpe_32k.model")
    docs = pick(df, "doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    staged = shelf.put(
        docs.mapInArrow(
            lambda it: align_texts(it, a_path, b_path),
            f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
            "pairs array<long>, links array<long>",
        ).withColumn("row", F.monotonically_increasing_id()),
        "texts",
    )
    counts = shelf.put(rated_pairs(staged), "counts")
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))  # one row per id of the vocabulary
    rated = shelf.put(
        counts.join(F.broadcast(highest), "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best")),
        "rated",
    )
    # how many pairs there are from each power of two on: at most 63 rows
    power = F.floor(F.log2("n")).cast("int").alias("power")
    histogram = rated.groupBy(power).agg(F.count("*").alias("pairs")).orderBy(F.desc("power")).collect()
    total, cutoff, held = sum(r["pairs"] for r in histogram), None, 0
    for row in histogram:
        if held + row["pairs"] > hot_pairs:
            break
        held, cutoff = held + row["pairs"], row["power"]
    is_hot = F.lit(False) if cutoff is None else F.floor(F.log2("n")) >= cutoff
    hot = F.broadcast(rated.filter(is_hot))  # at most `hot_pairs` rows of three numbers
    linked = staged.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), F.col("p.links").alias("links")
    )
    sums = (
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
        F.sum(F.col("links") * F.col("n")).alias("count_sum"),
    )
    per_row = linked.join(hot, "pair").groupBy("row").agg(*sums)
    if held < total:
        rare = linked.join(hot, "pair", "left_anti").join(rated.filter(~is_hot), "pair")
        per_row = per_row.unionAll(rare.groupBy("row").agg(*sums))
        per_row = per_row.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    none = F.lit(0).cast("long")
    return staged.join(per_row, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"),
        "groups_sha256",
    )
