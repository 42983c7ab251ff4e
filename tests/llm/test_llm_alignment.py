"""Alignment of two tokenizers against a naive one over whole texts."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from waybill.llm import alignment, queries

SF = "/root/testdata/sf0.001"
A_LETTERS = "".join(chr(b) for b in [*range(33, 127), *range(161, 173), *range(174, 256)])


def tokens_of(text):
    """(id, start, end) of both sides, whole text at once; None where bytes differ."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    others = [x for x in range(256) if chr(x) not in A_LETTERS]
    byte_of = {c: ord(c) for c in A_LETTERS} | {chr(256 + i): x for i, x in enumerate(others)}
    names = {i: t for t, i in a.get_vocab().items()}

    def both(text):
        if not text:
            return None
        left = [(i, bytes(byte_of[c] for c in names[i])) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        if b"".join(t for _, t in left) != whole or b"".join(t for _, t in right) != whole:
            return None
        return left, right

    return [both(t) for t in text]


def expected_of(rows):
    tokenized = tokens_of([t for _, t in rows])
    grouped = []
    for found in tokenized:
        groups = []
        if found:
            ends = [set(), set()]
            for side, tokens in enumerate(found):
                at = 0
                for _, piece in tokens:
                    at += len(piece)
                    ends[side].add(at)
            common = sorted(ends[0] & ends[1])
            groups = [([], []) for _ in common]
            for side, tokens in enumerate(found):
                at = group = 0
                for i, piece in tokens:
                    groups[group][side].append(i)
                    at += len(piece)
                    group += at == common[group]
        grouped.append(groups)
    holders = Counter()
    for groups in grouped:
        holders.update({(x, y) for left, right in groups for x in left for y in right})
    highest = defaultdict(int)
    for (x, _), n in holders.items():
        highest[x] = max(highest[x], n)
    for (doc, _), groups in zip(rows, grouped):
        links = [(x, y) for left, right in groups for x in left for y in right]
        shown = ";".join(f"{','.join(map(str, left))}|{','.join(map(str, right))}" for left, right in groups)
        yield (
            doc,
            sum(len(left) for left, _ in groups),
            sum(len(right) for _, right in groups),
            len(groups),
            len(links),
            sum(holders[p] == highest[p[0]] for p in links),
            sum(holders[p] for p in links),
            hashlib.sha256(shown.encode()).hexdigest() if groups else "",
        )


ODD = [
    "plain words, and some more.",
    "plain words, and some more.",
    "  two  spaces \n\nlines\n begin \n",
    "\nfirst line feed",
    "tab\there, return\r\nand \x0b \x1c \x85   others .",
    "it's I'd we'll don't 12.5 3,000 x2. (a),b;c:d!e?f \"q\" .hidden ..., ²,³. ½",
    "<s> <unk> </s> <|endoftext|> <0x0A> special as text",
    "a ▁ marker is lost",
    "▁",
    "naïve Ünïcödé ×÷ ĀŁɏ ɐʘ 日本語、中文。 😀👩‍👩‍👧 é \u0000 nul",
    "ends with space ",
    " ",
    "\n",
    "",
    None,
    "x" * 5000,
    "ab " * 3000 + "\n" * 300 + "." * 900 + " " * 700 + "z",
    "¡hola! ¿qué? l'été; c'est-à-dire: «oui»",
]


def compared(df, rows, **more):
    got = Counter(tuple(r) for r in alignment.align(df, **more).collect())
    assert got == Counter(expected_of(rows))


@pytest.mark.parametrize("hot_pairs", [1 << 19, 100, 0])
def test_odd_texts(spark, hot_pairs):
    rows = [(i if i % 5 else None, t) for i, t in enumerate(ODD)] + [(1, ODD[1])]
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id long, text string, Text string, pairs int")
    compared(df, rows, hot_pairs=hot_pairs)


def test_given_texts(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op11_alignment(spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, got.collect())) == Counter(expected_of(rows))


def test_long_texts_in_segments(spark, monkeypatch):
    monkeypatch.setattr(alignment, "SEGMENT", 37)
    aligner = alignment.Aligner(
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )
    for text in filter(None, ODD):
        found, whole = aligner(text), aligner.whole(text)
        if whole is None:
            assert found == (0, 0, 0, 0, "", {})
        else:
            assert found[:4] == whole[:4] and found[4] == hashlib.sha256(whole[4].encode()).hexdigest()
            assert found[5] == dict(zip(whole[5], whole[6] or [1] * len(whole[5])))


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id string, text string")).collect() == []
