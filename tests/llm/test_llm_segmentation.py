"""Sampled segmentations against all segmentations of short texts, and round trips."""

import math
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash

from waybill.llm import queries, segmentation

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["the cat 漢x", " two  spaces\nand\tlines\n", "", "x", "Ünïcode 🙂 text", "a" * 40, "▁"]


@pytest.fixture(scope="module")
def pieces():
    return segmentation.pieces_of(PATH)


def all_segmentations(text, pieces):
    """Ids -> log-probability, by enumeration."""
    s = "▁" + text.replace(" ", "▁")
    found = []

    def go(i, path, weight):
        if i == len(s):
            found.append((tuple(path), weight))
        for n in range(1, min(16, len(s) - i) + 1):
            known = pieces.processor.piece_to_id(s[i : i + n])
            if pieces.weight[known] > -math.inf:
                go(i + n, [*path, known], weight + pieces.weight[known])
            elif n == 1:
                raw = s[i].encode()
                go(i + 1, [*path, *(pieces.bytes[b] for b in raw)], weight + pieces.byte_weight * len(raw))

    go(0, [], 0.0)
    total = np.logaddexp.reduce([w for _, w in found])
    return {p: w - total for p, w in found}


def draws(text, pieces, k, n):
    seeds = [xxhash.xxh64_intdigest(str(i)) for i in range(n)]
    lattices, searches = segmentation.sample_texts([text] * n, seeds, pieces, k)
    for s in searches:
        yield s, [tuple(segmentation.piece_ids(d.edges, lattices, pieces).tolist()) for d in s.draws]


def test_draws_are_distinct_ordered_and_follow_the_distribution(pieces):
    truth = all_segmentations("the cat 漢x", pieces)
    first, length, n = Counter(), 0.0, 2000
    for search, found in draws("the cat 漢x", pieces, 3, n):
        assert len(set(found)) == 3 and set(found) <= set(truth)
        values = [d.value for d in search.draws]
        assert values == sorted(values, reverse=True) and search.kappa() < values[-1]
        first[found[0]] += 1
        kappa = search.kappa()
        length += sum(math.exp(truth[x]) * len(x) / -math.expm1(-math.exp(truth[x] - kappa)) for x in found)
    for x, log_p in truth.items():
        p = math.exp(log_p)
        assert abs(first[x] / n - p) < 5 * math.sqrt(p / n) + 1e-3
    # weighted by inclusion scores, samples without replacement estimate means without bias
    assert length / n == pytest.approx(sum(math.exp(w) * len(x) for x, w in truth.items()), abs=0.1)


def test_few_segmentations_are_all_found(pieces):
    truth = all_segmentations("at", pieces)
    for search, found in draws("at", pieces, 50, 20):
        assert set(found) == set(truth) and search.kappa() == -math.inf


def test_round_trip_and_repeatability(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (90, None), (3, "x")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, rank int, Text string")
    got = segmentation.encode(df, k=3).collect()
    again = segmentation.encode(df.repartition(4), k=3).collect()
    key = lambda r: (str(r.doc_id), r.rank, tuple(r.ids), r.perturbed)
    assert sorted(map(key, got)) == sorted(map(key, again))
    texts = defaultdict(set)
    for doc, text in rows:
        texts[doc].add((text or "").replace("▁", " "))
    for r in segmentation.decode(spark.createDataFrame(got)).collect():
        assert r.text in texts[r.doc_id]
    empty = [r for r in got if r.doc_id in (2, 90)]
    assert [(r.ids, r.log_prob, r.inclusion) for r in empty] == [([], 0.0, 1.0)] * 2


def test_given_documents_round_trip(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = queries.QUERIES["op1_gumbel_top_k"](spark, "/root/testdata/sf0.001")
    back = segmentation.decode(got)
    texts = {r.doc_id: r.text for r in df.collect()}
    rows = back.collect()
    assert all(r.text == texts[r.doc_id] for r in rows) and {r.doc_id for r in rows} == set(texts)


def test_long_word(pieces):
    (search, found), = draws("q" * 20_000, pieces, 2, 1)
    assert found[0] != found[1] and pieces.processor.decode(list(found[1])) == "q" * 20_000


def test_no_rows(spark):
    assert segmentation.encode(spark.createDataFrame([], "doc_id long, text string")).collect() == []
