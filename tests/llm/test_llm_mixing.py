"""Mixing against the same steps in plain Python, and the promises of a mix."""

import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from waybill.llm import mixing, queries
from waybill.llm.common import pick

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KIND = "doc_id long, text string, source string"


def targets_of(sizes, weights, share, most):
    """Shares that stop at the cap, the excess reshared until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, shares, open_ = share * sum(sizes.values()), {}, set(order)
    while open_:
        each = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if each[s] >= most * sizes[s]}
        if not above:
            shares |= each
            break
        for s in above:
            shares[s] = Fraction(most * sizes[s])
            left -= shares[s]
        open_ -= above
    return shares


def expected_of(rows, weights=(5, 2, 1), share=Fraction(3, 2), most=2, long_from=4096):
    """rows: doc_id, text, source, u."""
    size = [len(WORD.findall(text or "")) for _, text, _, _ in rows]
    per_source = defaultdict(int)
    members = defaultdict(list)
    for i, (_, _, source, _) in enumerate(rows):
        per_source[source] += size[i]
        members[source].append(i)
    targets = targets_of(per_source, weights, share, most)
    taken = [0] * len(rows)
    for source, target in targets.items():
        held = [i for i in members[source] if size[i]]
        copies, left, open_ = {}, target, set(held)
        while open_:
            level = left / sum(min(size[i], long_from) for i in open_)
            above = {i for i in open_ if level * min(size[i], long_from) >= most * size[i]}
            if not above:
                copies |= {i: level * min(size[i], long_from) / size[i] for i in open_}
                break
            for i in above:
                copies[i] = Fraction(most)
                left -= most * size[i]
            open_ -= above
        words = int(float(target) + 0.5)
        for i in held:
            taken[i] = int(copies[i]) * size[i]
            words -= taken[i]
        odds = lambda p: p / (1 - p)
        ranked = [(odds(rows[i][3]) / odds(float(copies[i] % 1)), rows[i][0] or -1, i) for i in held if copies[i] % 1]
        for _, _, i in sorted(ranked):
            more = max(0, min(size[i], words))
            taken[i] += more
            words -= more
    return Counter(
        (rows[i][0], size[i], per_source[rows[i][2]], round(float(targets[rows[i][2]]), 6), taken[i]) for i in range(len(rows))
    )


def numbered(df, seed=0):
    chosen = pick(df, "doc_id", "text", "source")
    return [tuple(r) for r in chosen.withColumn("u", mixing.uniform(seed)).collect()]


def got(df):
    return Counter((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in df.collect())


ODD = (
    [(i, "word " * (1 + i * 7 % 23), f"s{i % 5}") for i in range(300)]
    + [(1000 + i, "a b\tc\nd\x0be\x0cf\rg h", "s1") for i in range(40)]
    + [(7, "same row twice", "s2")] * 6
    + [(400, None, "s0"), (401, "", None), (402, " \n ", "blank"), (None, "no id at all", None), (None, None, None)]
    + [(403, "long " * 30000, "s3"), (404, "long " * 9000, "s4"), (405, "one", "zz"), (406, "x" * 50000, "Z")]
)


@pytest.mark.parametrize("rows_per_bucket, long_from", [(2_000, 4096), (3, 3)])
def test_odd_rows(spark, rows_per_bucket, long_from):
    df = spark.createDataFrame([(*r, "x", 3, 4) for r in ODD], KIND + ", Source string, size int, row int").repartition(3)
    mixed = mixing.mix(df, rows_per_bucket=rows_per_bucket, long_from=long_from)
    assert mixed.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert got(mixed) == expected_of(numbered(df), long_from=long_from)


def test_given_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    mixed = queries.op13_mixing(spark, "/root/testdata/sf0.001")
    first = got(mixed)
    assert first == expected_of(numbered(docs))
    assert first == got(mixing.mix(docs.repartition(5)))  # reruns agree, whatever the partitioning
    assert first != got(mixing.mix(docs, seed=1))
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    taken, target = Counter(), {}
    for doc, size, _, aim, words in first:
        assert 0 <= words <= 2 * size
        taken[source[doc]] += words
        target[source[doc]] = aim
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in target)
    sizes = Counter(r["source"] for r in docs.collect() for _ in WORD.findall(r["text"] or ""))
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_few_words_or_none(spark):
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], KIND)
    assert got(mixing.mix(blank)) == Counter([(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)])
    assert mixing.mix(blank.filter("false")).collect() == []
    one = spark.createDataFrame([(1, "just three words", None)], KIND)
    assert got(mixing.mix(one)) == Counter([(1, 3, 3, 4.5, 5)])
