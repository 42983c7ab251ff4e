"""Source divergence against a count of every term in every group."""

import re
from collections import Counter, defaultdict

import pytest

from waybill.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
KIND = "doc_id long, text string, lang string, source string"


def expected_of(rows, least, top):
    in_docs, counts = Counter(), defaultdict(Counter)
    for _, text, lang, source in rows:
        terms = [t.translate(LOWER) for t in TERM.findall(text or "")]
        counts[lang or "", source or ""].update(terms)
        in_docs.update((lang or "", t) for t in set(terms))
    out = []
    for lang in {lang for lang, _ in counts}:
        kept = [t for (where, t), n in in_docs.items() if where == lang and n >= least]
        sources = [s for where, s in counts if where == lang]

        def rated(count):
            total = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 5) // total for t in kept}

        p = {s: rated(counts[lang, s]) for s in sources}
        q = rated(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(ranked, 1)]
    return Counter(out)


def got(df, **more):
    return Counter(map(tuple, divergence.audit(df, **more).select("lang", "source", "part", "item", "value", "rank").collect()))


ODD = [
    (1, "The the THE Ünï ünï ÜNÏ x9y 日本 a\u0000b", "en", "s1"),
    (2, "the cat-sat [on] the mat @home", "en", "s2"),
    (2, "the cat-sat [on] the mat @home", "en", "s2"),
    (None, "mat Mat mat cat", "en", None),
    (4, None, "en", "s4"),
    (5, "", None, "s1"),
    (6, "12 34 .,", "de", "s1"),
    (7, "nur hier", "de", "s2"),
    (8, "un seul", "fr", "s1"),
    (9, "the " * 40000 + "tail", "en", "s5"),
    (10, "x" * 100000, "en", "s5"),
]


@pytest.mark.parametrize("tile, chunk, held", [(64, 20_000, 400_000), (2, 3, 5), (1, 1, 0)])
def test_odd_rows(spark, monkeypatch, tile, chunk, held):
    monkeypatch.setattr(divergence, "SOURCES_PER_TILE", tile)
    monkeypatch.setattr(divergence, "BITMAPS_PER_CHUNK", chunk)
    monkeypatch.setattr(divergence, "ENTRIES_HELD", held)
    monkeypatch.setattr(divergence, "SEGMENT", 1000)
    df = spark.createDataFrame([(*r, "x", 1) for r in ODD], KIND + ", Text string, value int")
    for least in (1, 2, 50):
        assert got(df, least_documents=least, top_terms=3) == expected_of(ODD, least, 3)


def test_given_rows_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SOURCES_PER_TILE", 7)
    monkeypatch.setattr(divergence, "BITMAPS_PER_CHUNK", 2000)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source")
    assert got(docs, least_documents=5) == expected_of([tuple(r) for r in docs.collect()], 5, 50)


def test_terms_of_like_count_share_words(spark):
    """More than 64 terms of one count are one bitset each 64, whatever the group."""
    rows = [(i, " ".join(chr(0x4E00 + j) for j in range(200)), "zh", f"s{i}") for i in range(3)]
    df = spark.createDataFrame(rows, KIND)
    found = got(df, least_documents=3)
    assert found == expected_of(rows, 3, 50) and {v for _, _, _, _, v, _ in found} == {0}


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], KIND)).collect() == []
