"""Models, vectors and segmentations."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from waybill.llm import knn, lm_scoring, queries, toxicity
from waybill.llm.common import pick

SF = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_top(rows, modulus, k):
    take = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for i, q in take:
        if i % modulus == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, x)), j) for j, x in take if j != i)[:k]
            out.update((i, n + 1, j, -s) for n, (s, j) in enumerate(scored))
    return out


def test_top_k_of_given_vectors(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert Counter(tuple(r) for r in knn.top_k(df, 20, 20).collect()) == brute_top(rows, 20, 20)


def test_top_k_with_ties_repeats_and_gaps(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in rng.integers(-3, 4, 4) / 64]) for i in range(60)]
    rows += [(100 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(40)]  # one vector that is everywhere
    rows += [(7, [0.1, 0.2, 0.3, 0.4]), (200, None), (None, [1.0] * 4), (220, [1.0, None, 0.0, 0.0]), (240, [float("nan")] * 4), (260, []), (280, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, Embedding string, rank int")
    assert Counter(tuple(r) for r in knn.top_k(df, 20, 5).collect()) == brute_top(rows, 20, 5)


def test_top_k_of_a_query_repeated_more_than_k_times(spark, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK", 8)
    corners = [(16, 63), (25, 60), (33, 56), (39, 52), (52, 39), (56, 33), (60, 25), (63, 16)]  # of one length
    others = [(a * x / 64, b * y / 64) for x, y in corners for a in (1, -1) for b in (1, -1)]
    rows = [(i, list(v)) for i, v in enumerate(others, 101) if i % 20] + [(20, [65 / 64, 0.0])] * 200
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert Counter(tuple(r) for r in knn.top_k(df, 20, 20).collect()) == brute_top(rows, 20, 20)


@pytest.mark.parametrize("largest", [2.0**27, 1e12, 1e200])
def test_top_k_of_large_components(spark, largest):
    """Finite vectors of any size take part; scores beyond a long are its ends."""
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.normal(size=3) * (largest if i % 7 == 0 else 1)]) for i in range(80)]
    rows.append((81, [1.7e308, 0.0, 0.0]))  # its 64-fold is not finite
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    exact = brute_top([r for r in rows if r[0] != 81], 20, 80)
    ends = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    clipped = {}
    for q, _, j, s in exact:
        clipped.setdefault(q, []).append((-ends(s), j))
    expected = Counter((q, n + 1, j, -s) for q, found in clipped.items() for n, (s, j) in enumerate(sorted(found)[:20]))
    assert Counter(tuple(r) for r in knn.top_k(df, 20, 20).collect()) == expected


def test_top_k_in_many_parts(spark, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK", 16)
    monkeypatch.setattr(knn, "BYTES_PER_PART", 1 << 12)
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert Counter(tuple(r) for r in knn.top_k(df, 20, 20).collect()) == brute_top(rows, 20, 20)


def test_bound_counts_ids_and_not_rows():
    """Two copies of a query at its pivot say nothing about where its nearest neighbour is."""
    cells = knn.Cells(np.array([[0.0], [1000.0]]), 1000.0**2)
    shortest, ids = {0: [0.0, 900.0], 1: [0.0]}, {0: [7, 8], 1: [7]}
    pairs = {(i, j): (low, high) for i, j, low, high, *_ in knn.needed(cells, {1: 0.0}, shortest, 1, ids)}
    assert pairs[1, 0][1] >= 2 * cells.apart()[1, 0] + 900 - 1e-3


def test_top_k_of_few_or_no_vectors(spark):
    kind = "vec_id long, embedding array<float>"
    assert knn.top_k(spark.createDataFrame([], kind)).collect() == []
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], kind)
    assert [tuple(r) for r in knn.top_k(few).collect()] == [(0, 1, 1, 64 * 128)]


def test_cells_that_cannot_matter_are_not_read():
    cells = knn.Cells(np.array([[0.0], [1000.0]]), 1000.0**2)
    pairs = {(i, j): (low, high) for i, j, low, high, *_ in knn.needed(cells, {1: 1.0}, {0: [0.0, 0.1], 1: [0.0, 0.5]}, 1)}
    assert pairs[1, 1][0] <= 0 and pairs[1, 0][0] > 1


ODD = [(1, "Hello World.\nhello  again"), (2, None), (3, ""), (None, "hello world"), (4, "äöü ÄÖ " * 50), (5, "z" * 5000), (1, "Hello World.\nhello  again")]


@pytest.mark.parametrize("hot", [1 << 19, 5])
def test_base_scores(spark, hot):
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = given + ODD
    df = spark.createDataFrame([(*r, "t", 1.0) for r in rows], "doc_id long, text string, Text string, score double")
    held = lambda doc: zlib.crc32(b"" if doc is None else str(doc).encode()) % 7 == 2
    tokens = lambda text: re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + [None]
    counts = Counter()
    for doc, text in rows:
        if not held(doc):
            counts.update(tokens(text))
    n, v = sum(counts.values()), len(counts)
    expected = Counter()
    for doc, text in rows:
        t = tokens(text)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t)
        expected[doc, held(doc), len(t), sum(counts[w] > 0 for w in t), n, round(base, 4)] += 1
    got = lm_scoring.score(df, hot_tokens=hot).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == expected
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    shuffled = {r.doc_id: r.bits_per_byte for r in got if r.doc_id in {d for d, _ in given}}
    assert sum(shuffled.values()) / len(shuffled) < 4  # eight without a model


def test_language_model_is_a_distribution():
    """Over all bytes the probabilities of the next byte add up to one."""
    rng = np.random.default_rng(3)
    odds = rng.normal(size=lm_scoring.SLOTS).astype(np.float16)
    weights = np.full((len(lm_scoring.ORDERS), lm_scoring.GATES), 0.3, np.float32)
    refine = rng.uniform(0.1, 0.9, lm_scoring.GATES * lm_scoring.BUCKETS).astype(np.float32)
    units = [b"ab" + bytes((x,)) for x in range(256)] + [b"ab"]
    scores = lm_scoring.unit_scores([0] * 257, units, odds, weights, refine)
    assert (10 ** (scores[:256] - scores[256])).sum() == pytest.approx(1, abs=1e-4)


def test_every_unit_teaches_every_order():
    """A rare word among 310,000 others is in the longest contexts' counts; 300,000 was a limit once."""
    word = "zyxwvutsrqponm"
    bits = lm_scoring.Bits([0], [word.encode() + b" "])
    rare = {int(s) for t in range(8) for s in bits.slots[t][-1]}
    others = [f"{i:x}".encode() + b" " for i in range(310_000)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([0] * 310_001, pa.int32()), pa.array([*others, word.encode() + b" "]), pa.array([2] * 310_000 + [1])],
        ["mark", "unit", "n"],
    )
    hit = set()
    for part in lm_scoring.context_counts(iter([batch]), len(lm_scoring.ORDERS) - 1):
        for block, where in zip(part.column("block").to_pylist(), part.column("hit").to_pylist()):
            hit.update((block * lm_scoring.SLOTS_PER_BLOCK + np.frombuffer(where, "<u2").astype(int)).tolist())
    assert rare <= hit and not hasattr(lm_scoring, "TEACHERS")


def test_orders_counted_apart_are_the_orders_of_all():
    """Each order's counts hit exactly the slots that coding looks up for it."""
    units = [b"word ", b"w\n", "größe ".encode(), b"a" * 40 + b" "]
    bits = lm_scoring.Bits([0, 3, 17, 0], units)
    batch = pa.RecordBatch.from_arrays([pa.array([0, 3, 17, 0], pa.int32()), pa.array(units), pa.array([1] * 4)], ["mark", "unit", "n"])
    for at in range(len(lm_scoring.ORDERS)):
        hit = {}
        for part in lm_scoring.context_counts(iter([batch]), at):
            for block, where, counts in zip(*(part.column(c).to_pylist() for c in ("block", "hit", "counts"))):
                slots = block * lm_scoring.SLOTS_PER_BLOCK + np.frombuffer(where, "<u2").astype(int)
                hit |= dict(zip(slots.tolist(), np.frombuffer(counts, "<f4").reshape(2, -1).T.tolist()))
        expected = Counter((int(s), int(b)) for t in range(8) for s, b in zip(bits.slots[t][at], bits.bit[t]))
        assert {(s, b): c[b] for s, c in hit.items() for b in (0, 1) if c[b]} == dict(expected)


def test_words_beyond_a_group_are_coded_in_parts(spark):
    """A word of several groups is all coded, each part as a unit of its own."""
    size = lm_scoring.BYTES_AT_ONCE
    word = b"ab" * size
    parts = lm_scoring.cut_long(3, word)
    assert [len(u) for _, u in parts] == [size, size] and b"".join(u for _, u in parts) == word and parts[0][0] == 3
    rows = [(1, "short text"), (2, "ab" * size + " tail"), (3, "short text"), (4, "z" * 3 * size)]
    got = {r.doc_id: r for r in lm_scoring.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].score == got[3].score and all(math.isfinite(r.score) and r.score < 0 for r in got.values())
    assert [got[i].n_tokens for i in (1, 2, 3, 4)] == [3, 3, 3, 2]


def test_units_join_to_the_text():
    for text in ("a b\n\nc ", "", " x", "ä\tö", "no"):
        assert b"".join(lm_scoring.units_of(text)) == text.encode() + b"\xff"


def test_score_does_not_depend_on_how_rows_are_dealt(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    one = {r.doc_id: r.score for r in lm_scoring.score(df).collect()}
    two = {r.doc_id: r.score for r in lm_scoring.score(df.repartition(5)).collect()}
    assert one.keys() == two.keys() and all(one[k] == pytest.approx(two[k], rel=1e-9) for k in one)


def labelled(spark, rows):
    docs = spark.createDataFrame([(i, t, "t", 0.5) for i, t, _ in rows], "doc_id long, text string, TEXT string, score double")
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows], "doc_id long, toxic int, quality int")
    return docs, labels


def test_lm_scores_do_not_depend_on_the_words_kept(monkeypatch):
    from types import SimpleNamespace

    rng = np.random.default_rng(2)
    odds = rng.normal(size=lm_scoring.SLOTS).astype(np.float16)
    weights = np.full((len(lm_scoring.ORDERS), lm_scoring.GATES), 0.3, np.float32)
    refine = rng.uniform(0.1, 0.9, lm_scoring.GATES * lm_scoring.BUCKETS).astype(np.float32)
    model = SimpleNamespace(value=(odds, weights, refine))
    hot = SimpleNamespace(value=(np.zeros(0, np.uint64), np.zeros(1)))
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 40, 12)) for _ in range(60)]
    batches = [
        pa.record_batch([pa.array([i]), pa.array([False]), pa.array([text])], ["doc_id", "held_out", "text"]) for i, text in enumerate(texts)
    ]
    got = []
    for kept in (1 << 20, 30, 0):
        monkeypatch.setattr(lm_scoring, "UNITS_HELD", kept)
        got.append([b.column("score")[0].as_py() for b in lm_scoring.score_rows(iter(batches), model, hot, f"test {kept}")])
    assert got[1] == pytest.approx(got[0], rel=1e-6) and got[2] == pytest.approx(got[0], rel=1e-6)


def test_lm_hot_tokens_reach_the_driver_packed(spark):
    n = 3000  # counts 1 to 30, a hundred tokens each
    hashed = spark.range(n).selectExpr("id % 30 + 1 AS n", "xxhash64(id) AS digest").repartition(3)
    rows = {r.digest % (1 << 64): r.n for r in hashed.collect()}
    for most in (0, 250, n, 2 * n):
        digests, logs = lm_scoring.hot_table(hashed, most)
        assert (np.diff(digests.astype(object)) > 0).all() and abs(len(digests) - min(n, most)) <= 60 * (0 < most < n)
        got = {int(d): round(10**x - 1) for d, x in zip(digests, logs)}
        assert got.items() <= rows.items() and {d for d, k in rows.items() if k > 30 - most // 100} <= got.keys()
    packed = lm_scoring.hottest(hashed.coalesce(2), 2 * n).mapInArrow(lm_scoring.pack_tokens, "digests binary, counts binary")
    assert packed.count() == 2  # a row per task, not per token
    assert len(lm_scoring.hot_table(hashed.limit(0), 5)[0]) == 0


def test_toxicity_on_unseen_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert {r.doc_id: r.held_out for r in got} == {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in got}
    pairs = [(a.score, b.score) for a in held for b in held if truth[a.doc_id] > truth[b.doc_id]]
    assert sum((a > b) + (a == b) / 2 for a, b in pairs) / len(pairs) > 0.9
    assert sum(r.predicted for r in held if not truth[r.doc_id]) == 0


def test_counterfactuals_take_the_weight_off_group_names(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(1, 900):
        bad = i % 3 == 0
        group = "muslim" if rng.random() < (0.8 if bad else 0.1) else "christian"
        insult = "idiot" if bad and rng.random() < 0.7 else "person"
        rows.append((i, f"that {group} is a {insult} {['x', 'y', 'z'][i % 7 % 3]}", int(bad)))
    docs, labels = labelled(spark, rows)
    fair = toxicity.train(docs, labels)
    biased = toxicity.train(docs, labels, terms=())
    neutral = "that muslim is a person x"
    gap = lambda m: abs(m.score(neutral) - m.score(neutral.replace("muslim", "christian")))
    assert gap(fair) < gap(biased) / 4 and biased.score(neutral) > fair.score(neutral)
    assert fair.score("that muslim is a idiot x") > 0.5


def test_toxicity_of_odd_rows(spark):
    docs, labels = labelled(spark, [(1, None, 1), (2, "", 0), (None, "x", 1), (3, "x", None), (3, "x", None)])
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == 5 and len({r.score for r in got}) == 1
    none = toxicity.classify(docs, labels.filter("false")).collect()
    assert {r.predicted for r in none} == {0}
    assert toxicity.classify(docs.filter("false"), labels).collect() == []
    clean = toxicity.keep_clean(pick(docs, "doc_id", "text"), labels.filter("false"))
    assert clean.count() == 5 and clean.columns == ["doc_id", "text"]


def refitted(rows, truth):
    """The same model over the same labelled rows, from dense matrices: id, text -> scores of all rows."""
    word = re.compile(r"\w+")
    stems = lambda words: words | {w[:5] + "*" for w in words if len(w) > 5}
    words_of = lambda text: stems(set(word.findall((text or "").lower())))
    taught = [(words_of(t), truth[i], t) for i, t in rows if i in truth and zlib.crc32(str(i).encode()) % 3 != 1]
    n = Counter(y for _, y, _ in taught)
    counts = {y: Counter(w for words, label, _ in taught if label == y for w in words) for y in (0, 1)}
    z = {}
    for w in counts[0].keys() | counts[1].keys():
        bad, good = counts[1][w], counts[0][w]
        if bad + good >= 3:
            a, b, c, d = bad + 0.5, good + 0.5, n[1] - bad + 0.5, n[0] - good + 0.5
            z[w] = abs(math.log(a * d / (b * c)) / math.sqrt(1 / a + 1 / b + 1 / c + 1 / d))
    strong = sorted((w for w in z if z[w] >= 3.0), key=lambda w: (-z[w], w))[:4000]
    columns = list(dict.fromkeys([*sorted({t for kind in toxicity.IDENTITY_TERMS for t in kind}), *strong]))
    vector = lambda words: np.array([c in words for c in columns], float)
    x, y = np.array([vector(words) for words, _, _ in taught]), np.array([label for _, label, _ in taught], float)
    pairs = set()
    for _, _, text in taught:
        for sentence in re.findall(r"[^.!?\n]+", (text or "").lower()):
            said = word.findall(sentence)
            for kind in toxicity.IDENTITY_TERMS:
                for old in kind:
                    for new in kind:
                        if old in said and new != old:
                            swapped = [new if w == old else w for w in said]
                            pairs.add(tuple(tuple(vector(stems(set(s)))) for s in (said, swapped)))
    left, right = (np.array([p[i] for p in pairs]).reshape(-1, len(columns)) for i in (0, 1))
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    weights, bias = np.zeros(len(columns)), math.log(y.mean() / (1 - y.mean()))
    first = second = np.zeros(len(columns) + 1)
    for step in range(1, 401):
        error = sigmoid(x @ weights + bias) - y
        grad, rest = x.T @ error + 0.1 * weights, error.sum()
        if len(pairs):
            p, q = sigmoid(left @ weights + bias), sigmoid(right @ weights + bias)
            pull = 20.0 * len(y) / len(pairs) * (p - q)
            grad = grad + left.T @ (pull * p * (1 - p)) - right.T @ (pull * q * (1 - q))
            rest += (pull * p * (1 - p) - pull * q * (1 - q)).sum()
        grad = np.append(grad, rest) / len(y)
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        move = 0.3 / math.sqrt(1 + step / 20) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return [float(sigmoid(vector(words_of(t)) @ weights + bias)) for _, t in rows]


def test_toxicity_against_a_refit(spark):
    """All scores equal those of a model fitted anew from the same labelled rows, to rounding."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    long = spark.createDataFrame([(10**9, "plain words again " * 60_000)], "doc_id long, text string")
    docs = docs.unionAll(long)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [tuple(r) for r in docs.collect()]
    scores = {r.doc_id: r.score for r in toxicity.classify(docs, labels).collect()}
    assert [scores[i] for i, _ in rows] == pytest.approx(refitted(rows, truth), abs=1e-4)


def test_swaps_change_whole_words_only():
    terms = (("man", "woman"),)
    assert toxicity.swaps(["the", "man", "mans"], terms) == [["the", "woman", "mans"]]


def test_lm_scores_of_an_empty_table(spark, monkeypatch):
    empty = spark.createDataFrame([], "doc_id long, text string")
    monkeypatch.setattr(queries, "table", lambda s, d, t: empty)
    assert queries.QUERIES["op3_lm_scoring"](spark, SF).collect() == []


def test_lm_marks_are_those_of_the_units_before():
    """Marks, found over whole arrays, against a loop over the units of each text."""
    ends = b" \t\n\x0b\x0c\r\xff"
    texts = ["", None, " ", "\n", "a \n b.\n", "größe é\x0bü . ? !a", "日本 語\U0001f600 ok\n\n", "\x1c a b", "end.", " é", "q" * 70]
    expected = []
    for i, text in enumerate(texts):
        mark = state = 0
        for unit in lm_scoring.units_of(text):
            expected.append((i, bytes((mark,)) + unit))
            last, wide = unit[-2:-1], [c for c in unit.rstrip(ends).decode() if c >= "\x80"]
            ending = 1 if unit.endswith(b"\n") else 2 if last.isalnum() or last >= b"\x80" else 3 if last in b".!?" else 4
            state = 1 + ord(wide[-1]) % (lm_scoring.STATES - 1) if wide else state
            mark = ending * lm_scoring.STATES + state
    for array in (pa.array(texts), pa.array(["x", *texts])[1:]):
        keys, text = lm_scoring.keys_of(array)
        assert list(zip(text.tolist(), keys.to_pylist())) == expected


def test_lm_bytes_after_the_same_beginning_are_one_node():
    """A thousand words that begin alike cost about as many nodes as they differ in, not as they have bytes."""
    units = [b"beginning" + str(i).encode() + b" " for i in range(1000)]
    flat, sizes = lm_scoring.behind_marks([3] * 1000, b"".join(units), np.array([len(u) for u in units]))
    nodes = lm_scoring.Nodes(flat, sizes)
    beginnings = [b"\x03" + u[:i] for u in units for i in range(1, len(u) + 1)]
    assert len(nodes.at) == len(set(beginnings)) < len(beginnings) / 5
    place = {}
    assert all(place.setdefault(b, n) == n for b, n in zip(beginnings, nodes.of.tolist())) and len(set(place.values())) == len(place)
    batch = pa.RecordBatch.from_arrays([pa.array([3] * 1000, pa.int32()), pa.array(units), pa.array([2] * 1000)], ["mark", "unit", "n"])
    parts = [lm_scoring.rows_of(b)[0].tobytes() for b in (batch.slice(0, 400), batch.slice(400))]
    assert b"".join(parts) == flat.tobytes()


def test_lm_hot_units_are_not_scored_again(monkeypatch):
    from types import SimpleNamespace

    rng = np.random.default_rng(4)
    odds = rng.normal(size=lm_scoring.SLOTS).astype(np.float16)
    weights = np.full((len(lm_scoring.ORDERS), lm_scoring.GATES), 0.3, np.float32)
    refine = rng.uniform(0.1, 0.9, lm_scoring.GATES * lm_scoring.BUCKETS).astype(np.float32)
    model = SimpleNamespace(value=(odds, weights, refine))
    hot = SimpleNamespace(value=(np.zeros(0, np.uint64), np.zeros(1)))
    units = pa.record_batch([pa.array([0, 2 * lm_scoring.STATES], pa.int32()), pa.array([b"some ", b"words "])], ["mark", "unit"])
    packed = [r for b in lm_scoring.score_hot_units(iter([units]), model) for r in b.to_pylist()]
    ready = SimpleNamespace(value=lm_scoring.unpacked(packed, "digests", "scores"))
    batch = pa.record_batch([pa.array([1]), pa.array([False]), pa.array(["some words here"])], ["doc_id", "held_out", "text"])
    scored, plain = [], lm_scoring.key_scores
    monkeypatch.setattr(lm_scoring, "key_scores", lambda keys, m: scored.append(keys.to_pylist()) or plain(keys, m))
    run = lambda *more: next(lm_scoring.score_rows(iter([batch]), model, hot, f"hot units {more}", *more)).column("score")[0].as_py()
    assert run(ready) == pytest.approx(run(), rel=1e-9)
    assert [len(x) for x in scored] == [1, 3] and scored[0] == [bytes((2 * lm_scoring.STATES,)) + b"here\xff"]
