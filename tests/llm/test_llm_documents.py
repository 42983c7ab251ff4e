"""Operators on documents against brute force: given tables and small odd ones."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from waybill.llm import exact_dedup, line_dedup, packing, queries, secrets, sharding, simhash

SF = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}
SPACES = " \t\n\x0b\x0c\r"
LONG = "Einige lange Zeile äöü. " * 4000

ODD = [
    (1, "one line\nsecond  line\n\nKey", "en", "a"),
    (2, "One\tline \nother", "en", "a"),
    (2, "One\tline \nother", "en", "a"),  # a repeated row
    (3, None, None, None),
    (4, "", "en", "b"),
    (None, "one line\nsecond line", "de", "b"),
    (None, None, "de", None),
    (5, LONG, "de", "c"),
    (6, LONG + "x", "de", "c"),
    (7, LONG.replace(" ", "\n", 1), "de", "c"),
    (8, "   ", "fr", "c"),
    (9, "x" * 30000, "fr", "c"),
    (10, "one line\nÄ É key <|endoftext|> H̱ it's 12.5, \"quoted\".", "en", "a"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """With columns whose names clash with each other and with results."""
    kind = "doc_id long, text string, lang string, source string, Text string, n_chars long, shard int, kept string, row int"
    return spark.createDataFrame([(*r, "other", len(r[1] or ""), 1, "k", 2) for r in ODD], kind)


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module", params=["odd", "given"])
def docs(request):
    return request.getfixturevalue(request.param)


def plain(df):
    at = [df.columns.index(c) for c in ("doc_id", "text", "lang", "source")]
    return [tuple(r[i] for i in at) for r in df.collect()]


def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def counted(rows):
    return Counter(tuple(r) for r in rows)


def test_runs_are_merged_without_a_shuffle(spark, plan_of):
    """Runs are compared and compacted bucket by bucket; only the batch's own lines are shuffled."""
    shelf = line_dedup.Shelf(spark, "test-runs")
    runs = line_dedup.LineRuns(shelf, threshold=3, fan_in=3)
    before = {t.name for t in spark.catalog.listTables()}
    batch = lambda n, k: spark.range(n).selectExpr(f"id % {k} AS h1", f"id % {k} * 7 AS h2")
    for n, k in ((50, 20), (90, 30)):
        runs.add(batch(n, k))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        anti, merged = runs.unsettled(batch(40, 40)), runs.merged(runs.runs())
        assert plan_of(anti, executed=True).count("Exchange hashpartitioning") <= 2  # once more in the initial plan
        assert "Exchange" not in plan_of(merged, executed=True) and plan_of(merged).count("SortMergeJoin") >= 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # 0 to 9 thrice in the first batch, all of 0 to 29 thrice in the second unless settled before
    assert sorted(tuple(r) for r in anti.collect()) == [(i, 7 * i, 1) for i in range(30, 40)]
    runs.add(batch(40, 40))
    assert [len(level) for level in runs.levels] == [0, 1]  # three runs became one
    found = {r.h1: r.n for r in runs.frequent().collect()}
    assert found == {i: 5 if 10 <= i < 20 else 3 for i in range(30)}
    assert {t.name for t in spark.catalog.listTables()} == before


@pytest.mark.parametrize("threshold", [2, 10])
def test_lines(docs, threshold):
    rows = plain(docs)
    key = lambda line: line.strip(SPACES).translate(LOWER)
    found = Counter()
    for _, text, _, _ in rows:
        found.update({key(x) for x in (text or "").split("\n")})
    expected = []
    for doc, text, _, _ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not key(x) or found[key(x)] < threshold]
        rest = "\n".join(kept)
        expected.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256(rest.encode()).hexdigest(), rest))
    got = line_dedup.dedup_lines(docs, threshold=threshold, least_batches=3)
    assert counted(got.collect()) == counted(expected)


def test_exact_copies(docs):
    rows = plain(docs)
    groups = defaultdict(list)
    for doc, text, _, _ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc)
    got = exact_dedup.radix_groups(docs).collect()
    assert len(got) == len(rows)
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    kept = Counter()
    for r in got:
        ids = by_digest[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert r.group_size == len(ids) and r.keep_id == (min(known) if known else None)
        if r.kept:
            assert r.doc_id == r.keep_id
            kept[r.text_sha256] += 1
    assert set(kept) == set(by_digest) and set(kept.values()) == {1}


def test_simhash(docs):
    rows = plain(docs)
    prints = {}
    for doc, text, _, _ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[doc, text] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    values = sorted(set(prints.values()))
    group = {v: v for v in values}
    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= 3 and group[a] != group[b]:
                old, new = group[b], group[a]
                group = {v: new if g == old else g for v, g in group.items()}
    least = {}
    for (doc, _), v in prints.items():
        if doc is not None:
            least[group[v]] = min(doc, least.get(group[v], doc))
    expected = counted((doc, f"{prints[doc, text]:016x}", least.get(group[prints[doc, text]])) for doc, text, _, _ in rows)
    assert counted(simhash.near_duplicates(docs).collect()) == expected


def test_simhash_links_across_nodes(spark, tmp_path, monkeypatch):
    import numpy as np

    from waybill.llm.common import Shelf
    from waybill.llm.components import components

    monkeypatch.setattr(simhash, "LEAF", 16)
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 63, 400, dtype=np.uint64) << np.uint64(1)
    chain = [values[0]]
    for i in range(60):  # a long chain: neighbours link, ends do not
        chain.append(chain[-1] ^ np.uint64(0b111 << (i % 61)))
    near = values[:100] ^ (np.uint64(1) << rng.integers(0, 64, 100, dtype=np.uint64))
    prints = np.unique(np.concatenate([values, near, np.array(chain, np.uint64), np.array([0, 1, 2**64 - 1], np.uint64)]))
    df = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long")
    shelf = Shelf(spark, "test")
    got = {r.node: r.component for r in components(simhash.link_fingerprints(df, 3, shelf), shelf).collect()}
    label = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in np.flatnonzero(np.bitwise_count(prints ^ a) <= 3):
            old, new = label[j], label[i]
            label = [new if x == old else x for x in label] if old != new else label
    seen = {}
    for x, mine in zip(prints.view(np.int64).tolist(), label):
        assert seen.setdefault(mine, got.get(x, x)) == got.get(x, x)
    assert len(set(seen.values())) == len(seen)


def test_simhash_many_small_nodes_share_tasks(spark, monkeypatch):
    import numpy as np

    from waybill.llm.common import Shelf

    frame = type(spark.range(0))
    by_range = frame.repartitionByRange
    monkeypatch.setattr(frame, "repartitionByRange", lambda self, n, *c: by_range(self, 40, *c))
    values = np.random.default_rng(3).integers(0, 1 << 63, 800, dtype=np.int64)
    twins = np.concatenate([values, values ^ 5])
    df = spark.createDataFrame([(int(x),) for x in twins], "fp long")
    shelf = Shelf(spark, "test")
    links = simhash.link_fingerprints(df, 3, shelf)
    pairs = spark.read.parquet(f"{shelf.root}/pairs").count()
    assert pairs > 400 and links.rdd.getNumPartitions() <= 4  # a task had four pairs
    assert {tuple(sorted(r)) for r in links.collect()} == {tuple(sorted((int(x), int(x ^ 5)))) for x in values}


def test_simhash_full_nodes_get_tasks_of_their_own():
    full = simhash.LEAF
    assert simhash.link_tasks(0, None, None) == 1
    assert simhash.link_tasks(400, 400 * 2 * full, 400.0 * full * full) == 100
    assert simhash.link_tasks(20000, 20000 * 2 * full, 20000.0 * full) >= 20000 / 64  # little to compare, much to read


def test_gray_rank_orders_code_words():
    import numpy as np

    n = np.arange(1000, dtype=np.uint64)
    assert (simhash.gray_rank(n ^ (n >> np.uint64(1))) == n).all()


def base_spans(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    spans = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(spans)


SECRETS = [
    (20, "é token=secret: longvalue12 password : 'abc' Token=abcdefgh", "en", "a"),
    (21, "AKIAAKIAAKIAAKIA0 AKIASHORT " + "0f" * 20 + " x" + "a" * 31, "en", "a"),
    (22, "API_KEY=\"0123456789abcdef0123456789abcdef\" apikey=zzzzzzzz", "de", "b"),
    (23, "copied apikey=zzzzzzzz", "de", "c"),
    (24, "-----BEGIN RSA PRIVATE KEY----- https://u:passw0rd@host", "de", "d"),
]


def test_secrets(spark, docs):
    more = spark.createDataFrame([r for r in SECRETS], "doc_id long, text string, lang string, source string")
    from waybill.llm.common import pick

    docs = pick(docs, "doc_id", "text", "lang", "source").unionAll(more)
    got = secrets.scan(docs).collect()
    expected = Counter()
    for doc, text, _, _ in plain(docs):
        spans = base_spans(text or "")
        kinds = Counter(s[3] for s in spans)
        joined = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
        expected[doc, kinds["assign"], kinds["access"], kinds["hex"], hashlib.sha256(joined.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == expected
    by_id = {r.doc_id: r for r in got}
    assert by_id[24].spans.startswith("private:0:31,url:")
    assert by_id[23].n_live == 1  # two owners only
    for r in got:
        assert set(filter(None, r.live_spans.split(","))) <= set(r.spans.split(","))


def test_ownership_separates_examples(spark):
    rows = [(i, f"password=copied4everybody{'' if i < 5 else i}", "en", f"s{i}") for i in range(7)]
    got = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), 3)
    assert {r.doc_id: r.n_live for r in got.collect()} == {i: int(i >= 5) for i in range(7)}


def test_redaction_keeps_examples_and_positions(spark):
    rows = [
        (1, "é password=0123456789abcdef0123456789abcdef b http://u:passw0rd@h", "en", "a", 1),
        (2, "clean", "en", "a", 5),
        (None, None, None, None, None),
    ] + [(i, "token=EXAMPLE-TOKEN", "en", f"s{i}", 19) for i in (3, 4, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in secrets.redact(df).collect()}
    hidden = "é password=[SECRET] b http://u:[SECRET]@h"
    assert got == {1: (hidden, len(hidden)), 2: ("clean", 5), None: (None, None), **{i: ("token=EXAMPLE-TOKEN", 19) for i in (3, 4, 5)}}


def test_private_keys_are_counted_by_body_and_hidden_whole(spark):
    def pem(body, gap="\n"):
        return gap.join(["-----BEGIN RSA PRIVATE KEY-----", *body, "-----END RSA PRIVATE KEY-----"])

    body = lambda x: [x * 64] * 400 + [x * 10 + "=="]
    wide = "p" * 300
    texts = {i: "é " + pem(body("abcd"[i])) + " rest" for i in range(4)}
    texts |= {10: pem(body("x")), 11: pem(body("x"), "\\n"), 12: pem(body("x"), " \r\n")}  # one example, three owners
    texts[20] = "a -----BEGIN PRIVATE KEY-----\nDEK-Info: AES,00FF\n\n" + "\n".join(body("y"))  # cut off
    texts[21] = f"git https://u:{wide}@host"
    texts[22] = "write -----BEGIN PRIVATE KEY----- above it. " + pem(body("z")) + " ."
    rows = [(i, t, "en", f"s{i}", len(t)) for i, t in texts.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    scanned = {r.doc_id: r for r in secrets.scan(df).collect()}
    live = {i: sum(x.startswith("private") for x in r.live_spans.split(",")) for i, r in scanned.items()}
    assert live == {0: 1, 1: 1, 2: 1, 3: 1, 10: 0, 11: 0, 12: 0, 20: 1, 21: 0, 22: 2}
    assert f"private:2:{len(texts[0]) - 5}" in scanned[0].live_spans
    got = {r.doc_id: r.text for r in secrets.redact(df).collect()}
    assert all(got[i] == "é [SECRET] rest" for i in range(4)) and all(got[i] == texts[i] for i in (10, 11, 12))
    assert got[20] == "a [SECRET]" and got[21] == "git https://u:[SECRET]@host"
    assert got[22] == "write [SECRET] above it. [SECRET] ."


def test_no_python_in_secret_scan(spark, given, plan_of):
    assert not re.search("Python|Pandas|Arrow", plan_of(secrets.scan(given)))


def loads_of(sizes, shards):
    """Longest first, each to the least loaded shard, one by one."""
    loads = [0] * shards
    for size in sorted(sizes, reverse=True):
        loads[loads.index(min(loads))] += size
    return loads


@pytest.mark.parametrize("shards", [4, 16])
def test_shards(docs, shards):
    rows = plain(docs)
    got = sharding.shard_documents(docs, shards).collect()
    size = lambda text: len((text or "").encode()) + 1
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (doc, size(text), zlib.crc32((text or "").encode())) for doc, text, _, _ in rows
    )
    loads = [0] * shards
    for shard in range(shards):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
        loads[shard] = sum(r["size"] for r in got if r.shard == shard)
    shard_of = defaultdict(set)
    for r in got:
        shard_of[r["size"], r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in shard_of.values())
    groups = Counter()
    for _, text, _, _ in rows:
        groups[text or ""] += size(text)
    assert loads == loads_of(groups.values(), shards)


@pytest.mark.parametrize("singly", [256, 0])
def test_runs_are_dealt_as_single_groups(monkeypatch, singly):
    monkeypatch.setattr(sharding, "SINGLY", singly)
    random = __import__("random").Random(3)
    for _ in range(60):
        shards = random.randint(1, 9)
        runs = sorted({random.randint(1, 60): random.randint(1, 700) for _ in range(random.randint(1, 8))}.items(), reverse=True)
        loads = [0] * shards
        for size, groups in runs:
            assert sum(sharding.deal_run(loads, size, groups)) == groups
        assert loads == loads_of([size for size, groups in runs for _ in range(groups)], shards)


def test_repeated_rows_are_no_one_tasks_slots(spark):
    """Rows equal throughout stay in one shard and still get one slot each."""
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 > 0 THEN 1 ELSE id END AS doc_id", "'t' || (id % 3 > 0) || if(id % 3 > 0, 0, id) AS text")
    got = sharding.shard_documents(df, 3).collect()
    assert len(got) == 3000 and sum(r.doc_id == 1 for r in got) == 2000
    for shard in range(3):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))


def test_packing(docs):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = plain(docs)
    got = packing.pack(docs, length=256, own_queues=3).collect()
    texts = Counter(doc for doc, _, _, _ in rows)
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(texts)
    for doc, text, _, _ in rows:
        if texts[doc] > 1:
            continue
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    windows = defaultdict(list)
    for r in got:
        windows[r.sequence_id].append((r.offset, r.length))
    assert sorted(windows) == list(range(len(windows)))
    for n, parts in windows.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 256 or n == len(windows) - 1


def test_packing_of_a_text_beyond_a_chunk(spark):
    """A text longer than what is tokenized at once is packed whole."""
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    text = "Some longer words, and more of them.\n" * 60_000
    df = spark.createDataFrame([(1, text, "a"), (2, "short", "b")], "doc_id long, text string, source string")
    ids = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode(text, add_special_tokens=False).ids
    blob = np.array([*ids, 1], "<u4").tobytes()
    at = 0
    for r in sorted((r for r in packing.pack(df).collect() if r.doc_id == 1), key=lambda r: r.start):
        assert r.start == at and r.ids_crc32 == zlib.crc32(blob[4 * at : 4 * (at + r.length)])
        at += r.length
    assert 4 * at == len(blob) > 1 << 20


def test_sources_that_share_a_queue_are_served_in_proportion(given):
    """At the end of every window each of them is as far as all of them, but for a document."""
    source = {r["doc_id"]: r["source"] for r in given.collect()}
    got = packing.pack(given, length=256, own_queues=4).collect()
    rows = Counter(source.values())
    large = sorted(rows, key=lambda s: (-rows[s], s))[:3]
    total, largest = Counter(), 0
    for r in got:
        total[source[r.doc_id]] += r.length
        largest = max(largest, r.doc_tokens)
    shared = [s for s in total if s not in large]
    everything, done = sum(total[s] for s in shared), Counter()
    assert len(shared) > 10
    for window in range(max(r.sequence_id for r in got) + 1):
        for r in (r for r in got if r.sequence_id == window):
            done[source[r.doc_id]] += r.length
        share = sum(done[s] for s in shared) / everything
        assert all(abs(done[s] - share * total[s]) <= 1.5 * largest for s in shared)


@pytest.mark.parametrize("name, wordwise", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_ids_are_those_of_the_tokenizer(name, wordwise):
    """Whichever way a tokenizer is asked, the ids are its own."""
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    tokenizer = Tokenizer.from_file(path)
    assert packing.wordwise(tokenizer) == wordwise
    texts = ["Hello World, two  spaces", "", "it's 12.5\n<|endoftext|> Ünïcode H\u0331", *(t or "" for _, t, _, _ in ODD)]
    for text, blob in zip(texts, packing.token_bytes(path)(texts)):
        assert np.frombuffer(blob, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("totals", [{0: 10_000, 1: 3, 2: 5000}, {0: 1}, {i: 7 * i + 1 for i in range(64)}, {0: 3, 1: 3}])
def test_round_robin_serves_every_token_once_in_proportion(totals):
    robin = packing.RoundRobin(totals, 128)
    total = sum(totals.values())
    taken = Counter()
    for queue, n in totals.items():
        at = 0
        for window, offset, position, length in robin.windows(queue, 0, n):
            assert position == at and length > 0
            at += length
            taken[window] += length
        assert at == n
    assert all(n == 128 for w, n in taken.items() if w < (total - 1) // 128) and sum(taken.values()) == total
    import numpy as np

    ends = np.arange(0, total, 128)
    served = robin.served(ends)
    assert (served.sum(axis=1) == ends).all() and (np.diff(served, axis=0) >= 0).all()
    assert abs(served - ends[:, None] * robin.sizes / total).max() <= len(totals)


@pytest.mark.parametrize("totals", [{i: 5 for i in range(3000)}, {0: 40_000} | {i: 1 + i % 9 for i in range(1, 2000)}])
def test_more_queues_than_a_window_has_tokens(totals):
    import numpy as np

    robin, total = packing.RoundRobin(totals, 128), sum(totals.values())
    ends = np.minimum(np.arange(0, total + 128, 128), total)
    served = robin.served(ends)
    assert (served.sum(axis=1) == ends).all() and (np.diff(served, axis=0) >= 0).all()
    assert (served[-1] == robin.sizes).all()
    for queue in list(totals)[:50]:
        at = 0
        for _, _, position, length in robin.windows(queue, 0, totals[queue]):
            assert position == at
            at += length
        assert at == totals[queue]


def test_every_source_keeps_its_share_in_every_window(spark):
    """Of 100 sources in file order, one with few but long documents."""
    rows = [(1000 * s + i, "word " * 20, f"s{s:03}") for s in range(99) for i in range(10)]
    rows += [(200_000 + i, "word " * 2000, "long") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    source = {d: s for d, _, s in rows}
    tokens, per_window = Counter(), defaultdict(Counter)
    for r in packing.pack(df, length=1024).collect():
        per_window[r.sequence_id][source[r.doc_id]] += r.length
        tokens[source[r.doc_id]] += r.length
    whole = sum(tokens.values())
    for n, window in per_window.items():
        size = sum(window.values())
        for s, t in tokens.items():
            assert abs(window[s] - size * t / whole) <= 3, (n, s)


@pytest.mark.parametrize("name", ["op2_line_dedup", "op5_secret_scan", "op7_exact_dedup", "op8_simhash", "op9_sharding", "op10_packing"])
def test_empty_tables(spark, monkeypatch, name):
    monkeypatch.setattr(queries, "table", lambda s, d, t: nothing(s))
    assert queries.QUERIES[name](spark, SF).collect() == []
