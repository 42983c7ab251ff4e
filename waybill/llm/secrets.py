"""Secret scans with corpus-wide ownership frequency. DataFrame functions only.

Patterns give candidates. The hash of a candidate's value is then counted over the corpus, by
distinct repositories and distinct owners: a value that many owners have is an example that
everybody copies, one that few owners have looks like a live credential. A private key's value
is its body without white space, its span the whole block. Positions come from
the lengths of what lies between the matches, summed in a window per document and kind.

In the documents table an owner is a `source`, a repository a `source` in one `lang`.

Defined cases: a null text is the empty text and has no spans. Rows equal in all four columns
get equal results, and count as one repository anyway. A null owner or repository part is a
value of its own. An empty table gives no rows. Other columns are left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.common import Shelf, pick, text_or_empty
from waybill.operators.skew import split_join

# kind -> (pattern, group of the value, least length of the value). Fixed values of the contract:
BASE = {
    "assign": (
        r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"""
        r"""[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        1,
        8,
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    # short runs are left out by the pattern already; a run is never cut in two
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
# A private key is all from its header to its END line. One that is cut off is its header and the
# long runs that follow, with a short one if the text ends there; a header alone is its own value.
KEY_END = r"-----END [A-Z ]*PRIVATE KEY-----"
KEY_GAP = r"(?:\s|\\[nr])*+"
KEY_BODY = (
    rf"(?:(?!-----)[\s\S])*+(?={KEY_END})"
    rf"|(?:(?:{KEY_GAP}[A-Za-z][A-Za-z-]*:\x20?\S++)*+(?:{KEY_GAP}[A-Za-z0-9+/=]{{20,}}+)++"
    rf"(?:{KEY_GAP}[A-Za-z0-9+/=]++(?={KEY_GAP}(?![\s\S])))?)?"
)
# Well-known forms of further credentials.
MORE = {
    "private": (rf"-----BEGIN [A-Z ]*PRIVATE KEY-----({KEY_BODY})(?:{KEY_END})?", 1, 1),
    "github": (r"\bgh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    "jwt": (r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*", 0, 1),
    "url": (r"://[^\s/:@]++:([^\s/:@]{4,}+)@", 1, 4),
}
KINDS = {**BASE, **MORE}
ANY_KIND = "|".join(f"(?:{pattern})" for pattern, _, _ in KINDS.values())
ORDER = {kind: i for i, kind in enumerate(KINDS)}


def _hits(kind: str) -> Column:
    pattern, group, _ = KINDS[kind]
    pattern_column = F.lit(pattern)
    found = F.regexp_extract_all("text", pattern_column, F.lit(0))
    values = F.regexp_extract_all("text", pattern_column, F.lit(group)) if group else found
    gaps = F.transform(F.split("text", pattern), F.length)
    zipped = F.arrays_zip(found.alias("match"), values.alias("value"), F.slice(gaps, 1, F.size(found)).alias("gap"))
    nothing = F.array().cast("array<struct<match:string,value:string,gap:int>>")
    return F.struct(
        F.lit(kind).alias("kind"),
        F.when(F.col("text").rlike(pattern), zipped).otherwise(nothing).alias("hits"),
    )


def candidates(docs: DataFrame) -> DataFrame:
    """r1, r2, owner, repository, kind, start, end, value for every span in `docs`."""
    per_kind = (
        docs.filter(F.col("text").rlike(ANY_KIND))
        .select("r1", "r2", "owner", "repository", F.explode(F.array(*map(_hits, KINDS))).alias("k"))
        .select("r1", "r2", "owner", "repository", "k.kind", F.posexplode("k.hits").alias("nth", "hit"))
        .select("r1", "r2", "owner", "repository", "kind", "nth", "hit.match", "hit.value", "hit.gap")
        .distinct()
    )
    # the same key is the same value however its lines are broken
    body = F.regexp_replace("value", r"\s|\\[nr]", "")
    value = F.when(F.col("kind") != "private", F.col("value")).when(body != "", body).otherwise(F.col("match"))
    per_kind = per_kind.withColumn("value", value)
    so_far = Window.partitionBy("r1", "r2", "kind").orderBy("nth")
    size = F.length("match")
    end = F.sum(F.col("gap") + size).over(so_far)
    long_enough = F.lit(False)
    for kind, (_, _, least) in KINDS.items():
        long_enough = long_enough | ((F.col("kind") == kind) & (F.length("value") >= least))
    return (
        per_kind.withColumn("end", end)
        .filter(long_enough)
        .select("r1", "r2", "owner", "repository", "kind", (F.col("end") - size).alias("start"), "end", "value")
    )


def with_ownership(found: DataFrame, example_owners: int, shelf: Shelf) -> DataFrame:
    """Adds n_repositories, n_owners and `live`: fewer than `example_owners` owners have the value.

    `found` is a stored table. The rows of a value that is everywhere are dealt over several tasks."""
    value_hash = (F.xxhash64("value"), F.xxhash64(F.lit("secret"), F.col("value")))
    hashed = found.withColumns({"v1": value_hash[0], "v2": value_hash[1]}).drop("value")
    counts = shelf.put(
        hashed.groupBy("v1", "v2", "owner", "repository")
        .agg(F.count("*").alias("n"))
        .groupBy("v1", "v2", "owner")
        .agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
        .groupBy("v1", "v2")
        .agg(F.sum("repositories").alias("n_repositories"), F.count("*").alias("n_owners"), F.sum("n").alias("n")),
        "owners",
    )
    owned = split_join(hashed, counts.drop("n"), ["v1", "v2"], counts=counts)
    return owned.withColumn("live", F.col("n_owners") < example_owners)


def keyed(df: DataFrame, *more: str, blank: bool = True) -> DataFrame:
    """Rows with their hashes, owner and repository; null texts as empty ones if `blank`."""
    whole = ("doc_id", "text", "lang", "source")
    return pick(df, *dict.fromkeys((*whole, *more))).select(
        "doc_id",
        (text_or_empty() if blank else F.col("text")).alias("text"),
        F.coalesce("source", F.lit("(none)")).alias("owner"),
        F.concat_ws("/", F.coalesce("source", F.lit("(none)")), F.coalesce("lang", F.lit("(none)"))).alias("repository"),
        F.xxhash64(*whole).alias("r1"),
        F.xxhash64(F.lit("row"), *whole).alias("r2"),
        *(F.col(c).alias(f"kept_{c}") for c in more),
    )


def spans_of(df: DataFrame, example_owners: int, shelf: Shelf) -> DataFrame:
    """All spans with ownership, staged."""
    found = shelf.put(candidates(keyed(df)), "candidates")
    return with_ownership(found, example_owners, shelf)


def _joined(spans: str) -> str:
    return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"


def scan(df: DataFrame, example_owners: int = 3) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example and
    live_spans. `spans` lists all kinds; ownership decides what is live, never what is listed."""
    shelf = Shelf(df.sparkSession, "secrets")
    order = F.create_map(*(F.lit(x) for pair in ORDER.items() for x in pair))
    per_doc = (
        spans_of(df, example_owners, shelf)
        .withColumn("s", F.struct("start", order[F.col("kind")].alias("ord"), "kind", "end", "live"))
        .groupBy("r1", "r2")
        .agg(F.sort_array(F.collect_list("s")).alias("all"))
    )
    base = f"filter(all, s -> s.ord < {len(BASE)})"
    spans = keyed(df).select("doc_id", "r1", "r2").join(per_doc, ["r1", "r2"], "left")
    count = lambda kind: F.coalesce(F.size(F.expr(f"filter(all, s -> s.kind = '{kind}')")), F.lit(0))
    has = F.col("all").isNotNull()
    text = lambda sql: F.when(has, F.expr(_joined(sql))).otherwise(F.lit(""))
    live = F.when(has, F.size(F.expr("filter(all, s -> s.live)"))).otherwise(0).cast("long")
    every = F.when(has, F.size("all")).otherwise(0).cast("long")
    return spans.select(
        "doc_id",
        *(F.when(has, count(kind)).otherwise(0).cast("long").alias(f"n_{kind}") for kind in BASE),
        F.sha2(text(base).cast("binary"), 256).alias("base_sha256"),
        text("all").alias("spans"),
        live.alias("n_live"),
        (every - live).alias("n_example"),
        text("filter(all, s -> s.live)").alias("live_spans"),
    )


def redact(df: DataFrame, example_owners: int = 3, instead: str = "[SECRET]") -> DataFrame:
    """The rows, with live-looking values overwritten and n_chars counted anew.

    Values go wherever their span is; the name before an assigned value stays."""
    shelf = Shelf(df.sparkSession, "redact")
    columns = [c for c in ("doc_id", "text", "lang", "source", "n_chars") if c in df.columns]
    found = shelf.put(candidates(keyed(df)), "candidates")
    # where the value lies: at the end of the span, before the @ of a url; a private key goes whole
    value_end = F.col("end") - F.when(F.col("kind") == "url", 1).otherwise(0)
    value_start = F.when(F.col("kind") == "private", F.col("start")).otherwise(value_end - F.length("value"))
    live = with_ownership(found.withColumns({"value_start": value_start, "value_end": value_end}), example_owners, shelf).filter("live")
    # spans in order; each adds what lies between it and the furthest end so far
    earlier = Window.partitionBy("r1", "r2").orderBy("value_start", "value_end").rowsBetween(Window.unboundedPreceding, -1)
    piece = F.struct(
        F.col("value_start").alias("a"),
        F.col("value_end").alias("b"),
        F.coalesce(F.max("value_end").over(earlier), F.lit(0)).alias("done"),
    )
    per_doc = (
        live.select("r1", "r2", piece.alias("piece"))
        .groupBy("r1", "r2")
        .agg(F.sort_array(F.collect_list("piece")).alias("pieces"), F.max("piece.b").alias("last"))
    )
    # only texts with a span are shuffled to their spans; the others pass as they are
    everything = keyed(df, *(c for c in columns if c != "text"), blank=False)
    has_span = F.coalesce(F.col("text").rlike(ANY_KIND), F.lit(False))
    rows = everything.filter(has_span).join(per_doc, ["r1", "r2"], "left")
    clean = everything.filter(~has_span).select(*(F.col("text" if c == "text" else f"kept_{c}").alias(c) for c in columns))
    hidden = F.expr(
        f"""concat(
            array_join(transform(filter(pieces, p -> p.b > p.done), p ->
                concat(substring(text, cast(p.done AS int) + 1, greatest(cast(p.a - p.done AS int), 0)),
                       if(p.a >= p.done, '{instead}', ''))), ''),
            substring(text, cast(last AS int) + 1))"""
    )
    texts = rows.withColumn(
        "new_text", F.when(F.col("pieces").isNull(), F.col("text")).otherwise(hidden)
    )
    redacted = texts.select(
        *(
            F.col("new_text").alias("text")
            if c == "text"
            else F.coalesce(F.when(F.col("pieces").isNull(), F.col("kept_n_chars")), F.length("new_text").cast("long")).alias("n_chars")
            if c == "n_chars"
            else F.col(f"kept_{c}").alias(c)
            for c in columns
        )
    )
    return redacted.unionAll(clean)
