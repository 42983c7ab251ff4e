"""A toxicity classifier that is regularised by counterfactuals.

Logistic regression over the words, and beginnings of words, that a text contains. Sentences of labelled texts that mention a
group are copied with the mention swapped for others of its kind; training penalises the squared
change of the score between a sentence and its copy. So what a group is called cannot carry
weight by itself, and neutral mentions are not taken for toxic ones because toxic texts happen
to mention some group more often.

Fitted on a bounded sample: up to `per_class` labelled rows of each class, in hash order of the
id; examples are weighted back to the classes' true shares. Words are chosen by the z-score of
their log-odds among the sampled rows, counted in Spark. The driver sees the chosen words of
the sampled rows and their swapped sentences, up to `most_pairs`. Scoring covers all rows and
whole texts.

Defined cases: a null or empty text has no words and gets the score of the intercept. A null
id is in the training part but never labelled. Of several labels of one id the highest counts;
null labels do not. Repeated rows are scored each. Without labels of both classes every score
is the share of toxic labels (0 without any). Other columns are left out."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import Shelf, id_remainder, pick, text_chunks

WORDS = re.compile(r"\w+")
STEM = 5
SENTENCE = re.compile(r"[^.!?\n]+")

#: Mentions of groups, by kind; a term is swapped for the others of its line.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("woman", "man"),
    ("women", "men"),
    ("girl", "boy"),
    ("girls", "boys"),
    ("mother", "father"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"),
    ("american", "mexican", "chinese", "african", "european", "arab"),
    ("americans", "mexicans", "chinese", "africans", "europeans", "arabs"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrant", "native", "refugee"),
    ("immigrants", "natives", "refugees"),
    ("old", "young"),
    ("deaf", "blind", "disabled"),
)


def with_stems(words: set[str]) -> set[str]:
    """The words, and the beginnings of longer ones: inflected forms are many and rare each."""
    return words | {w[:STEM] + "*" for w in words if len(w) > STEM}


def words_of(text: str | None) -> set[str]:
    return with_stems(set(WORDS.findall((text or "").lower())))


def swaps(sentence: list[str], terms: tuple[tuple[str, ...], ...]) -> list[list[str]]:
    """The sentence with every mention of one kind swapped, for each other term of the kind."""
    out = []
    for kind in terms:
        for old in kind:
            if old in sentence:
                out += [[new if w == old else w for w in sentence] for new in kind if new != old]
    return out


def swapped_pairs(text: str | None, terms: tuple[tuple[str, ...], ...]) -> Iterator[tuple[set[str], set[str]]]:
    known = {t for kind in terms for t in kind}
    lowered = (text or "").lower()
    for sentence in SENTENCE.findall(lowered):
        words = WORDS.findall(sentence)
        if known.isdisjoint(words):
            continue
        for other in swaps(words, terms):
            yield with_stems(set(words)), with_stems(set(other))


def sample_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_chunks(batch):
            words = [sorted(words_of(t)) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("toxic"), part.column("example"), pa.array(words, pa.list_(pa.string()))],
                ["toxic", "example", "words"],
            )


def counterfactuals(
    batches: Iterator[pa.RecordBatch], vocabulary: dict[str, int], terms: tuple[tuple[str, ...], ...]
) -> Iterator[pa.RecordBatch]:
    """Differences in features between a sentence and its swapped copy, without repeats."""
    for batch in batches:
        for part in text_chunks(batch):
            found = set()
            for text in part.column("text").to_pylist():
                for words, other in swapped_pairs(text, terms):
                    plus = tuple(sorted(vocabulary[w] for w in words - other if w in vocabulary))
                    minus = tuple(sorted(vocabulary[w] for w in other - words if w in vocabulary))
                    both = tuple(sorted(vocabulary[w] for w in words & other if w in vocabulary))
                    found.add((plus, minus, both))
            columns = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.list_(pa.int32())) for c in columns], ["plus", "minus", "both"]
            )


class Rows:
    """A sparse 0/1 matrix."""

    def __init__(self, rows: list[list[int]], n_columns: int):
        sizes = np.array([len(r) for r in rows], np.int64)
        self.n, self.n_columns = len(rows), n_columns
        self.row = np.repeat(np.arange(len(rows)), sizes)
        self.column = np.array([c for r in rows for c in r], np.int64)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.column], self.n)

    def back(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, values[self.row], self.n_columns)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit(
    examples: list[list[int]],
    labels: np.ndarray,
    example_weights: np.ndarray,
    sentences: list[list[int]],
    swapped: list[list[int]],
    n_features: int,
    ridge: float = 0.1,
    fairness: float = 10.0,
    steps: int = 400,
) -> tuple[np.ndarray, float]:
    """Weights and intercept minimising the log loss plus ridge * |w|^2 / 2 plus
    fairness * sum (p(sentence) - p(swapped sentence))^2, by Adam with a falling rate."""
    x, left, right = (Rows(r, n_features) for r in (examples, sentences, swapped))
    share = float((example_weights * labels).sum() / example_weights.sum())
    bias = math.log(max(share, 1e-6) / max(1 - share, 1e-6))
    theta = np.zeros(n_features + 1)
    theta[-1] = bias
    scale = example_weights.sum()
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        weights, bias = theta[:-1], theta[-1]
        error = (sigmoid(x.dot(weights) + bias) - labels) * example_weights
        grad = np.append(x.back(error) + ridge * weights, error.sum())
        if left.n:
            p, q = sigmoid(left.dot(weights) + bias), sigmoid(right.dot(weights) + bias)
            pull = 2 * fairness * scale / left.n * (p - q)
            dp, dq = pull * p * (1 - p), -pull * q * (1 - q)
            grad += np.append(left.back(dp) + right.back(dq), dp.sum() + dq.sum())
        grad /= scale
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        rate = 0.3 / math.sqrt(1 + step / 20)
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


class Model:
    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias

    def score(self, text: str | None) -> float:
        logit = self.bias + math.fsum(self.weights[w] for w in words_of(text) & self.weights.keys())
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, logit))))


def train(
    documents: DataFrame,
    labels: DataFrame,
    per_class: int = 8000,
    most_features: int = 4000,
    most_pairs: int = 20000,
    least_z: float = 3.0,
    terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS,
) -> Model:
    spark = documents.sparkSession
    shelf = Shelf(spark, "toxicity")
    known = (
        pick(labels, "doc_id", "toxic")
        .filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .filter(id_remainder(3) != 1)
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    # a label counts only if its document is there
    ids = pick(documents, "doc_id").distinct()
    known = shelf.put(known.join(ids, "doc_id", "left_semi"), "labels")
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    n_all = sum(totals.values())
    if not totals.get(0) or not totals.get(1):
        share = totals.get(1, 0) / n_all if n_all else 0.0
        return Model({}, math.log(share / (1 - share)) if 0 < share < 1 else (500.0 if share else -500.0))
    picked = [known.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    chosen = F.broadcast(picked[0].unionAll(picked[1]))  # at most 2 * per_class rows
    texts = shelf.put(
        pick(documents, "doc_id", "text").join(chosen, "doc_id").select(
            "toxic", "text", F.monotonically_increasing_id().alias("example")
        ),
        "texts",
    )
    words = shelf.put(texts.mapInArrow(sample_words, "toxic int, example long, words array<string>"), "words")
    n = {r["toxic"]: r["count"] for r in words.groupBy("toxic").count().collect()}
    counts = (
        words.select("toxic", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
        .filter("bad + good >= 3")
    )
    a, b = F.col("bad") + 0.5, F.col("good") + 0.5
    c, d = n[1] - F.col("bad") + 0.5, n[0] - F.col("good") + 0.5
    z = F.log(a * d / (b * c)) / F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    strong = counts.withColumn("z", F.abs(z)).filter(F.col("z") >= least_z)
    identity = sorted({t for kind in terms for t in kind})
    vocabulary_words = [r["word"] for r in strong.orderBy(F.desc("z"), "word").limit(most_features).select("word").collect()]
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys([*identity, *vocabulary_words]))}
    examples = words.mapInArrow(
        lambda it: (
            pa.RecordBatch.from_arrays(
                [
                    b.column("toxic"),
                    b.column("example"),
                    pa.array([[vocabulary[w] for w in ws if w in vocabulary] for ws in b.column("words").to_pylist()], pa.list_(pa.int32())),
                ],
                ["toxic", "example", "features"],
            )
            for b in it
        ),
        "toxic int, example long, features array<int>",
    ).orderBy("example").collect()
    pairs = (
        texts.select("text")
        .mapInArrow(lambda it: counterfactuals(it, vocabulary, terms), "plus array<int>, minus array<int>, both array<int>")
        .distinct()
        .orderBy(F.xxhash64("plus", "minus", "both"), "plus", "minus", "both")
        .limit(most_pairs)
        .collect()
    )
    toxic = np.array([r["toxic"] for r in examples], float)
    weight_of = {k: totals[k] / n_all * len(examples) / n[k] for k in n}
    weights, bias = fit(
        [r["features"] for r in examples],
        toxic,
        np.array([weight_of[r["toxic"]] for r in examples]),
        [[*r["both"], *r["plus"]] for r in pairs],
        [[*r["both"], *r["minus"]] for r in pairs],
        len(vocabulary),
    )
    return Model({w: float(weights[i]) for w, i in vocabulary.items() if weights[i]}, bias)


def score_rows(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = [model.score(t) for t in batch.column("text").to_pylist()]
        rest = [i for i, name in enumerate(batch.schema.names) if name != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in rest), pa.array(scores, pa.float64())],
            [*(batch.schema.names[i] for i in rest), "score"],
        )


def classify(documents: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `documents`."""
    model = train(documents, labels, **options)
    rows = pick(documents, "doc_id", "text").select("doc_id", (id_remainder(3) == 1).alias("held_out"), "text")
    kinds = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double"
    scored = rows.mapInArrow(lambda it: score_rows(it, model), kinds)
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def keep_clean(documents: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """The rows of `documents`, all columns, whose score stays below the threshold."""
    model = train(documents, labels, **options)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return documents.mapInArrow(lambda it: clean_rows(it, model, threshold), kinds)


def clean_rows(batches: Iterator[pa.RecordBatch], model: Model, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array([model.score(t) < threshold for t in batch.column("text").to_pylist()], pa.bool_()))
