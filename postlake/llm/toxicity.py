"""Toxic passages: maximum-scoring segments of token log-odds, calibrated by extreme-value statistics.

Fit: on a bounded sample of labelled documents, each distinct text once, the documents that hold a word are counted by label, and the word's
log-odds between toxic and clean text are taken under an informative Dirichlet prior, at their lower confidence bound and
less a constant, so that rare words and ordinary text drift downwards. Words are known by 64-bit hashes; the model lists those in at least two
toxic documents of the sample, which bounds it, and gives all others one low score.

Score: one linear scan finds all maximal scoring segments of a text. Their scores follow extreme-value statistics: by chance a text of
n words holds K n exp(-lambda S) segments of score S. The best ones of a text are combined by the statistics of their sum, and the
expected number E of such chance finds becomes the score 2^(-E / E0), with E0 chosen on the sample.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm.batches import free_name, in_batches, joined, steps
from postlake.llm.kernels import PUNCTUATION, word_hashes
from postlake.llm.store import keep

#: Labelled documents that a fit reads at most, taken by a hash of their id.
SAMPLE = 30_000
#: Weight of the prior (documents of background for each document seen), width of the confidence bound, drift, lowest token score, and the score of words that are not listed.
PRIOR, BOUND, DRIFT, LEAST, OTHER = 0.1, 1.645, 0.25, -1.0, -0.5
#: Chance finds expected at which a passage counts as significant; K of the statistics; passages combined in one text.
SIGNIFICANT, K, COMBINED = 0.05, 0.1, 8
#: Largest E0: a text without any find has an E of 1 or more, so it never counts as toxic.
MOST_EVEN = 0.5
PASSAGES = "array<struct<start:int,end:int,score:double,expected:double>>"


@dataclass
class Model:
    """Sorted hashes of the listed words and their scores, the score of all others, lambda, and E0."""

    words: np.ndarray
    scores: np.ndarray
    other: float
    rate: float
    even: float

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(hashes), self.other)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, self.scores[at], self.other)


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes, starts, _ = word_hashes(data, PUNCTUATION, lower=True)
    return hashes.view(np.int64), starts


def segments(scores: list[tuple[float, float]]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of a sequence, given as the running sum before and after each positive run:
    (first run, last run, score) from left to right, in linear time."""
    left: list[float] = []
    right: list[float] = []
    span: list[tuple[int, int]] = []
    before: list[int] = []  # the nearest earlier segment that begins lower
    for k, (a, b) in enumerate(scores):
        first, low, j = k, a, len(left) - 1
        while True:
            while j >= 0 and left[j] >= low:
                j = before[j]
            if j < 0 or right[j] >= b:
                break
            first, low = span[j][0], left[j]  # it and all after it join the new segment
            del left[j:], right[j:], span[j:]
            j = before[j]
            del before[len(left) :]
        left.append(low)
        right.append(b)
        span.append((first, k))
        before.append(j)
    return [(s[0], s[1], b - a) for s, a, b in zip(span, left, right, strict=True)]


def _expected(found: list[float], n: int, rate: float) -> float:
    """Expected number of chance finds as good as the best r segments together, for the r where it is smallest."""
    best, total = K * n * math.exp(-rate * found[0]), 0.0
    for r, s in enumerate(found[:COMBINED], 1):
        total += rate * s - math.log(max(K * n, 1e-9))
        if r > 1 and total > 0:
            best = min(best, math.exp(-total + (r - 1) * math.log(total) - math.lgamma(r + 1) - math.lgamma(r)))
    return best


def _scan(data: np.ndarray, at: np.ndarray, model: Model) -> Iterator[tuple[float, list[tuple[int, int, float, float]]]]:
    """(E, significant passages by word number) of each text."""
    hashes, starts = _words(data)
    scores = model.of(hashes)
    first = np.searchsorted(starts, at)
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    up = np.concatenate([[False], scores > 0, [False]])
    bounds = np.zeros(len(up), bool)
    bounds[first + 1 if len(starts) else first] = True  # runs end with their text
    a = np.flatnonzero(up[1:] & (~up[:-1] | bounds[1:]))
    b = np.flatnonzero(up[:-1] & (~up[1:] | bounds[1:]))
    of = np.searchsorted(a, first)
    a_list, b_list = a.tolist(), b.tolist()
    low, high = sums[a].tolist(), sums[b].tolist()
    for i in range(len(at) - 1):
        n, p, q = int(first[i + 1] - first[i]), int(of[i]), int(of[i + 1])
        if p == q:
            yield K * n + 1.0, []
            continue
        found = segments(list(zip(low[p:q], high[p:q], strict=True)))
        ranked = sorted((s for _, _, s in found), reverse=True)
        kept = [(a_list[p + x] - int(first[i]), b_list[p + y] - int(first[i]), s, K * n * math.exp(-model.rate * s)) for x, y, s in found]
        yield _expected(ranked, n, model.rate), [x for x in kept if x[3] <= SIGNIFICANT]


def _counted(rows: DataFrame, text: str) -> DataFrame:
    """(word, toxic, clean): documents of either label that hold a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, text):
                data, at = joined(part, text)
                hashes, starts = _words(data)
                word, number = np.unique(hashes, return_inverse=True)
                doc = np.searchsorted(at, starts, "right") - 1
                once = np.unique(doc * max(len(word), 1) + number)
                number = once % max(len(word), 1)
                toxic = part.column(1).to_numpy(zero_copy_only=False).astype(np.int64)[once // max(len(word), 1)]
                counts = np.bincount(number, weights=toxic, minlength=len(word)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(counts), pa.array(np.bincount(number, minlength=len(word)) - counts)], ["word", "toxic", "clean"])

    return in_batches(rows.select(text, "toxic"), run, "word long, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Learns from labelled rows (label 0 or 1; others, null ids and contradicting labels of one id are left out), at most `sample` of them.

    Only the sampled ids are broadcast. Without a row of both labels the model gives every text the score of no find.
    """
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)")
    known = known.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).filter("toxic = most").drop("most")
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(known), "doc_id")
    rows = rows.groupBy(F.sha2("text", 256).alias("key")).agg(F.max("toxic").alias("toxic"), F.first("text").alias("text"))
    rows = keep(rows, "sample")
    counts = keep(_counted(rows, "text"), "words")
    n_t, n_c, distinct = counts.agg(F.sum("toxic"), F.sum("clean"), F.count("*")).first()
    listed = counts.filter("toxic > 1").orderBy("word").toArrow()  # words of at least two toxic documents of the sample
    toxic, clean = (listed[c].to_numpy().astype(np.float64) for c in ("toxic", "clean"))
    n_t, n_c = float(n_t or 0), float(n_c or 0)
    prior = PRIOR * (toxic + clean) + 1e-3
    mass = PRIOR * (n_t + n_c) + 1e-3 * distinct
    t, c = (toxic + prior) / (n_t + mass), (clean + prior) / (n_c + mass)
    odds = np.log(t / (1 - t)) - np.log(c / (1 - c)) - BOUND * np.sqrt(1 / (toxic + prior) + 1 / (clean + prior))
    scores = np.maximum(odds, LEAST) - DRIFT
    if not n_t or not n_c:
        scores[:] = -DRIFT
    rest = -DRIFT + OTHER
    model = Model(listed["word"].to_numpy().copy(), scores, rest, _rate(np.append(scores, rest), np.append(c, max(1 - c.sum(), 0.0))), 1.0)
    found = _finds(rows, "text", model).select("toxic", "expected").toArrow()  # at most `sample` rows of two numbers
    labels_of = found["toxic"].to_numpy()
    if len(np.unique(labels_of)) == 2:
        model.even = min(_even(found["expected"].to_numpy(), labels_of), MOST_EVEN)
    return model


def _rate(scores: np.ndarray, share: np.ndarray) -> float:
    """lambda: where the mean of exp(lambda * score) over clean text is 1."""
    share = share / share.sum()
    low, high = 1e-3, 20.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (share * np.exp(mid * scores)).sum() < 1 else (low, mid)
    return low


def _even(expected: np.ndarray, toxic: np.ndarray) -> float:
    """The E that divides the sample with the fewest errors of both labels' shares, in the middle of its gap."""
    order = np.argsort(expected, kind="stable")
    e, y = np.log(np.maximum(expected[order], 1e-300)), toxic[order]
    caught, false = np.cumsum(y) / max(y.sum(), 1), np.cumsum(1 - y) / max((1 - y).sum(), 1)
    gain = np.where(np.append(e[1:] > e[:-1], True), caught - 2 * false, -np.inf)
    i = int(np.argmax(gain))
    return float(np.exp(np.clip((e[i] + (e[i + 1] if i + 1 < len(e) else e[i])) / 2, -600, 600)))


def _finds(docs: DataFrame, text: str, model: Model, passages: str | None = None, expected: str = "expected") -> DataFrame:
    rest = [c for c in docs.columns if c not in (expected, passages)]
    fields = [*docs.select(*rest).schema.fields, T.StructField(expected, T.DoubleType())]
    if passages:
        fields.append(T.StructField(passages, T._parse_datatype_string(PASSAGES)))
    kept = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, text):
                found = list(_scan(*joined(part, text), kept.value))
                columns = [*part.columns, pa.array([e for e, _ in found], pa.float64())]
                if passages:
                    columns.append(pa.array([[dict(zip(("start", "end", "score", "expected"), x, strict=True)) for x in p] for _, p in found], kind))
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return in_batches(docs.select(*rest), run, T.StructType(fields))


def score(docs: DataFrame, model: Model, *, text: str = "text", out: str = "score", passages: str = "passages") -> DataFrame:
    """docs with `out` (0 to 1) and `passages`: (start, end, score, expected) of each significant one, by word number, end exclusive.

    Null and empty texts have no passage and score as a text without finds; repeated rows score alike.
    """
    expected = free_name(docs, "expected")
    found = _finds(docs.drop(out), text, model, passages, expected)
    return found.withColumn(out, F.pow(F.lit(2.0), F.greatest(-F.col(expected) / model.even, F.lit(-1000.0)))).drop(expected)


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the id as text is a multiple of 5: rows that a fit never sees."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its toxicity."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out())
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))
