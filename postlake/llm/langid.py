"""Language identification of mixed text: script ranges narrow the candidates, Viterbi over word scores labels the spans.

A word's score under a language is the log-probability of its hashed byte trigrams. The best path through a text's words pays a
penalty for each switch of language; runs of equal labels are the spans, the text's language is the one with most letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm.batches import free_name, in_batches, joined, lists, steps
from postlake.llm.kernels import LOWER, NOT_LETTERS

FEATURES = 1 << 16
#: Smoothing count of a trigram, log penalty of a switch, least share of a language's words for a script to be one of its own.
SMOOTH, SWITCH, SCRIPT_SHARE = 0.5, 12.0, 0.002
#: Numbers (words or bytes x languages) that a task holds together beside the longest text, and languages that it counts before it passes its counts on.
GROUP, HELD = 4 << 20, 16
#: First and last code point of the ranges of each script, from the blocks of the Unicode standard. A word has the last script here that a character of it has.
RANGES = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x24F), (0x250, 0x2AF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFB00, 0xFB06), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFE)],
    "syriac": [(0x700, 0x74F)],
    "thaana": [(0x780, 0x7BF)],
    "devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "oriya": [(0xB00, 0xB7F)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "sinhala": [(0xD80, 0xDFF)],
    "thai": [(0xE00, 0xE7F)],
    "lao": [(0xE80, 0xEFF)],
    "tibetan": [(0xF00, 0xFFF)],
    "myanmar": [(0x1000, 0x109F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "ethiopic": [(0x1200, 0x139F), (0x2D80, 0x2DDF)],
    "cherokee": [(0x13A0, 0x13FF), (0xAB70, 0xABBF)],
    "khmer": [(0x1780, 0x17FF)],
    "mongolian": [(0x1800, 0x18AF)],
    "han": [(0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "bopomofo": [(0x3100, 0x312F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7FF)],
}
SCRIPTS = ["none", *RANGES]
SPANS = "array<struct<lang:string,start:int,end:int>>"
_EDGES = np.array(sorted((a, b + 1, k) for k, own in enumerate(RANGES.values(), 1) for a, b in own), np.int64)


def _script_of(points: np.ndarray) -> np.ndarray:
    """Script number of each code point, 0 outside all ranges."""
    at = np.searchsorted(_EDGES[:, 0], points, "right") - 1
    return np.where((at >= 0) & (points < _EDGES[at, 1]), _EDGES[at, 2], 0).astype(np.uint8)


_ASCII = _script_of(np.arange(256) * (np.arange(256) < 128))


@dataclass
class Model:
    """Languages, log-probabilities (feature x language), and which scripts each writes (script x language)."""

    langs: list[str]
    table: np.ndarray
    allowed: np.ndarray


def _features(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Trigram feature around each byte, whether the byte belongs to a word, and the words' first bytes and ends."""
    low = LOWER[data].astype(np.uint32)
    low[NOT_LETTERS[data]] = 32
    padded = np.concatenate([[np.uint32(32)], low, [np.uint32(32)]]).astype(np.uint32)
    mix = padded[:-2] * np.uint32(0x9E3779B1) ^ padded[1:-1] * np.uint32(0x85EBCA77) ^ padded[2:] * np.uint32(0xC2B2AE3D)
    feature = (mix ^ (mix >> np.uint32(15))) & np.uint32(FEATURES - 1)
    inside = ~NOT_LETTERS[data]
    edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    return feature, inside, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _scripts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Script of each word: the code points of all multi-byte characters are put together where they begin."""
    if not len(starts):
        return np.zeros(0, np.uint8)
    own = _ASCII[data]
    lead = np.flatnonzero(data >= 0xC2)
    if len(lead):
        b = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int64)
        first, second, third, fourth = (b[lead + k] for k in range(4))
        second, third, fourth = second & 63, third & 63, fourth & 63
        points = np.where(first < 0xE0, (first & 31) << 6 | second, np.where(first < 0xF0, (first & 15) << 12 | second << 6 | third, (first & 7) << 18 | second << 12 | third << 6 | fourth))
        own[lead] = _script_of(points)
    return np.maximum.reduceat(own, starts)


def fit(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> Model:
    """Learns every non-null lang from all its rows. Each task sums its counts first; the model has FEATURES numbers a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for name, counts in held.items():
                some = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(counts[some])], ["lang", "feature", "n"])
            held.clear()

        for batch in batches:
            for part in steps(batch, "text"):
                data, at = joined(part, "text")
                feature, inside, starts, _ = _features(data)
                script = _scripts(data, starts)
                names = part.column(1).to_pylist()
                doc_of_byte = np.repeat(np.arange(len(names)), np.diff(at))
                doc_of_word = doc_of_byte[starts]
                for name in set(names):
                    mine = np.array([x == name for x in names])
                    counts = held.setdefault(name, np.zeros(FEATURES + len(SCRIPTS), np.int64))
                    counts[:FEATURES] += np.bincount(feature[inside & mine[doc_of_byte]], minlength=FEATURES)
                    counts[FEATURES:] += np.bincount(script[mine[doc_of_word]], minlength=len(SCRIPTS))
                if len(held) > HELD:
                    yield from out()
        yield from out()

    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("lang is not null and text is not null")
    counted = in_batches(rows, run, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow()
    names = counted["lang"].to_pylist()
    langs = sorted(set(names))
    counts = np.zeros((FEATURES + len(SCRIPTS), len(langs)))
    place = {x: i for i, x in enumerate(langs)}
    counts[counted["feature"].to_numpy(), [place[x] for x in names]] = counted["n"].to_numpy()
    grams, scripts = counts[:FEATURES] + SMOOTH, counts[FEATURES:]
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(0), 1)
    allowed[~allowed.any(1)] = True  # a script that no language writes excludes none
    return Model(langs, np.log(grams / grams.sum(0)).astype(np.float32), allowed)


def paths(scores: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """The best label of every word: all texts go forward and back together, one word of each a step."""
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    longest, begin = counts[order], first[:-1][order]
    labels = np.zeros(len(scores), np.int16)
    came = np.zeros(scores.shape, np.int16)
    live = np.searchsorted(-longest, -np.arange(1, int(longest[0]) + 1 if len(longest) else 0), "right")
    best = np.zeros((len(order), scores.shape[1]), np.float32)
    own = np.arange(scores.shape[1], dtype=np.int16)[None, :]
    for t, m in enumerate(live):
        word, now = begin[:m] + t, best[:m]
        if t:
            top = now.argmax(1)
            jump = now[np.arange(m), top] - np.float32(switch)
            stay = now >= jump[:, None]
            came[word] = np.where(stay, own, top[:, None])
            now = np.where(stay, now, jump[:, None])
        best[:m] = now + scores[word]
    state = best.argmax(1).astype(np.int16)
    for t in range(len(live) - 1, -1, -1):
        m = live[t]
        word = begin[:m] + t
        labels[word] = state[:m]
        if t:
            state[:m] = came[word, state[:m]]
    return labels


def _word_scores(table: np.ndarray, feature: np.ndarray, inside: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Score of each word under each language; the features of some words at a time are looked up."""
    room = max(1, GROUP // table.shape[1])
    out, k = [], 0
    ends = np.append(starts[1:], len(feature))
    while k < len(starts):
        to = max(k + 1, int(np.searchsorted(ends, starts[k] + room, "right")))
        each = table[feature[starts[k] : ends[to - 1]]]
        each[~inside[starts[k] : ends[to - 1]]] = 0
        out.append(np.add.reduceat(each, starts[k:to] - starts[k], axis=0))
        k = to
    return np.concatenate(out)


def _labelled(part: pa.RecordBatch, text: str, model: Model, switch: float) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Language, share of its letters, and spans of each text."""
    data, at = joined(part, text)
    scores, starts, ends = [], [], []
    for low in range(0, part.num_rows, 64):  # texts whose features are held together
        high = min(low + 64, part.num_rows)
        block = data[at[low] : at[high]]
        feature, inside, a, b = _features(block)
        if len(a):
            ok = model.allowed[_scripts(block, a)]
            made = _word_scores(model.table, feature, inside, a)
            scores.append(np.where(ok, made, np.minimum(made, made.min(1, keepdims=True)) - np.float32(50)).astype(np.float32))
            starts.append(a + at[low])
            ends.append(b + at[low])
    n = part.num_rows
    if not scores:
        return pa.nulls(n, pa.string()), pa.array(np.zeros(n)), pa.array([[]] * n, _span_type())
    start, end = np.concatenate(starts), np.concatenate(ends)
    first = np.searchsorted(start, at)
    labels = paths(np.concatenate(scores), first, switch)
    doc = np.repeat(np.arange(n), np.diff(first))
    letters = np.bincount(doc * len(model.langs) + labels, weights=end - start, minlength=n * len(model.langs)).reshape(n, -1)
    top, total = letters.argmax(1), letters.sum(1)
    names = pa.array(model.langs, pa.string())
    chosen = names.take(pa.array(np.where(total > 0, top, 0)))
    share = np.where(total > 0, letters.max(1) / np.maximum(total, 1), 0.0)
    new = np.flatnonzero(np.concatenate([[True], (labels[1:] != labels[:-1]) | (doc[1:] != doc[:-1])]))
    to = np.append(new[1:], len(labels))
    spans = pa.StructArray.from_arrays([names.take(pa.array(labels[new])), pa.array((new - first[doc[new]]).astype(np.int32)), pa.array((to - first[doc[new]]).astype(np.int32))], ["lang", "start", "end"])
    return chosen, pa.array(share), pa.ListArray.from_arrays(lists(np.zeros(len(new), np.int8), np.bincount(doc[new], minlength=n)).offsets, spans)


def _span_type() -> pa.DataType:
    return pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def predict(docs: DataFrame, model: Model, *, text: str = "text", out: str = "lang_pred", share: str = "score", spans: str = "spans", switch: float = SWITCH) -> DataFrame:
    """docs with the language, the share of its letters in the text, and the spans (lang, start, end) by word number, end exclusive.

    Null and empty texts, texts without a letter and a model without languages give 'und' and 0 and no spans. Repeated rows
    get the same answer; columns named as the new ones are replaced, others pass unchanged.
    """
    new = (out, share, spans)
    rest = [c for c in docs.columns if c not in new]
    fields = [*docs.select(*rest).schema.fields, T.StructField(out, T.StringType()), T.StructField(share, T.DoubleType()), T.StructField(spans, T._parse_datatype_string(SPANS))]
    if not model.langs:
        return docs.select(*rest, F.lit("und").alias(out), F.lit(0.0).alias(share), F.array().cast(SPANS).alias(spans))
    kept = docs.sparkSession.sparkContext.broadcast(model)
    size = max(1 << 16, 8 * GROUP // len(model.langs))  # a word has some eight bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, text, size):
                yield pa.RecordBatch.from_arrays([*part.columns, *_labelled(part, text, kept.value, switch)], [*rest, *new])

    none = ~F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    marked = free_name(docs, "no_letter")
    rest.append(marked)
    fields.insert(len(rest) - 1, T.StructField(marked, T.BooleanType()))
    made = in_batches(docs.withColumn(marked, none).select(*rest), run, T.StructType(fields))
    bare = F.col(marked) | F.col(out).isNull()
    return made.withColumns({out: F.when(bare, "und").otherwise(F.col(out)), share: F.when(bare, 0.0).otherwise(F.col(share)), spans: F.when(bare, F.array().cast(SPANS)).otherwise(F.col(spans))}).drop(marked)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its language."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = fit(docs.filter(~held))
    found = predict(docs.drop("lang"), model)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))
