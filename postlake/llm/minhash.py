"""MinHash near-duplicates by a multi-index Hamming join.

A document's word shingles give a signature of POSITIONS values of 16 bits; two documents whose shingle sets have Jaccard
similarity s differ in about (1 - s) of the positions. The signature is cut into c chunks. Of two signatures that
differ in at most 2 * c - 1 positions some chunk differs in at most one, so if each chunk is indexed once without each of its positions,
every such pair meets in some bucket. c is the smallest number for which a pair at the threshold differs in more positions
with probability below MISS (10 chunks at similarity 0.85, 12 at 0.8).

Equal sets are one class. A bucket is not expanded into pairs: each of its members is compared with one hub, the member that shares
most with others over all its buckets, so a group of edited copies meets its centre. Near pairs are confirmed on the full sets. What
may still be missing are links between members of one bucket that lie in different components. For these, the members of such buckets
alone are indexed by the rarest shingles of their sets: of two sets that link, some shingle is among the first few of both, and its
places bound what the rest can share. These pairs, again near in signature, are confirmed too, so that no link that joins two components is lost.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlake.llm.batches import in_batches, joined, map_batches
from postlake.llm.kernels import SPACES, mixed, run_hashes, word_hashes
from postlake.llm.store import components, keep, shuffled

POSITIONS, MISS = 48, 1e-5
#: Ids up to this number (some 10 MB) are broadcast to pick texts; more are joined by a shuffle.
BROADCAST_IDS = 200_000
_NULL_ID = -(1 << 63)
_FACTORS = mixed(np.arange(1, POSITIONS + 1, dtype=np.uint64)) | np.uint64(1)


def chunks_for(similarity: float) -> int:
    """Chunks that keep the chance to miss a pair at this similarity below MISS."""
    p = 1 - similarity
    chance = [math.comb(POSITIONS, k) * p**k * (1 - p) ** (POSITIONS - k) for k in range(POSITIONS + 1)]
    return next((c for c in range(1, POSITIONS) if sum(chance[2 * c :]) < MISS), POSITIONS)


def row_keys(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """doc_id (a stand-in for null) and text_key (128-bit digest): rows with both equal repeat each other."""
    return [F.coalesce(F.col(doc_id).cast("long"), F.lit(_NULL_ID)).alias("doc_id"), F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("text_key")]


def _sets(part: pa.RecordBatch, text: str, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in a row, and where each text's begin."""
    data, at = joined(part, text)
    hashes, starts, _ = word_hashes(data, SPACES, lower=True)
    first = np.searchsorted(starts, at)
    runs = run_hashes(hashes, words)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(runs[a : b - words + 1])
        elif b > a:
            out.append(run_hashes(hashes[a:b], b - a) + np.uint64(b - a))
        else:
            out.append(hashes[:0])
    sizes = np.cumsum([0, *map(len, out)])
    return (np.concatenate(out) if out else hashes[:0]), sizes


def signatures(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """Per row: doc_id, text_key, n_shingles (distinct), class_key (digest of the set), signature (16-bit values; null without shingles)."""

    def step(part: pa.RecordBatch) -> pa.RecordBatch:
        values, at = _sets(part, "text", words)
        full = np.flatnonzero(at[1:] > at[:-1])
        lows = np.zeros((len(full), POSITIONS), np.uint16)
        if len(full):
            for k, factor in enumerate(_FACTORS):
                lows[:, k] = (mixed(np.minimum.reduceat(values * factor, at[full])) & np.uint64(0xFFFF)).astype(np.uint16)
        sizes, keys, marks, i = [], [], [], 0
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            own = np.unique(values[a:b])
            sizes.append(len(own))
            keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if b > a else None)
            marks.append(lows[i].tolist() if b > a else None)
            i += b > a
        return pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(marks, pa.list_(pa.int32()))], ["doc_id", "text_key", "n_shingles", "class_key", "signature"])

    rows = docs.select(*row_keys(doc_id, text), F.col(text).alias("text"))
    return map_batches(rows, step, "doc_id long, text_key binary, n_shingles long, class_key binary, signature array<int>", "text")


def _buckets(classes: DataFrame, chunks: int) -> DataFrame:
    """(bucket, rep): a bucket for each chunk of a signature without each of its positions."""
    parts = np.array_split(np.arange(POSITIONS), chunks)

    def step(part: pa.RecordBatch) -> pa.RecordBatch:
        marks = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, POSITIONS).astype(np.uint64)
        out = []
        for c, chunk in enumerate(parts):
            for gap in chunk:
                key = np.full(part.num_rows, 1 + c * 64 + int(gap), np.uint64)
                for i in chunk:
                    if i != gap:
                        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + marks[:, i] + np.uint64(1))
                out.append(key)
        rep = part.column(0).to_numpy(zero_copy_only=False)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(out).view(np.int64)), pa.array(np.tile(rep, len(out)))], ["bucket", "rep"])

    def slices(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                yield step(batch.slice(at, 2000))

    return in_batches(classes.select("rep", "signature"), slices, "bucket long, rep long")


def _distance(a: Column, b: Column) -> Column:
    """Positions in which two signatures differ."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x != y), lambda d: d))


def _near(pairs: DataFrame, classes: DataFrame, chunks: int) -> DataFrame:
    """(a, b) of the pairs whose signatures are near enough."""
    marks = classes.select("rep", F.col("signature").alias("marks"))
    both = pairs.join(shuffled(marks.toDF("a", "marks_a")), "a").join(shuffled(marks.toDF("b", "marks_b")), "b")
    return both.filter(_distance(F.col("marks_a"), F.col("marks_b")) <= 2 * chunks - 1).select("a", "b")


def _shingles(ids: DataFrame, classes: DataFrame, docs: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """(id, shingles): the sorted set of each of these classes, from the text of its first row."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS

    def step(part: pa.RecordBatch) -> pa.RecordBatch:
        values, at = _sets(part, "text", words)
        sets = [np.unique(values[a:b]).tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["id", "shingles"])

    firsts = classes.select(F.col("rep").alias("id"), "first.doc_id", "first.text_key").join(F.broadcast(ids) if few else shuffled(ids), "id", "left_semi")
    rows = docs.select(*row_keys(doc_id, text), F.col(text).alias("text"))
    rows = rows.join(F.broadcast(firsts) if few else shuffled(firsts), ["doc_id", "text_key"]).select("id", "text")
    return keep(map_batches(rows, step, "id long, shingles binary", "text").groupBy("id").agg(F.first("shingles").alias("shingles")), "shingles")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs whose full shingle sets have at least `percent` / 100 of their union in common."""

    def compare(part: pa.RecordBatch) -> pa.RecordBatch:
        ok = []
        for a, b in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            ok.append(100 * both >= percent * (len(a) + len(b) - both))
        return pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    full = pairs.select("a", "b").join(shuffled(sets.toDF("a", "set_a")), "a").join(shuffled(sets.toDF("b", "set_b")), "b").select("a", "b", "set_a", "set_b")
    return map_batches(full, compare, "a long, b long", "set_a")


def _spread(sets: DataFrame) -> DataFrame:
    """(rep, shingle) of all sets."""

    def step(part: pa.RecordBatch) -> pa.RecordBatch:
        own = part.column(1).to_pylist()
        sizes = np.array([len(x) // 8 for x in own])
        ids = part.column(0).to_numpy(zero_copy_only=False)
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, sizes)), pa.array(np.frombuffer(b"".join(own), np.int64))], ["rep", "shingle"])

    return map_batches(sets, step, "rep long, shingle long", "shingles")


def _hubs(members: DataFrame) -> DataFrame:
    """(bucket, hub): of each bucket the member whose buckets have most members together."""
    shared = members.groupBy("rep").agg(F.sum("n").alias("shared"))
    order = F.struct("shared", -F.col("rep"))
    return members.join(shuffled(shared), "rep").groupBy("bucket").agg(F.max_by("rep", order).alias("hub"))


def _across(sets: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """(a, b) of different components among these sets that may link by what their rarest shingles show.

    Of two sets with n_a and n_b shingles that link, both hold one of the others' shingles among their n - ceil(n * percent / 100) + 1
    rarest ones; if the first such stands at places p_a and p_b (from 0), they share at most min(n_a - p_a, n_b - p_b). A pair is
    made only from a row outside the shingle's largest component, so a large group costs nothing by itself.
    """
    rows = _spread(sets)
    holders = rows.groupBy("shingle").agg(F.count("*").alias("holders")).filter("holders > 1")
    held = rows.join(shuffled(holders), "shingle")
    sizes = sets.select(F.col("id").alias("rep"), (F.length("shingles") / 8).cast("int").alias("n"))
    sizes = sizes.join(shuffled(held.groupBy("rep").agg(F.count("*").cast("int").alias("shared"))), "rep")  # the others stand before all shared ones
    sizes = sizes.filter(F.col("shared") * 100 >= F.col("n") * percent)
    order = Window.partitionBy("rep").orderBy("holders", "shingle")
    placed = held.join(shuffled(sizes), "rep").withColumn("place", F.col("n") - F.col("shared") + F.row_number().over(order) - 1)
    placed = placed.filter((F.col("n") - F.col("place")) * 100 >= F.col("n") * percent).select("shingle", "rep", "n", "place")
    weight = found.groupBy("component").agg(F.count("*").alias("weight"))
    label = found.join(shuffled(weight), "component").toDF("component", "rep", "weight")
    placed = placed.join(shuffled(label), "rep", "left").withColumns({"component": F.coalesce("component", "rep"), "weight": F.coalesce("weight", F.lit(1))})
    placed = keep(placed, "places")
    mixed_ = placed.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.max(F.struct("weight", "component")).alias("top"))
    placed = placed.join(shuffled(mixed_.filter("low < high").select("shingle", F.col("top.component").alias("top"))), "shingle")
    left = placed.filter("component != top").select("shingle", "rep", "n", "place", "component").toDF("shingle", "a", "na", "pa", "ca")
    right = placed.select("shingle", "rep", "n", "place", "component", "top").toDF("shingle", "b", "nb", "pb", "cb", "top")
    room = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) * (100 + percent) >= (F.col("na") + F.col("nb")) * percent
    pairs = left.join(shuffled(right), (left["shingle"] == right["shingle"]) & (F.col("ca") != F.col("cb")) & ((F.col("cb") == F.col("top")) | (F.col("a") < F.col("b"))) & room)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links: the links between components are joined into components of components."""
    ends = links.join(shuffled(found.toDF("a", "ca")), "a", "left").join(shuffled(found.toDF("b", "cb")), "b", "left")
    ends = keep(ends.select(F.coalesce("ca", "a").alias("src"), F.coalesce("cb", "b").alias("dst")), "joined")
    over = keep(components(ends).toDF("component", "top"), "over")
    old = found.join(shuffled(over), "component", "left").select("id", F.coalesce("top", "component").alias("component"))
    new = over.join(shuffled(found.select(F.col("id").alias("component"))), "component", "left_anti").toDF("id", "component")
    return keep(old.unionByName(new), "components")


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = 3, percent: int = 85) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable over links, itself included), kept.

    Words are runs of non-spaces after lower-casing A-Z. A text with fewer words than a shingle is one shingle; null and empty
    texts have none, link with nothing and are kept. Rows that repeat a doc_id are returned each, with the class of their text;
    a null doc_id counts as smaller than all others. Of each component one row is kept: of those with its smallest doc_id the one
    whose text has the smallest digest, and of rows that repeat that one, one. Extra columns are ignored.
    """
    out = decided(docs, doc_id=doc_id, text=text, words=words, percent=percent)
    shown = lambda c: F.when(F.col(c) > _NULL_ID, F.col(c)).alias(c)
    return out.select(shown("doc_id"), "n_shingles", shown("component_id"), "kept")


def decided(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = 3, percent: int = 85) -> DataFrame:
    """near_duplicates with the text_key of each row; null ids by their stand-in."""
    # Written once: every later step reads it, the texts are read again only for the sets.
    # Ids may repeat or be null, so rows and classes have numbers of their own, fixed by the writing.
    marked = keep(signatures(docs, doc_id=doc_id, text=text, words=words).withColumn("row", F.monotonically_increasing_id()), "signatures")
    classes = marked.filter("n_shingles > 0").groupBy("class_key").agg(F.min(F.struct("doc_id", "text_key", "row")).alias("first"), F.first("signature").alias("signature"))
    classes = keep(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    chunks = chunks_for(percent / 100)
    buckets = _buckets(classes, chunks)
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = keep(buckets.join(shuffled(shared), "bucket"), "members")
    pairs = members.join(shuffled(_hubs(members)), "bucket").filter("rep != hub").select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()
    near = keep(_near(pairs, classes, chunks), "near")
    crowd = members.filter("n > 2")  # a bucket of two has no pair but the one with its hub
    ids = near.select(F.col("a").alias("id")).unionByName(near.select(F.col("b").alias("id"))).unionByName(crowd.select(F.col("rep").alias("id"))).distinct()
    sets = _shingles(keep(ids, "ids"), classes, docs, doc_id, text, words)
    found = keep(components(_confirmed(near, sets, percent), "a", "b"), "components")

    # buckets that still hold several components
    labelled = crowd.join(shuffled(found.toDF("rep", "component")), "rep", "left").select("bucket", "rep", F.coalesce("component", "rep").alias("component"))
    mixed_ = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("bucket")
    open_ = labelled.join(shuffled(mixed_), "bucket").select(F.col("rep").alias("id")).distinct()
    across = _across(keep(sets.join(shuffled(open_), "id"), "open"), found, percent).join(shuffled(near), ["a", "b"], "left_anti")
    across = keep(_near(across, classes, chunks), "across")
    if not across.isEmpty():
        found = _joined(found, _confirmed(across, sets, percent))

    reps = keep(classes.select("class_key", "rep", "first").join(shuffled(found.toDF("rep", "component")), "rep", "left"), "reps")
    firsts = reps.filter("component is not null").groupBy("component").agg(F.min("first").alias("least"))
    reps = reps.join(shuffled(firsts), "component", "left").select("class_key", F.coalesce("least", "first").alias("first"))
    out = marked.select("doc_id", "text_key", "n_shingles", "class_key", "row").join(shuffled(reps), "class_key", "left")
    return out.select("doc_id", "text_key", "n_shingles", F.coalesce("first.doc_id", "doc_id").alias("component_id"), F.coalesce(F.col("row") == F.col("first.row"), F.lit(True)).alias("kept"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates among documents."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sh as (select distinct doc_id, array_to_string(w[i : i + 2], ' ') as s from w, unnest(generate_series(1, greatest(len(w) - 2, 1))) as t(i) where len(w) > 0),
n as (select doc_id, count(*) as n from sh group by doc_id),
pair as (select a.doc_id as a, b.doc_id as b, count(*) as c from sh a join sh b on a.s = b.s and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id),
link as (select a, b from pair join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
reach as (select doc_id as a, doc_id as b from w union select reach.a, link.b from reach join link on link.a = reach.b),
low as (select a as doc_id, min(b) as component_id from reach group by a)
select w.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, component_id, w.doc_id = component_id as kept from w left join n using (doc_id) join low using (doc_id)
"""
