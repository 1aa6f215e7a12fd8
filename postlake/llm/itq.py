"""Near-duplicate embeddings: iterative quantisation, multi-index Hamming tables, reranking by exact cosine.

A code is the signs of a vector under rotations about the origin. The rotations are learned on a sample: signs and rotation are fitted to
each other in turns, so that vectors move away from the borders between codes. Nothing is centred, as that would widen the
angles of vectors that share a direction. Code chunks are the keys of the tables; each vector is looked up under its own chunk and
the chunks one bit away, and what is found there, unless its code is far, is compared by cosine in double precision. Equal
vectors are one class.

There are as many tables as make the chance to miss a pair at the threshold at most MISS for the width of the chunks. For learned
rotations that chance is measured on pairs made from the sample at exactly the threshold; for random rotations, where each bit differs with
chance angle / pi whatever the vectors are, it is known. The sample also shows how many vectors that are no links would meet, and
the cheapest width is taken. Random rotations come in only where learned ones cost WORTH times as much, as where vectors share a
direction and learning draws them all into one corner, or where the sample is too small to learn from. Every vector is indexed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm.batches import in_batches
from postlake.llm.store import components, keep

#: Vectors that rotations and width are learned from; rounds of learning; least number of tables; chance to miss a pair at the threshold; standard deviations kept above the mean distance.
SAMPLE, ROUNDS, TABLES, MISS, SPREAD = 2_000, 15, 8, 0.005, 4.5
#: Widths of a chunk; bits of a code that the distance is taken on, as they are in every row of a table; rotations that the choice is made on.
WIDTHS, CODE_BITS, TRIED = range(8, 40), 504, 4
#: Work of random rotations, times which learned ones may cost before the random ones are taken.
WORTH = 2.0
_NULL_ID = -(1 << 63)


def rotations(dims: int, bits: int, seed: int = 7) -> np.ndarray:
    """Columns of random rotations: signs of x @ rotations are the code."""
    random, out = np.random.default_rng(seed), []
    while (left := bits - sum(x.shape[1] for x in out)) > 0:
        out.append(np.linalg.qr(random.standard_normal((dims, min(dims, left))))[0])
    return np.concatenate(out, 1)


def scaled(x: np.ndarray) -> np.ndarray:
    """Vectors times powers of two that bring their largest component to 0.5 .. 1: angles keep every bit, and squares neither over- nor underflow."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def learned(some: np.ndarray, bits: int, seed: int = 7) -> np.ndarray:
    """Columns of rotations fitted to the vectors `some` by iterative quantisation, each from another random start."""
    x, out = unit(some), []
    dims = x.shape[1]
    for k in range(-(-bits // dims)):
        turn = rotations(dims, dims, seed + k)
        for _ in range(ROUNDS):
            signs = np.where(x @ turn > 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(x.T @ signs)
            turn = u @ v
        out.append(turn)
    return np.concatenate(out, 1)[:, :bits]


def _meets(share, width: int):
    """Chance that two chunks differ in at most one bit when each bit differs with chance `share`."""
    return (1 - share) ** width + width * share * (1 - share) ** (width - 1)


def at_threshold(x: np.ndarray, least: float, seed: int = 5) -> np.ndarray:
    """For each unit vector one at cosine `least`: every second one turned towards another vector, the others in a random direction."""
    random = np.random.default_rng(seed)
    aside = random.standard_normal(x.shape)
    aside[::2] = x[random.permutation(len(x))][::2] + 1e-6 * aside[::2]
    aside -= (aside * x).sum(1, keepdims=True) * x
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    return least * x + math.sqrt(1 - least * least) * aside


def _tables(share: np.ndarray, width: int) -> int:
    """Tables that keep the mean chance to miss a pair, over pairs with these shares of differing bits, at MISS or below."""
    apart, n = 1 - _meets(share, width), TABLES
    while (apart**n).mean() > MISS and n < 1 << 14:
        n += max(1, n // 8)
    return n


def plan(some: np.ndarray, count: int, least: float) -> tuple[int, int, bool]:
    """(width, tables, learned?): of the widths, each with the tables that MISS asks for, the one with the fewest lookups and candidates."""
    x = unit(some)
    pairs = np.triu_indices(len(x), 1)
    cosines = (x @ x.T)[pairs]
    others, known = cosines < least, np.array([math.acos(least) / math.pi])
    ways = [(False, known, np.arccos(np.clip(cosines[others], -1, 1)) / math.pi)]
    if len(x) >= 2 * x.shape[1]:  # with fewer vectors every one finds a corner of its own, and the sample says nothing about the rest
        half = learned(x[::2], TRIED * x.shape[1])  # measured on vectors that it was not learned from
        y = x[1::2]
        codes = np.where(y @ half > 0, 1.0, -1.0)
        near = np.where(at_threshold(y, least) @ half > 0, 1.0, -1.0)
        apart = (1 - (codes @ codes.T / half.shape[1])) / 2
        own = np.triu_indices(len(y), 1)
        ways.append((True, (1 - (codes * near).mean(1)) / 2, apart[own][(y @ y.T)[own] < least]))
    best = []
    for taught, share, others_ in ways:
        for width in WIDTHS:
            tables = _tables(share, width)
            met = _meets(others_, width).sum() / max(len(others_), 1)
            cost = tables * (count * (width + 2) + met * count * count / 2)
            best.append((cost if taught else WORTH * cost, width, tables, taught))
    return min(best)[1:]


def _keys(codes: np.ndarray, width: int, probe: bool) -> tuple[np.ndarray, np.ndarray]:
    """(table and chunk as one number, row) of every lookup."""
    out, rows = [], np.arange(len(codes))
    weights = (1 << np.arange(width, dtype=np.int64))[None, :]
    for t in range(codes.shape[1] // width):
        chunk = (codes[:, t * width : (t + 1) * width] * weights).sum(1)
        flips = [0, *(1 << np.arange(width, dtype=np.int64)).tolist()] if probe else [0]
        out += [(chunk ^ f) | (t << 40) for f in flips]
    return np.concatenate(out), np.tile(rows, len(out))


def near_vectors(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", least: float = 0.95, sample: int = SAMPLE) -> DataFrame:
    """Per row: vec_id, n_links (other rows with cosine >= least that were found), component_id (smallest vec_id reachable), kept.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of different lengths do not
    link. Equal vectors (repeated rows too) all link. A null vec_id counts as smaller than all others. Extra columns are ignored.
    """
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    usable = F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)
    rows = vectors.select(F.coalesce(F.col(vec_id).cast("long"), F.lit(_NULL_ID)).alias("id"), F.when(usable, F.col(vector).cast("array<double>")).alias("v"))
    rows = keep(rows.withColumn("same", F.sha2(F.to_json(F.struct("v")), 256)), "vectors")
    good = rows.filter("v is not null")
    classes = keep(good.groupBy("same").agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.first("v").alias("v")), "classes")
    none = classes.select(F.col("rep").alias("a"), F.col("rep").alias("b")).limit(0)
    links = none
    for size in classes.groupBy(F.size("v").alias("size")).count().collect():  # one row for each length of vectors
        mine = classes.filter(F.size("v") == size["size"])
        if size["count"] > 1:
            links = links.unionByName(_links(mine, size["count"], least, sample))
    links = keep(links, "links")
    counts = classes.select("rep", "n")
    ways = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = ways.join(counts.toDF("b", "m"), "b").groupBy("a").agg(F.sum("m").alias("others"))
    found = components(links, "a", "b")
    told = counts.join(others.withColumnRenamed("a", "rep"), "rep", "left").join(found.toDF("rep", "component"), "rep", "left")
    told = classes.select("same", "rep").join(told, "rep").select("same", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    # vectors that link with nothing share one digest: they don't go through the join
    alone = rows.filter("v is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    every = good.select("id", "same").join(told, "same").select("id", F.col("n_links").cast("long").alias("n_links"), "component").unionByName(alone)
    shown = lambda c: F.when(c > _NULL_ID, c)
    return every.select(shown(F.col("id")).alias("vec_id"), "n_links", shown(F.col("component")).alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))


def _links(classes: DataFrame, count: int, least: float, sample: int) -> DataFrame:
    """(a, b), a < b, of classes with cosine >= least that the tables find."""
    taken = classes.orderBy(F.xxhash64("rep")).limit(sample).select("v").toArrow()["v"].combine_chunks()  # at most `sample` vectors
    some = taken.flatten().to_numpy(zero_copy_only=False).reshape(len(taken), -1)
    width, tables, taught = plan(some, count, least)
    rotated = learned(some, tables * width) if taught else rotations(some.shape[1], tables * width)
    bits = min(tables * width, CODE_BITS)
    share = math.acos(least) / math.pi
    far = math.ceil(bits * share + SPREAD * math.sqrt(bits * share * (1 - share)))
    if taught:  # the farthest of the made pairs may lie beyond
        x = unit(some)
        apart = ((x @ rotated[:, :bits] > 0) != (at_threshold(x, least) @ rotated[:, :bits] > 0)).sum(1)
        far = max(far, int(apart.max() + math.sqrt(bits)))
    words = -(-bits // 63)

    def coded(probe: bool):
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            x = np.array(part.column(1).flatten()).reshape(part.num_rows, -1)
            codes = (unit(x) @ rotated > 0).astype(np.int64)
            keys, row = _keys(codes, width, probe)
            padded = np.zeros((len(codes), words * 63), np.int64)
            padded[:, :bits] = codes[:, :bits]
            packed = (padded.reshape(len(codes), words, 63) << np.arange(63, dtype=np.int64)).sum(2)
            ids = part.column(0).to_numpy(zero_copy_only=False)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(packed[row].reshape(-1)), words).cast(pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids[row]), flat], ["key", "id", "code"])

        size = max(1, 500 * 8 * 18 // (tables * (width + 1)))

        def slices(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, size):
                    yield step(batch.slice(at, size))

        return in_batches(classes.select("rep", "v"), slices, "key long, id long, code array<bigint>")

    index, probes = coded(False).toDF("key", "b", "code_b"), coded(True).toDF("key", "a", "code_a")
    distance: Column = F.lit(0)
    for i in range(words):
        distance = distance + F.bit_count(F.get("code_a", F.lit(i)).bitwiseXOR(F.get("code_b", F.lit(i)))).cast("int")
    pairs = probes.join(index, "key").filter((F.col("a") < F.col("b")) & (distance <= far)).select("a", "b").distinct()
    values = classes.select("rep", "v")

    def cosine(part: pa.RecordBatch) -> pa.RecordBatch:
        x, y = (scaled(np.array(part.column(i).flatten()).reshape(part.num_rows, -1)) for i in (2, 3))
        near = (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1))) >= least
        return pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(near))

    full = pairs.join(values.toDF("a", "x"), "a").join(values.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return in_batches(full, lambda batches: (cosine(b) for b in batches if b.num_rows), "a long, b long")


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates among embeddings."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE_SQL = r"""
with recursive v as (select vec_id, cast(embedding as double[]) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
link as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.95),
reach as (select vec_id as a, vec_id as b from embeddings union select reach.a, link.b from reach join link on link.a = reach.b),
low as (select a as vec_id, min(b) as component_id from reach group by a),
n as (select a as vec_id, count(*) as n from link group by a)
select e.vec_id, cast(coalesce(n.n, 0) as bigint) as n_links, component_id, e.vec_id = component_id as kept from embeddings e join low using (vec_id) left join n using (vec_id)
"""
