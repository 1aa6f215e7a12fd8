"""Ranked lexical search by the Best Position Algorithm.

Documents are read once: each becomes its number of terms and the frequencies of those terms that some item asks for, written as
a table of postings. Corpus counts (documents, terms, documents of a term) come from that table. A task then takes postings in blocks of bounded
size, builds for each term of a block its impact list, ordered by impact, and searches the block for every item:

* sorted access reads the lists of the item's terms some positions further, all alike;
* direct access looks each document that was met there up in all other lists, which gives its whole score and marks its positions there as seen;
* the best position of a list is the last one before its first unseen position. The impacts at the best positions add up to a bound for every unseen
  document, tighter than the impacts read last, since direct accesses push best positions on;
* reading stops when that bound is strictly below the k-th score, so documents of equal score and smaller id are not missed.

The k best of an item go with the task from block to block, so later blocks stop earlier. The best of the tasks are merged in two rounds of windows.
Items are taken in groups of bounded size, each a search of its own over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm.batches import in_batches, joined, lists, map_batches
from postlake.llm.kernels import PUNCTUATION, word_hashes
from postlake.llm.store import keep

TOP = 50
#: Terms of the items that are searched together (8 bytes each on the driver and in a task); more items are searched group after group.
TERMS_AT_ONCE = 500_000
#: Documents and postings of a block; a longer single document is a block of its own.
BLOCK_DOCS, BLOCK_POSTINGS = 1 << 15, 1 << 20
#: Positions of the first sorted access; it doubles.
READ = 64
#: First round of the merge: parts into which the tasks of an item are dealt.
PARTS = 64


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, terms): the distinct term hashes of each item; rows that repeat an id (or have a null one) are one item."""
    schema = T.StructType([T.StructField("item_id", items.schema[item_id].dataType), T.StructField("terms", T.ArrayType(T.LongType()))])

    def step(part: pa.RecordBatch) -> pa.RecordBatch:
        data, at = joined(part, "text")
        words, start, _ = word_hashes(data, PUNCTUATION, lower=True)
        first = np.searchsorted(start, at)
        own = [np.unique(words[a:b]).view(np.int64) for a, b in zip(first[:-1], first[1:], strict=True)]
        column = lists(np.concatenate([np.zeros(0, np.int64), *own]), np.array([len(x) for x in own]))
        return pa.RecordBatch.from_arrays([part.column(0), column], ["item_id", "terms"])

    rows = map_batches(items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")), step, schema, "text")
    return rows.filter("size(terms) > 0").groupBy("item_id").agg(F.array_distinct(F.flatten(F.collect_set("terms"))).alias("terms"))


def postings(docs: DataFrame, known: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, terms, tfs) of each document with a term: its number of terms, and for each of `known` (sorted hashes) that it holds, the place there and how often."""
    asked = docs.sparkSession.sparkContext.broadcast(known)

    def step(part: pa.RecordBatch) -> pa.RecordBatch:
        vocabulary = asked.value
        data, at = joined(part, "text")
        words, start, _ = word_hashes(data, PUNCTUATION, lower=True)
        n = np.diff(np.searchsorted(start, at))
        doc = np.repeat(np.arange(part.num_rows), n)
        place = np.searchsorted(vocabulary, words)
        place[place == len(vocabulary)] = 0
        hit = np.flatnonzero(vocabulary[place] == words) if len(vocabulary) else np.zeros(0, np.int64)
        pairs, tf = np.unique(doc[hit] * max(len(vocabulary), 1) + place[hit], return_counts=True)
        owner, term = np.divmod(pairs, max(len(vocabulary), 1))
        counts = np.bincount(owner, minlength=part.num_rows)
        made = [part.column(0), pa.array(n.astype(np.int64)), lists(term.astype(np.int32), counts), lists(tf.astype(np.int64), counts)]
        return pa.RecordBatch.from_arrays(made, ["doc_id", "n", "terms", "tfs"]).filter(pa.array(n > 0))

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(rows, step, "doc_id long, n long, terms array<int>, tfs array<long>", "text")


class Best:
    """The k best documents of an item so far: by score, then by id (null last)."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids, self.nulls = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        if len(self.scores) == self.k:
            near = scores >= self.scores[-1]
            scores, ids, nulls = scores[near], ids[near], nulls[near]
        if not len(scores):
            return
        scores, ids, nulls = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids]), np.concatenate([self.nulls, nulls])
        order = np.lexsort((ids, nulls, -scores))[: self.k]
        self.scores, self.ids, self.nulls = scores[order], ids[order], nulls[order]

    def floor(self) -> int:
        """The k-th score; 0 while there are fewer."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 0


class Lists:
    """Impact lists of a block of documents: for each term its documents by impact, and by document where in that order they stand."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int):
        by_impact = np.lexsort((doc, -impact, term))
        self.n_docs = n_docs
        self.start = np.searchsorted(term[by_impact], np.arange(n_terms + 1))
        self.docs, self.impacts = doc[by_impact], impact[by_impact]
        position = np.arange(len(doc)) - self.start[term[by_impact]]
        by_doc = np.lexsort((self.docs, term[by_impact]))
        self.doc_order, self.position, self.impact_by_doc = self.docs[by_doc], position[by_doc], self.impacts[by_doc]

    def search(self, terms: np.ndarray, best: Best, ids: np.ndarray, nulls: np.ndarray, read: int = READ) -> int:
        """Adds the documents that belong to the k best of an item; returns how many positions were read in each list."""
        spans = [(a, b) for a, b in zip(self.start[terms], self.start[terms + 1], strict=True) if b > a]
        if not spans or best.floor() > sum(int(self.impacts[a]) for a, _ in spans):
            return 0
        seen = np.zeros(self.n_docs, bool)
        marked = [np.zeros(b - a + 1, bool) for a, b in spans]  # one entry more, never seen
        at = [0] * len(spans)  # best positions, as counts
        depth, longest = 0, max(b - a for a, b in spans)
        while depth < longest:
            met = np.concatenate([self.docs[a + depth : min(a + depth + read, b)] for a, b in spans])
            new = np.unique(met[~seen[met]])
            seen[new] = True
            depth, read = depth + read, read * 2
            if len(new):
                scores = np.zeros(len(new), np.int64)
                for (a, b), marks in zip(spans, marked, strict=True):
                    place = np.searchsorted(self.doc_order[a:b], new)
                    place[place == b - a] = 0
                    found = self.doc_order[a:b][place] == new
                    scores[found] += self.impact_by_doc[a:b][place[found]]
                    marks[self.position[a:b][place[found]]] = True
                best.add(scores, ids[new], nulls[new])
            bound = 0
            for i, ((a, b), marks) in enumerate(zip(spans, marked, strict=True)):
                at[i] += int(np.argmin(marks[at[i] :]))
                bound += int(self.impacts[a + at[i] - 1]) if at[i] < b - a else 0
            if bound < best.floor():
                break
        return depth


def weights(n: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1)))."""
    return np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64)


def impacts(w: np.ndarray, tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term adds to a document's score, in whole numbers."""
    m = 50 + (50 * n * n_docs) // n_terms
    return w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def _search_group(spark: SparkSession, docs: DataFrame, group: list, id_type: T.DataType, k: int, block_docs: int, block_postings: int) -> DataFrame:
    """The k best documents of each item of a group."""
    known = np.unique(np.concatenate([np.zeros(0, np.int64), *(np.array(r["terms"], np.int64) for r in group)]).view(np.uint64))
    wanted = [np.searchsorted(known, np.array(r["terms"], np.int64).view(np.uint64)) for r in group]
    table = keep(postings(docs, known), "postings")
    n_docs, n_terms = table.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(known), np.int64)
    for row in table.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most one row a term of the group
        df[row["term"]] = row["count"]
    shared = spark.sparkContext.broadcast((weights(n_docs, df), wanted, [r["item_id"] for r in group]))
    schema = T.StructType([T.StructField("item_id", id_type), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    item_type = pa.schema([]) if not group else pa.array([r["item_id"] for r in group]).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, items, names = shared.value
        best = [Best(k) for _ in items]

        def search(held: list[pa.RecordBatch]) -> None:
            rows = pa.Table.from_batches(held)
            ids = rows.column("doc_id")
            nulls = ids.is_null().to_numpy()
            ids = pc.fill_null(ids, 0).to_numpy()
            n = rows.column("n").to_numpy()
            counts = pc.list_value_length(rows.column("terms")).to_numpy()
            doc = np.repeat(np.arange(len(n)), counts)
            term = np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in rows.column("terms").chunks]).astype(np.int64)
            tf = np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in rows.column("tfs").chunks])
            impact = impacts(w[term], tf, n[doc], n_docs, n_terms)
            some = impact > 0
            block = Lists(doc[some], term[some], impact[some], len(n), len(w))
            for terms, own in zip(items, best, strict=True):
                block.search(terms, own, ids, nulls)

        held, rows, entries = [], 0, 0
        for batch in batches:
            counts = np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False))
            start = 0
            while start < batch.num_rows:
                before = int(counts[start - 1]) if start else 0
                end = min(start + block_docs - rows, int(np.searchsorted(counts, before + block_postings - entries, "right")))
                end = max(end, start + 1) if not held else max(end, start)
                if end > start:
                    held.append(batch.slice(start, end - start))
                    rows, entries, start = rows + end - start, entries + int(counts[end - 1]) - before, end
                if start < batch.num_rows:
                    search(held)
                    held, rows, entries = [], 0, 0
        if held:
            search(held)
        for i, own in enumerate(best):
            if len(own.ids):
                some = own.scores > 0
                count = int(some.sum())
                yield pa.RecordBatch.from_arrays([pa.array([names[i]] * count, item_type), pa.array(own.ids[some], mask=own.nulls[some]), pa.array(own.scores[some])], ["item_id", "doc_id", "score"])

    return keep(in_batches(table, run, schema), "best") if group else spark.createDataFrame([], schema)


def search(docs: DataFrame, items: DataFrame, *, k: int = TOP, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", terms_at_once: int = TERMS_AT_ONCE, block_docs: int = BLOCK_DOCS, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of highest positive score for each item, all if there are fewer.

    Null and empty texts have no terms: such a document is found by no item and counted nowhere, such an item has no rows. Rows that repeat an item id are one item with
    all their terms, rows that repeat a document id are documents of their own; equal scores go by ascending doc_id, null last. Extra columns are ignored. Terms are
    compared by 64-bit hashes. Long texts are read whole.
    """
    spark = docs.sparkSession
    asked = keep(item_terms(items, item_id, item_text), "items")
    total = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    groups = -(-total // terms_at_once)
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = items.schema[item_id].dataType
    found = []
    for g in range(groups):
        group = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g).collect()  # about terms_at_once terms
        found.append(_search_group(spark, docs, group, id_type, k, block_docs, block_postings))
    if not found:
        found = [_search_group(spark, docs, [], id_type, k, block_docs, block_postings)]
    rows = reduce(DataFrame.unionByName, found).withColumn("part", F.spark_partition_id() % PARTS)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    first = Window.partitionBy("item_id", "part").orderBy(*order)
    rows = rows.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).filter(F.col("rank") <= k)
    return rows.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op12_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for each benchmark item."""
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE_SQL = r"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
b as (select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t from benchmark),
n as (select r, doc_id, cast(len(w) as bigint) as n from d where len(w) > 0),
total as (select count(*) as nd, cast(sum(n) as bigint) as l from n),
tf as (select r, t, count(*) as tf from (select r, unnest(w) as t from d) where t in (select t from b) group by r, t),
w as (select t, cast(floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1))) as bigint) as w from tf, total group by t, nd),
impact as (select tf.r, tf.t, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // l))) as s from tf join w using (t) join n using (r), total),
score as (select item_id, r, cast(sum(s) as bigint) as score from b join impact using (t) group by item_id, r having sum(s) > 0),
ranked as (select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score from score join n using (r))
select item_id, rank, doc_id, score from ranked where rank <= 50
"""
