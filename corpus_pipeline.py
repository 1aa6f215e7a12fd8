"""A corpus through five operators: toxic documents go, one of each group of near-duplicates stays, documents with benchmark
passages go, personal data is masked, and what is left is encoded.

Every stage works on all rows that the one before kept and, but for the last, returns the columns of documents. Rows with a null text pass the
filters; an empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm import bpe, minhash, pii, toxicity, winnow
from postlake.llm.batches import free_name
from postlake.llm.store import keep, shuffled


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below one half."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~toxicity.held_out())
    model = toxicity.fit(docs, labels)
    score, passages = free_name(docs, "score"), free_name(docs, "passages")
    return toxicity.score(docs, model, out=score, passages=passages).filter(F.col(score) < 0.5).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group, by five-word shingles at similarity 0.8: with the smallest id (null first), and of rows that repeat it, one.

    Rows are told apart by id and text, so ids may repeat or be null.
    """
    rows = minhash.decided(docs, words=5, percent=80).filter("n_shingles > 0")
    own = [free_name(docs, "key_id"), free_name(docs, "key_text")]
    mine = docs.withColumns(dict(zip(own, minhash.row_keys(), strict=True)))
    marks = rows.groupBy(F.col("doc_id").alias(own[0]), F.col("text_key").alias(own[1])).agg(F.max("kept").alias("kept"), F.count("*").alias("n")).filter("not kept or n > 1")
    marks = keep(marks, "marks")
    marks = F.broadcast(marks) if marks.limit(minhash.BROADCAST_IDS + 1).count() <= minhash.BROADCAST_IDS else shuffled(marks)
    rest = mine.join(marks.select(*own), own, "left_anti").select(*docs.columns)
    again = marks.filter("kept").select(*own)
    if again.isEmpty():
        return rest
    return rest.unionByName(mine.join(again, own, "left_semi").dropDuplicates(own).select(*docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of words of any benchmark item, told apart by their text, so ids may repeat or be null."""
    own = free_name(docs, "key_text")
    mine = docs.withColumn(own, minhash.row_keys()[1])
    hits = winnow.find_overlaps(mine, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), doc_id=own)
    hit = hits.filter(F.size("hits") > 0).select(F.col("doc_id").alias(own))
    return mine.join(hit, own, "left_anti").select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text."""
    spans = free_name(docs, "pii")
    masked = pii.redact(pii.find_pii(docs, out=spans), spans).drop(spans)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return masked.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, and whether the decoded ids give the text again."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    sha = free_name(docs, "text_sha")
    rows = docs.select("doc_id", "lang", "source", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias(sha))
    coded = bpe.decode(bpe.encode(rows, vocabulary_path=path).drop("text"), vocabulary_path=path)
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.sha2("decoded", 256) == F.col(sha)).alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("encoding", encode),
]

#: No SQL expresses the classifier and the merges of the encoding; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
