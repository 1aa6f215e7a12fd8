"""Token ids as ORC: integer run-length encoded lists in stripes, row indexes and Bloom filters on document ids.

Rows lie in ascending document order over the files and inside each file. A row holds its document id, its number of ids, the
ids, the number of its file and the ids before it in that file, so stripes are read in parallel and in any order, a filter on
document ids skips files, stripes and row groups by their indexes, and the ids before a document follow from counts alone.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm.batches import LOADED, in_batches, lists, steps, texts_of
from postlake.llm.pieces import Pieces
from postlake.llm.store import shared_dir

#: Characters of the strings that hold many new pieces for one call of the library.
_JOINED = 20_000


class Library:
    """Ids of new pieces by the tokenizers library, many pieces that begin with a space in one call. Pieces hold no added token."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_file(path)
        self.added = {t.content: i for i, t in self.coder.get_added_tokens_decoder().items()}
        back = {chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}  # how byte-level tokens are spelt
        rest = [b for b in range(256) if b not in back.values()]
        back |= {chr(256 + k): b for k, b in enumerate(rest)}
        self.length = np.zeros(self.coder.get_vocab_size(), np.int64)
        for token, i in self.coder.get_vocab().items():
            self.length[i] = len(token) if all(c in back for c in token) else 0

    def each(self, pieces: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.int32).tobytes() for e in self.coder.encode_batch_fast(pieces, add_special_tokens=False)]

    def __call__(self, pieces: list[str]) -> list[bytes]:
        """Words after a space stay pieces of their own when they are joined; the ids are cut where the bytes end."""
        out: dict[str, bytes] = {}
        words = [p for p in pieces if p[0] == " " and p[1:].isalpha()]
        group, size, groups = [], 0, []
        for p in words:
            group.append(p)
            size += len(p)
            if size > _JOINED:
                groups.append(group)
                group, size = [], 0
        groups.append(group)
        for group in filter(None, groups):
            ids = np.array(self.coder.encode_batch_fast(["".join(group)], add_special_tokens=False)[0].ids, np.int32)
            ends = np.cumsum(self.length[ids])
            cuts = np.cumsum([len(p.encode("utf-8", "replace")) for p in group])
            at = np.searchsorted(ends, cuts)
            if len(ends) and at[-1] < len(ends) and (ends[at] == cuts).all() and at[-1] == len(ends) - 1:
                starts = np.concatenate([[0], at[:-1] + 1])
                out.update((p, ids[a : b + 1].tobytes()) for p, a, b in zip(group, starts, at, strict=True))
            else:
                out.update(zip(group, self.each(group), strict=True))
        rest = [p for p in pieces if p not in out]
        out.update(zip(rest, self.each(rest), strict=True))
        return [out[p] for p in pieces]


class Coder:
    """Packed ids of whole texts, as the library gives them by default: added tokens in a text are ids of their own."""

    def __init__(self, path: str, pattern: str):
        library = Library(path)
        self.pieces = Pieces(library, pattern)
        self.packed = {token: np.array([i], np.int32).tobytes() for token, i in library.added.items()}
        self.added = re.compile("(" + "|".join(map(re.escape, sorted(library.added, key=len, reverse=True))) + ")") if library.added else None

    def encode(self, texts: list[str]) -> list[bytes]:
        special = [i for i, t in enumerate(texts) if any(token in t for token in self.packed)]
        if not special:
            return self.pieces.encode(texts)
        parts = {i: self.added.split(texts[i]) for i in special}  # every second part is an added token
        made = iter(self.pieces.encode([*(t for i, t in enumerate(texts) if i not in parts), *(p for own in parts.values() for p in own[::2])]))
        out = [b"" if i in parts else next(made) for i in range(len(texts))]
        for i, own in parts.items():
            out[i] = b"".join(next(made) if k % 2 == 0 else self.packed[p] for k, p in enumerate(own))
        return out


def _encoder(path: str, pattern: str) -> Coder:
    if (path, pattern) not in LOADED:
        LOADED[path, pattern] = Coder(path, pattern)
    return LOADED[path, pattern]


def write_tokens(docs: DataFrame, path: str, *, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int | None = 0, pattern: str = public_tokenizers.PATTERN, files: int | None = None, stripe_bytes: int = 64 << 20, compression: str = "lz4") -> None:
    """Writes the ids of every text (null: empty) and then end_id, in ascending doc_id order (null first; equal ids by text).

    The texts, not the longer ids, are dealt into ranges of document ids, one file each; a task streams through its rows, so
    its memory follows one step of about 2 MB or the longest single text. An empty table gives files without rows. Added tokens of the
    tokenizer that stand in a text get their own ids, as the library does by default.
    """
    spark = docs.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "text")
    last = b"" if end_id is None else np.array([end_id], np.int32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, before = _encoder(tokenizer, pattern), TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in steps(batch, "text"):
                packed = [x + last for x in coder.encode(texts_of(rows, "text"))]
                counts = np.array([len(x) // 4 for x in packed], np.int64)
                ends = np.cumsum(counts)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.full(len(counts), part, np.int32)), pa.array(before + ends - counts), pa.array(counts), lists(np.frombuffer(b"".join(packed), np.int32), counts)],
                    ["doc_id", "file", "before", "n_tokens", "ids"],
                )
                before += int(ends[-1])

    made = in_batches(rows, run, SCHEMA, loads=True)
    (made.write.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").option("orc.create.index", "true")
     .option("orc.row.index.stride", "1000").option("orc.stripe.size", str(stripe_bytes)).option("compression", compression).orc(path))


SCHEMA = "doc_id long, file int, before long, n_tokens long, ids array<int>"


def read_tokens(spark: SparkSession, path: str, where: str | None = None) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids); start: ids of all documents before it. where: a filter on doc_id, pushed to the
    indexes and Bloom filters. The table of counts by file has one row a file, and only that is broadcast."""
    rows = spark.read.schema(SCHEMA).orc(path)
    counts = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    rows = rows.filter(where) if where else rows
    return rows.join(F.broadcast(bases), "file").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids")


def with_crc32(rows: DataFrame, ids: str = "ids", out: str = "ids_crc32") -> DataFrame:
    """rows with the unsigned CRC-32 of each list of ids as little-endian 32-bit integers in place of the list."""
    rest = [c for c in rows.columns if c not in (ids, out)]
    schema = T.StructType([*rows.select(*rest).schema.fields, T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(rest))
            flat = memoryview(np.ascontiguousarray(pc.fill_null(column.flatten(), 0).to_numpy(zero_copy_only=False).astype("<i4", copy=False))).cast("B")
            ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))]) * 4
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], pa.array(crc, pa.int64())], [*rest, out])

    return in_batches(rows.select(*rest, ids), run, schema)


def op5_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as token files and what reading them back gives."""
    path = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    write_tokens(docs, path, tokenizer=public_tokenizers.path("byte_bpe_50k.json"))
    return with_crc32(read_tokens(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")
