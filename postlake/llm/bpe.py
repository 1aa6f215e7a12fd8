"""Byte-level BPE encoding and decoding.

A trie automaton over the vocabulary, its bytes mapped to Latin-1, reports every token that occurs in a piece. Encoding
takes the longest token at each place and keeps it only if it may follow the token before: two tokens may be adjacent
exactly if merging their joined bytes from scratch gives these two again, which is memoised per pair. Where no token fits, the
last token is shortened; a place that has failed is never tried again, so a piece takes time in proportion to its length, and
the one sequence whose neighbours are all compatible is the one that merging by rank produces.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cached_property

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm.batches import LOADED, in_batches, lists, steps, texts_of
from postlake.llm.pieces import Pieces

#: Pieces and adjacent pairs that a worker remembers; some 80 MB together, kept between tasks.
PIECES, FITS = 100_000, 300_000


class Vocabulary:
    """Ranks of a tiktoken-style file and what encoding by adjacency needs."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
        self.size = max(self.rank.values()) + 1
        self.bytes_of = [b""] * self.size
        for token, i in self.rank.items():
            self.bytes_of[i] = token
        self.length = [len(x) for x in self.bytes_of]
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.shorter: dict[int, int] = {}
        self.fits: dict[int, bool] = {}

    @cached_property
    def trie(self) -> ahocorasick.Automaton:
        """Only encoding needs it."""
        made = ahocorasick.Automaton()
        for token, i in self.rank.items():
            made.add_word(token.decode("latin-1"), i)
        made.make_automaton()
        return made

    def halves_of(self, i: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes token i; None for single bytes."""
        if i not in self.halves:
            parts = [self.rank[bytes([b])] for b in self.bytes_of[i]]
            while len(parts) > 2:
                ranked = [(self.rank.get(self.bytes_of[a] + self.bytes_of[b], self.size), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
                best, k = min(ranked)
                if best >= i:
                    break
                parts[k : k + 2] = [best]
            self.halves[i] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self.halves[i]

    def may_follow(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b from scratch ends with a, b. The seam is undone from the latest merge back:
        a merge across the seam that ranks before the ones that made its two sides would have come first."""
        pair = a * self.size + b
        known = self.fits.get(pair)
        if known is None:
            left, right, before, known = a, b, self.size, True
            while True:
                across = self.rank.get(self.bytes_of[left] + self.bytes_of[right])
                if across is not None and across < before:
                    known = False
                    break
                halves_l, halves_r = self.halves_of(left), self.halves_of(right)
                if halves_l is None and halves_r is None:
                    break
                if halves_r is None or (halves_l is not None and left > right):  # the side that was merged last
                    before, left = left, halves_l[1]
                else:
                    before, right = right + 1, halves_r[0]  # on equal rank the left one of two places merges first
            if len(self.fits) > FITS:
                self.fits.clear()
            self.fits[pair] = known
        return known

    def next_shorter(self, i: int) -> int:
        """The longest token that is a proper prefix of token i, or -1."""
        if i not in self.shorter:
            token = self.bytes_of[i]
            self.shorter[i] = next((self.rank[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in self.rank), -1)
        return self.shorter[i]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        if piece in self.rank:
            return [self.rank[piece]]
        n, length = len(piece), self.length
        longest = [-1] * n
        for end, i in self.trie.iter(piece.decode("latin-1")):
            at = end + 1 - length[i]
            if longest[at] < 0 or length[i] > length[longest[at]]:
                longest[at] = i
        out: list[int] = []
        dead = bytearray(n + 1)
        at, token = 0, longest[0]
        while at < n:
            while token >= 0 and (dead[at + length[token]] or (out and not self.may_follow(out[-1], token))):
                token = self.next_shorter(token)
            if token >= 0:
                out.append(token)
                at += length[token]
                token = longest[at] if at < n else -1
            else:
                if not out:
                    raise ValueError("the vocabulary lacks single bytes")
                dead[at] = 1
                token = out.pop()
                at -= length[token]
        return out


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, read once per worker."""
    if path not in LOADED:
        LOADED[path] = Vocabulary(path)
    return LOADED[path]


def _encoder(path: str, pattern: str) -> Pieces:
    if (path, pattern) not in LOADED:
        words = vocabulary(path)
        LOADED[path, pattern] = Pieces(lambda new: [np.array(words.encode_piece(p.encode("utf-8", "replace")), np.int32).tobytes() for p in new], pattern, PIECES)
    return LOADED[path, pattern]


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", *, vocabulary_path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """docs with the column `ids` (array<int>), each match of pattern encoded separately, without special tokens.

    Null and empty texts get an empty array; repeated rows are each encoded; other columns pass unchanged, but a column named
    as `ids` is replaced. Texts are processed whole, in steps of about 2 MB, so memory follows the longest single text.
    """
    rest = [c for c in docs.columns if c != ids]
    schema = T.StructType([*docs.select(*rest).schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType(), True))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(vocabulary_path, pattern)
        for batch in batches:
            for part in steps(batch, text):
                packed = coder.encode(texts_of(part, text))
                column = lists(np.frombuffer(b"".join(packed), np.int32), np.array([len(x) // 4 for x in packed]))
                yield pa.RecordBatch.from_arrays([*part.columns, column], [*rest, ids])

    return in_batches(docs.select(*rest), run, schema, loads=True)


def decode(docs: DataFrame, ids: str = "ids", out: str = "decoded", *, vocabulary_path: str) -> DataFrame:
    """docs with the column `out` (binary): the bytes of the ids in order. A null or empty array gives empty bytes; a null id or
    one that is not in the vocabulary adds nothing. A column named as `out` is replaced."""
    rest = [c for c in docs.columns if c != out]
    schema = T.StructType([*docs.select(*rest).schema.fields, T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(vocabulary_path)
        table = pa.array([*known.bytes_of, b""], pa.binary())
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                column = part.column(rest.index(ids))
                flat = pc.fill_null(column.flatten(), known.size).to_numpy(zero_copy_only=False)
                flat = np.where((flat < 0) | (flat > known.size), known.size, flat)
                counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
                values = table.take(pa.array(flat))
                ends = np.zeros(len(counts) + 1, np.int64)
                np.cumsum(counts, out=ends[1:])
                at = np.frombuffer(values.buffers()[1], np.int32)[values.offset :][ends] if len(flat) else np.zeros(len(ends), np.int32)
                made = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(np.ascontiguousarray(at).tobytes()), values.buffers()[2] if len(flat) else pa.py_buffer(b"")])
                yield pa.RecordBatch.from_arrays([*part.columns, made], [*rest, out])

    return in_batches(docs.select(*rest), run, schema, loads=True)


def op1_bpe(spark, sf_dir: str) -> DataFrame:
    """Every text of documents, encoded and decoded; digests of both."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    coded = decode(encode(docs, vocabulary_path=path).drop("text"), vocabulary_path=path)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
