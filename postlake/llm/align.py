"""Alignment of two tokenizers, and how often their tokens meet over a corpus.

Each text is encoded by a byte-level BPE (A) and by a SentencePiece model (B). Byte offsets where a token of both ends cut the tokens into groups, and every
stretch between neighbouring ends of either is one link: the one place where an A token and a B token overlap.

Links are counted by external spilling. The task that encodes texts keeps (pair, document) records until a bound, sorts them by pair with B first, deals
them by the radix of the B id and writes each part as a *run* of zstd frames, next to one row for each document. A *cell* is the runs of one radix and
one slice of the runs, so that a B id or pair that fills the corpus is still spread over slices of bounded size. A cell is merged twice:

1. a k-way merge over the frames of its runs, by a heap of the frames' last keys, counts each pair; sums over slices are grouped and, B by B, the highest is marked;
2. the same merge meets the totals in the same order and streams each record's share back to its document.

Memory of a merge is one frame a run and the cell's distinct pairs, whatever the number of records.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlake.llm.batches import LOADED, in_batches, release, steps, texts_of
from postlake.llm.pieces import Pieces
from postlake.llm.store import keep
from postlake.llm.tokenfile import Library

#: Links that a task holds before it spills, records of a frame, radix parts, and links of all cells of one slice.
SPILL, FRAME, RADIX, SLICE = 1 << 20, 1 << 14, 8, 1 << 24
#: Pieces of each side that a worker remembers.
MEMO = 150_000
#: Text bytes of a step, and bits of a record for the document's place in its run.
_STEP, _PLACE = 1 << 20, 24


class Bytes:
    """Bytes of each id of a vocabulary, and the ids as decimal text with what follows them."""

    def __init__(self, of: list[bytes], inner: str, last: str):
        self.length = np.array([len(x) for x in of], np.int64)
        self.bytes = pa.array(of, pa.binary())
        self.text = pa.array([f"{i}{end}".encode() for end in (inner, last) for i in range(len(of))], pa.binary())
        self.size = len(of)


def _joined(table: pa.Array, index: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The entries of a binary array at index, as one buffer, and their ends."""
    taken = table.take(pa.array(index))
    ends = np.frombuffer(taken.buffers()[1], np.int32)[taken.offset : taken.offset + len(taken) + 1]
    return memoryview(taken.buffers()[2] or b"").cast("B")[ends[0] : ends[-1]], (ends[1:] - ends[0]).astype(np.int64)


class ByteLevel:
    """Packed ids of " " + text by a tokenizers file; special tokens in a text are plain text, since no piece of the pattern holds one."""

    def __init__(self, path: str, pattern: str):
        library = Library(path)
        library.coder.encode_special_tokens = True
        self.pieces = Pieces(library, pattern, MEMO)
        back = {c: b for b, c in _byte_letters().items()}
        of = [b""] * library.coder.get_vocab_size()
        for token, i in library.coder.get_vocab().items():
            of[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        self.table = Bytes(of, ",", "|")

    def encode(self, spaced: list[str]) -> list[bytes]:
        return self.pieces.encode(spaced)


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies spell each byte: printable Latin-1 as itself, the rest from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


class SpacedWords(Pieces):
    """A SentencePiece model word by word: spaces and what follows them. No piece of the model has a space after another character (else texts
    are encoded whole), so no merge crosses these borders."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.whole = any(re.search("[^▁]▁", x) for x in names)
        self.one_space = np.array([self.model.piece_to_id("▁")], np.int32).tobytes()
        super().__init__(self._new, memo=MEMO)
        self.cut = re.compile(" +[^ ]*")
        of = [bytes([int(x[3:5], 16)]) if self.model.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]
        self.table = Bytes(of, ",", ";")

    def split(self, text: str) -> list[str]:
        return [text] if self.whole else self.cut.findall(text)

    def _new(self, words: list[str]) -> list[bytes]:
        """Ids of words that begin with a space, which the model adds itself."""
        made = [np.array(x, np.int32).tobytes() for x in self.model.encode([w[1:] for w in words], num_threads=1)]
        return [self.one_space if w == " " else x for w, x in zip(words, made, strict=True)]


def _coders(tokenizer: str, model: str, pattern: str) -> tuple[ByteLevel, SpacedWords]:
    if (tokenizer, model, pattern) not in LOADED:
        LOADED[tokenizer, model, pattern] = ByteLevel(tokenizer, pattern), SpacedWords(model)
    return LOADED[tokenizer, model, pattern]


# runs: frames of records in the order of their keys


def _planes(values: np.ndarray, kind: str) -> bytes:
    """Whole numbers byte by byte, the lowest of all first, so that equal high bytes lie together."""
    return np.ascontiguousarray(values.astype(kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T).tobytes()


def _from_planes(data: memoryview, kind: str, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data[: n * size], np.uint8).reshape(size, n).T).view(kind).reshape(-1)


def pack(keys: np.ndarray, places: np.ndarray, counts: np.ndarray, frame: int = FRAME) -> list[bytes]:
    """Frames of records that are sorted by key and place."""
    coder, out = zstandard.ZstdCompressor(level=1), []
    for at in range(0, len(keys), frame):
        k, p, c = keys[at : at + frame], places[at : at + frame], counts[at : at + frame]
        same = np.concatenate([[False], k[1:] == k[:-1]])
        first = np.flatnonzero(~same)
        step = p - np.where(same, np.concatenate([[0], p[:-1]]), 0)
        head = np.array([len(k), len(first)], "<i8").tobytes()
        body = _planes(np.diff(k[first], prepend=0), "<i8") + _planes(np.diff(first, append=len(k)), "<i4") + _planes(step, "<i4") + _planes(c, "<i4")
        out.append(coder.compress(head + body))
    return out


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, places, counts) of a frame."""
    raw = memoryview(zstandard.ZstdDecompressor().decompress(data))
    n, m = np.frombuffer(raw[:16], "<i8").tolist()
    at = 16
    keys = np.cumsum(_from_planes(raw[at:], "<i8", m))
    at += 8 * m
    sizes = _from_planes(raw[at:], "<i4", m).astype(np.int64)
    at += 4 * m
    step = _from_planes(raw[at:], "<i4", n).astype(np.int64)
    counts = _from_planes(raw[at + 4 * n :], "<i4", n).astype(np.int64)
    sums = np.cumsum(step)
    first = np.cumsum(sizes) - sizes
    return np.repeat(keys, sizes), sums - np.repeat(sums[first] - step[first], sizes), counts


def merge(runs: list[tuple[int, list[bytes]]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks (keys, rows, counts) of all runs (base row, frames), keys ascending in and between blocks.

    A heap holds the last key of each run's open frame: up to the smallest of them every run's records are at hand, so these go out and that run's next frame is opened.
    """
    frames = [iter(f) for _, f in runs]
    held: list[tuple | None] = [None] * len(runs)
    heap: list[tuple[int, int]] = []

    def load(i: int) -> None:
        data = next(frames[i], None)
        held[i] = None
        if data is not None:
            keys, places, counts = unpack(data)
            held[i] = keys, places + runs[i][0], counts
            heapq.heappush(heap, (int(keys[-1]), i))

    for i in range(len(runs)):
        load(i)
    while heap:
        last, _ = heap[0]
        parts = []
        for i, now in enumerate(held):
            if now is not None and now[0][0] <= last:
                n = int(np.searchsorted(now[0], last, "right"))
                parts.append([x[:n] for x in now])
                held[i] = tuple(x[n:] for x in now)
        ended = []
        while heap and heap[0][0] <= last:
            ended.append(heapq.heappop(heap)[1])
        for i in ended:
            load(i)
        keys, rows, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(keys, kind="stable")
        yield keys[order], rows[order], counts[order]


def _sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums of the values for each distinct key of sorted keys."""
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return (keys[at], *((np.add.reduceat(v, at) if len(at) else v[:0]) for v in values))


def _sorted_sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(keys, kind="stable")
    return _sums(keys[order], *(v[order] for v in values))


# texts


class _Aligned:
    """The tokens of some texts by both tokenizers, their groups and links. Texts whose tokens' bytes aren't the text's have none."""

    def __init__(self, texts: list[str], a: ByteLevel, b: SpacedWords):
        self.n = len(texts)
        spaced = [" " + t for t in texts]
        packed = [(x, y) if t else (b"", b"") for t, x, y in zip(texts, a.encode(spaced), b.encode(spaced), strict=True)]
        raw = [s.encode("utf-8", "replace") if t else b"" for t, s in zip(texts, spaced, strict=True)]
        bad = self._differs(raw, [x for x, _ in packed], a.table) | self._differs(raw, [y for _, y in packed], b.table)
        packed = [(b"", b"") if wrong else p for p, wrong in zip(packed, bad, strict=True)]
        self.a, self.b = (np.frombuffer(b"".join(p[k] for p in packed), np.int32).astype(np.int64) for k in (0, 1))
        self.n_a, self.n_b = (np.array([len(p[k]) // 4 for p in packed], np.int64) for k in (0, 1))
        self.end_a, self.end_b = np.cumsum(a.table.length[self.a]), np.cumsum(b.table.length[self.b])
        self.ends_a, self.ends_b = (np.zeros(int(self.end_a[-1] if len(self.end_a) else 0) + 1, bool) for _ in "ab")  # by byte
        self.ends_a[self.end_a], self.ends_b[self.end_b] = True, True
        cut = self.ends_a & self.ends_b
        cuts = np.cumsum(cut)
        self.group_a, self.group_b = cuts[self.end_a] - 1, cuts[self.end_b] - 1
        self.group_a += ~cut[self.end_a]  # a token that ends before its group does lies behind one cut fewer
        self.group_b += ~cut[self.end_b]
        self.n_cuts = int(cuts[-1])
        stop = np.cumsum(np.where(bad, 0, [len(x) for x in raw])).astype(np.int64)  # texts end at cuts
        self.n_groups = np.diff(cuts[stop], prepend=0)
        self.n_links = self.n_a + self.n_b - self.n_groups
        self.tables = a.table, b.table

    @staticmethod
    def _differs(raw: list[bytes], packed: list[bytes], table: Bytes) -> np.ndarray:
        ids = np.frombuffer(b"".join(packed), np.int32)
        made, ends = _joined(table.bytes, ids)
        at, out, start = 0, np.zeros(len(raw), bool), 0
        for i, (want, p) in enumerate(zip(raw, packed, strict=True)):
            at += len(p) // 4
            end = int(ends[at - 1]) if at else 0
            out[i] = made[start:end] != want
            start = end
        return out

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, A id, B id) of each link."""
        ends = np.flatnonzero(self.ends_a | self.ends_b)
        before = lambda there: (np.cumsum(there) - there)[ends]
        return np.repeat(np.arange(self.n), self.n_links), self.a[before(self.ends_a)], self.b[before(self.ends_b)]

    def groups(self) -> list[bytes]:
        """a1,a2|b1;a3|b2,b3 of each text."""
        table_a, table_b = self.tables
        both = pa.concat_arrays([table_a.text, table_b.text])
        index = np.zeros(len(self.a) + len(self.b), np.int64)
        last = lambda g: np.concatenate([g[1:] != g[:-1], [True]]) if len(g) else np.zeros(0, bool)
        upto = lambda g: np.cumsum(np.bincount(g, minlength=self.n_cuts))
        index[np.arange(len(self.a)) + (upto(self.group_b) - np.bincount(self.group_b, minlength=self.n_cuts))[self.group_a]] = self.a + table_a.size * last(self.group_a)
        index[np.arange(len(self.b)) + upto(self.group_a)[self.group_b]] = 2 * table_a.size + self.b + table_b.size * last(self.group_b)
        made, ends = _joined(both, index)
        ends = np.concatenate([[0], ends])[np.cumsum(np.concatenate([[0], self.n_a + self.n_b]))].tolist()
        return [bytes(made[x : max(y - 1, x)]) for x, y in zip(ends[:-1], ends[1:], strict=True)]


SCHEMA = "bucket int, row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, frames array<binary>"


def aligned(docs: DataFrame, *, tokenizer: str, model: str, doc_id: str = "doc_id", text: str = "text", pattern: str = public_tokenizers.PATTERN, digest: bool = False, spill: int = SPILL, radix: int = RADIX) -> DataFrame:
    """A written table of two kinds of rows: one for each document (bucket null) with its counts and its groups, ``a1,a2|b1;a3|b2,b3`` as text or, with
    digest, that text's SHA-256 ('' without tokens), and the runs of records (bucket, row: number of the run's first document, frames, n_links).

    Texts that are null, empty or not given back by either tokenizer's bytes have no tokens and no groups. Rows that repeat an id are documents of their own.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = [pa.int32(), *[pa.int64()] * 6, pa.string(), pa.list_(pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _coders(tokenizer, model, pattern)
        row = TaskContext.get().partitionId() << 33
        base, size, waiting = row, 0, []

        def spilled() -> Iterator[pa.RecordBatch]:
            records = np.sort(np.concatenate(waiting)) if waiting else np.zeros(0, np.int64)
            waiting.clear()
            records, counts = _sums(records, np.ones(len(records), np.int64))
            keys, places = records >> _PLACE, records & ((1 << _PLACE) - 1)
            part = (keys // a.table.size) % radix
            for k in range(radix):
                own = np.flatnonzero(part == k)
                if len(own):
                    frames = pack(keys[own], places[own], counts[own])
                    values = [k, base, None, None, None, None, int(counts[own].sum()), None, frames]
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names)

        for batch in batches:
            for part in steps(batch, "text", _STEP):
                texts = texts_of(part, "text")
                found = _Aligned(texts, a, b)
                told = found.groups()
                told = [hashlib.sha256(x).hexdigest() if x else "" for x in told] if digest else [x.decode() for x in told]
                n = len(texts)
                columns = [pa.nulls(n, kinds[0]), pa.array(np.arange(row, row + n)), part.column(0), *map(pa.array, (found.n_a, found.n_b, found.n_groups, found.n_links)), pa.array(told, pa.string()), pa.nulls(n, kinds[-1])]
                yield pa.RecordBatch.from_arrays(columns, names)
                doc, id_a, id_b = found.links()
                waiting.append(((id_b * a.table.size + id_a) << _PLACE) | (doc + (row - base)))
                size, row = size + len(doc), row + n
                if size >= spill or row - base >= 1 << (_PLACE - 1):
                    yield from spilled()
                    base, size = row, 0
        yield from spilled()

    return keep(in_batches(rows, run, SCHEMA, loads=True), "aligned")


def _cells(table: DataFrame, slice_links: int) -> DataFrame:
    """The runs with the cell that each belongs to."""
    runs = table.filter("bucket is not null")
    total = runs.agg(F.sum("n_links")).first()[0] or 0
    slices = max(1, math.ceil(total / slice_links))
    return runs.select((F.pmod(F.xxhash64("row"), F.lit(slices)) * 1000 + F.col("bucket")).alias("cell"), "row", "frames")


def _runs_of(table: pa.Table) -> list[tuple[int, list[bytes]]]:
    return list(zip(table.column("row").to_pylist(), table.column("frames").to_pylist(), strict=True))


def _counted(table: pa.Table) -> pa.Table:
    """First merge of a cell: how many links each pair has in it."""
    cell, keys, sums = table.column("cell")[0], [], []
    for k, _, c in merge(_runs_of(table)):
        k, c = _sums(k, c)
        if keys and keys[-1][-1] == k[0]:  # a pair that goes on from the block before
            sums[-1][-1] += c[0]
            k, c = k[1:], c[1:]
        if len(k):
            keys.append(k)
            sums.append(c)
    keys, sums = np.concatenate(keys), np.concatenate(sums)
    release()
    return pa.table({"cell": pa.repeat(cell, len(keys)), "pair": keys, "n": sums})


def _shares(runs: pa.Table, totals: pa.Table) -> pa.Table:
    """Second merge of a cell: what its records add to their documents."""
    pair, n, best = (totals.column(c).to_numpy() for c in ("pair", "n", "best"))
    order = np.argsort(pair)
    pair, n, best = pair[order], n[order], best[order].astype(np.int64)
    held, size = [], 0
    for k, rows, c in merge(_runs_of(runs)):
        at = np.searchsorted(pair, k)
        held.append((rows, c * best[at], c * n[at]))
        size += len(k)
        if size > 1 << 20:
            held = [_sorted_sums(*map(np.concatenate, zip(*held, strict=True)))]
            size = 0
    rows, n_best, total = _sorted_sums(*map(np.concatenate, zip(*held, strict=True)))
    release()
    return pa.table({"row": rows, "n_best": n_best, "count_sum": total})


def pair_counts(cells: DataFrame, size_a: int) -> tuple[DataFrame, DataFrame]:
    """(by cell, totals): links of each pair in each cell, and over all with whether that is the highest of its B id, ties included."""
    by_cell = keep(cells.groupBy("cell").applyInArrow(_counted, "cell long, pair long, n long"), "cell_counts")
    totals = by_cell.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.expr(f"pair div {size_a}"))
    return by_cell, totals.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b")))  # at most one row an A id in each


def align(docs: DataFrame, *, tokenizer: str, model: str, doc_id: str = "doc_id", text: str = "text", pattern: str = public_tokenizers.PATTERN, digest: bool = False, spill: int = SPILL, radix: int = RADIX, slice_links: int = SLICE) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, groups (see `aligned`), n_best (links whose pair is the most frequent of its B id, ties included), count_sum (of the
    pairs' corpus-wide counts over its links).

    Null and empty texts, and those that the bytes of either side don't give back, have zeros. Rows that repeat an id, or have a null one, each get their own row; extra
    columns are ignored; an empty table gives no row. Long texts are aligned whole.
    """
    from tokenizers import Tokenizer

    table = aligned(docs, tokenizer=tokenizer, model=model, doc_id=doc_id, text=text, pattern=pattern, digest=digest, spill=spill, radix=radix)
    cells = _cells(table, slice_links)
    by_cell, totals = pair_counts(cells, Tokenizer.from_file(tokenizer).get_vocab_size())
    known = by_cell.select("cell", "pair").join(totals.select("pair", "n", "best"), "pair").select("cell", "pair", "n", "best")
    shares = cells.groupBy("cell").cogroup(known.groupBy("cell")).applyInArrow(_shares, "row long, n_best long, count_sum long")
    shares = shares.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    rows = table.filter("bucket is null").select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")
    return rows.join(shares, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups")


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of documents by a byte-level BPE and a SentencePiece model."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = align(docs, tokenizer=public_tokenizers.path("byte_bpe_50k.json"), model=public_tokenizers.path("piece_bpe_32k.model"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")
