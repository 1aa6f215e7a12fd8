"""Repeated byte strings by threshold-bounded interval expansion on Burrows-Wheeler transforms.

A byte is removed if a string of LENGTH bytes that covers it starts anywhere else too. Every such string holds an anchor, the run of GRAM
bytes with the smallest hash; equal strings have equal anchors, so they meet where texts are dealt by the anchors' hashes, and strings
whose anchor occurs in one text only, once, need no comparison. Neighbouring strings with one anchor form a region. Equal regions are
counted before any of their bytes move; the distinct regions of an anchor are then sorted together: their
transform is built and, from the empty string on, intervals of suffixes are extended backwards breadth-first. A boundary between
two suffixes is found at the level of their common prefix, so common prefixes come out by increasing value, and the expansion stops
at LENGTH: boundaries that were not found have longer ones. Between two found boundaries lie equal strings.

Anchors with very many distinct regions are not gathered in a task: their strings are counted one by one, by hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm.batches import joined, lists, map_batches
from postlake.llm.kernels import TABLE, minimum_places, run_hashes
from postlake.llm.store import keep

LENGTH, GRAM = 400, 160
#: Bytes of regions sorted together (the regions of one anchor stay together), and distinct regions of an anchor that may be gathered.
SORTED, CROWDED = 1_000_000, 4_000
_SPANS = "array<struct<start:int,end:int>>"
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _sorted_places(high: np.ndarray, low: np.ndarray, bits: int) -> np.ndarray:
    """Places in the order of (high, low), both below 2^bits. Where it fits, keys and places are packed into one integer and sorted
    as values, some ten times faster than an indirect sort."""
    width = max(len(high) - 1, 1).bit_length()
    if 2 * bits + width <= 64:
        key = (high.astype(np.uint64) << np.uint64(bits)) | low.astype(np.uint64)
        packed = np.sort((key << np.uint64(width)) | np.arange(len(high), dtype=np.uint64))
        return (packed & np.uint64((1 << width) - 1)).astype(np.int32)
    return np.lexsort((low, high))


def suffix_order(text: np.ndarray, length: int) -> np.ndarray:
    """Rotations of text (uint8) in the order of at least their first `length` bytes, by prefix doubling over those not yet told apart."""
    n, known = len(text), 5
    around = np.concatenate([text, np.resize(text, known)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for j in range(known):
        key = (key << np.uint64(8)) | around[j : j + n]
    if n < 1 << 24:
        packed = np.sort((key << np.uint64(24)) | np.arange(n, dtype=np.uint64))
        order, ranked = (packed & np.uint64((1 << 24) - 1)).astype(np.int32), packed >> np.uint64(24)
    else:
        order = np.argsort(key, kind="stable")
        ranked = key[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    rank = np.empty(n, order.dtype)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n, dtype=order.dtype), 0))
    del ranked, key, around
    open_ = np.flatnonzero(~(new & np.append(new[1:], True))).astype(order.dtype)
    bits = max(n - 1, 1).bit_length()
    while known < length and len(open_):
        rows = order[open_]
        ahead = rows + known
        ahead[ahead >= n] %= n
        own, then = rank[rows], rank[ahead]
        way = _sorted_places(own, then, bits)
        order[open_] = rows[way]
        own, then = own[way], then[way]
        new = np.concatenate([[True], (own[1:] != own[:-1]) | (then[1:] != then[:-1])])
        rank[order[open_]] = np.maximum.accumulate(np.where(new, open_, 0))
        open_ = open_[~(new & np.append(new[1:], True))]
        known *= 2
    return order


def equal_prefix_groups(text: np.ndarray, length: int, end: int = 0xFF) -> tuple[np.ndarray, np.ndarray]:
    """(suffix order, group number of each): suffixes of one group agree in their first `length` bytes. Exact for suffixes
    whose first `length` bytes hold no `end`, the largest byte, which closes every region."""
    n = len(text)
    order = suffix_order(text, length)
    bwt = text[order - 1]
    by_byte = np.argsort(bwt, kind="stable")
    back = np.empty(n, np.int64)
    back[by_byte] = np.arange(n)
    ranked = bwt[by_byte]
    same = ranked[1:] == ranked[:-1]
    later, earlier = np.full(n, n, np.int64), np.full(n, -1, np.int64)
    later[by_byte[:-1][same]] = by_byte[1:][same]
    earlier[by_byte[1:][same]] = by_byte[:-1][same]
    found = np.zeros(n + 1, bool)
    found[0] = found[n] = True
    low, high = np.array([0]), np.array([n])
    for _ in range(length):
        if not len(low):
            break
        size = high - low
        starts = np.cumsum(size) - size
        at = np.arange(int(size.sum())) + np.repeat(low - starts, size)
        inside = bwt[at] != end
        last = at[inside & (later[at] >= np.repeat(high, size))]
        first = at[inside & (earlier[at] < np.repeat(low, size))]
        low, high = np.sort(back[first]), np.sort(back[last]) + 1  # the intervals of all extensions are apart, so ends pair up in order
        fresh = ~found[high]
        low, high = low[fresh], high[fresh]
        found[high] = True
    return order, np.cumsum(found[:n]) - 1


def repeated_starts(regions: list[bytes], weights: list[int], length: int) -> list[np.ndarray]:
    """For each region which of its strings of `length` bytes occur at least twice; a region counts as often as its weight."""
    text = np.frombuffer(b"".join(x + b"\xff" for x in regions), np.uint8)
    order, group = equal_prefix_groups(text, length)
    sizes = np.array([len(x) + 1 for x in regions])
    begin = np.cumsum(sizes) - sizes
    weight = np.repeat(np.array(weights, np.int64), sizes)
    weight[np.arange(len(text)) > np.repeat(begin + sizes - 1 - length, sizes)] = 0  # no string starts there
    total = np.bincount(group, weights=np.minimum(weight, 2)[order])
    twice = np.zeros(len(text), bool)
    twice[order] = total[group] >= 2
    twice &= weight > 0
    return [twice[a : a + max(s - length, 0)] for a, s in zip(begin.tolist(), sizes.tolist(), strict=True)]


def _spans_of(mask: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]


def _bytes_of(part: pa.RecordBatch, column: str) -> list[bytes]:
    return [x or b"" for x in part.column(column).cast(pa.binary()).to_pylist()]


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, crowded: int = CROWDED, digest: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, removed (array of (start, end) byte intervals, maximal, end exclusive), and the remaining bytes
    joined: `kept` (binary), or with digest=True their SHA-256 `kept_sha256`.

    Null and empty texts have no bytes; texts shorter than `length` lose none. Rows that repeat a text, with the same doc_id or
    another or null, are copies of each other, so both lose what they share. Extra columns are ignored.
    """
    out = "kept_sha256" if digest else "kept"
    out_type = "string" if digest else "binary"
    sha = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    # inside, a document is known by a hash of its id and text, so rows that repeat an id stay apart
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(F.col(doc_id).cast("long"), sha).alias("doc_id"), F.col(text).alias("text"), sha.alias("sha"))

    def closed(kept: bytes):
        return hashlib.sha256(kept).hexdigest() if digest else kept

    def anchors(part: pa.RecordBatch) -> pa.RecordBatch:
        """Where each text's runs of strings with one anchor hash start, these hashes, and at how many places each run has it: equal anchors that follow each other, as in
        text of one byte, are one run."""
        data, at = joined(part, "text")
        n = part.num_rows
        starts, doc = np.zeros(0, np.int64), np.zeros(0, np.int64)
        values, places = np.zeros(0, np.int64), np.zeros(0, np.int32)
        if len(data) >= length:
            hashes = run_hashes(TABLE[data], gram)
            place = minimum_places(hashes, length - gram + 1)[: len(data) - length + 1]
            counts = np.maximum(np.diff(at) - length, 0)  # strings of each text; one byte between texts
            of = np.repeat(np.arange(n), counts)
            window = np.arange(counts.sum()) + np.repeat(at[:-1] - (np.cumsum(counts) - counts), counts)
            place = place[window]
            if len(window):
                value, first = hashes[place], of[1:] != of[:-1]
                new = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | first]))
                moved = np.concatenate([[1], ((place[1:] != place[:-1]) | first).astype(np.int32)])
                starts, doc, values, places = window[new], of[new], value[new].view(np.int64), np.add.reduceat(moved, new).astype(np.int32)
        sizes = np.bincount(doc, minlength=n)
        return pa.RecordBatch.from_arrays([part.column(0), part.column(2), lists((starts - at[doc]).astype(np.int32), sizes), lists(values, sizes), lists(places, sizes)], ["doc_id", "sha", "starts", "anchors", "places"])

    marked = keep(map_batches(rows.select("doc_id", "text", "sha"), anchors, "doc_id long, sha string, starts array<int>, anchors array<bigint>, places array<int>", "text").filter("size(starts) > 0"), "anchors")
    each = marked.select("doc_id", F.xxhash64("sha").alias("own"), F.posexplode(F.arrays_zip("anchors", "places")).alias("run", "x")).select("doc_id", "own", "run", F.col("x.anchors").alias("anchor"), F.col("x.places").alias("places"))
    each = each.groupBy("anchor", "doc_id", "own").agg(F.min("run").alias("run"), F.sum("places").alias("n"))
    once = each.groupBy("anchor").agg(F.min("own").alias("low"), F.max("own").alias("high"), F.max("n").alias("n"), F.min("doc_id").alias("doc_id"), F.min("run").alias("run"))
    once = once.filter("low = high and n = 1").groupBy("doc_id").agg(F.collect_list("run").alias("once"))
    copies = marked.groupBy("sha").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")).filter("copies > 1")
    told = marked.join(copies, "sha", "left").join(once, "doc_id", "left").select("doc_id", "starts", "anchors", "places", "once", F.coalesce("copies", F.lit(1)).alias("copies"), F.coalesce("rep", "doc_id").alias("rep"))
    told = told.groupBy("doc_id", "copies", "rep").agg(F.first("starts").alias("starts"), F.first("anchors").alias("anchors"), F.first("places").alias("places"), F.first("once").alias("once"))

    def judge(part: pa.RecordBatch) -> pa.RecordBatch:
        """Final rows of texts without strings to compare; the others keep their text and the runs to compare."""
        n = part.num_rows
        raw = _bytes_of(part, "text")
        copies, rep, ids = (part.column(c).to_pylist() for c in ("copies", "rep", "doc_id"))
        starts, values, places, done = (part.column(c).to_pylist() for c in ("starts", "anchors", "places", "once"))
        texts, spans, kinds, removed, kept, weights, many = [], [], [], [], [], [], []
        for i in range(n):
            size = len(raw[i])
            gone = (copies[i] or 1) > 1 and size >= length
            mine: list[dict] = []
            owned: list[int] = []
            again: list[bool] = []
            if starts[i] and (not gone or rep[i] == ids[i]):
                end = [*starts[i][1:], size - length + 1]
                seen = set(done[i] or ())
                left = [k for k in range(len(starts[i])) if k not in seen]
                mine = [{"start": starts[i][k], "end": end[k]} for k in left]
                owned = [values[i][k] for k in left]
                again = [places[i][k] > 1 for k in left]
            texts.append(raw[i] if mine else None)
            spans.append(mine)
            kinds.append(owned)
            many.append(again)
            weights.append(2 if gone else 1)
            final = gone or not mine
            removed.append(([{"start": 0, "end": size}] if gone else []) if final else None)
            kept.append(closed(b"" if gone else raw[i]) if final else None)
        return pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), pa.array(list(map(len, raw)), pa.int64()), pa.array(texts, pa.binary()), pa.array(spans, _SPAN), pa.array(kinds, pa.list_(pa.int64())), pa.array(many, pa.list_(pa.bool_())), pa.array(weights, pa.int32()), pa.array(removed, _SPAN), pa.array(kept, pa.string() if digest else pa.binary())],
            ["id", "doc_id", "n_bytes", "bytes", "runs", "anchors", "many", "weight", "removed", out],
        )

    judged = rows.join(told, "doc_id", "left").select("id", "doc_id", "text", "starts", "anchors", "places", "once", "copies", "rep")
    judged = keep(map_batches(judged, judge, f"id long, doc_id long, n_bytes long, bytes binary, runs {_SPANS}, anchors array<bigint>, many array<boolean>, weight int, removed {_SPANS}, {out} {out_type}", "text"), "judged")
    open_ = judged.filter("bytes is not null")

    def regions(part: pa.RecordBatch) -> Iterator[tuple[int, int, int, int, int, bytes, bytes, bool]]:
        """(row, anchor, weight, start, end, digest, bytes, whether it has its anchor at several places) of every region."""
        for i, (data, runs, values, many, weight) in enumerate(zip(*(part.column(c).to_pylist() for c in ("bytes", "runs", "anchors", "many", "weight")), strict=True)):
            for run, value, again in zip(runs, values, many, strict=True):
                region = data[run["start"] : run["end"] + length - 1]
                yield i, value, weight, run["start"], run["end"], hashlib.blake2b(region, digest_size=16).digest(), region, again

    def occurrences(part: pa.RecordBatch) -> pa.RecordBatch:
        all_ = [(*x[:6], None, x[7]) for x in regions(part)]
        ids = part.column("doc_id").to_pylist()
        return pa.RecordBatch.from_arrays([pa.array([x[1] for x in all_], pa.int64()), pa.array([x[5] for x in all_], pa.binary()), pa.array([ids[x[0]] for x in all_], pa.int64()), pa.array([x[3] for x in all_], pa.int32()), pa.array([x[4] - x[3] for x in all_], pa.int32()), pa.array([x[2] for x in all_], pa.int32()), pa.array([x[7] for x in all_], pa.bool_())], ["anchor", "region", "doc_id", "start", "strings", "weight", "many"])

    columns = ["doc_id", "bytes", "runs", "anchors", "many", "weight"]
    occurring = keep(map_batches(open_.select(*columns), occurrences, "anchor long, region binary, doc_id long, start int, strings int, weight int, many boolean", "bytes"), "occurrences")
    distinct = occurring.groupBy("anchor", "region").agg(F.min("doc_id").alias("doc_id"), F.sum("weight").alias("weight"), F.max("strings").alias("strings"), F.max("many").alias("many"))
    crowds = distinct.groupBy("anchor").agg(F.sum("weight").alias("total"), F.count("*").alias("n"), F.max("many").alias("inside")).filter("total > 1 or inside").drop("inside")
    distinct = keep(distinct.join(crowds, "anchor").select("anchor", "region", "doc_id", F.least("weight", F.lit(2)).cast("int").alias("weight"), "strings", (F.col("n") == 1).alias("alone"), (F.col("total") > 1).alias("twice"), (F.col("n") > crowded).alias("crowded")), "distinct")
    # an anchor whose region is the same wherever it occurs: all its strings repeat, and there is nothing to compare
    whole = distinct.filter("alone and twice").select("region", F.array(F.struct(F.lit(0).alias("start"), F.col("strings").alias("end"))).alias("found"))
    wanted = distinct.filter("not (alone and twice)").groupBy("doc_id").agg(F.collect_list(F.struct("region", "weight", "crowded")).alias("wanted"))
    wanted = keep(open_.select("doc_id", "bytes", "runs", "anchors", "many").join(wanted, "doc_id"), "wanted")

    def pick(part: pa.RecordBatch) -> Iterator[tuple[int, bytes, int, bool, bytes]]:
        """(anchor, digest, weight, crowded, bytes) of the regions that this text stands for."""
        filled = part.append_column("weight", pa.array(np.ones(part.num_rows, np.int32)))
        lists_ = [{x["region"]: x for x in own} for own in part.column("wanted").to_pylist()]
        for i, value, _, _, _, name, region, _ in regions(filled):
            if x := lists_[i].pop(name, None):
                yield value, name, x["weight"], x["crowded"], region

    def send(part: pa.RecordBatch) -> pa.RecordBatch:
        some = [x for x in pick(part) if not x[3]]
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in some], pa.int64()), pa.array([x[1] for x in some], pa.binary()), pa.array([x[2] for x in some], pa.int32()), pa.array([x[4] for x in some], pa.binary())], ["anchor", "region", "weight", "bytes"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by anchor; whole anchors are sorted together, some 1 MB at a time."""
        held: list[dict] = []
        size = 0

        def flush() -> pa.RecordBatch:
            masks = repeated_starts([x["bytes"] for x in held], [x["weight"] for x in held], length)
            found = [(x["region"], _spans_of(m)) for x, m in zip(held, masks, strict=True) if m.any()]
            return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], _SPAN)], ["region", "found"])

        for batch in batches:
            for x in batch.to_pylist():
                if size >= SORTED and x["anchor"] != held[-1]["anchor"]:
                    yield flush()
                    held, size = [], 0
                held.append(x)
                size += len(x["bytes"])
        if held:
            yield flush()

    sent = map_batches(wanted, send, "anchor long, region binary, weight int, bytes binary", "bytes")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = sent.repartition(parts, "anchor").sortWithinPartitions("anchor").mapInArrow(sort, f"region binary, found {_SPANS}").unionByName(whole)

    def single(part: pa.RecordBatch) -> pa.RecordBatch:
        """Every string of the crowded anchors' regions by its hash."""
        names, weights, places, hashes = [], [], [], []
        for _, name, weight, crowd, region in pick(part):
            if crowd:
                for at in range(len(region) - length + 1):
                    names.append(name)
                    weights.append(weight)
                    places.append(at)
                    hashes.append(hashlib.blake2b(region[at : at + length], digest_size=16).digest())
        return pa.RecordBatch.from_arrays([pa.array(hashes, pa.binary()), pa.array(names, pa.binary()), pa.array(places, pa.int32()), pa.array(weights, pa.int32())], ["string", "region", "at", "weight"])

    if not distinct.filter("crowded").isEmpty():
        strings = keep(map_batches(wanted, single, "string binary, region binary, at int, weight int", "bytes", 1 << 16), "strings")
        twice = strings.groupBy("string").agg(F.sum("weight").alias("total")).filter("total > 1")
        more = strings.join(twice, "string").groupBy("region").agg(F.sort_array(F.collect_set("at")).alias("at"))
        found = found.unionByName(more.select("region", F.transform("at", lambda a: F.struct(a.alias("start"), (a + 1).alias("end"))).alias("found")))

    hits = occurring.select("doc_id", "region", "start").join(found, "region").groupBy("doc_id").agg(F.collect_list(F.struct("start", "found")).alias("hits"))

    def finish(part: pa.RecordBatch) -> pa.RecordBatch:
        removed, kept = [], []
        for data, hits in zip(part.column("bytes").to_pylist(), part.column("hits").to_pylist(), strict=True):
            step = np.zeros(len(data) + 1, np.int32)
            for hit in hits or ():
                for span in hit["found"]:
                    step[hit["start"] + span["start"]] += 1
                    step[hit["start"] + span["end"] - 1 + length] -= 1
            mask = np.cumsum(step)[:-1] > 0
            removed.append(_spans_of(mask))
            kept.append(closed(np.frombuffer(data, np.uint8)[~mask].tobytes()))
        return pa.RecordBatch.from_arrays([part.column("id"), part.column("n_bytes"), pa.array(removed, _SPAN), pa.array(kept, pa.string() if digest else pa.binary())], ["doc_id", "n_bytes", "removed", out])

    rest = judged.filter("bytes is not null and removed is null").select("id", "doc_id", "n_bytes", "bytes").join(hits, "doc_id", "left")
    finished = map_batches(rest, finish, f"doc_id long, n_bytes long, removed {_SPANS}, {out} {out_type}", "bytes")
    return judged.filter("removed is not null").select(F.col("id").alias("doc_id"), "n_bytes", "removed", out).unionByName(finished)


def op10_bwt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents without the bytes of repeated strings."""
    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest=True)
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + (x["end"] - x["start"]))
    return found.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), "kept_sha256")
