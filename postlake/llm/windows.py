"""Substring dedup: Rabin-Karp hashes of every fixed-length window of words, counted in Spark.

A window is removed if its words also start a window earlier (smaller document id, or earlier in the same document). In each window
the run of GRAM words with the smallest hash is its anchor; equal windows have equal anchors at the same place, so a
window whose anchor occurs once in the whole corpus repeats nowhere and needs no count. The hashes of all other windows are counted,
each with the first document that has it, and removed windows merge into maximal intervals. Windows count as equal if 96 bits of two
hashes of their words agree; the first document is told the 64 bits of one, which tell apart the windows of that one text.

No group is ever gathered: counts and minima are combined before each shuffle, and the only lists are those of one document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm.batches import joined, map_batches
from postlake.llm.kernels import SPACES, minimum_places, mixed, run_hashes, word_hashes
from postlake.llm.store import keep

#: Words of a window, and of its anchor.
WINDOW, GRAM = 20, 8
#: Digests of copied texts up to this number (some 10 MB) are broadcast to mark the copies; more are joined by a shuffle.
BROADCAST_KEYS = 200_000
_OTHER = np.uint64(0x94D049BB133111EB)
_NULL_ID = -(1 << 63)


class _Step:
    """The words of a record batch's texts and their windows."""

    def __init__(self, part: pa.RecordBatch, text: str, window: int, gram: int):
        self.data, self.at = joined(part, text)
        self.words, self.start, self.end = word_hashes(self.data, SPACES, lower=False)
        self.first = np.searchsorted(self.start, self.at)  # first word of each text
        self.n_words = np.diff(self.first)
        doc = np.repeat(np.arange(part.num_rows), self.n_words)
        n = max(len(self.words) - window + 1, 0)
        self.windows = np.flatnonzero(doc[:n] == doc[window - 1 :]) if n else np.zeros(0, np.int64)
        self.doc = doc[self.windows]
        grams = run_hashes(self.words, gram)
        self.grams = grams
        self.anchor = minimum_places(grams, window - gram + 1)[self.windows] if n else self.windows

    def hashes(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of every window, of 64 and 32 bits."""
        if not len(self.windows):
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        more = run_hashes(mixed(self.words ^ _OTHER), window)[self.windows] >> np.uint64(32)
        return run_hashes(self.words, window)[self.windows].view(np.int64), more.astype(np.uint32).view(np.int32)

    def kept(self, i: int, removed: np.ndarray) -> bytes:
        """The words of text i that are not removed, joined by one space."""
        raw = self.data[self.at[i] : self.at[i + 1]].tobytes().split()
        if not removed.any():
            return b" ".join(raw)
        return b" ".join([w for w, gone in zip(raw, removed.tolist(), strict=True) if not gone])


def _first_of(keys: np.ndarray) -> np.ndarray:
    """Places of the first row of each distinct row of keys (columns compared together), in order."""
    order = np.lexsort(keys.T[::-1])
    ranked = keys[order]
    new = np.concatenate([[True], (ranked[1:] != ranked[:-1]).any(1)]) if len(order) else np.zeros(0, bool)
    return np.sort(order[new])


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, digest: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, removed (array of (start, end) word intervals, end exclusive), and the kept words joined by one
    space: `kept`, or with digest=True only their SHA-256 `kept_sha256`.

    Null and empty texts have no words; a text shorter than a window loses none. Rows that repeat a doc_id and text are each returned
    with the same answer, as one document; different texts with one doc_id are documents of their own, in the order of their digests;
    a null doc_id comes before all others. Extra columns are ignored.
    """
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_NULL_ID)).alias("id"), F.col(text).alias("text"))
    digest_of = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    keys = keep(rows.select("id", digest_of.alias("key")).distinct(), "keys")
    # inside, a document is known by a number in the order of ids: the id itself where no id has two texts
    if keys.groupBy("id").count().filter("count > 1").isEmpty():
        rows, keys = rows.withColumn("doc_id", F.col("id")), keys.withColumn("doc_id", F.col("id"))
    else:
        keys = keep(keys.sort("id", "key").withColumn("doc_id", F.monotonically_increasing_id()), "numbers")
        rows = rows.withColumn("key", digest_of).join(keys, ["id", "key"])
    rows = rows.select("doc_id", "id", "text")

    def anchors(part: pa.RecordBatch) -> pa.RecordBatch:
        s = _Step(part, "text", window, gram)
        place = np.unique(s.anchor)
        doc = np.searchsorted(s.first, place, "right") - 1
        value = s.grams[place].view(np.int64)
        one = _first_of(np.stack([doc, value], 1)) if len(place) else place
        order = np.lexsort((value, doc))
        ids = part.column(0).to_numpy(zero_copy_only=False)
        counts = np.ones(len(one), np.int32)
        if len(one) < len(place):  # the same anchor twice in one text
            ranked = np.stack([doc, value], 1)[order]
            new = np.concatenate([[True], (ranked[1:] != ranked[:-1]).any(1)])
            twice = np.diff(np.append(np.flatnonzero(new), len(new))) > 1
            counts[np.searchsorted(np.sort(order[new]), order[new][twice])] = 2
        return pa.RecordBatch.from_arrays([pa.array(value[one]), pa.array(ids[doc[one]]), pa.array((place - s.first[doc])[one].astype(np.int32)), pa.array(counts)], ["anchor", "doc_id", "at", "n"])

    found = map_batches(rows.select("doc_id", "text"), anchors, "anchor long, doc_id long, at int, n int", "text")
    once = found.groupBy("anchor").agg(F.sum("n").alias("n"), F.min("doc_id").alias("doc_id"), F.min("at").alias("at")).filter("n = 1")
    once = keep(once.groupBy("doc_id").agg(F.collect_list("at").alias("once")), "once")
    # exact copies: all but the first are removed as a whole, and need no windows
    copies = keys.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high")
    copies = F.broadcast(copies) if copies.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS else copies
    copies = keys.join(copies, "key").filter("doc_id > low").select("doc_id", F.lit(True).alias("copy"))

    # every text is moved once, to its list: counting and finishing read the same exchange, and nothing of a text is written between them
    told = rows.join(once, "doc_id", "left").join(copies, "doc_id", "left").select("doc_id", "id", "text", "once", "copy")

    def opened(s: _Step, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Places among the windows of those to count, and which texts are removed as a whole."""
        lists_once = part.column("once")
        flat = lists_once.flatten().to_numpy(zero_copy_only=False)
        known = np.zeros(len(s.words) + 1, bool)
        known[np.repeat(s.first[:-1], lists_once.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)) + flat] = True
        gone = part.column("copy").fill_null(False).to_numpy(zero_copy_only=False) & (s.n_words >= window)
        return np.flatnonzero(~known[s.anchor] & ~gone[s.doc]) if len(s.doc) else s.windows, gone

    def hashes(part: pa.RecordBatch) -> pa.RecordBatch:
        """The hash of every counted window, once a document."""
        s = _Step(part, "text", window, gram)
        use, _ = opened(s, part)
        hashed, more, doc = *(h[use] for h in s.hashes(window)), s.doc[use]
        one = _first_of(np.stack([doc, hashed, more], 1)) if len(doc) else doc
        return pa.RecordBatch.from_arrays([pa.array(hashed[one]), pa.array(more[one]), pa.array(part.column(0).to_numpy(zero_copy_only=False)[doc[one]])], ["hash", "more", "doc_id"])

    firsts = map_batches(told, hashes, "hash long, more int, doc_id long", "text").groupBy("hash", "more").agg(F.min("doc_id").alias("doc_id"))
    firsts = firsts.groupBy("doc_id").agg(F.collect_list("hash").alias("firsts"))

    out = "kept_sha256" if digest else "kept"
    spans_type = "array<struct<start:int,end:int>>"

    def finish(part: pa.RecordBatch) -> pa.RecordBatch:
        """A counted window stays if this text is the first with its hash and it is the first such window of the text."""
        s = _Step(part, "text", window, gram)
        use, whole = opened(s, part)
        hashed, more, doc = *(h[use] for h in s.hashes(window)), s.doc[use]
        mine = np.stack([doc, hashed, more], 1) if len(doc) else np.zeros((0, 3), np.int64)
        first = np.zeros(len(doc), bool)
        first[_first_of(mine)] = True
        owned = part.column("firsts")
        of = np.repeat(np.arange(part.num_rows), owned.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        keys = np.stack([of, owned.flatten().to_numpy(zero_copy_only=False).astype(np.int64)], 1)
        gone = ~(first & _is_in(mine[:, :2], keys))
        removed = np.zeros(len(s.words) + 1, np.int64)
        np.add.at(removed, s.windows[use][gone], 1)
        np.add.at(removed, s.windows[use][gone] + window, -1)
        removed = (np.cumsum(removed)[:-1] > 0) | np.repeat(whole, s.n_words)
        spans, values = [], []
        for i in range(part.num_rows):
            mask = removed[s.first[i] : s.first[i + 1]]
            edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
            spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)])
            words = b"" if whole[i] else s.kept(i, mask)
            values.append(hashlib.sha256(words).hexdigest() if digest else words.decode("utf-8", "replace"))
        return pa.RecordBatch.from_arrays([part.column("id"), pa.array(s.n_words), pa.array(spans, _SPANS), pa.array(values, pa.string())], ["id", "n_words", "removed", out])

    every = map_batches(told.join(firsts, "doc_id", "left"), finish, f"id long, n_words long, removed {spans_type}, {out} string", "text")
    return every.select(F.when(F.col("id") > _NULL_ID, F.col("id")).alias("doc_id"), "n_words", "removed", out)


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _is_in(rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which rows (text, hashes) are among keys; all are ranked together."""
    both = np.concatenate([keys, rows])
    if not len(both):
        return np.zeros(0, bool)
    order = np.lexsort(both.T[::-1])
    ranked = both[order]
    group = np.cumsum(np.concatenate([[0], (ranked[1:] != ranked[:-1]).any(1)]))
    has = np.zeros(group[-1] + 1, bool)
    has[group[order < len(keys)]] = True
    out = np.zeros(len(both), bool)
    out[order] = has[group]
    return out[len(keys) :]


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents without the words of repeated windows."""
    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest=True)
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + (x["end"] - x["start"]))
    return found.select("doc_id", "n_words", n_removed.alias("n_removed"), "kept_sha256")


ORACLE_SQL = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (select doc_id, i, hash(w[i : i + 19]) as h, w[i : i + 19] as win from w, unnest(generate_series(1, len(w) - 19)) as t(i) where len(w) >= 20),
firsts as (select h, min(doc_id) as d from win group by h),
lead as (select win.h, win.doc_id as d, min(i) as i from win join firsts on win.h = firsts.h and win.doc_id = firsts.d group by win.h, win.doc_id),
gone as (select distinct win.doc_id, win.i + k as p from win join lead on win.h = lead.h, unnest(generate_series(0, 19)) as t(k) where (win.doc_id, win.i) > (lead.d, lead.i)),
words as (select doc_id, p, w[p] as word from w, unnest(generate_series(1, len(w))) as t(p)),
kept as (select words.doc_id, count(gone.p) as n_removed, coalesce(string_agg(word, ' ' order by words.p) filter (gone.p is null), '') as k from words left join gone on words.doc_id = gone.doc_id and words.p = gone.p group by words.doc_id)
select w.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed, sha256(coalesce(k, '')) as kept_sha256 from w left join kept using (doc_id)
"""
