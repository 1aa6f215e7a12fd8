"""Tables whose states are versions: a change writes new folders and becomes visible, for all tables at once, by one new manifest.

A manifest lists for each table the folders that hold it, by key bucket, what it was made from, and for each stream the last batch that went in. Readers take the
manifest with the highest number. A change that fails leaves its folders unlisted and every table as it was; one that is repeated after its manifest was written
finds its batch listed and does nothing. Two writers cannot both write the same number: the later one takes the next, unless both changed one table, which is an error.

Buckets are hashes of a table's keys, so a change of few keys reads and writes only their folders.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.operators import keyed

_BUCKET = "_bucket"


class Lake:
    """The tables under a folder that the driver and all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        folder = self._path(f"{self.root}/_versions")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, number: int | None = None) -> dict:
        """The state of all tables: the newest, or an older one by its number."""
        numbers = self._numbers()
        if number is None and not numbers:
            return {"number": 0, "tables": {}, "batches": {}}
        number = numbers[-1] if number is None else number
        stream = self._fs.open(self._path(f"{self.root}/_versions/{number:012d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _publish(self, state: dict) -> bool:
        """Writes the manifest beside its place and moves it there in one step; False if another one took the number."""
        target = self._path(f"{self.root}/_versions/{state['number']:012d}.json")
        made = self._path(f"{self.root}/_versions/.{uuid.uuid4().hex}")
        out = self._fs.create(made, False)
        out.write(bytearray(json.dumps(state, sort_keys=True).encode()))
        out.close()
        if self._fs.exists(target) or not self._fs.rename(made, target):
            self._fs.delete(made, False)
            return False
        return True

    def read(self, name: str, buckets: Sequence[int] | None = None, state: dict | None = None) -> DataFrame:
        """A table, or only some of its buckets, as one manifest has it; KeyError if there is none."""
        table = (state or self.manifest())["tables"][name]
        schema = T.StructType.fromJson(json.loads(table["schema"]))
        parts = [p for b, p in sorted(table["parts"].items(), key=lambda x: int(x[0])) if buckets is None or int(b) in set(buckets)]
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{p}" for p in parts])

    def buckets_of(self, name: str, touching: DataFrame, state: dict | None = None) -> list[int]:
        """The buckets of a table in which the keys of some rows lie; at most one row a bucket comes to the driver."""
        table = (state or self.manifest())["tables"][name]
        return sorted(r[0] for r in touching.select(_bucket(table["keys"], table["buckets"]).alias("b")).distinct().collect())

    def publish(self, state: dict | None = None) -> list[str]:
        """Registers all tables of one manifest as views, so that readers of several see one state."""
        state = state or self.manifest()
        for name in state["tables"]:
            self.read(name, state=state).createOrReplaceTempView(name)
        return sorted(state["tables"])

    @contextmanager
    def change(self) -> Iterator[Change]:
        """A change of one or more tables; nothing of it is seen before the block ends, nor if it fails. A table that another change published meanwhile is not overwritten."""
        before = self.manifest()
        now = Change(self, json.loads(json.dumps(before)))
        yield now
        while now.touched:
            newest = self.manifest()
            lost = [n for n in now.written if newest["tables"].get(n) != before["tables"].get(n)]
            if lost or any(newest["batches"].get(s) != before["batches"].get(s) for s in now.batches):
                raise RuntimeError(f"another change was published first: {lost or sorted(now.batches)}")
            tables = newest["tables"] | {n: now.state["tables"][n] for n in now.written}
            state = {"number": newest["number"] + 1, "tables": tables, "batches": newest["batches"] | now.batches}
            if self._publish(state):
                return

    def apply_batch(self, stream: str, batch: DataFrame, number: int, apply: Callable[[Change, DataFrame], None]) -> bool:
        """Applies a stream's batch once: its number is published with the tables that it changed. False if it was there."""
        with self.change() as now:
            if now.state["batches"].get(stream, -1) >= number:
                return False
            apply(now, batch)
            now.batches[stream] = number
        return True

    def fingerprint(self, name: str, state: dict) -> str:
        """What a stored table consists of."""
        return hashlib.sha256(json.dumps(state["tables"][name]["parts"], sort_keys=True).encode()).hexdigest()

    def files_of(self, path: str) -> str:
        """What the files under a path are: names, lengths and times of change."""
        files, found = self._fs_of(path).listFiles(self._path(path), True), []
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        return hashlib.sha256(json.dumps(sorted(found)).encode()).hexdigest()

    def _fs_of(self, path: str):
        return self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())


class Change:
    """Tables as they will be once the change is published."""

    def __init__(self, lake: Lake, state: dict):
        self.lake, self.state, self.written, self.batches = lake, state, set(), {}

    @property
    def touched(self) -> bool:
        return bool(self.written or self.batches)

    def read(self, name: str, buckets: Sequence[int] | None = None) -> DataFrame:
        return self.lake.read(name, buckets, self.state)

    def buckets_of(self, name: str, touching: DataFrame) -> list[int]:
        return self.lake.buckets_of(name, touching, self.state)

    def put(self, name: str, rows: DataFrame, order: Sequence[str] = (), keys: Sequence[str] = (), buckets: int = 1, made_from: str = "") -> None:
        """Stores a whole table. Rows are sorted inside their files by `order`; with keys it can be changed bucket by bucket later."""
        schema = rows.schema
        self.state["tables"][name] = {"schema": schema.json(), "keys": list(keys), "buckets": buckets, "parts": {}, "from": made_from}
        self._write(name, rows, list(range(buckets)), order)

    def rewrite(self, name: str, touching: DataFrame, step: Callable[[DataFrame], DataFrame], order: Sequence[str] = ()) -> list[int]:
        """step(rows of the buckets that hold a key of `touching`) in their place; the other buckets are neither read nor written. step may change or add rows of those keys."""
        hit = self.buckets_of(name, touching)
        if hit:
            self._write(name, step(self.read(name, hit)), hit, order)
        return hit

    def upsert(self, name: str, updates: DataFrame, changes: dict[str, Column] | None = None, order: Sequence[str] | None = None) -> list[int]:
        """keyed.upsert on the buckets that hold a key of updates; returns these."""
        keys = self.state["tables"][name]["keys"]
        return self.rewrite(name, updates, lambda rows: keyed.upsert(rows, updates, keys, changes, order))

    def _write(self, name: str, rows: DataFrame, hit: list[int], order: Sequence[str]) -> None:
        table, folder = self.state["tables"][name], f"{name}/{uuid.uuid4().hex}"
        if table["keys"]:
            rows = rows.withColumn(_BUCKET, _bucket(table["keys"], table["buckets"])).repartition(len(hit), _BUCKET).sortWithinPartitions(_BUCKET, *order)
        else:
            rows = (rows.sortWithinPartitions(*order) if order else rows).withColumn(_BUCKET, F.lit(0))
        rows.write.partitionBy(_BUCKET).parquet(f"{self.lake.root}/{folder}")
        for b in hit:
            made = f"{folder}/{_BUCKET}={b}"
            if self.lake._fs.exists(self.lake._path(f"{self.lake.root}/{made}")):
                table["parts"][str(b)] = made
            else:
                table["parts"].pop(str(b), None)
        self.written.add(name)


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


Step = tuple[str, Callable[[dict[str, DataFrame]], DataFrame], list[str], list[str]]


def refresh(lake: Lake, sources: dict[str, str], steps: list[Step], version: str = "") -> list[str]:
    """Makes stored read models anew, in the order given, and publishes them together; returns the names of those that were made.

    sources: name -> Parquet path. A step is (name, function of the tables that it reads, their names, sort columns); it runs only if one of these tables, the files
    of one of these sources, or `version` (of the steps' own code) differ from what its stored table was made from. If a step fails nothing is published.
    """
    made = []
    with lake.change() as now:
        known = {n: lake.files_of(p) for n, p in sources.items()}
        for name, step, reads, order in steps:
            inputs = {n: known[n] if n in known else lake.fingerprint(n, now.state) for n in reads}
            mark = hashlib.sha256(json.dumps([version, inputs, order], sort_keys=True).encode()).hexdigest()
            if now.state["tables"].get(name, {}).get("from") == mark:
                continue
            tables = {n: lake.spark.read.parquet(sources[n]) if n in sources else now.read(n) for n in reads}
            now.put(name, step(tables), order, made_from=mark)
            made.append(name)
    return made
