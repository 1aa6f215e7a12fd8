"""Benchmark decontamination by winnowing.

Words are hashed, runs of `gram` words are hashed again, and of every `window` words the smallest such hash is kept, in the
benchmark as in the documents. A window that both share keeps the same hash at the same place in both, so joining the kept
hashes misses no shared window; each joined pair is extended word by word to both sides and counts where the
run of equal words is at least a window long. All of it is column expressions and joins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of a window, and of the runs whose hashes are compared.
WINDOW, GRAM = 10, 5
#: Kept benchmark hashes up to this number (some 60 MB) are broadcast; beyond it documents are first reduced by a shuffled join.
BROADCAST_ROWS = 200_000
_SENTINEL = -1
#: Characters outside ASCII that lower() would change; only texts with one take the slower exact way.
_UPPER = r"[^\x00-\x7F&&[\p{Lu}\p{Lt}\p{Nl}\p{So}]]"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _once(value: Column) -> Column:
    """The value as a generator's output: the filters that Spark derives for a later explode then read it, instead of being pushed below with the whole expression in
    the place of each of its uses, inside loops too."""
    return F.explode(F.array(value))


def words_of(text: Column) -> Column:
    """Words of a text after lower-casing A-Z: runs of digits, a-z and characters outside ASCII. Null has none."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    held = F.coalesce(text, F.lit(""))
    low = F.when(held.rlike(r"[^\x00-\x7F]") & held.rlike(_UPPER), F.translate(held, upper, upper.lower())).otherwise(F.lower(held))
    return F.filter(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1), lambda w: w != "")


def _grams(words: Column, n: int) -> Column:
    """Hash of every run of n entries of an array of word hashes; none if it is shorter."""
    none = F.array().cast("array<bigint>")
    made = F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))
    return F.when(F.size(words) >= n, made).otherwise(none)


def _runs(words: Column, n: int) -> Column:
    """(n, fp, at) of every run of n words."""
    return F.transform(_grams(words, n), lambda fp, at: F.struct(F.lit(n).alias("n"), fp.alias("fp"), at.alias("at")))


def _kept(grams: Column, window: int, gram: int) -> Column:
    """The smallest of every window - gram + 1 neighbouring hashes."""
    n = window - gram + 1
    none = F.array().cast("array<bigint>")
    made = F.transform(F.sequence(F.lit(0), F.size(grams) - n), lambda i: F.least(*[F.get(grams, i + k) for k in range(n)]))
    return F.when(F.size(grams) >= n, F.array_distinct(made)).otherwise(none)


def _kept_places(grams: Column, window: int, gram: int) -> Column:
    """(fp, at) of the hashes that are the smallest of some window - gram + 1 neighbours."""
    n = window - gram + 1
    none = F.array().cast("array<struct<fp:bigint,at:int>>")
    lows = F.transform(F.sequence(F.lit(0), F.size(grams) - n), lambda i: F.least(*[F.get(grams, i + k) for k in range(n)]))

    def made(low: Column) -> Column:
        # no window's smallest hash is above one of its own, so a hash is the smallest of some window if the largest of theirs equals it
        top = lambda at: F.greatest(*[F.get(low, at - k) for k in range(n)]) if n > 1 else F.get(low, at)
        marked = F.transform(grams, lambda g, at: F.when(top(at) == g, F.struct(g.alias("fp"), at.alias("at"))))
        return F.filter(marked, lambda x: x.isNotNull())

    return F.when(F.size(grams) >= n, _let(lows, made)).otherwise(none)


def _hashed(text: Column) -> Column:
    return F.transform(words_of(text), lambda w: F.xxhash64(w))


def _places(grams: Column, value: Column) -> Column:
    """Where a hash occurs in an array of hashes."""
    return F.filter(F.sequence(F.lit(0), F.size(grams) - 1), lambda i: F.get(grams, i) == value)


def find_overlaps(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, gram: int = GRAM, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Per document: doc_id, n_words, hits (array of (start, end) word intervals, end exclusive, sorted and apart), items (array
    of item ids as strings, sorted).

    Null and empty texts have no words and no hits; an item without words matches nothing; one with fewer words than a window
    is one window of its own length. Items with equal words are one class, compared once. Rows that repeat a doc_id are
    one document, hit wherever one of them is, and so are rows with a null one; extra columns are ignored.
    """
    # benchmark: one row per distinct word sequence
    known = items.select(F.col(item_id).cast("string").alias("item"), _hashed(F.col(item_text)).alias("h")).filter("size(h) > 0")
    known = known.groupBy("h").agg(F.array_sort(F.collect_set("item")).alias("items"))
    long = known.filter(F.size("h") >= window).withColumn("g", _grams(F.col("h"), gram))
    prints = (
        long.select("items", "h", "g", F.explode(_kept(F.col("g"), window, gram)).alias("fp"))
        .select("items", "h", "fp", F.explode(_places(F.col("g"), F.col("fp"))).alias("at"))
        .select("fp", "items", _around(F.col("h"), F.col("at"), window, gram).alias("known"))
    )
    prints = prints.groupBy("fp", "known").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")).select("fp", "items", "known")  # a phrase of many items is one row
    sentinel = docs.sparkSession.range(1).select(F.lit(_SENTINEL).cast("long").alias("fp"), F.lit(None).cast("array<string>").alias("items"), F.lit(None).cast("array<bigint>").alias("known"))
    table = prints.unionByName(sentinel)
    sizes = known.agg(F.collect_set(F.when(F.size("h") < window, F.size("h"))).alias("short")).first()
    n_prints = prints.count()

    # documents: hashes, kept hashes, and one that always joins, which brings the number of words
    hashed = _let(_hashed(F.col(text)), lambda h: F.struct(h.alias("h"), _grams(h, gram).alias("g")))
    base = docs.select(F.col(doc_id).alias("doc_id"), F.md5(F.to_json(F.struct(F.col(doc_id).alias("i"), F.col(text).alias("t")))).alias("key"), _once(hashed).alias("x"))
    base = base.select("doc_id", "key", F.col("x.h").alias("h"), F.col("x.g").alias("g"))
    # A place carries the words around it, not the text's, and arrays are made before they are exploded: rows stay small however often a hash repeats.
    entries = "array<struct<fp:bigint,at:int,mine:array<bigint>>>"
    around = lambda places: F.transform(places, lambda x: F.struct(x["fp"].alias("fp"), x["at"].alias("at"), _around(F.col("h"), x["at"], window, gram).alias("mine"))).cast(entries)
    n_words = F.size("h").cast("long").alias("n_words")
    known_fps = prints.select("fp").distinct()
    if n_prints <= broadcast_rows:
        first = F.array(F.struct(F.lit(_SENTINEL).cast("long").alias("fp"), F.lit(-1).alias("at"), F.lit(None).cast("array<bigint>").alias("mine"))).cast(entries)
        held = base.select("doc_id", n_words, _once(F.concat(first, around(_kept_places(F.col("g"), window, gram)))).alias("places"))
        near = held.select("doc_id", "n_words", F.explode("places").alias("x")).select("doc_id", "n_words", "x.*").join(F.broadcast(table.select("fp").distinct()), "fp", "left_semi")
        table, none = F.broadcast(table), None
    else:  # row keys, kept hashes and their places are shuffled; those that the benchmark has go back to the words once a row
        mine = base.select("key", _once(_kept_places(F.col("g"), window, gram)).alias("places")).select("key", F.explode("places").alias("x")).select("key", "x.fp", "x.at")
        met = mine.join(known_fps, "fp", "left_semi").groupBy("key").agg(F.collect_set(F.struct("fp", "at")).alias("met"))
        held = base.join(met, "key").select("doc_id", n_words, _once(around(F.col("met"))).alias("places"))
        near = held.select("doc_id", "n_words", F.explode("places").alias("x")).select("doc_id", "n_words", "x.*")
        table, none = prints, base.select("doc_id", n_words)
    # equal words around equal hashes are extended once, for all their places; all runs hold the place, so the widest is their union
    alike = near.groupBy("doc_id", "fp", "mine").agg(F.max("n_words").alias("n_words"), F.collect_list("at").alias("at"))
    run = F.when(F.col("mine").isNotNull(), _extended(F.col("mine"), F.col("known"), window, gram)).alias("run")
    ran = alike.join(table, "fp").select("doc_id", "fp", "mine", "n_words", "at", "items", run)
    ran = ran.filter(F.col("mine").isNull() | (F.col("run.left") + F.col("run.right") + gram >= window))
    ran = ran.groupBy("doc_id", "fp", "mine").agg(F.first("n_words").alias("n_words"), F.first("at").alias("at"), F.max("run.left").alias("left"), F.max("run.right").alias("right"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    some = F.transform("at", lambda at: F.struct((at - F.col("left")).alias("start"), (at + gram + F.col("right")).alias("end")))
    no_spans = F.array().cast("array<struct<start:int,end:int>>")
    found = ran.select("doc_id", "n_words", "items", F.when(F.col("left").isNotNull(), some).otherwise(no_spans).alias("spans"))
    if none is not None:
        found = found.unionByName(none.select("doc_id", "n_words", F.lit(None).cast("array<string>").alias("items"), no_spans.alias("spans")))
    if lengths := sorted(sizes["short"] if sizes else []):  # at most window - 1 lengths, all in one reading
        short = known.filter(F.size("h") < window)
        whole = F.coalesce(*[F.when(F.size("h") == n, _grams(F.col("h"), n)[0]) for n in lengths])
        short = short.select(F.size("h").alias("n"), whole.alias("fp"), "items")
        runs = [_runs(F.col("h"), n) for n in lengths]
        mine = base.select("doc_id", n_words, _once(F.concat(*runs)).alias("runs")).select("doc_id", "n_words", F.explode("runs").alias("x")).select("doc_id", "n_words", "x.n", "x.fp", "x.at")
        few = short.limit(broadcast_rows + 1).count() <= broadcast_rows
        other = mine.join(F.broadcast(short) if few else short, ["n", "fp"])
        found = found.unionByName(other.select("doc_id", "n_words", "items", F.array(F.struct(F.col("at").alias("start"), (F.col("at") + F.col("n")).alias("end"))).alias("spans")))
    merged = found.groupBy("doc_id").agg(F.max("n_words").alias("n_words"), F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    return merged.select("doc_id", "n_words", _apart(F.col("spans")).alias("hits"), "items")


def _around(words: Column, at: Column, window: int, gram: int) -> Column:
    """2 * (window - gram) + gram hashes with the run at its middle; null beyond either end."""
    reach = window - gram
    return F.transform(F.sequence(F.lit(-reach), F.lit(gram + reach - 1)), lambda k: F.when(at + k >= 0, F.get(words, at + k)))


def _extended(mine: Column, known: Column, window: int, gram: int) -> Column:
    """Equal words next to a common run, to the left and to the right; both null-padded, a null equals nothing."""
    reach = window - gram
    same = lambda i: F.coalesce(F.get(mine, F.lit(i)) == F.get(known, F.lit(i)), F.lit(False))
    middle = F.lit(True)
    for i in range(reach, reach + gram):
        middle = middle & same(i)

    def count(order: range) -> Column:
        total, going = F.lit(0), F.lit(True)
        for i in order:
            going = going & same(i)
            total = total + going.cast("int")
        return total

    left, right = count(range(reach - 1, -1, -1)), count(range(reach + gram, 2 * reach + gram))
    return F.when(middle, F.struct(left.alias("left"), right.alias("right")))


def _apart(spans: Column) -> Column:
    """Sorted intervals with those that overlap or touch joined."""
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(a: Column, x: Column) -> Column:
        last = F.get(a, F.size(a) - 1)
        grown = F.concat(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))))
        return F.when((F.size(a) > 0) & (x["start"] <= last["end"]), grown).otherwise(F.concat(a, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end")))))

    return F.aggregate(spans, empty, step)


def op9_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents that lie in windows of benchmark."""
    found = find_overlaps(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + (x["end"] - x["start"]))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


ORACLE_SQL = r"""
with dw as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
bw as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
bwin as (select distinct item_id, least(10, len(w)) as n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') as win
  from bw, unnest(generate_series(1, greatest(len(w) - 9, 1))) as t(i) where len(w) > 0),
sizes as (select distinct n from bwin),
dwin as (select doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') as win from dw, sizes, unnest(generate_series(1, len(w) - n + 1)) as t(i) where len(w) >= n),
hit as (select d.doc_id, d.i, d.n, b.item_id from dwin d join bwin b on d.n = b.n and d.win = b.win),
words as (select doc_id, count(distinct i + k) as n_hit from hit, unnest(generate_series(0, n - 1)) as t(k) group by doc_id),
its as (select doc_id, count(*) as n_items, string_agg(s, ',' order by s) as ids from (select distinct doc_id, cast(item_id as varchar) as s from hit) group by doc_id)
select dw.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw left join words using (doc_id) left join its using (doc_id)
"""
