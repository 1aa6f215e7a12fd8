"""Quality rules with risk-controlled cutoffs.

Every text is measured by counts of whole numbers; a rule is one measure and a cutoff above which a text is rejected. Cutoffs come from
labelled rows. One half of them (the fitting half) orders candidate settings into a ladder for each stratum: step j cuts every rule
where at most a share TAILS[j] of the good fitting rows lies above, so a later step rejects whatever an earlier one does. The
other half (the holdout) tests the steps in that order: a step passes if an exact binomial test rejects "over ALPHA of good
texts are rejected", and the first step that fails ends the ladder, so no further correction is due within a stratum; across
strata the level DELTA is divided by their number. With probability 1 - DELTA all steps that passed, in all strata at once, reject
at most ALPHA of the good texts; of these the one that parts bad from good best is taken, the mildest on ties. A stratum with
too few labels has no cutoff and loses nothing.

All of it is column expressions, grouped counts and joins.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlake.llm.batches import free_name
from postlake.llm.store import keep

#: Bound on the share of good texts that the cutoffs reject in a stratum, and the chance that it fails anywhere.
ALPHA, DELTA = 0.05, 0.05
#: Ladder: good fitting rows above a cutoff, in ten-thousandths.
TAILS = (0, 5, 10, 20, 50, 100, 200)
#: Measures, each a whole number from 0 up, larger where a text is worse.
RULES = ("symbols", "marks", "capitals", "digits", "repeats", "dup_lines", "word_length")
#: Strata up to this number (some kilobytes each) are broadcast; beyond it the same join is shuffled.
BROADCAST_STRATA = 2_000
_SPACE = r"[\x20\x09-\x0D]+"
#: Characters written out in classes: the engine looks single characters up in a table, but asks ranges one after another.
_MARKS = r"!\"#$%&'()*+,\-./:;<=>?@\[\\\]\^_`{|}~"
_CAPITALS, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text. Windows are compared by 64-bit hashes, sorted with their
    places, so the work is that of a sort however often one repeats."""
    none = F.array().cast("array<bigint>")

    def windows(h: Column) -> Column:
        return F.when(F.size(h) >= 3, F.transform(F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)))).otherwise(none)

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(places, j + 1) - p, F.lit(3))).cast("long"))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def places(s: Column) -> Column:
        same = lambda e, j: F.coalesce(F.get(s, j + 1)["x"] == e["x"], F.lit(False)) | F.coalesce((j > 0) & (F.get(s, j - 1)["x"] == e["x"]), F.lit(False))
        return F.sort_array(F.filter(F.transform(s, lambda e, j: F.when(same(e, j), e["i"])), lambda p: p.isNotNull()))

    def count(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), _let(_let(ordered, places), covered)).otherwise(F.lit(0).cast("long"))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: _let(windows(h), count))


def measure(docs: DataFrame, text: str = "text", out: str = "measures") -> DataFrame:
    """docs with the column `out`, a struct of whole-number counts of each whole text.

    n_words, word_chars (code points in words), n_symbols (of ``#*$%&|<>``), n_marks (ASCII punctuation), n_capitals (A-Z), n_digits
    (0-9), n_lines (``\\n``-split lines with a word), n_dup_lines (those equal to an earlier one) and n_repeat_words (in 3-word windows
    that occur twice or more). Null and empty texts have zeros; a column named as `out` is replaced, all others pass unchanged.
    """
    held = F.coalesce(F.col(text), F.lit(""))
    left = lambda value, drop: F.length(F.regexp_replace(value, drop, "")).cast("long")
    picked = F.regexp_replace(held, f"[^{_MARKS}{_CAPITALS}{_DIGITS}]+", "")  # few characters, which the next counts read
    words = F.filter(F.split(held, _SPACE, -1), lambda w: w != "")
    lines = F.filter(F.split(held, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    by_word = _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeated(w).alias("repeated")))
    by_line = _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("again")))
    made = _let(
        F.struct(by_word.alias("w"), by_line.alias("l"), picked.alias("p")),
        lambda x: F.struct(
            x["w"]["n"].alias("n_words"), left(held, _SPACE).alias("word_chars"), left(x["p"], r"[^#*$%&|<>]+").alias("n_symbols"), left(x["p"], f"[{_CAPITALS}{_DIGITS}]+").alias("n_marks"),
            left(x["p"], f"[^{_CAPITALS}]+").alias("n_capitals"), left(x["p"], f"[^{_DIGITS}]+").alias("n_digits"), x["l"]["n"].alias("n_lines"), x["l"]["again"].alias("n_dup_lines"), x["w"]["repeated"].alias("n_repeat_words"),
        ),
    )
    return docs.withColumn(out, made)


def base_failed(m: Column) -> Column:
    """Under 50 words, or over half of them repeated."""
    return (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def values(m: Column) -> Column:
    """One whole number for each rule: thousandths of the word characters, words or lines; characters a hundred words. 0 for texts without words."""
    share = lambda n, of: F.when(m[of] > 0, F.floor(m[n] * 1000 / m[of])).otherwise(F.lit(0)).cast("long")
    length = F.when(m["n_words"] > 0, F.floor(m["word_chars"] * 100 / m["n_words"])).otherwise(F.lit(0)).cast("long")
    return F.array(
        share("n_symbols", "word_chars"), share("n_marks", "word_chars"), share("n_capitals", "word_chars"), share("n_digits", "word_chars"), share("n_repeat_words", "n_words"), share("n_dup_lines", "n_lines"),
        F.least(length, F.lit(2000)),
    )


def in_fitting_half(doc_id: str = "doc_id") -> Column:
    """Half of the ids, by the first digit of the MD5 of the id as text."""
    return F.substring(F.md5(F.col(doc_id).cast("string")), 1, 1) < "8"


def _at_most(k: Column, n: Column, p: float) -> Column:
    """Chance of at most k in n draws at p: the exact binomial sum, term by term in logarithms. 1 where k is over n * p (no test passes there)."""
    odds = math.log(p) - math.log1p(-p)

    def step(a: Column, i: Column) -> Column:
        term = a["term"] + F.log(((n - i) / (i + 1)).cast("double")) + F.lit(odds)
        top = F.greatest(a["total"], term)
        return F.struct(term.alias("term"), (top + F.log(F.exp(a["total"] - top) + F.exp(term - top))).alias("total"))

    first = n.cast("double") * math.log1p(-p)
    summed = F.aggregate(F.sequence(F.lit(0).cast("long"), k - 1), F.struct(first.alias("term"), first.alias("total")), step, lambda a: F.exp(a["total"]))
    return F.when(k > n * p, F.lit(1.0)).when(k == 0, F.exp(first)).otherwise(summed)


def _sized(table: DataFrame, limit: int = BROADCAST_STRATA) -> DataFrame:
    return F.broadcast(table) if table.limit(limit + 1).count() <= limit else table


def fit(measured: DataFrame, labels: DataFrame, *, measures: str = "measures", stratum: str = "lang", doc_id: str = "doc_id", quality: str = "quality", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row for each stratum with a cutoff: stratum, n_good, n_bad (holdout rows), step, cuts (array of one cutoff a rule).

    Labels: doc_id and 1 (good) or 0; several for one id count as the lowest, null ids and null labels not at all. Only texts that pass the base
    rules are used, since the cutoffs judge only those. A null stratum is that of the empty string. Tables without labels give no row.
    """
    marks = labels.select(F.col(doc_id).alias("id"), F.col(quality).cast("int").alias("good")).filter("id is not null and good in (0, 1)").groupBy("id").agg(F.min("good").alias("good"))
    m = F.col(measures)
    known = measured.filter(~base_failed(m)).select(F.col(doc_id).alias("id"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), values(m).alias("v"), in_fitting_half(doc_id).alias("fitting"))
    known = keep(known.join(marks, "id").drop("id"), "labelled")

    counts = known.filter("fitting and good = 1").select("stratum", F.posexplode("v").alias("rule", "value")).groupBy("stratum", "rule", "value").agg(F.count("*").alias("n"))
    by_rule = Window.partitionBy("stratum", "rule")
    above = F.coalesce(F.sum("n").over(by_rule.orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumns({"above": above, "total": F.sum("n").over(by_rule)})
    cuts = F.array(*[F.min(F.when(F.col("above") * 10_000 <= t * F.col("total"), F.col("value"))) for t in TAILS])
    ladder = counts.groupBy("stratum", "rule").agg(cuts.alias("cuts")).groupBy("stratum").agg(F.array_sort(F.collect_list(F.struct("rule", "cuts"))).alias("rules"))
    ladder = keep(ladder.select("stratum", F.transform("rules", lambda r: r["cuts"]).alias("ladder")), "ladder")

    def beyond(j: int) -> Column:
        tests = [F.col("v")[r] > F.col("ladder")[r][j] for r in range(len(RULES))]
        out = tests[0]
        for x in tests[1:]:
            out = out | x
        return out

    n = len(TAILS)
    first = F.coalesce(*[F.when(beyond(j), F.lit(j + 1)) for j in range(n)], F.lit(n + 1))
    tested = known.filter("not fitting").join(_sized(ladder), "stratum").groupBy("stratum", first.alias("first"), "good").agg(F.count("*").alias("n"))
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0)).cast("long")
    steps = range(1, n + 1)
    good, bad = F.col("good") == 1, F.col("good") == 0
    tested = tested.groupBy("stratum").agg(
        total(good).alias("n_good"), total(bad).alias("n_bad"), F.array(*[total(good & (F.col("first") <= j)) for j in steps]).alias("lost"), F.array(*[total(bad & (F.col("first") <= j)) for j in steps]).alias("caught"),
    )
    level = delta / max(ladder.count(), 1)
    passed = F.transform("lost", lambda k: _at_most(k, F.col("n_good"), alpha) <= level)
    tried = tested.withColumn("passed", (F.array_position(F.concat(passed, F.array(F.lit(False))), F.lit(False)) - 1).cast("int"))
    gains = F.concat(F.array(F.lit(0).cast("long")), F.transform(F.slice(F.arrays_zip("lost", "caught"), F.lit(1), F.col("passed")), lambda x: x["caught"] * F.col("n_good") - x["lost"] * F.col("n_bad")))
    chosen = tried.withColumn("gains", gains).withColumn("step", (F.array_position("gains", F.array_max("gains")) - 1).cast("int")).filter("step > 0")
    return chosen.join(ladder, "stratum").select("stratum", "n_good", "n_bad", "step", F.transform("ladder", lambda c: F.get(c, F.col("step") - 1)).alias("cuts"))


def judge(measured: DataFrame, cutoffs: DataFrame, *, measures: str = "measures", stratum: str = "lang", out: str = "kept") -> DataFrame:
    """measured with the boolean `out`: passes the base rules and exceeds no cutoff of its stratum (all pass where it has none).

    Rows are neither lost nor joined twice; a column named as `out` is replaced, all others pass unchanged."""
    rest = [c for c in measured.columns if c != out]
    key, cuts = free_name(measured, "stratum_key"), free_name(measured, "stratum_cuts")
    table = _sized(cutoffs.select(F.col("stratum").alias(key), F.col("cuts").alias(cuts)))
    rows = measured.withColumn(key, F.coalesce(F.col(stratum).cast("string"), F.lit(""))).join(table, key, "left")
    m = F.col(measures)
    over = F.coalesce(F.exists(F.arrays_zip(values(m).alias("v"), F.col(cuts).alias("c")), lambda x: x["v"] > x["c"]), F.lit(False))
    return rows.withColumn(out, ~base_failed(m) & ~over).select(*rest, out)


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every text of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    measured = keep(measure(docs).drop("text"), "measures")
    found = judge(measured, fit(measured, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    m = F.col("measures")
    return found.select("doc_id", *[m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], base_failed(m).alias("base_failed"), "kept")


ORACLE_SQL = r"""
with t as (select row_number() over () as row, doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as text from documents),
w as (select row, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from t),
g as (select row, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as s from w, unnest(generate_series(1, len(w) - 2)) as x(i)),
again as (select row, i, count(*) over (partition by row, s) as c from g),
rep as (select row, count(distinct i + k) as n_repeat_words from again, unnest([0, 1, 2]) as y(k) where c > 1 group by row),
ln as (select row, unnest(string_split(text, chr(10))) as line from t),
dup as (select row, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines from ln where regexp_matches(line, '[^\x20\x09-\x0D]') group by row),
m as (select t.row, doc_id, stratum, cast(len(w) as bigint) as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as n_symbols, length(regexp_replace(text, '[^!-/:-@\[-`{-~]+', '', 'g')) as n_marks,
    length(regexp_replace(text, '[^A-Z]+', '', 'g')) as n_capitals, length(regexp_replace(text, '[^0-9]+', '', 'g')) as n_digits,
    coalesce(n_lines, 0) as n_lines, coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words
  from t join w using (row) left join rep using (row) left join dup using (row)),
v as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    [coalesce(n_symbols * 1000 // nullif(word_chars, 0), 0), coalesce(n_marks * 1000 // nullif(word_chars, 0), 0), coalesce(n_capitals * 1000 // nullif(word_chars, 0), 0),
     coalesce(n_digits * 1000 // nullif(word_chars, 0), 0), coalesce(n_repeat_words * 1000 // nullif(n_words, 0), 0), coalesce(n_dup_lines * 1000 // nullif(n_lines, 0), 0),
     least(coalesce(word_chars * 100 // nullif(n_words, 0), 0), 2000)] as v from m),
lab as (select doc_id, min(quality) as good from labels where doc_id is not null and quality in (0, 1) group by doc_id),
known as (select v.*, good, substr(md5(cast(doc_id as varchar)), 1, 1) < '8' as fitting from v join lab using (doc_id) where not base_failed),
hist as (select stratum, r, v[r] as value, count(*) as n from known, unnest(generate_series(1, 7)) as z(r) where fitting and good = 1 group by all),
cum as (select *, coalesce(sum(n) over (partition by stratum, r order by value desc rows between unbounded preceding and 1 preceding), 0) as above, sum(n) over (partition by stratum, r) as total from hist),
ladder as (select stratum, r, j, min(value) as cut from cum, (values (1, 0), (2, 5), (3, 10), (4, 20), (5, 50), (6, 100), (7, 200)) as q(j, tail) where above * 10000 <= tail * total group by all),
hold as (select row, known.stratum, good, coalesce(min(case when v[r] > cut then j end), 8) as first from known join ladder on known.stratum = ladder.stratum where not fitting group by all),
res as (select stratum, j, count(*) filter (good = 1) as n_good, count(*) filter (good = 0) as n_bad, count(*) filter (good = 1 and first <= j) as lost, count(*) filter (good = 0 and first <= j) as caught
  from hold, generate_series(1, 7) as s(j) group by all),
p as (select res.*, (select sum(exp(lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1) + i * ln(0.05) + (n_good - i) * ln(0.95))) from generate_series(0, lost) as b(i) where i <= n_good) as tail,
  (select count(distinct stratum) from ladder) as strata from res),
ok as (select *, min(case when lost <= n_good * 0.05 and tail <= 0.05 / strata then 1 else 0 end) over (partition by stratum order by j) as passed from p),
best as (select stratum, j, caught * n_good - lost * n_bad as gain from ok where passed = 1),
pick as (select stratum, arg_min(j, (-gain, j)) as j from best where gain > 0 group by stratum),
cuts as (select ladder.stratum, list(cut order by r) as cuts from pick join ladder on pick.stratum = ladder.stratum and pick.j = ladder.j group by ladder.stratum)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not coalesce(v[1] > cuts[1] or v[2] > cuts[2] or v[3] > cuts[3] or v[4] > cuts[4] or v[5] > cuts[5] or v[6] > cuts[6] or v[7] > cuts[7], false) as kept
from v left join cuts using (stratum)
"""
