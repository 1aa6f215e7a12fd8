"""Skill dictionary and its matches in texts."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.functions.intake import nfkc


def normalized(text: str) -> str:
    return re.sub(r"\s+", " ", unicodedata.normalize("NFKC", text).lower()).strip()


def flatten(groups: dict) -> list[tuple[str, int, str, int, str]]:
    """(group, place, canonical, place, alias) of a dictionary {group: [{canonical, aliases: list or {language: list}}]}; letters-only aliases of at
    most two characters are dropped, repeated ones too. Malformed entries raise ValueError."""
    rows = []
    for g, (group, entries) in enumerate(groups.items()):
        if not isinstance(entries, list):
            raise ValueError(f"group {group}: a list of skills is needed")
        for c, entry in enumerate(entries):
            if not isinstance(entry, dict) or not str(entry.get("canonical") or "").strip():
                raise ValueError(f"group {group}: an entry without a canonical name")
            given = entry.get("aliases") or []
            lists = list(given.values()) if isinstance(given, dict) else [given]
            if not all(isinstance(own, list) and all(isinstance(a, str) for a in own) for own in lists):
                raise ValueError(f"group {group}, {entry['canonical']}: aliases are a list of texts, or one for each language")
            given = [a for own in lists for a in own]
            names = dict.fromkeys(normalized(str(a)) for a in [entry["canonical"], *given])
            rows += [(group, g, entry["canonical"], c, a) for a in names if a and not (a.isalpha() and len(a) <= 2)]
    return rows


def load(spark: SparkSession, path: str) -> tuple[int, list[tuple[str, int, str, int, str]]]:
    """(version, rows as of `flatten`) of a dictionary file, YAML or JSON (which YAML includes), read by Spark so that it may lie in any store."""
    import yaml

    held = yaml.safe_load(spark.read.text(path, wholetext=True).first()[0])
    if not isinstance(held, dict) or not isinstance(held.get("groups"), dict) or not isinstance(held.get("version"), int):
        raise ValueError("a dictionary has a whole number `version` and `groups`")
    return held["version"], flatten(held["groups"])


def dictionary_table(spark: SparkSession, rows: list[tuple[str, int, str, int, str]]) -> DataFrame:
    """(group_name, group_pos, canonical, canonical_pos, alias) of a dictionary."""
    return spark.createDataFrame(rows, "group_name string, group_pos int, canonical string, canonical_pos int, alias string")


def text_for_matching(text: Column) -> Column:
    """NFKC, lower case, single spaces; Python only sees texts with a character outside ASCII."""
    return F.regexp_replace(F.lower(nfkc(text)), r"\s+", " ")


def _alias_hits(aliases: list[str]):
    """Function of folded texts: numbers of the aliases that occur between edges, ascending. One automaton a task reports all aliases in one pass over a text."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        trie = ahocorasick.Automaton()
        for i, alias in enumerate(aliases):
            trie.add_word(alias, (i, len(alias)))
        trie.make_automaton()
        letters = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")

        def found(text: str) -> list[int]:
            out, n = set(), len(text)
            for end, (i, size) in trie.iter(text):
                if i not in out and (end + 1 == n or text[end + 1] not in letters) and (end < size or text[end - size] not in letters):
                    out.add(i)
            return sorted(out)

        for texts in batches:
            yield texts.map(found)

    return hits


def grouped_skills(docs: DataFrame, rows: list[tuple[str, int, str, int, str]], text: str = "text", out: str = "skills") -> DataFrame:
    """docs with `out`: map of group -> canonical names found, in dictionary order; groups without a match are absent.

    An alias counts between edges: no ASCII letter or digit stands next to it. Each alias counts on its own, also inside a longer one. Texts go once, in Arrow batches,
    through an automaton of all aliases, so the work does not grow with the dictionary; what follows reads the few hits. Null and empty texts have none.
    """
    folded = "_folded"
    while folded in docs.columns:
        folded = "_" + folded
    ordered = sorted(rows, key=lambda r: (r[1], r[3]))
    if not ordered:
        return docs.withColumn(out, F.create_map().cast("map<string,array<string>>"))
    aliases = list(dict.fromkeys(r[4] for r in ordered))
    meant: dict[str, list[int]] = {}
    for i, row in enumerate(ordered):
        meant.setdefault(row[4], []).append(i)
    entries = F.from_json(F.lit(json.dumps([{"g": r[0], "c": r[2]} for r in ordered])), "array<struct<g:string,c:string>>")
    of_alias = F.from_json(F.lit(json.dumps([meant[a] for a in aliases])), "array<array<int>>")
    groups = F.array(*[F.lit(g) for g in dict.fromkeys(r[0] for r in ordered)])

    def grouped(numbers: Column) -> Column:
        places = F.array_sort(F.flatten(F.transform(numbers, lambda a: F.get(of_alias, a))))
        found = F.transform(places, lambda i: F.get(entries, i))
        own = lambda hit, g: F.array_distinct(F.transform(F.filter(hit, lambda x: x["g"] == g), lambda x: x["c"]))
        pairs = lambda hit: F.filter(F.transform(groups, lambda g: F.struct(g.alias("key"), own(hit, g).alias("value"))), lambda p: F.size(p["value"]) > 0)
        return F.map_from_entries(F.element_at(F.transform(F.array(found), pairs), 1))

    rows_ = docs.withColumn(folded, _alias_hits(aliases)(text_for_matching(F.coalesce(F.col(text), F.lit("")))))
    none = F.create_map().cast("map<string,array<string>>")
    return rows_.withColumn(out, F.when(F.size(folded) > 0, grouped(F.col(folded))).otherwise(none)).drop(folded)


def recompute_skills(details: DataFrame, pending: DataFrame, rows: list[tuple[str, int, str, int, str]], version: int, at: Column, key: list[str], text: str = "job_description") -> DataFrame:
    """details after a new run of the dictionary over the rows of pending (keys): skills as JSON, version and time; other rows are untouched."""
    new = grouped_skills(pending.select(*key, text), rows, text, "_new").select(*key, F.to_json("_new").alias("_new"), F.lit(True).alias("_due"))
    out = details.join(new, key, "left")
    due = lambda value, old: F.when(F.col("_due"), value).otherwise(F.col(old)).alias(old)
    changed = {"extracted_skills": F.col("_new"), "extracted_skills_version": F.lit(version).cast("int"), "extracted_skills_at": at}
    return out.select(*[due(changed[c], c) if c in changed else F.col(c) for c in details.columns])


def search_terms(keywords: DataFrame, places: DataFrame) -> DataFrame:
    """search_grid for a row a keyword (platform, pos, keyword) and a row a place (platform, location)."""
    from postlake.functions.urls import slug
    from postlake.plans.places import small

    tidy = keywords.select("platform", "pos", F.trim(F.regexp_replace("keyword", r"\s+", " ")).alias("keyword")).filter("keyword <> ''")
    kept = tidy.groupBy("platform", F.lower("keyword").alias("low")).agg(F.min_by("keyword", "pos").alias("keyword"))
    both = kept.join(small(places), "platform", "left")
    return both.select("platform", F.concat_ws("__", "platform", slug(F.col("keyword")), slug(F.coalesce("location", F.lit("")))).alias("name"), "keyword", "location")


def search_grid(spec: DataFrame) -> DataFrame:
    """One search a keyword and location: (platform, name, keyword, location). spec: platform, keywords, locations (arrays).

    Keywords are trimmed and single-spaced; of those that differ in case only, the first spelling stays; no location gives one search.
    """
    from postlake.functions.urls import slug

    tidy = F.filter(F.transform("keywords", lambda k: F.trim(F.regexp_replace(k, r"\s+", " "))), lambda k: k != "")
    rows = spec.select("platform", "locations", F.posexplode(tidy).alias("pos", "keyword"))
    kept = rows.groupBy("platform", F.lower("keyword").alias("low")).agg(F.min_by(F.struct("keyword", "locations", "pos"), "pos").alias("k")).select("platform", "k.*")
    return kept.select("platform", "keyword", "pos", F.explode_outer("locations").alias("location")).select("platform", F.concat_ws("__", "platform", slug(F.col("keyword")), slug(F.coalesce("location", F.lit("")))).alias("name"), "keyword", "location")
