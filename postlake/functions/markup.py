"""Elements of HTML and objects of embedded scripts as column expressions: texts are cut at tags or braces, and a fold over the cuts keeps the depth.

`cut` splits a page once into its tags and the texts between them; the other functions read that struct, so a page is cut once however many
fields are taken from it. An element ends at its own end tag: of the tags behind it those of its name are counted up and down. One
that is never closed ends with the page; void elements hold nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements without an end tag.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
#: A tag whose attributes are quoted properly, or else anything up to the next angle bracket.
TAG = r"""(?s)<(?:/?[A-Za-z][A-Za-z0-9:-]*(?:\s+[^\s"'<>/=]+(?:\s*=\s*(?:"[^"]*+"|'[^']*+'|[^\s"'<>]++))?)*+\s*/?>|/?[A-Za-z][^>]*>)"""
DEAD = r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>"
#: (tag name or pattern, attribute, value): the attribute holds the word (class), holds the text (a name that ends in *), starts with it (^) or equals it.
Selector = tuple[str, str | None, str | None]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def cut(html: Column) -> Column:
    """Struct of a page without comments, scripts and styles: marks (its tags), pieces (texts between them, one more), names, step (1 opens, -1 closes, 0 holds nothing)."""
    alive = F.regexp_replace(F.coalesce(html, F.lit("")), DEAD, " ")

    def of(text: Column) -> Column:
        return let(F.regexp_extract_all(text, F.lit(TAG), F.lit(0)), lambda marks: F.struct(
            F.split(text, TAG, -1).alias("pieces"), marks.alias("marks"), F.transform(marks, lambda m: F.lower(F.regexp_extract(m, "^</?([A-Za-z][A-Za-z0-9:-]*)", 1))).alias("names"),
            F.transform(marks, lambda m: F.when(m.startswith("</"), -1).when(m.endswith("/>") | F.lower(F.regexp_extract(m, "^<([A-Za-z][A-Za-z0-9:-]*)", 1)).isin(*VOID), 0).otherwise(1)).alias("step"),
        ))

    return let(alive, of)


def with_cut(rows: DataFrame, name: str, html: str = "html") -> DataFrame:
    """rows with the cut page as a column that a generator makes, so that no optimiser rule puts the cutting into the expressions that read it."""
    return made_once(rows, name, cut(F.col(html)))


def made_once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """rows with a column that is computed once a row however many expressions read it."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def opening(selector: Selector) -> str:
    """Pattern of an opening tag."""
    name, attribute, value = selector
    if attribute is None:
        return rf"(?is)^<(?:{name})(?=[\s/>])"
    plain = attribute.rstrip("*^")
    inner = rf"[^\"']*{value}[^\"']*" if attribute.endswith("*") else rf"{value}[^\"']*" if attribute.endswith("^") else rf"(?:[^\"']*\s)?{value}(?:\s[^\"']*)?" if plain == "class" else value
    return rf"(?is)^<(?:{name})(?=[\s/>])(?=[^>]*\s{plain}\s*=\s*[\"']{inner}[\"'])"


def _range(low: Column, high: Column) -> Column:
    """low .. high, both included; empty if high is smaller."""
    return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))


def end_of(page: Column, at: Column) -> Column:
    """The number of the tag that closes tag `at`, or of tags if none does."""
    n = F.size(page["marks"])

    def step(a: Column, k: Column) -> Column:
        depth = a["depth"] + F.when(F.get(page["names"], k) == F.get(page["names"], at), F.get(page["step"], k)).otherwise(0)
        return F.when(a["end"] < n, a).otherwise(F.struct(depth.alias("depth"), F.when(depth == 0, k).otherwise(n).alias("end")))

    found = F.aggregate(_range(at + 1, n - 1), F.struct(F.lit(1).alias("depth"), n.alias("end")), step)["end"]
    return F.when(F.get(page["step"], at) == 0, at).otherwise(found)


def inside(page: Column, at: Column) -> Column:
    """The markup that tag `at` holds."""
    def text(end: Column) -> Column:
        parts = F.transform(_range(at + 1, end - 1), lambda k: F.concat(F.get(page["pieces"], k), F.get(page["marks"], k)))
        return F.when(end == at, F.lit("")).otherwise(F.concat(F.array_join(parts, ""), F.get(page["pieces"], end)))

    return let(end_of(page, at), text)


def places(page: Column, path: list[Selector]) -> Column:
    """Numbers of the opening tags that fit the last selector and lie in an element that fits the one before it, and so on; in page order."""
    def within(around: Column, inner: Column) -> Column:
        return let(around, lambda spans: F.filter(inner, lambda k: F.exists(spans, lambda s: (s["a"] < k) & (k < s["b"]))))

    fits = lambda selector: F.filter(_range(F.lit(0), F.size(page["marks"]) - 1), lambda k: (F.get(page["step"], k) >= 0) & F.get(page["marks"], k).rlike(opening(selector)))
    found = fits(path[0])
    for selector in path[1:]:
        found = within(F.transform(found, lambda i: F.struct(i.alias("a"), end_of(page, i).alias("b"))), fits(selector))
    return found


def first(page: Column, path: list[Selector]) -> Column:
    """Markup inside the first element of a path, null without one."""
    return let(F.get(places(page, path), F.lit(0)), lambda at: F.when(at.isNotNull(), inside(page, at)))


def every(page: Column, path: list[Selector]) -> Column:
    """(tag, inside) of all elements of a path."""
    return F.transform(places(page, path), lambda at: F.struct(F.get(page["marks"], at).alias("tag"), inside(page, at).alias("inside")))


def around(page: Column, path: list[Selector], name: str, holds: Callable[[Column], Column]) -> Column:
    """Markup inside the innermost element `name` around the first element of the path whose markup passes `holds`; null without one."""

    def innermost(at: Column) -> Column:
        outer = F.transform(places(page, [(name, None, None)]), lambda i: F.when((i < at) & (at < end_of(page, i)), i))
        return let(F.array_max(F.filter(outer, lambda i: i.isNotNull())), lambda i: F.when(i.isNotNull(), inside(page, i)))

    hit = F.get(F.filter(places(page, path), lambda k: holds(inside(page, k))), F.lit(0))
    return let(hit, lambda at: F.when(at.isNotNull(), innermost(at)))


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag, null without it."""
    value = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'<>]+))"""
    return F.when(tag.rlike(value), F.concat(*[F.regexp_extract(tag, value, k) for k in (1, 2, 3)]))


def leading_object(text: Column) -> Column:
    """The JSON object that a text begins with, to its own closing brace: braces in strings don't count, nor do escaped quotes end one. Null if it is never closed."""
    cuts = r"(?s)\\.|[{}\"]"

    def scan(x: Column) -> Column:
        def step(a: Column, k: Column) -> Column:
            mark = F.get(x["marks"], k)
            quoted = F.when(mark == '"', ~a["quoted"]).otherwise(a["quoted"])
            depth = a["depth"] + F.when(a["quoted"], 0).when(mark == "{", 1).when(mark == "}", -1).otherwise(0)
            return F.when(a["end"] >= 0, a).otherwise(F.struct(quoted.alias("quoted"), depth.alias("depth"), F.when((depth == 0) & ~a["quoted"] & (mark == "}"), k).otherwise(-1).alias("end")))

        start = F.struct(F.lit(False).alias("quoted"), F.lit(0).alias("depth"), F.lit(-1).alias("end"))
        end = F.aggregate(_range(F.lit(0), F.size(x["marks"]) - 1), start, step)["end"]
        return let(end, lambda e: F.when(e >= 0, F.array_join(F.transform(_range(F.lit(0), e), lambda k: F.concat(F.get(x["pieces"], k), F.get(x["marks"], k))), "")))

    cut_up = F.struct(F.split(text, cuts, -1).alias("pieces"), F.regexp_extract_all(text, F.lit(cuts), F.lit(0)).alias("marks"))
    return F.when(F.ltrim(text).startswith("{"), let(cut_up, scan))
