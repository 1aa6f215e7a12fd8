"""Personal data in texts: patterns propose spans, checksums confirm them, context words adjust their score.

Everything is a column expression over one row, so no row moves: `split` gives the text between the matches and
`regexp_extract_all` the matches, and a running sum of their lengths gives the positions, in code points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.batches import free_name

#: kind -> (cheap test that a text can match, pattern). A run that fails at its first character fails at the others too, so
#: patterns start only there or right after the match before; possessive repeats take the same text without backtracking.
BASE = {
    "email": ("@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"),
    "card": (r"(?:[0-9][\x20-]?){13}[0-9]", r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": (r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
}
# Characters of an account number by country, as registered.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """Account numbers of their country's length, in one piece or in groups of four; what follows them is no part of them."""
    ways = []
    for size, countries in IBAN_LENGTHS.items():
        fours, rest = divmod(size - 4, 4)
        grouped = rf"(?:\x20[A-Z0-9]{{4}}){{{fours}}}" + (rf"\x20[A-Z0-9]{{{rest}}}" if rest else "")
        ways.append(rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:[A-Z0-9]{{{size - 4}}}|{grouped})")
    return rf"(?<![A-Za-z0-9])(?:{'|'.join(ways)})(?![A-Za-z0-9])"


ADDED = {
    "iban": (r"[A-Z]{2}[0-9]{2}", _iban()),
    "ssn": (r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "local_phone": (r"[0-9]{3}[\x20.-][0-9]{4}", r"(?<![0-9+)(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])"),
}
KINDS = [*BASE, *ADDED]
#: Score of a confirmed span alone, what a context word adds, and the words.
SCORES = {
    "email": (0.9, 0.1, "mail|contact|write"), "ip": (0.7, 0.2, "ip|host|address|server|login"), "card": (0.8, 0.2, "card|visa|credit|payment"), "phone": (0.8, 0.2, "phone|tel|call|mobile|fax"),
    "iban": (0.9, 0.1, "iban|account|bank|konto"), "ssn": (0.3, 0.5, "ssn|social security|taxpayer"), "local_phone": (0.3, 0.5, "phone|tel|call|mobile|fax|dial"),
}
#: Added kinds stay only from this score on; base kinds always stay.
LEAST, CONTEXT = 0.5, 40
_BLOCK = 256


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(steps: Column) -> Column:
    """Sums up to and including each entry of a non-empty array of longs; in blocks, so that very many matches stay cheap."""

    def within(part: Column, base: Column) -> Column:
        empty = F.array().cast("array<bigint>")
        grown = F.aggregate(part, F.struct(base.alias("n"), empty.alias("out")), lambda a, x: F.struct((a["n"] + x).alias("n"), F.concat(a["out"], F.array(a["n"] + x)).alias("out")))
        return grown["out"]

    def blocks(all_steps: Column) -> Column:
        part = lambda b: F.slice(all_steps, b * _BLOCK + 1, F.lit(_BLOCK))
        numbers = F.sequence(F.lit(0), F.floor((F.size(all_steps) - 1) / _BLOCK).cast("int"))
        sums = F.transform(numbers, lambda b: F.aggregate(part(b), F.lit(0).cast("long"), lambda a, x: a + x))
        return _let(within(sums, F.lit(0).cast("long")), lambda ends: F.flatten(F.transform(numbers, lambda b: within(part(b), F.when(b == 0, F.lit(0).cast("long")).otherwise(F.get(ends, b - 1))))))

    return _let(steps, blocks)


def _matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, hit) of all matches, leftmost and not overlapping."""
    pairs = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda gap, hit: F.struct(F.length(gap).cast("long").alias("gap"), hit.alias("hit")))

    def placed(found: Column) -> Column:
        ends = _running(F.transform(found, lambda x: x["gap"] + F.length(x["hit"])))
        return F.zip_with(ends, found, lambda end, x: F.struct((end - F.length(x["hit"])).alias("start"), end.alias("end"), x["hit"].alias("hit")))

    none = F.array().cast("array<struct<start:bigint,end:bigint,hit:string>>")
    return _let(F.filter(pairs, lambda x: x["hit"].isNotNull()), lambda found: F.when(F.size(found) > 0, placed(found)).otherwise(none))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn's check of up to 19 digits, filled to 19 so that the doubled places are fixed."""
    doubled = F.translate(digits, "0123456789", "0246813579")
    places = [F.substring(doubled if i % 2 == 0 else digits, i, 1).cast("int") for i in range(1, 20)]
    return sum(places[1:], places[0]) % 10 == 0


def _mod97(hit: Column) -> Column:
    """The remainder of an IBAN, its first four characters moved to the end and letters as 10 to 35."""
    plain = F.regexp_replace(hit, " ", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    codes = F.transform(F.filter(F.split(turned, ""), lambda c: c != ""), lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55))
    return F.aggregate(codes, F.lit(0), lambda a, v: F.when(v < 10, (a * 10 + v) % 97).otherwise((a * 100 + v) % 97))


def _confirmed(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), lambda part: F.coalesce(part.try_cast("bigint") <= 255, F.lit(False)))
    if kind == "card":
        return _let(_digits(hit), lambda d: F.length(d).between(14, 19) & _luhn(F.lpad(d, 19, "0")))
    if kind == "phone":
        return F.length(_digits(hit)).between(10, 15)
    if kind == "iban":
        return _mod97(hit) == 1
    if kind == "ssn":
        return ~hit.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


_SPANS = "array<struct<start:bigint,kind_no:int,end:bigint,kind:string,score:double>>"


def _spans(text: Column, kind: str) -> Column:
    gate, pattern = (BASE | ADDED)[kind]
    alone, more, words = SCORES[kind]

    def scored(x: Column) -> Column:
        before = F.lower(F.substring(text, F.greatest(x["start"] - CONTEXT, F.lit(0)).cast("int") + 1, F.least(x["start"], F.lit(CONTEXT)).cast("int")))
        score = F.lit(alone) + F.when(before.rlike(rf"(?<![a-z])(?:{words})"), F.lit(more)).otherwise(F.lit(0.0))
        return F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"), x["end"].alias("end"), F.lit(kind).alias("kind"), score.alias("score"))

    found = F.transform(F.filter(_matches(text, pattern), lambda x: _confirmed(kind, x["hit"])), scored)
    if kind in ADDED:
        found = F.filter(found, lambda x: x["score"] >= LEAST)
    can = text.contains(gate) if gate == "@" else text.rlike(gate)
    return F.when(can, found).otherwise(F.array()).cast(_SPANS)


def find_pii(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """docs with the column `out`: array of (start, kind_no, end, kind, score), ordered by start and then kind.

    Positions are code points, `end` exclusive. Null and empty texts give an empty array, repeated rows the same spans each;
    spans of different kinds may overlap. A column named as `out` is replaced, all others pass unchanged.
    """
    held = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn(out, F.array_sort(F.concat(*[_spans(held, kind) for kind in KINDS])))


def redact(docs: DataFrame, spans: str = "pii", text: str = "text") -> DataFrame:
    """docs with every span in `text` replaced by its kind in angle brackets; a span that overlaps the one before extends it. A
    null text stays null."""
    held = F.col(text)

    def step(a: Column, x: Column) -> Column:
        new = x["start"] >= a["at"]
        added = F.concat(F.substring(held, a["at"].cast("int") + 1, (x["start"] - a["at"]).cast("int")), F.lit("<"), x["kind"], F.lit(">"))
        return F.struct(F.greatest(a["at"], x["end"]).alias("at"), F.when(new, F.concat(a["parts"], F.array(added))).otherwise(a["parts"]).alias("parts"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))
    end = lambda a: F.concat(F.array_join(a["parts"], ""), F.substring(held, a["at"].cast("int") + 1, F.length(held)))
    return docs.withColumn(text, F.when(F.size(spans) > 0, F.aggregate(F.col(spans), start, step, end)).otherwise(held))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op7_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data of every text of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_pii(docs, out=free_name(docs, "pii")).drop("text")
    count = lambda kind: F.size(F.filter("pii", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("pii", lambda x: x["kind_no"] < len(BASE))
    return found.select("doc_id", *map(count, BASE), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("pii")).alias("spans"))
