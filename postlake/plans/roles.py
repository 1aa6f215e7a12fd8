"""Role classification with sources, reasons and confidence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions import roles


def _any(flags: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, flags)


def structured(unified: DataFrame) -> DataFrame:
    """The structured fields that a platform has, blank as null, and its part-time flag."""
    platform = F.col("platform")
    shown = lambda name, ok: F.when(ok, F.nullif(F.trim(F.col(name)), F.lit("")))
    employment = shown("employment_type", platform.isin("linkedin", "xing"))
    flag = F.when(platform == "stepstone", F.col("part_time")).when(employment.isNotNull(), F.lower(F.trim("employment_type")).isin(*roles.PART_TIME_VALUES))
    return unified.withColumns({"employment_type": employment, "part_time_flag": flag, "contract_type": shown("contract_type", platform == "stepstone"), "work_type": shown("work_type", platform == "stepstone")})


def classify(unified: DataFrame) -> DataFrame:
    """is_working_student, is_internship, is_part_time, is_target_role, match_sources, match_reasons, confidence and its rank.

    A description counts for the first two roles only if no role has a structured or title signal; for part time it always does.
    """
    rows = structured(unified)
    texts = {"title_lc": F.lower(F.coalesce("job_title", F.lit(""))), "description_lc": F.lower(F.coalesce("job_description", F.lit(""))), "employment_lc": F.lower(F.coalesce("employment_type", F.lit(""))), "structured_lc": F.lower(F.concat_ws(" | ", "employment_type", "contract_type", "work_type"))}
    rows = rows.withColumns(texts)  # computed once; every pattern reads these
    seen = roles.evidence(F.col("platform"), F.col("employment_lc"), F.col("structured_lc"), F.col("title_lc"), F.col("description_lc"), F.col("part_time_flag"))
    names = {(role, source): f"_{role}_{source}" for role, sources in seen.items() for source in sources}
    rows = rows.withColumns({names[r, s]: c for r, own in seen.items() for s, c in own.items()} | {"_contra": F.col("structured_lc").rlike(roles.any_word(roles.CONTRADICTING))})
    strong = {r: _any([F.col(names[r, s]) for s in own if s != "description_terms"]) for r, own in seen.items()}
    any_strong = _any(list(strong.values()))
    text = {r: F.col(names[r, "description_terms"]) & (F.lit(True) if r == "part_time" else ~any_strong) for r in seen}
    is_role = {r: strong[r] | text[r] for r in seen}
    target = _any(list(is_role.values()))
    by_source = {
        "structured": _any([F.col(names[r, s]) for r, own in seen.items() for s in own if s not in ("title_terms", "description_terms")]),
        "title": _any([F.col(names[r, "title_terms"]) for r in seen]),
        "description": _any(list(text.values())),
    }
    reason = lambda r, s: text[r] if s == "description_terms" else F.col(names[r, s])
    medium = ((text["working_student"] | text["internship"]) & ~F.col("_contra")) | (text["part_time"] & ~strong["part_time"])
    rank = F.when(~target, None).when(any_strong, 3).when(medium, 2).otherwise(1)
    out = rows.withColumns(
        {f"is_{r}": c for r, c in is_role.items()}
        | {
            "is_target_role": target,
            "match_sources": F.array_compact(F.array(*[F.when(c, n) for n, c in by_source.items()])),
            "match_reasons": F.array_compact(F.array(*[F.when(reason(r, s), f"{r}.{s}") for r, own in seen.items() for s in own])),
            "target_role_confidence_rank": rank.cast("smallint"),
        }
    )
    rank = F.col("target_role_confidence_rank")
    name = F.when(rank == 3, "high").when(rank == 2, "medium").when(rank == 1, "low")
    return out.withColumn("target_role_confidence", name).drop(*names.values(), *texts, "_contra")


def target_jobs(unified: DataFrame) -> DataFrame:
    return classify(unified).filter("is_target_role")


def role_jobs(targets: DataFrame, role: str = "working_student", confidence: tuple[str, ...] = ("high", "medium")) -> DataFrame:
    """Active target jobs of a role at the given confidences."""
    return targets.filter(F.col(f"is_{role}") & F.col("is_active") & F.col("target_role_confidence").isin(*confidence))
