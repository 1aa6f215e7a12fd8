"""Rules that tell working-student, internship and part-time postings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Terms as regular expressions, and values of structured fields.
TITLE_TERMS = {
    "working_student": (
        r"werkstudent(?:[:*/._-]?in|en|entätigkeit)?",
        r"studentenjobs?",
        r"student job",
        r"working[ -]?student",
        r"student assistant",
        r"student employee",
        r"student worker",
        r"student(?:ische|ischer|isches)?[ -]+(?:hilfskraft|aushilfe|mitarbeiter(?:[:*/._-]?in)?)",
    ),
    "internship": (
        r"praktikum",
        r"praktikant(?:[:*/._-]?in)?",
        r"pflichtpraktikum",
        r"freiwillig(?:es|en)?[ -]+praktikum",
        r"internship",
        r"intern",
        r"trainee intern",
        r"praxissemester",
    ),
    "part_time": (
        r"teilzeit(?:stelle|job)?",
        r"part[ -]?time",
    ),
}
STRUCTURED_ONLY = {"working_student": (r"industrial placement student",)}
CONTRADICTING = (
    r"full[ -]?time",
    r"vollzeit",
    r"permanent contract",
    r"feste anstellung",
    r"contract",
    r"self-employed",
    r"temporary contract",
    r"befristeter vertrag",
)
STUDENT_VALUES = ("student", "for students")
INTERN_VALUES = ("internship",)
PART_TIME_VALUES = ("part-time", "part time")

ROLES = tuple(TITLE_TERMS)


def any_word(terms: tuple[str, ...]) -> str:
    """A pattern for one of the terms between word edges, in a form that has no lookaround."""
    return r"(?:^|[^\p{L}\p{N}_])(?:" + "|".join(terms) + r")(?:$|[^\p{L}\p{N}_])"


def structured_pattern(role: str) -> str:
    return any_word(TITLE_TERMS[role] + STRUCTURED_ONLY.get(role, ()))


def evidence(platform: Column, employment: Column, structured: Column, title: Column, description: Column, part_time: Column) -> dict[str, dict[str, Column]]:
    """role -> source -> boolean; texts in lower case and not null."""
    return {
        "working_student": {
            "structured_terms": structured.rlike(structured_pattern("working_student")),
            "xing_employment_type": (platform == "xing") & employment.isin(*STUDENT_VALUES),
            "title_terms": title.rlike(any_word(TITLE_TERMS["working_student"])),
            "description_terms": description.rlike(any_word(TITLE_TERMS["working_student"])),
        },
        "internship": {
            "structured_terms": structured.rlike(structured_pattern("internship")),
            "linkedin_employment_type": (platform == "linkedin") & employment.isin(*INTERN_VALUES),
            "title_terms": title.rlike(any_word(TITLE_TERMS["internship"])),
            "description_terms": description.rlike(any_word(TITLE_TERMS["internship"])),
        },
        "part_time": {
            "part_time_flag": part_time.eqNullSafe(F.lit(True)),
            "structured_terms": structured.rlike(structured_pattern("part_time")),
            "linkedin_employment_type": (platform == "linkedin") & employment.isin(*PART_TIME_VALUES),
            "xing_employment_type": (platform == "xing") & employment.isin(*PART_TIME_VALUES),
            "title_terms": title.rlike(any_word(TITLE_TERMS["part_time"])),
            "description_terms": description.rlike(any_word(TITLE_TERMS["part_time"])),
        },
    }
