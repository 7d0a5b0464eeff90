"""Column-level building blocks (all built-in Spark expressions, no UDFs)."""

from regstat.functions.codes import cohort_predicate, group_flag, group_flags, main_diagnosis
from regstat.functions.scalar import (
    age_at,
    care_level_ok,
    four_digit,
    null_sentinels,
    pad_code,
    sex_label,
    string_id,
    try_int,
    valid_person_id,
)

__all__ = [
    "age_at",
    "care_level_ok",
    "cohort_predicate",
    "four_digit",
    "group_flag",
    "group_flags",
    "main_diagnosis",
    "null_sentinels",
    "pad_code",
    "sex_label",
    "string_id",
    "try_int",
    "valid_person_id",
]
