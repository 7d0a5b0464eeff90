"""Scalar column helpers with the register's exact NULL and string rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regstat import catalogue as cat


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def string_id(c) -> Column:
    """Person ids compare as text with trailing blanks ignored: cast to string
    and right-trim once, so later equality and length tests agree."""
    return F.rtrim(_c(c).cast("string"))


def valid_person_id(c, max_length: int = cat.MAX_ID_LENGTH) -> Column:
    """Id present and shorter than ``max_length`` characters (trailing blanks
    not counted). NULL ids fail."""
    return F.coalesce(F.length(F.rtrim(_c(c))) < F.lit(max_length), F.lit(False))


def care_level_ok(c, levels=cat.CARE_LEVELS) -> Column:
    """``care_level IN (1, 2)``; NULL gives NULL, so a filter drops it and a
    CASE sends it to the ELSE branch. A plain IN reaches parquet as a pushed
    filter."""
    return _c(c).isin(*levels)


def sex_label_sql(dim_sex: str, stay_sex: str) -> str:
    """SQL text: dimension sex first, stay sex second; '1' men, '2' women,
    anything else or NULL unknown."""
    whens = " ".join(f"WHEN '{code}' THEN '{label}'" for code, label in cat.SEX_CODES.items())
    return (
        f"CASE coalesce(CAST({dim_sex} AS STRING), CAST({stay_sex} AS STRING)) "
        f"{whens} ELSE '{cat.SEX_UNKNOWN}' END"
    )


def sex_label(dim_sex: str, stay_sex: str) -> Column:
    """Sex label from two column names (see ``sex_label_sql``)."""
    return F.expr(sex_label_sql(dim_sex, stay_sex))


def age_at_sql(year: str, birth_year: str) -> str:
    """SQL text: age as year minus birth year; NULL when the person is unknown."""
    return f"CAST({year} - {birth_year} AS INT)"


def age_at(year: str, birth_year: str) -> Column:
    return F.expr(age_at_sql(year, birth_year))


def stay_conditions_sql(max_length: int = cat.MAX_ID_LENGTH, levels=cat.CARE_LEVELS) -> list[str]:
    """SQL text of the id and care-level rules on a stays table. Plain
    comparisons, so the care-level test reaches parquet as a pushed filter."""
    return [
        f"length(rtrim(person_id)) < {max_length}",
        f"care_level IN ({', '.join(str(v) for v in levels)})",
    ]


def null_sentinels(c, sentinels=cat.MUNICIPALITY_SENTINELS) -> Column:
    out = _c(c).cast("string")
    for s in sentinels:
        out = F.nullif(out, F.lit(s))
    return out


def pad_code(c, width: int = cat.MUNICIPALITY_WIDTH) -> Column:
    """Left-pad with zeros to ``width`` without ever truncating a longer code
    (plain ``lpad`` would cut '12345' to '1234')."""
    s = _c(c).cast("string")
    return F.when(F.length(s) < F.lit(width), F.lpad(s, width, "0")).otherwise(s)


def four_digit(c, pattern: str = cat.MUNICIPALITY_PATTERN) -> Column:
    return _c(c).rlike(pattern)


def try_int(c) -> Column:
    """Integer cast that yields NULL on bad text instead of raising."""
    return _c(c).try_cast("int")
