"""Residence: the cohort's municipality on 1 January and 31 December of each
year, from a history of validity intervals.

Long form is the core. Each interval is joined to the cohort by person (semi
join, so the history is cut to the cohort before anything else), exploded
only over the years it touches, and reduced once per (person, year) with a
conditional MAX - a range join keyed by person, never a nested loop.

Order of steps per (person, year), as delivered:
  1. MAX over the raw codes valid on each date (overlaps: the larger text wins)
  2. sentinels '9999' and '' become NULL
  3. 1 January, else 31 December
  4. drop NULL, left-pad to four without truncating, keep four-digit codes
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regstat import catalogue as cat
from regstat.functions.scalar import four_digit, null_sentinels, pad_code, string_id


def cohort(extract: DataFrame) -> DataFrame:
    """Distinct person ids over the (unioned) extracts."""
    return extract.select("person_id").distinct()


def _covers_sql(day: str) -> str:
    """Interval [from_date, to_date] holds ``day``: both ends inclusive, NULL
    end is open, NULL start never matches."""
    return f"(from_date <= {day} AND (to_date IS NULL OR to_date >= {day}))"


def snapshots(
    cohort_ids: DataFrame,
    residence: DataFrame,
    start: int = cat.START_YEAR,
    end: int = cat.END_YEAR,
) -> DataFrame:
    """(person_id, year, jan1, dec31): raw MAX of the codes valid on each
    date, before sentinels and fallback. Person-years where no interval
    covers either date are absent."""
    r = residence.select(
        string_id("person_id").alias("person_id"), "from_date", "to_date", "municipality"
    ).join(cohort_ids, "person_id", "left_semi")
    # years an interval touches, clipped to the period; sequence() counts
    # down when start > stop, so only forward ranges are kept
    touched = r.selectExpr(
        "*",
        f"greatest(year(from_date), {start}) AS y0",
        f"least(coalesce(year(to_date), {end}), {end}) AS y1",
    ).filter("from_date IS NOT NULL AND y0 <= y1")
    jan1, dec31 = "make_date(year, 1, 1)", "make_date(year, 12, 31)"
    dated = touched.selectExpr("person_id", "explode(sequence(y0, y1)) AS year", "from_date", "to_date",
                               "CAST(municipality AS STRING) AS m").selectExpr(
        "person_id",
        "year",
        f"CASE WHEN {_covers_sql(jan1)} THEN m END AS m_jan1",
        f"CASE WHEN {_covers_sql(dec31)} THEN m END AS m_dec31",
    ).filter("m_jan1 IS NOT NULL OR m_dec31 IS NOT NULL")
    return dated.groupBy("person_id", "year").agg(
        F.expr("max(m_jan1) AS jan1"), F.expr("max(m_dec31) AS dec31")
    )


def resolve(snap: DataFrame) -> DataFrame:
    """Sentinels to NULL, fallback, pad, four-digit test."""
    m = F.coalesce(null_sentinels("jan1"), null_sentinels("dec31"))
    out = snap.select("person_id", "year", m.alias("municipality")).filter(
        F.col("municipality").isNotNull()
    )
    out = out.withColumn("municipality", pad_code("municipality"))
    return out.filter(four_digit("municipality"))


def residence_by_year(
    cohort_ids: DataFrame,
    residence: DataFrame,
    start: int = cat.START_YEAR,
    end: int = cat.END_YEAR,
) -> DataFrame:
    """(person_id, year, municipality), at most one row per person-year
    (the grouping key makes the delivered distinct a no-op)."""
    return resolve(snapshots(cohort_ids, residence, start, end))


def wide_names(start: int = cat.START_YEAR, end: int = cat.END_YEAR) -> list[str]:
    yrs = cat.years(start, end)
    return [f"jan1_{y}" for y in yrs] + [f"dec31_{y}" for y in yrs]


def residence_wide(
    cohort_ids: DataFrame,
    residence: DataFrame,
    start: int = cat.START_YEAR,
    end: int = cat.END_YEAR,
    ids: DataFrame | None = None,
) -> DataFrame:
    """One row per cohort person, raw MAX code on each of the 28
    dates. Persons with no residence keep an all-NULL row (left join).

    The history is cut to ``ids`` (the cohort's ids with repeats, if given): a semi
    join needs no distinct right side, and AQE can split a hot person only where
    no aggregate lies above the join's exchange. A written cohort needs none."""
    snap = snapshots(cohort_ids if ids is None else ids, residence, start, end)
    yrs = cat.years(start, end)
    aggs = [F.expr(f"max(CASE WHEN year = {y} THEN jan1 END)").alias(f"jan1_{y}") for y in yrs]
    aggs += [F.expr(f"max(CASE WHEN year = {y} THEN dec31 END)").alias(f"dec31_{y}") for y in yrs]
    wide = snap.groupBy("person_id").agg(*aggs)
    return cohort_ids.join(wide, "person_id", "left")


def wide_years(wide: DataFrame) -> list[int]:
    """The years present in a wide table, read off its dated column
    names (``jan1_YYYY`` / ``dec31_YYYY``)."""
    found = set()
    for c in wide.columns:
        prefix, _, year = c.partition("_")
        if prefix in ("jan1", "dec31") and year.isdigit():
            found.add(int(year))
    return sorted(found)


def wide_to_long(wide: DataFrame) -> DataFrame:
    """H6: unpivot the dated columns to (person_id, year, jan1, dec31) with
    ``stack``, then resolve as in the long form."""
    yrs = wide_years(wide)
    args = ", ".join(f"{y}, `jan1_{y}`, `dec31_{y}`" for y in yrs)
    long = wide.selectExpr("person_id", f"stack({len(yrs)}, {args}) AS (year, jan1, dec31)")
    return resolve(long.withColumn("year", F.col("year").cast("int")))
