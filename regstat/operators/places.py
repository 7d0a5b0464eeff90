"""Place dimension: one row per four-character municipality code.

The dimension is small (one row per municipality code ever issued), so the
joins that use it are broadcast by Spark's own size check; nothing here
collects it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regstat import catalogue as cat

KEY = cat.PLACE_COLUMNS[0]
OTHER = cat.PLACE_COLUMNS[1:]


def _override_sql(target: str, pick: int, overrides) -> str:
    """CASE text for a current-code or current-name column. A NULL key gives
    NULL, as a vectorised if-else with a missing condition does."""
    whens = " ".join(f"WHEN {KEY} = '{o[0]}' THEN '{o[pick]}'" for o in overrides)
    return f"CASE WHEN {KEY} IS NULL THEN NULL {whens} ELSE {target} END AS {target}"


def prepared(raw: DataFrame, overrides=cat.PLACE_OVERRIDES) -> DataFrame:
    """Distinct raw rows (A5), all columns as text, key padded without
    truncation (B20), then overrides (B22). May still hold several rows per
    key."""
    d = raw.select(*cat.PLACE_COLUMNS).distinct()
    d = d.selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c in cat.PLACE_COLUMNS])
    d = d.selectExpr(
        f"CASE WHEN length({KEY}) < {cat.MUNICIPALITY_WIDTH} "
        f"THEN lpad({KEY}, {cat.MUNICIPALITY_WIDTH}, '0') ELSE {KEY} END AS {KEY}",
        *OTHER,
    )
    return d.selectExpr(
        *[
            _override_sql(c, 1, overrides) if c == "kommunenrdagens"
            else _override_sql(c, 2, overrides) if c == "kommunenavndagens"
            else c
            for c in cat.PLACE_COLUMNS
        ]
    )


def duplicates(raw: DataFrame, overrides=cat.PLACE_OVERRIDES) -> DataFrame:
    """Keys that occur more than once after padding and overrides."""
    return (
        prepared(raw, overrides)
        .groupBy(KEY)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def places(raw: DataFrame, overrides=cat.PLACE_OVERRIDES) -> DataFrame:
    """P5: one row per key. Of duplicate rows the first by the remaining
    columns (NULLs last) is kept, so the choice is deterministic (H4)."""
    order = ", ".join(f"{c} ASC NULLS LAST" for c in OTHER)
    return (
        prepared(raw, overrides)
        .selectExpr("*", f"row_number() OVER (PARTITION BY {KEY} ORDER BY {order}) AS _row")
        .filter("_row = 1")
        .drop("_row")
    )
