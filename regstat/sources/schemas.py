"""Source schemas, column guards and the one normalising projection.

Guards look only at ``df.schema`` (no Spark job), so a missing column stops
the run before any data is read.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from regstat.catalogue import ServiceSpec

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DateType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


CODES = _schema(
    ("stay_key", L),
    ("year", I),
    ("code_type", I),
    ("code_no", I),
    ("axis", I),
    ("condition", I),
    ("code", S),
)
STAYS = _schema(
    ("stay_key", L),
    ("year", I),
    ("person_id", S),
    ("sex", S),
    ("home_municipality", S),
    ("care_level", I),
    ("is_rehab", I),
    ("niva", S),
)
PERSONS = _schema(("person_id", L), ("birth_year", I), ("sex", S))
RESIDENCE = _schema(("person_id", L), ("from_date", D), ("to_date", D), ("municipality", S))
PLACES = _schema(*[(c, S) for c in (
    "kommunenr", "kommunenavn", "kommunenrdagens", "kommunenavndagens",
    "fylkenr", "fylkenavn", "fylkenrdagens", "fylkenavndagens",
)])

SCHEMAS: dict[str, T.StructType] = {
    "codes": CODES,
    "stays": STAYS,
    "persons": PERSONS,
    "residence": RESIDENCE,
    "places": PLACES,
}


class MissingColumnError(RuntimeError):
    """A required column is absent from a source or an extract."""

    def __init__(self, missing: list[tuple[str, str]], code: int = 50001):
        self.missing = missing
        self.code = code
        where = ", ".join(f"{t}.{c}" for t, c in missing)
        super().__init__(f"[{code}] required column(s) missing: {where}")


def read_columns(spec: ServiceSpec) -> dict[str, list[str]]:
    """The columns that a service's selector, filters and extract read, by
    source kind."""
    selector = ["code_type", "code_no"] if spec.selector.kind == "type" else ["axis", "condition"]
    somatic = ["is_rehab", "niva"] if spec.somatic_stay_filter else []
    return {
        "codes": ["stay_key", "year", "code", *selector],
        "stays": ["stay_key", "year", "person_id", "sex", "home_municipality", "care_level", *somatic],
    }


def _lower_names(df: DataFrame) -> set[str]:
    return {f.name.lower() for f in df.schema.fields}


def require_columns(
    tables: Mapping[str, DataFrame], columns: Iterable[str], code: int = 50001
) -> None:
    """Fail unless every table has every column (case-insensitive). Reads the
    schema only: no job runs."""
    cols = list(columns)
    missing = [
        (name, c) for name, df in tables.items() for c in cols if c.lower() not in _lower_names(df)
    ]
    if missing:
        raise MissingColumnError(missing, code)


def missing_columns(
    spark: SparkSession, tables: Mapping[str, DataFrame], required: Iterable[tuple[str, str]]
) -> DataFrame:
    """The same check as data: required (table, column) pairs anti-joined
    against the columns the tables expose. Both sides are schema metadata,
    bounded by the number of columns, never by rows."""
    present = spark.createDataFrame(
        [(t, f.name.lower()) for t, df in tables.items() for f in df.schema.fields],
        "table_name string, column_name string",
    )
    want = spark.createDataFrame(
        [(t, c.lower()) for t, c in required], "table_name string, column_name string"
    )
    return want.join(present, ["table_name", "column_name"], "left_anti")


def normalise(
    df: DataFrame,
    schema: T.StructType,
    id_columns: Iterable[str] = (),
    keep: Iterable[str] = (),
) -> DataFrame:
    """Rename columns to the schema's case, cast to the schema's types
    (integers by ``try_cast`` so bad text becomes NULL), right-trim the
    string columns listed in ``id_columns`` (ids and codes compared by
    equality), and keep only the schema's columns (plus ``keep``). One
    projection, built as SQL expressions in a single call; no job runs."""
    by_lower = {f.name.lower(): f.name for f in df.schema.fields}
    ids = {c.lower() for c in id_columns}
    out = [f"`{by_lower[k.lower()]}` AS `{k}`" for k in keep if k.lower() in by_lower]
    for field in schema.fields:
        src = by_lower.get(field.name.lower())
        t = field.dataType.simpleString()
        if src is None:
            expr = f"CAST(NULL AS {t})"
        elif field.name.lower() in ids and isinstance(field.dataType, T.StringType):
            expr = f"rtrim(CAST(`{src}` AS STRING))"
        elif isinstance(field.dataType, (T.IntegerType, T.LongType)):
            expr = f"try_cast(`{src}` AS {t})"
        else:
            expr = f"CAST(`{src}` AS {t})"
        out.append(f"{expr} AS `{field.name}`")
    return df.selectExpr(*out)


def normalise_names(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Only fix the case of the given column names (``personid`` -> ``PersonId``
    style drift); other columns are left as they are."""
    wanted = {n.lower(): n for n in names}
    for f in df.schema.fields:
        target = wanted.get(f.name.lower())
        if target and target != f.name:
            df = df.withColumnRenamed(f.name, target)
    return df
