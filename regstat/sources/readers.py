"""Readers for the register sources.

A run needs, per service, a codes table and a stays table, plus one person
dimension, one residence history and one place dimension. They can come from
parquet directories, catalog tables (``catalog.schema.table``) or JDBC; each
is normalised to the schema in ``regstat.sources.schemas`` by one projection,
so column and filter pushdown still reach the scan.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from regstat import catalogue as cat
from regstat.session import ensure_checkpoint_dir
from regstat.sources import fixtures
from regstat.sources.schemas import (
    CODES,
    PERSONS,
    PLACES,
    RESIDENCE,
    SCHEMAS,
    STAYS,
    normalise,
    read_columns,
    require_columns,
)


# String columns compared by equality in the statistics: right-trimmed once at
# load, since the source database ignores trailing blanks in such comparisons.
STAY_TRIM = ["person_id", "sex", "niva"]
PERSON_TRIM = ["sex"]


@dataclass
class Sources:
    codes: dict[str, DataFrame]  # service name -> codes table
    stays: dict[str, DataFrame]  # service name -> stays table
    persons: DataFrame
    residence: DataFrame
    places: DataFrame  # raw place rows (8 columns)
    services: tuple[cat.ServiceSpec, ...] = field(default=cat.SERVICES)
    #: The rows of ``codes`` as one table with a ``service`` column, where it comes as
    #: one: a scan (or join) of it then serves all services, not one for each.
    codes_together: DataFrame | None = None

    def check(self) -> None:
        """Fail before any job if a stays table lacks ``care_level``."""
        require_columns({f"{s}.stays": df for s, df in self.stays.items()}, ["care_level"], 50001)


def read_table(spark: SparkSession, ref: str, fmt: str | None = None, **options) -> DataFrame:
    """Read one table by catalog name (``cat.db.table`` / ``db.table``), by
    path (``fmt`` defaults to parquet) or over JDBC (``fmt='jdbc'`` plus the
    usual ``url``/``dbtable``/``partitionColumn``... options)."""
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(**options).load()
    if fmt is None and "/" not in ref and ":" not in ref:
        return spark.table(ref)
    return spark.read.format(fmt or "parquet").options(**options).load(ref)


def _by_service(df: DataFrame, schema, ids=()) -> dict[str, DataFrame]:
    """Normalise once, then one filter per service."""
    n = normalise(df, schema, ids, keep=["service"])
    return {s.name: n.filter(F.col("service") == s.name).drop("service") for s in cat.SERVICES}


def read_sources(spark: SparkSession, root: str, services=cat.SERVICES) -> Sources:
    """Read the staged layout written by ``regstat.sources.sinks.write_sources``:
    ``codes`` and ``stays`` in folders by ``service`` (and ``year``), plus
    ``persons``, ``residence`` and ``places``. Each service's folders are
    read under their own columns (see ``read_service``); year and selector
    filters reach parquet as pushed filters."""
    root = root.rstrip("/")

    def by_service(kind: str, ids=()) -> dict[str, DataFrame]:
        with ThreadPoolExecutor(max_workers=len(services)) as pool:
            found = list(pool.map(lambda s: read_service(spark, root, kind, s, ids), services))
        return {s.name: df for s, df in zip(services, found, strict=True)}

    return Sources(
        codes=by_service("codes"),
        stays=by_service("stays", STAY_TRIM),
        persons=normalise(spark.read.parquet(f"{root}/persons"), PERSONS, PERSON_TRIM),
        residence=normalise(spark.read.parquet(f"{root}/residence"), RESIDENCE),
        places=spark.read.parquet(f"{root}/places"),
        services=tuple(services),
    )


def read_service(spark: SparkSession, root: str, kind: str, spec: cat.ServiceSpec, ids=()) -> DataFrame:
    """The codes or stays (``kind``) of one service, normalised.

    The service's folder is looked at folder by folder (one for each year): every
    one must have the columns that the service reads, else error 50001 names it,
    before any data is read. Folders with equal columns and types are one read;
    those that differ (another order, case or type, columns that only some services or
    years have) are read and normalised on their own, then unioned by name. The
    files inside one folder come from one write and share their columns. A service
    without a folder has no rows."""
    schema = SCHEMAS[kind]
    folder = f"{root}/{kind}/service={spec.name}"
    found = folder_schemas(spark, f"{root}/{kind}", folder)
    reads, frames = [], {}
    for own, paths in found.items():
        columns = StructType.fromJson(json.loads(own))
        reads.append(spark.read.schema(columns).option("basePath", f"{root}/{kind}").parquet(*paths))
        for path in paths if len(found) > 1 else [folder]:
            frames[f"{spec.name}.{kind}{path.removeprefix(folder)}"] = reads[-1]
    require_columns(frames, read_columns(spec)[kind], 50001)
    if not reads:
        return normalise(spark.createDataFrame([], schema), schema, ids)
    parts = [normalise(df.filter(F.col("service") == spec.name), schema, ids) for df in reads]
    return reduce(DataFrame.unionByName, parts)


def folder_schemas(spark: SparkSession, base: str, folder: str) -> dict[str, list[str]]:
    """The folders of files below ``folder``, by their schema (as JSON, with the
    columns that stand in paths below ``base``). Only file footers are read; a
    folder that is missing or holds no file gives none."""
    try:
        files = spark.read.option("basePath", base).parquet(folder).inputFiles()
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return {}
        raise
    name = folder.rpartition("/")[2]
    leaves = sorted({folder + unquote(f).rpartition("/")[0].rpartition(name)[2] for f in files})

    def own(leaf: str) -> str:
        return spark.read.option("basePath", base).option("mergeSchema", True).parquet(leaf).schema.json()

    with ThreadPoolExecutor(max_workers=8) as pool:
        schemas = list(pool.map(own, leaves))
    out: dict[str, list[str]] = {}
    for leaf, schema in zip(leaves, schemas, strict=True):
        out.setdefault(schema, []).append(leaf)
    return out


def named_sources(
    spark: SparkSession,
    tables: Mapping[str, str | DataFrame],
    persons: str | DataFrame,
    residence: str | DataFrame,
    places: str | DataFrame,
    services=cat.SERVICES,
    keys: Mapping[str, tuple[str, str, str]] = cat.SERVICE_TABLES,
    columns: Mapping[str, Mapping[str, str]] = cat.SOURCE_COLUMNS,
) -> Sources:
    """Sources from one codes and one stays table per service, each under its own
    name and with its own name of the stay key (``keys``: codes table, stays
    table and key of a service).

    ``tables`` says where a table is: by table name, a catalog name, a path, a
    view, or a DataFrame (such as a JDBC read). ``columns`` gives the register's
    name of each of our columns. A table must have the columns that its service
    reads, else error 50001. One projection for each table renames and casts, so
    column pruning and filters still reach the scans."""

    def read(ref: str | DataFrame) -> DataFrame:
        return ref if isinstance(ref, DataFrame) else read_table(spark, ref)

    def one(spec: cat.ServiceSpec, kind: str, ids=()) -> DataFrame:
        codes, stays, key = keys[spec.name]
        name = codes if kind == "codes" else stays
        if name not in tables:
            raise KeyError(f"no table given for {name} ({spec.name} {kind}); given: {sorted(tables)}")
        theirs = {**columns[kind], "stay_key": key}
        df = read(tables[name])
        wanted = read_columns(spec)[kind]
        require_columns({name: df}, [theirs.get(c, c) for c in wanted], 50001)
        return normalise(renamed(df, theirs), SCHEMAS[kind], ids)

    return Sources(
        codes={s.name: one(s, "codes") for s in services},
        stays={s.name: one(s, "stays", STAY_TRIM) for s in services},
        persons=normalise(renamed(read(persons), columns["persons"]), PERSONS, PERSON_TRIM),
        residence=normalise(renamed(read(residence), columns["residence"]), RESIDENCE),
        places=read(places),
        services=tuple(services),
    )


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """``df`` with the columns ``names`` (ours by theirs, any case) under our
    names. A column that already has one of our names and is not theirs goes, so
    that no name stands twice."""
    have = {c.lower() for c in df.columns}
    ours = {theirs.lower(): own for own, theirs in names.items()}
    shadowed = {own.lower() for own, theirs in names.items() if theirs.lower() in have}
    return df.select(
        *[
            F.col(f"`{c}`").alias(ours.get(c.lower(), c))
            for c in df.columns
            if c.lower() in ours or c.lower() not in shadowed
        ]
    )


def fixture_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five register inputs derived from the driver tables, with a
    ``service`` column on codes and stays."""
    ensure_checkpoint_dir(spark)
    return {
        "codes": fixtures.codes(spark, sf_dir),
        "stays": fixtures.stays(spark, sf_dir),
        "persons": fixtures.persons(spark, sf_dir),
        "residence": fixtures.residence(spark, sf_dir),
        "places": fixtures.places_raw(spark, sf_dir),
    }


_FIXTURE_CACHE: dict[tuple[int, str], Sources] = {}


def _alive(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext._jsc is not None
    except Exception:  # Spark Connect: no SparkContext, the session is the handle
        return True


def fixture_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """Lazy source plans over the driver tables. Plans (not data) are kept per
    session and folder, so the registered queries share one construction."""
    key = (id(spark), sf_dir.rstrip("/"))
    hit = _FIXTURE_CACHE.get(key)
    if hit is not None and hit.persons.sparkSession is spark and _alive(spark):
        return hit
    ensure_checkpoint_dir(spark)
    f = fixture_frames(spark, sf_dir)
    _FIXTURE_CACHE[key] = src = Sources(
        codes=_by_service(f["codes"], CODES),
        stays=_by_service(f["stays"], STAYS, STAY_TRIM),
        persons=normalise(f["persons"], PERSONS, PERSON_TRIM),
        residence=normalise(f["residence"], RESIDENCE),
        places=f["places"],
        codes_together=normalise(f["codes"], CODES, keep=["service"]),
    )
    return src


__all__ = ["Sources", "fixture_frames", "fixture_sources", "named_sources", "read_sources", "read_table", "PLACES"]
