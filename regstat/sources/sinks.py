"""Writers: staged sources, intermediate tables and the delivered result set.

A delivery replaces the one before as a whole. Each run writes a version of its own
under ``<out>/data/<version>``; when all its tables are there, one row appended to
``<out>/versions`` makes it the current one. A run that ends before leaves the
version before in place and readable. Paths are on the shared file system
the caller names; nothing goes to a machine-local folder.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    fmt: str = "parquet",
    sort_within: list | None = None,
) -> None:
    w = df
    if sort_within:
        w = w.sortWithinPartitions(*sort_within)
    writer = w.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_sources(frames: dict[str, DataFrame], root: str) -> None:
    """Stage register inputs in the layout ``read_sources`` expects: codes and
    stays partitioned by service and year, so service and year filters prune
    whole directories."""
    root = root.rstrip("/")
    for name in ("codes", "stays"):
        # group rows by directory so each gets few files; the rebalance hint
        # lets AQE split a (service, year) holding a large share of all rows
        # into several tasks and merge small ones
        df = frames[name].hint("rebalance", "service", "year")
        write_table(df, f"{root}/{name}", ["service", "year"])
    for name in ("persons", "residence", "places"):
        write_table(frames[name], f"{root}/{name}")


def _deliver_one(name: str, df: DataFrame, out: str, csv: bool, order: list) -> None:
    pq = f"{out}/{name}/parquet"
    by_year = "Ar" in df.columns
    # no partitionBy: the year stays the first column inside the files, and a
    # table without rows still leaves a file with its header
    write_table(_by_year(df, order) if by_year else df, pq)
    if not csv:
        return
    back = df.sparkSession.read.schema(df.schema).parquet(pq)
    if by_year:
        write_table(_by_year(back, order), f"{out}/{name}/csv", None, "csv")
    else:
        small = back.orderBy(*order) if order else back
        write_table(small.coalesce(1), f"{out}/{name}/csv", None, "csv")


def _by_year(df: DataFrame, order: list) -> DataFrame:
    """Whole years per file, sorted within: a year of a delivered table is
    bounded by its cells (municipalities x sexes x ages), not by register
    volume."""
    return df.repartition("Ar").sortWithinPartitions("Ar", *order)


_VERSION = "seq long, version string, tables array<string>"


def new_version() -> str:
    return uuid.uuid4().hex[:12]


def version_dir(out: str, version: str) -> str:
    return f"{out.rstrip('/')}/data/{version}"


def versions(spark: SparkSession, out: str) -> list[tuple[str, list[str]]]:
    """The published versions of a delivery and their tables, newest first: one
    row for each run, so few."""
    try:
        rows = spark.read.schema(_VERSION).parquet(f"{out.rstrip('/')}/versions").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = []
    return [(r["version"], r["tables"]) for r in sorted(rows, key=lambda r: (-r["seq"], r["version"]))]


def publish(spark: SparkSession, out: str, version: str, tables: list[str]) -> None:
    """Make a version whose tables are all written the current one: a single
    row, in a file that its commit lets appear at once."""
    row = [(len(versions(spark, out)), version, sorted(tables))]
    spark.createDataFrame(row, _VERSION).coalesce(1).write.mode("append").parquet(f"{out.rstrip('/')}/versions")


def read_delivery(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A table of the current version."""
    found = versions(spark, out)
    if not found:
        raise FileNotFoundError(f"no published delivery under {out}")
    version, tables = found[0]
    if name not in tables:
        raise KeyError(f"no table {name} in the delivery under {out}; it has {tables}")
    return spark.read.parquet(f"{version_dir(out, version)}/{name}/parquet")


def drop_old_versions(spark: SparkSession, out: str, keep: int = 1) -> list[str]:
    """Delete the data of published versions but the newest ``keep``; returns
    their names. Their rows in ``versions`` stay, as the delivery's history. Needs a
    session with a JVM of its own."""
    old = [version for version, _ in versions(spark, out)[max(1, keep) :]]
    conf, fs_path = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    for version in old:
        path = fs_path(version_dir(out, version))
        path.getFileSystem(conf).delete(path, True)
    return old


def write_delivery(
    tables: dict[str, DataFrame],
    out: str,
    csv: bool = True,
    orders: dict[str, list] | None = None,
    parallel: int = 4,
) -> None:
    """One directory per table. Parquet is written once (profile tables
    in whole years, ``Ar`` first); the CSV copy with a header row is made from
    the written parquet, not by recomputing the plan. Profile CSVs hold
    whole years, sorted within each file, so no single task
    writes a whole table; the small check tables are one sorted file each.

    The tables are independent, so up to ``parallel`` of them are written
    as concurrent Spark jobs of the same session."""
    out = out.rstrip("/")
    orders = orders or {}
    if parallel <= 1 or len(tables) <= 1:
        for name, df in tables.items():
            _deliver_one(name, df, out, csv, orders.get(name, []))
        return
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=min(parallel, len(tables))) as pool:
        futures = [
            pool.submit(_deliver_one, name, df, out, csv, orders.get(name, []))
            for name, df in tables.items()
        ]
        for f in futures:
            f.result()  # re-raise the first failure
