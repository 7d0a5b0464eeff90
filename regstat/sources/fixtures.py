"""Register-shaped test inputs derived from the driver's TPC-H-like tables.

The register itself is not public, so the tests and the benchmark derive the
five inputs from ``orders``, ``lineitem``, ``customer``, ``nation`` and
``region``: orders become stays (priority picks the service), line items
become code rows, customers become the person dimension, and each customer's
order dates become a residence history. Dates move forward 16 years so the
data span (1995-2001) becomes 2011-2017 and 2011 falls outside the period.

The arithmetic below is a fixed recipe shared with the DuckDB oracle
(``regstat.plans.oracle``); it is data generation, not statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the derivation recipe.
YEAR_SHIFT = 16
PRIORITY_TO_SERVICE = {
    "1-URGENT": "SOM",
    "2-HIGH": "PHV",
    "3-MEDIUM": "TSB",
    "4-NOT SPECIFIED": "PHBU",
}
OTHER_SERVICE = "AVT"
FIXTURE_CODES = (
    "I219", "I500", "J449", "M170", "S720", "S723", "S009", "T402", "T781", "T079",
    "F329", "F413", "F102", "F120", "F170", "F185", "F199", "F000", "Z000", "I109",
)
OVERRIDE_PLACE_ROW = ("1534", "Old Haram", "1507", "Alesund", "0", "AFRICA", "0", "AFRICA")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _shift_year(ts) -> F.Column:
    return (F.year(ts) + F.lit(YEAR_SHIFT)).cast("int")


def _shift_date(ts) -> F.Column:
    return F.add_months(F.to_date(ts), 12 * YEAR_SHIFT)


def _service(priority) -> F.Column:
    expr = None
    for p, s in PRIORITY_TO_SERVICE.items():
        expr = (F.when if expr is None else expr.when)(priority == F.lit(p), F.lit(s))
    return expr.otherwise(F.lit(OTHER_SERVICE))


def _municipality_code(n) -> F.Column:
    return (F.lit(301) + (n % 25) * 50).cast("string")


def stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        _service(F.col("o_orderpriority")).alias("service"),
        k.alias("stay_key"),
        _shift_year(F.col("o_orderdate")).alias("year"),
        F.when(c % 97 == 0, F.concat(F.lit("00000000000"), c.cast("string")))
        .otherwise(c.cast("string"))
        .alias("person_id"),
        F.when(k % 4 == 0, "1").when(k % 4 == 1, "2").when(k % 4 == 2, "9").alias("sex"),
        _municipality_code(c).alias("home_municipality"),
        F.when(k % 10 == 0, F.lit(None).cast("int"))
        .when(k % 10 == 1, F.lit(3))
        .otherwise((1 + k % 2).cast("int"))
        .alias("care_level"),
        F.when(k % 7 == 0, F.lit(1)).when(k % 7 == 1, F.lit(None).cast("int")).otherwise(F.lit(0))
        .alias("is_rehab"),
        F.when(k % 11 == 0, F.lit(None).cast("string"))
        .when((F.col("o_orderstatus") == "P") & (k % 3 == 0), F.lit("S"))
        .otherwise(F.col("o_orderstatus"))
        .alias("niva"),
    )


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    pick = ((F.col("l_partkey") + F.col("l_suppkey")) % len(FIXTURE_CODES) + 1).cast("int")
    return j.select(
        _service(F.col("o_orderpriority")).alias("service"),
        F.col("l_orderkey").alias("stay_key"),
        F.when(F.col("l_linenumber") == 7, _shift_year(F.col("l_shipdate")))
        .otherwise(_shift_year(F.col("o_orderdate")))
        .alias("year"),
        F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), F.lit(5))
        .otherwise(F.lit(6))
        .alias("code_type"),
        (F.lit(11) + F.col("l_linenumber") % 3).cast("int").alias("code_no"),
        F.when(F.col("l_returnflag") == "N", F.lit(2)).otherwise(F.lit(1)).alias("axis"),
        F.when(F.col("l_linestatus") == "O", F.lit(2)).otherwise(F.lit(1)).alias("condition"),
        F.element_at(F.array(*[F.lit(x) for x in FIXTURE_CODES]), pick).alias("code"),
    )


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.filter(k % 31 != 0).select(
        k.alias("person_id"),
        (F.lit(2010) - k % 90).cast("int").alias("birth_year"),
        (F.lit(1) + F.col("c_nationkey") % 2).cast("string").alias("sex"),
    )


def next_in_order(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Add ``next_<value>``: the value of the following row of the same ``key``
    under ``order``, NULLs last (as ``lead``).

    Two windows, so that a key holding a third of all rows is not in one task:
    first within each (key, first order column), then from the last row of each to
    the first row of the next, of which a key has one for each value (a customer:
    one for each order date)."""
    step, *rest = order
    within = Window.partitionBy(key, step).orderBy(*[F.col(c).asc_nulls_last() for c in rest])
    stepped = df.select(
        "*",
        F.lead(F.struct(value)).over(within).alias("_follows"),
        F.first(value).over(within).alias("_first"),
    ).withColumn("_last", F.col("_follows").isNull())
    # rows that are not the last of their step stay dealt by it
    between = Window.partitionBy(key, "_last", F.when(~F.col("_last"), F.col(step)))
    nxt = F.lead("_first").over(between.orderBy(F.col(step).asc_nulls_last()))
    return stepped.select(
        *df.columns,
        F.when(F.col("_last"), nxt).otherwise(F.col(f"_follows.{value}")).alias(f"next_{value}"),
    )


def residence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One interval per order: from the order date to the day before the
    customer's next order (some run 60 days past it, so intervals overlap);
    the last one is open."""
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    o = next_in_order(o, "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderdate")
    k = F.col("o_orderkey")
    nxt = _shift_date(F.col("next_o_orderdate"))
    return o.select(
        F.col("o_custkey").alias("person_id"),
        _shift_date(F.col("o_orderdate")).alias("from_date"),
        F.when(k % 13 == 0, F.date_add(nxt, 60)).otherwise(F.date_sub(nxt, 1)).alias("to_date"),
        F.when(k % 17 == 0, F.lit("9999"))
        .when(k % 19 == 0, F.lit(""))
        .when(k % 23 == 0, F.lit("12345"))
        .when(k % 29 == 0, F.lit("1534"))
        .otherwise(_municipality_code(k))
        .alias("municipality"),
    )


def places_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """27 place rows: one per nation, a second (older name) for nation 3 and
    one row whose code is overridden by the places operator."""
    n = _read(spark, sf_dir, "nation")
    r = _read(spark, sf_dir, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey, "inner")
    code = (F.lit(301) + F.col("n_nationkey") * 50).cast("int")

    def row(name):
        return [
            code.alias("kommunenr"),
            name.alias("kommunenavn"),
            code.cast("string").alias("kommunenrdagens"),
            F.col("n_name").alias("kommunenavndagens"),
            F.col("r_regionkey").cast("string").alias("fylkenr"),
            F.col("r_name").alias("fylkenavn"),
            F.col("r_regionkey").cast("string").alias("fylkenrdagens"),
            F.col("r_name").alias("fylkenavndagens"),
        ]

    base = j.select(*row(F.col("n_name")))
    old = j.filter(F.col("n_nationkey") == 3).select(*row(F.concat(F.col("n_name"), F.lit(" OLD"))))
    extra = spark.createDataFrame([OVERRIDE_PLACE_ROW], base.columns).withColumn(
        "kommunenr", F.col("kommunenr").cast("int")
    )
    return base.unionByName(old).unionByName(extra)
