"""The registry, and the roles that the test tables play."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query and, where SQL can express it, the SQL for DuckDB over the tables' views."""

    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A scored sample: lineitem with a target, scores, an amount, features with missing values, and a data flag.
FEATURES = ["f_quantity", "f_price", "f_discount", "f_tax"]

SAMPLE_SQL = """sample AS (
  SELECT l_orderkey AS key, l_linenumber AS line, l_shipdate AS loan_date,
    CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS month,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS bad, l_extendedprice AS score, l_quantity AS score2, l_quantity AS amount,
    CASE WHEN l_returnflag = 'R' THEN l_quantity * 0.5 ELSE 0 END AS overdue, l_linestatus AS status, l_quantity AS f_quantity, l_extendedprice AS f_price,
    CASE WHEN l_orderkey % 17 = 0 THEN CAST(-999999 AS DOUBLE) ELSE l_discount END AS f_discount, CASE WHEN l_orderkey % 23 = 0 THEN NULL ELSE l_tax END AS f_tax,
    CASE WHEN year(l_shipdate) < 1999 THEN CASE WHEN l_orderkey % 5 = 0 THEN 'test' ELSE 'train' END WHEN year(l_shipdate) < 2001 THEN 'oot' ELSE 'oos' END AS data_flag
  FROM lineitem)"""


def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem")
    year = F.year("l_shipdate")
    bad = F.col("l_returnflag") == "R"
    return x.select(
        F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("line"), F.col("l_shipdate").alias("loan_date"),
        (year * 100 + F.month("l_shipdate")).cast("int").alias("month"), F.when(bad, 1).otherwise(0).alias("bad"),
        F.col("l_extendedprice").alias("score"), F.col("l_quantity").alias("score2"), F.col("l_quantity").alias("amount"),
        F.when(bad, F.col("l_quantity") * 0.5).otherwise(0.0).alias("overdue"), F.col("l_linestatus").alias("status"), F.col("l_quantity").alias("f_quantity"),
        F.col("l_extendedprice").alias("f_price"), F.when(F.col("l_orderkey") % 17 == 0, -999999.0).otherwise(F.col("l_discount")).alias("f_discount"),
        F.when(F.col("l_orderkey") % 23 != 0, F.col("l_tax")).alias("f_tax"),
        F.when(year < 1999, F.when(F.col("l_orderkey") % 5 == 0, "test").otherwise("train")).when(year < 2001, "oot").otherwise("oos").alias("data_flag"),
    )


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that sums in another order compare equal."""
    return df.select(*(F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def unpivoted(names: list[str], source: str = "sample", keep: str = "bad") -> str:
    """SQL: keep, feature, value of the features as long rows."""
    return " UNION ALL ".join(f"SELECT {keep}, '{n}' AS feature, {n} AS value FROM {source}" for n in names)
