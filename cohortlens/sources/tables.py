"""Sources: table scans, schema checks (IO1-IO5) and the role-mapped feature table."""

from __future__ import annotations

import os
import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.config import FEATURE_ROLES, Roles
from cohortlens.session import materialize


class DuplicateIdError(ValueError):
    """Raised when ids are missing or repeated."""


class SchemaError(ValueError):
    """Raised when a table does not carry the columns its roles need."""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one bundled parquet table (column pruning / filters reach the scan)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


#: Texts that stand for a missing number in a CSV file.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
#: What counts as a number (a trailing type letter, as in ``1d``, does not).
NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$|^[+-]?([iI]nf|INF)([iI]nity|INITY)?$"
CORRUPT = "__row"


def _found(path: str, read):
    """``read()``, where a missing path is a clear error."""
    try:
        return read()
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(f"customer data not found: {path}") from exc
        raise


def parse_features(raw: DataFrame, roles: Roles) -> DataFrame:
    """``raw`` (all columns text) with its features as doubles and ``reasons``: why a row is no customer row. A missing marker is
    a null, any other text that is no number is a reason, and so is a row that does not fit the header."""
    features = [c for c in raw.columns if c in roles.features]
    text = {c: F.trim(F.col(f"`{c}`")) for c in features}
    present = {c: text[c].isNotNull() & ~text[c].isin(*MISSING) for c in features}
    bad = [F.when(present[c] & ~text[c].rlike(NUMBER), F.concat(F.lit(f"{c}: not a number: "), F.substring(text[c], 1, 80))) for c in features]
    if CORRUPT in raw.columns:
        bad.append(F.when(F.col(CORRUPT).isNotNull(), F.lit("row does not fit the header")))
    number = {c: F.when(present[c] & text[c].rlike(NUMBER), text[c].try_cast("double")) for c in features}
    cols = [number[c].alias(c) if c in number else F.col(f"`{c}`") for c in raw.columns]
    return raw.select(*cols, F.array_compact(F.array(*bad)).alias("reasons"))


def read_csv_checked(spark: SparkSession, path: str, roles: Roles, rejects: str | None = None) -> DataFrame:
    """IO1 + IO4 for CSV: features are parsed in one pass, which writes the parsed table to the scratch folder and counts, per
    feature, what does not parse.

    Text in a feature is a ``SchemaError``. With ``rejects``, a folder, such rows go there (Parquet: the row's columns as text and
    ``reasons``) and the rest is returned. Header lines of all files must name the same columns in the same order."""
    header = _found(path, lambda: spark.read.option("header", True).option("inferSchema", False).csv(path).columns)
    missing = [c for c in (roles.id, roles.category, *roles.features) if c not in header]
    if missing:
        raise SchemaError(f"missing required columns: {missing}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, CORRUPT)])
    raw = (spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    # The text of the features stays beside the numbers for the rejects.
    own = [c for c in header if c in roles.features]
    kept = raw.withColumn("__text", F.to_json(F.struct(*[F.col(f"`{c}`") for c in header])))
    seen = Observation()
    starts = lambda c: F.exists("reasons", lambda r: r.startswith(f"{c}: "))
    counts = [F.count_if(starts(c)).alias(f"n{i}") for i, c in enumerate(own)]
    parsed = parse_features(kept, roles).observe(seen, F.count_if(F.size("reasons") > 0).alias("rows"), *counts)
    try:
        parsed = materialize(parsed, "customers")
    except Exception as exc:
        if "CSV header" in str(exc):
            raise SchemaError(f"files of {path} have different header lines") from exc
        raise
    found = seen.get
    if found["rows"]:
        bad = {c: found[f"n{i}"] for i, c in enumerate(own) if found[f"n{i}"]}
        if rejects is None:
            one = parsed.where(F.size("reasons") > 0).select("reasons").first()["reasons"]
            raise SchemaError(f"features must be numeric: {found['rows']} rows do not parse, by feature {bad}, for example {one}")
        row = F.from_json("__text", T.StructType(schema.fields[:-1])).alias("r")
        parsed.where(F.size("reasons") > 0).select(row, "reasons").select("r.*", "reasons").write.mode("overwrite").parquet(rejects)
    return parsed.where(F.size("reasons") == 0).drop("reasons", "__text", CORRUPT)


def read_customers(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | None = None, roles: Roles | None = None,
                   rejects: str | None = None) -> DataFrame:
    """IO1: read a customer table (CSV with header, or parquet). A missing path is a clear error. A CSV's types
    come from ``schema``, or from ``roles`` with every value checked (``read_csv_checked``); only without both are they inferred by a scan."""
    if schema is None and roles is not None and fmt == "csv":
        return read_csv_checked(spark, path, roles, rejects)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        return _found(path, lambda: reader.option("header", True).option("inferSchema", schema is None).csv(path))
    return _found(path, lambda: reader.format(fmt).load(path))


def read_optional(spark: SparkSession, path: str | None, fmt: str = "csv") -> DataFrame | None:
    """IO2: read the labelled table if it is there. No path or nothing at it: None, with a warning. A table
    that is there but cannot be read is an error."""
    if not path:
        return None
    try:
        df = read_customers(spark, path, fmt)
        df.schema  # resolve now so a bad file fails here
        return df
    except FileNotFoundError as exc:
        warnings.warn(f"no labelled table, validation is left out: {exc}", stacklevel=2)
        return None


def check_ids(df: DataFrame, id_col: str) -> None:
    """Ids must be there and unique, or joins by id would attach wrong labels."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(id_col).alias("ids")).first()
    if r["n"] != r["ids"]:
        raise DuplicateIdError(f"{id_col}: {r['n']} rows, {r['ids']} distinct ids")


def check_schema(df: DataFrame, roles: Roles) -> None:
    """IO3 + IO4: required columns present; features numeric (booleans rejected). No job runs."""
    required = [roles.id, roles.category, *roles.features]
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise SchemaError(f"missing required columns: {missing}")
    by_name = {f.name: f.dataType for f in df.schema.fields}
    bad = [c for c in roles.features if not isinstance(by_name[c], T.NumericType)]
    if bad:
        raise SchemaError(f"features must be numeric: {bad}")


def shape_summary(df: DataFrame) -> DataFrame:
    """IO5: (n_rows, n_cols) — one count job."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(len(df.columns)).alias("n_cols"))


def customer_features(spark: SparkSession, sf_dir: str, orders_from: str | None = None,
                      with_nation: bool = False) -> DataFrame:
    """One row per customer: customer LEFT JOIN (orders pre-aggregated by customer).

    Orders are aggregated first (partial aggregation happens map-side, so a customer that holds
    a third of all orders is combined before the shuffle), then joined 1:1 on the key.
    ``orders_from`` keeps only orders on/after a date, which leaves real nulls in total_spend.
    """
    orders = table(spark, sf_dir, "orders")
    if orders_from:
        orders = orders.where(F.col("o_orderdate") >= F.lit(orders_from).cast("timestamp"))
    per_customer = orders.groupBy("o_custkey").agg(
        F.count("o_orderkey").alias("order_count"),
        F.sum("o_totalprice").alias("total_spend"),
    )
    extra = ["c_nationkey"] if with_nation else []
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal", *extra)
    r = FEATURE_ROLES
    return cust.join(per_customer, cust.c_custkey == per_customer.o_custkey, "left").select(
        *extra,
        F.col("c_custkey").alias(r.id),
        F.col("c_mktsegment").alias(r.category),
        F.col("c_acctbal").cast("double").alias("c_acctbal"),
        F.coalesce(F.col("order_count"), F.lit(0)).cast("double").alias("order_count"),
        F.col("total_spend").cast("double").alias("total_spend"),
    )


# SQL twin of customer_features (DuckDB and Spark SQL both accept it).
def customer_features_sql(orders_from: str | None = None, with_nation: bool = False) -> str:
    where = f"WHERE o_orderdate >= TIMESTAMP '{orders_from}'" if orders_from else ""
    extra = "c.c_nationkey, " if with_nation else ""
    return f"""
    SELECT {extra}c.c_custkey, c.c_mktsegment, CAST(c.c_acctbal AS DOUBLE) AS c_acctbal,
           CAST(COALESCE(o.order_count, 0) AS DOUBLE) AS order_count,
           CAST(o.total_spend AS DOUBLE) AS total_spend
    FROM customer c
    LEFT JOIN (SELECT o_custkey, COUNT(o_orderkey) AS order_count, SUM(o_totalprice) AS total_spend
               FROM orders {where} GROUP BY o_custkey) o
      ON c.c_custkey = o.o_custkey"""
