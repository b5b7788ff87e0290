"""Readers and writers for the job's inputs and outputs.

Inputs are read with an explicit schema (never inferred), projected to the
columns used, so the scan reads only those columns from columnar files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlens.operators.lookup import normalise_key, rename_positionally

# Source column names of the installations x certificates table, fixed by the source.
RECORD_SCHEMA = T.StructType([
    T.StructField("original_mcs_index", T.LongType()),
    T.StructField("commission_date", T.DateType()),
    T.StructField("postcode", T.StringType()),
    T.StructField("tech_type", T.StringType()),
    T.StructField("cost", T.DoubleType()),
    T.StructField("cluster", T.BooleanType()),
    T.StructField("original_epc_index", T.LongType()),
    T.StructField("installation_type", T.StringType()),
    T.StructField("TOTAL_FLOOR_AREA", T.DoubleType()),
    T.StructField("CONSTRUCTION_AGE_BAND", T.StringType()),
    T.StructField("NUMBER_HABITABLE_ROOMS", T.DoubleType()),
    T.StructField("TENURE", T.StringType()),
    T.StructField("TRANSACTION_TYPE", T.StringType()),
    T.StructField("BUILT_FORM", T.StringType()),
    T.StructField("PROPERTY_TYPE", T.StringType()),
    T.StructField("INSPECTION_DATE", T.DateType()),
])


def _by_name(raw: DataFrame, schema: T.StructType, columns) -> list:
    """Columns picked by header name; text that is no value of the schema's type becomes null."""
    wanted = list(columns or schema.fieldNames())
    missing = [c for c in wanted if c not in raw.columns]
    if missing:
        raise ValueError(f"columns not in the file: {missing}")
    types = {f.name: f.dataType for f in schema.fields}
    return [F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in wanted]


def _raw(spark: SparkSession, path: str, fmt: str | None) -> DataFrame:
    fmt = fmt or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")
    return spark.read.option("header", True).csv(path) if fmt == "csv" else spark.read.parquet(path)


def read_records(spark: SparkSession, path: str, columns=None, schema: T.StructType = RECORD_SCHEMA,
                 fmt: str | None = None) -> DataFrame:
    """Installations x certificates from CSV (header, ISO dates) or Parquet, projected to ``columns``.

    Columns are found by their name in the header, wherever they stand and
    whatever else the file holds, and cast to the schema's types; cells that
    do not cast become null (``bad_cells`` counts them). A missing column is
    an error.
    """
    raw = _raw(spark, path, fmt)
    return raw.select(*_by_name(raw, schema, columns))


def bad_cells(spark: SparkSession, path: str, columns=None, schema: T.StructType = RECORD_SCHEMA,
              fmt: str | None = None) -> DataFrame:
    """Per column the number of cells that hold text but no value of the schema's type."""
    raw = _raw(spark, path, fmt)
    wanted = [c for c in (columns or schema.fieldNames()) if c in schema.fieldNames()]
    cast = _by_name(raw, schema, wanted)
    one = raw.agg(*[F.count_if(F.col(f"`{c}`").isNotNull() & v.isNull()).alias(c) for c, v in zip(wanted, cast)])
    return one.unpivot([], wanted, "column", "n_bad")


def read_index_series(spark: SparkSession, path: str, title_col: str = "Title",
                      value_col: str | None = None) -> DataFrame:
    """Price-index series CSV as (title, value) strings; the value column is the
    named one, or the second column."""
    df = spark.read.option("header", True).csv(path)
    value_col = value_col or df.columns[1]
    return df.select(F.col(f"`{title_col}`").alias("title"), F.col(f"`{value_col}`").alias("value"))


def read_postcode_lookup(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """Postcode -> district CSV in Latin-1, with ``postcode`` = ``pcds`` without blanks."""
    df = spark.read.option("header", True).option("encoding", encoding).csv(path)
    return normalise_key(df.select("pcds", "ladcd", "ladnm"), "pcds", "postcode")


def read_region_lookup(spark: SparkSession, path: str) -> DataFrame:
    """District -> region CSV; columns renamed by position (headers vary by release)."""
    df = spark.read.option("header", True).csv(path)
    return rename_positionally(df.select(*df.columns[:5])).withColumn("fid", F.col("fid").cast("int"))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list | None = None) -> None:
    """Write predictions or metric tables (Parquet, CSV with header, or JSON lines)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    if fmt == "csv":
        r = spark.read.option("header", True)
        return (r.schema(schema) if schema is not None else r.option("inferSchema", True)).csv(path)
    if fmt == "json":
        return spark.read.schema(schema).json(path) if schema is not None else spark.read.json(path)
    return spark.read.parquet(path)
