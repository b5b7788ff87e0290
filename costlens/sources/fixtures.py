"""Stand-in inputs built from the driver's test tables.

Each view only renames and re-types columns of the TPC-H-like tables into
the shapes the cost-interval job reads (one row per installation x
certificate, a price-index series, two versions of two location lookups,
a predictions table). The SQL runs unchanged in Spark and DuckDB, so the
DuckDB oracle for a query can inline the same views as CTEs.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

FIXTURE_SQL: dict[str, str] = {
    "inst": """
SELECT l_orderkey AS unit_id,
 CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS event_date,
 CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE concat('PC', CAST(o_custkey AS STRING)) END AS postcode,
 CASE WHEN o_orderstatus = 'P' THEN 'Ground Source' ELSE 'Air Source' END AS tech_type,
 CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE 4000 + 20000 * (o_totalprice/500000) * (o_totalprice/500000) * (o_totalprice/500000) * (o_totalprice/500000) END AS cost,
 (o_custkey % 10 = 3) AS is_cluster,
 CASE WHEN l_linenumber = 7 AND l_quantity < 10 THEN NULL ELSE l_orderkey * 10 + l_linenumber END AS record_id,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'Commercial' WHEN '2-HIGH' THEN 'NON-DOMESTIC' WHEN '3-MEDIUM' THEN NULL ELSE 'Domestic' END AS install_type,
 l_quantity * 11 AS floor_area,
 CASE p_size % 14 WHEN 0 THEN 'England and Wales: before 1900' WHEN 1 THEN 'Scotland: before 1919' WHEN 2 THEN '1900-1929' WHEN 3 THEN '1930-1949' WHEN 4 THEN '1950-1966' WHEN 5 THEN '1965-1975' WHEN 6 THEN '1976-1983' WHEN 7 THEN '1983-1991' WHEN 8 THEN '1991-1998' WHEN 9 THEN '1996-2002' WHEN 10 THEN '2003-2007' WHEN 11 THEN '2007 onwards' WHEN 12 THEN 'Unknown' ELSE NULL END AS age_band,
 CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE CAST(1 + l_suppkey % 10 AS DOUBLE) END AS rooms,
 c_mktsegment AS tenure,
 CASE l_returnflag WHEN 'N' THEN 'new dwelling' WHEN 'A' THEN 'marketed sale' ELSE 'UNKNOWN reason' END AS transaction_type,
 CASE p_type WHEN 'ECONOMY' THEN 'Detached' WHEN 'MEDIUM' THEN 'Semi-Detached' WHEN 'PROMO' THEN 'End-Terrace' WHEN 'STANDARD' THEN 'Enclosed End-Terrace' WHEN 'SMALL' THEN 'Mid-Terrace' ELSE 'Enclosed Mid-Terrace' END AS built_form,
 CASE WHEN l_partkey % 5 = 4 THEN 'Flat' WHEN l_partkey % 5 = 3 THEN 'Bungalow' ELSE 'House' END AS property_type,
 CASE WHEN l_linenumber = 5 AND l_quantity < 5 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS inspection_date,
 l_linenumber AS tie_1, l_partkey AS tie_2, l_suppkey AS tie_3
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey
""",
    "price_index": """
SELECT 'CDID' AS title, 'D7CK' AS value
UNION ALL SELECT DISTINCT CAST(year(o_orderdate) AS STRING), CAST(81.25 + 2.5 * (year(o_orderdate) - 1995) AS STRING) FROM orders
UNION ALL SELECT DISTINCT concat(CAST(year(o_orderdate) AS STRING), ' Q', CAST(quarter(o_orderdate) AS STRING)), CAST(80 + 2.5 * (year(o_orderdate) - 1995) + 0.5 * quarter(o_orderdate) AS STRING) FROM orders WHERE year(o_orderdate) < 2001
UNION ALL SELECT '1995 JAN', '80.1'
""",
    "postcode_new": """
SELECT concat('PC ', CAST(c_custkey AS STRING)) AS pcds,
 CASE WHEN c_custkey % 41 = 0 THEN NULL WHEN n_regionkey <= 2 THEN concat('E', CAST(n_nationkey AS STRING)) WHEN n_regionkey = 3 THEN concat('W', CAST(n_nationkey AS STRING)) ELSE concat('S', CAST(n_nationkey AS STRING)) END AS ladcd,
 n_name AS ladnm
FROM customer JOIN nation ON c_nationkey = n_nationkey
""",
    "postcode_old": """
SELECT pcds, ladcd, ladnm FROM postcode_new WHERE CAST(substr(pcds, 4) AS BIGINT) % 17 <> 0
""",
    "region_new": """
SELECT concat('E', CAST(n_nationkey AS STRING)) AS ladcd, n_name AS ladnm, concat('R', CAST(r_regionkey AS STRING)) AS rgncd, r_name AS rgnnm, n_nationkey AS fid
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey <= 1
""",
    "region_old": """
SELECT concat('E', CAST(n_nationkey AS STRING)) AS ladcd, n_name AS ladnm, concat('R', CAST(r_regionkey AS STRING)) AS rgncd, r_name AS rgnnm, n_nationkey AS fid
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey <= 2
""",
    "preds": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS d, l_extendedprice AS y,
 40000 + 300 * l_quantity AS y_pred, CAST(8000 - 400 * (l_linenumber - 4) AS DOUBLE) AS lo, 90000 - 100 * l_quantity AS hi,
 l_returnflag AS grp, l_orderkey % 5 AS fold
FROM lineitem
""",
}

# The joins of a view in the order in which Spark makes them (inner joins: any order gives the same rows). Small sides meet
# first and the join on the unit comes last, so the rows leave it dealt by unit and the steps by unit need no shuffle of them.
_JOINS = {"inst": ("FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey",
                   "FROM lineitem JOIN part ON l_partkey = p_partkey JOIN (orders JOIN customer ON o_custkey = c_custkey) ON l_orderkey = o_orderkey")}

# Views that read other views (must be defined first).
FIXTURE_DEPS = {"postcode_old": ("postcode_new",)}


def register_tables(spark: SparkSession, sf_dir: str, names=BASE_TABLES) -> None:
    """Register the driver's parquet tables as temp views of the same name."""
    for name in names:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path) or "://" in sf_dir:
            spark.read.parquet(path).createOrReplaceTempView(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Return the stand-in view ``name`` over the tables in ``sf_dir``; only the tables it reads are opened."""
    text = " ".join(FIXTURE_SQL[n] for n in (name, *FIXTURE_DEPS.get(name, ())))
    register_tables(spark, sf_dir, [t for t in BASE_TABLES if re.search(rf"\b(FROM|JOIN) {t}\b", text)])
    for dep in FIXTURE_DEPS.get(name, ()):
        spark.sql(FIXTURE_SQL[dep]).createOrReplaceTempView(dep)
    return spark.sql(FIXTURE_SQL[name].replace(*_JOINS.get(name, ("", ""))))


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the fixture views it reads, as CTEs (for DuckDB)."""
    ordered: list[str] = []
    for n in names:
        for dep in FIXTURE_DEPS.get(n, ()):
            if dep not in ordered:
                ordered.append(dep)
        if n not in ordered:
            ordered.append(n)
    ctes = ",\n".join(f"{n} AS ({FIXTURE_SQL[n].strip()})" for n in ordered)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
