"""The dirty 21-column extract, derived from a TPC-H-like star schema.

The star tables are clean, so dirt is added by arithmetic on the line key; the same text runs in other
SQL engines, which makes it the common input of every check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STAR_TABLES = ["lineitem", "orders", "customer", "nation", "region", "part"]

TRANSACTIONS_SQL = """
WITH b AS (
 SELECT l.*, CAST(o.o_orderdate AS DATE) AS od, o.o_custkey, o.o_orderstatus, p.p_brand, p.p_type, p.p_retailprice, r.r_name,
        l.l_orderkey * 7 + l.l_linenumber AS k,
        CAST(year(CAST(o.o_orderdate AS DATE)) AS STRING) AS y,
        lpad(CAST(month(CAST(o.o_orderdate AS DATE)) AS STRING), 2, '0') AS m,
        lpad(CAST(day(CAST(o.o_orderdate AS DATE)) AS STRING), 2, '0') AS d
 FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
 JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey JOIN part p ON p.p_partkey = l.l_partkey)
SELECT
 CASE WHEN k % 97 = 0 THEN NULL WHEN k % 101 = 0 THEN ' UNKNOWN ' ELSE 'T' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) END AS transaction_id,
 CASE WHEN k % 61 = 0 THEN 'not-a-date' WHEN k % 67 = 0 THEN NULL WHEN k % 71 = 0 THEN y || '-02-30'
      WHEN k % 5 = 1 THEN m || '/' || d || '/' || y WHEN k % 5 = 2 THEN d || '-' || m || '-' || y WHEN k % 5 = 3 THEN y || m || d ELSE y || '-' || m || '-' || d END AS date,
 CASE WHEN k % 59 = 0 THEN 'bad' WHEN k % 2 = 0 THEN y || '-' || m || '-' || d || ' 10:11:12' ELSE y || '-' || m || '-' || d || 'T10:11:12' END AS timestamp,
 CASE WHEN k % 53 = 0 THEN NULL WHEN k % 8 = 0 THEN ' CÃ±' || CAST(o_custkey AS STRING) || ' ' ELSE 'C' || CAST(o_custkey AS STRING) END AS customer_id,
 CASE k % 9 WHEN 0 THEN 'business' WHEN 1 THEN 'Empresa' WHEN 2 THEN 'RETAIL' WHEN 3 THEN 'personal' WHEN 4 THEN 'Government' WHEN 5 THEN 'publico' WHEN 6 THEN 'Wholesale' WHEN 7 THEN ' corporate ' ELSE NULL END AS customer_segment,
 p_brand AS product_id,
 CASE p_type WHEN 'ECONOMY' THEN 'varilla' WHEN 'SMALL' THEN 'Wire' WHEN 'MEDIUM' THEN 'PROFILE' WHEN 'PROMO' THEN 'pipe' WHEN 'STANDARD' THEN 'LÃ¢mina' ELSE 'plate' END AS product_category,
 CASE k % 7 WHEN 0 THEN 'new' WHEN 1 THEN 'Activo' WHEN 2 THEN 'obsolete' WHEN 3 THEN 'phaseout' WHEN 4 THEN 'mature' WHEN 5 THEN 'decline' ELSE NULL END AS product_lifecycle,
 CASE WHEN k % 11 = 0 THEN NULL WHEN k % 37 = 0 THEN 'abc' WHEN k % 41 = 0 THEN '12.5' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS quantity,
 CASE WHEN k % 10 = 0 THEN NULL WHEN k % 43 = 0 THEN 'N/A'
      WHEN p_brand = 'Brand#7' AND r_name = 'ASIA' THEN NULL
      WHEN p_type = 'PROMO' AND r_name = 'EUROPE' THEN NULL
      WHEN r_name = 'MIDDLE EAST' AND y || m = '199703' THEN NULL
      ELSE CAST(CAST(p_retailprice + k % 13 AS DECIMAL(18,2)) AS STRING) END AS unit_price,
 CASE WHEN k % 83 = 0 THEN '' ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) END AS total_amount,
 CASE k % 6 WHEN 0 THEN 'mxn' WHEN 1 THEN 'Pesos' WHEN 2 THEN 'USD' WHEN 3 THEN 'euro' WHEN 4 THEN 'gbp' ELSE NULL END AS currency,
 CASE r_name WHEN 'AFRICA' THEN 'north' WHEN 'AMERICA' THEN 'Centro de Mexico' WHEN 'ASIA' THEN 'SUR' WHEN 'EUROPE' THEN 'oeste' ELSE 'East' END AS region,
 'WÃ¢-' || CAST(l_suppkey % 10 AS STRING) AS warehouse,
 CASE k % 8 WHEN 0 THEN 'completed' WHEN 1 THEN 'Finalizado' WHEN 2 THEN 'pending' WHEN 3 THEN 'en proceso' WHEN 4 THEN 'CANCELLED' WHEN 5 THEN 'return' WHEN 6 THEN 'done' ELSE NULL END AS status,
 CASE k % 7 WHEN 0 THEN 'cash' WHEN 1 THEN 'Tarjeta' WHEN 2 THEN 'bank' WHEN 3 THEN 'check' WHEN 4 THEN 'wire transfer' WHEN 5 THEN 'crypto' ELSE NULL END AS payment_method,
 CAST(CAST(l_discount AS DECIMAL(4,2)) AS STRING) AS discount_pct,
 CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS STRING) AS tax_amount,
 CASE WHEN k % 3 = 0 THEN NULL ELSE '  entrega   Ã± urgente ' END AS notes,
 CASE WHEN k % 19 = 0 THEN NULL ELSE 'UÃ±ER0' || CAST(k % 5 AS STRING) END AS created_by,
 CASE WHEN k % 73 = 0 THEN '' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS modified_date
FROM b
"""

# The same joins, with orders joined to their regions before the wide lines: the lines move for orders and parts only.
# The hint keeps Spark from broadcasting the lines of small tables, which leaves the whole extract to one task.
ORDERS_FIRST = {
    " SELECT l.*,": " SELECT /*+ MERGE(o) */ l.*,",
    " r.r_name,": " o.r_name,",
    """ JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
 JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey JOIN part""": """ JOIN (
 SELECT o.*, r.r_name FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
 JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey) o ON o.o_orderkey = l.l_orderkey JOIN part""",
}


def star_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All order lines as raw text transactions."""
    tables = {t: star_table(spark, sf_dir, t) for t in STAR_TABLES}
    sql = TRANSACTIONS_SQL
    for part, narrow in ORDERS_FIRST.items():
        assert sql.count(part) == 1, part
        sql = sql.replace(part, narrow)
    for t in STAR_TABLES:
        sql = sql.replace(f" {t} {t[0]} ", f" {{{t}}} {t[0]} ")
    return spark.sql(sql, **tables)
