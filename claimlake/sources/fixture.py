"""Claims fixture derived from the driver's TPC-H-style tables.

The driver data holds no claims, so this portable query derives the 20 raw
text columns of a claim line (with planted defects) from ``lineitem``,
``orders``, ``supplier`` and ``nation``. The same text is the head of every
DuckDB oracle (``claimlake.oracle``) and, run by Spark, the input of every
registered query, so both sides start from identical rows. Its work grows
with the tables: one output row per line item plus one copy per tenth part.

The claim id joins a line's keys (order, line, part, supplier), its quantity and the
copy as digits, the part padded to 11, the supplier to 10 and the quantity to 2 places:
up to 38 digits, one id per line at any size the keys reach (orders to 13 places). Planted amounts include
one of 11 digits and one that exceeds DECIMAL(18,2).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

LENS_TABLES = ("lineitem", "orders", "supplier", "nation")

# Resubmitted lines: every tenth part's lines stand twice. Spark makes the copies in one
# pass over the join; DuckDB reads it twice (its unnest fails on this plan).
COPIES_SQL = """SELECT base.*, 0 AS copy FROM base
  UNION ALL SELECT base.*, 1 AS copy FROM base WHERE l_partkey % 10 = 0"""
SPARK_COPIES_SQL = "SELECT base.*, explode(IF(l_partkey % 10 = 0, array(0, 1), array(0))) AS copy FROM base"

# Portable SQL (runs unchanged in DuckDB; Spark reads VARCHAR(n) as STRING).
LENS_SQL = """
WITH base AS (
  SELECT CONCAT(CAST(l_orderkey AS VARCHAR(20)), CAST(l_linenumber AS VARCHAR(20)),
                LPAD(CAST(l_partkey AS VARCHAR(20)), CAST(GREATEST(11, LENGTH(CAST(l_partkey AS VARCHAR(20)))) AS INT), '0'),
                LPAD(CAST(l_suppkey AS VARCHAR(20)), CAST(GREATEST(10, LENGTH(CAST(l_suppkey AS VARCHAR(20)))) AS INT), '0'),
                LPAD(CAST(CAST(l_quantity AS INT) AS VARCHAR(20)), CAST(GREATEST(2, LENGTH(CAST(CAST(l_quantity AS INT) AS VARCHAR(20)))) AS INT), '0')) AS k,
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag,
         CAST(l_quantity AS INT) AS qty,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
         CAST(1 - l_discount AS DECIMAL(4,2)) AS keep,
         o_custkey, s_name, s_nationkey, n_name
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
), copies AS (
  {copies}
), coded AS (
  SELECT copies.*, CASE WHEN l_partkey % 499 = 1
    THEN CONCAT('J', LPAD(CAST(l_partkey % 10000 AS VARCHAR(5)), 4, '0')) ELSE CASE l_partkey % 16
    WHEN 0 THEN 'U0003' WHEN 1 THEN 'U0004' WHEN 2 THEN 'U0005' WHEN 3 THEN '87635'
    WHEN 4 THEN '87426' WHEN 5 THEN 'G2023' WHEN 6 THEN 'G2024' WHEN 7 THEN '90837'
    WHEN 8 THEN '90834' WHEN 9 THEN '90853' WHEN 10 THEN '97110' WHEN 11 THEN '97140'
    WHEN 12 THEN '99213' WHEN 13 THEN '20610' WHEN 14 THEN '80053' ELSE '36415' END END AS code
  FROM copies
)
SELECT
  CAST(o_custkey AS VARCHAR(20)) AS claimant_id,
  CONCAT(k, CAST(copy AS VARCHAR(2))) AS claim_item_id,
  CASE l_partkey % 25 WHEN 0 THEN 'Medicare' WHEN 1 THEN 'Group' END AS type,
  CASE WHEN l_orderkey % 997 = 0 THEN 'not-a-date'
       WHEN l_orderkey % 41 = 3 THEN CONCAT(CAST(MONTH(DATE '2020-01-01' + CAST(l_orderkey % 1096 AS INT)) AS VARCHAR(2)), '/',
         CAST(DAY(DATE '2020-01-01' + CAST(l_orderkey % 1096 AS INT)) AS VARCHAR(2)), '/',
         CAST(YEAR(DATE '2020-01-01' + CAST(l_orderkey % 1096 AS INT)) AS VARCHAR(4)))
       ELSE CAST(DATE '2020-01-01' + CAST(l_orderkey % 1096 AS INT) AS VARCHAR(10)) END AS received_date,
  CASE WHEN l_partkey % 331 = 0 THEN 'n/a'
       WHEN l_partkey % 389 = 7 THEN '12345678901.25' WHEN l_partkey % 397 = 5 THEN '98765432109876543.21'
       WHEN l_partkey % 97 = 0 THEN CAST(-price AS VARCHAR(20)) ELSE CAST(price AS VARCHAR(20)) END AS charge_amt,
  CASE WHEN l_suppkey % 11 = 0 AND l_linenumber IN (1, 7) THEN '0.00'
       WHEN l_partkey % 89 = 0 THEN '-5.00'
       WHEN l_returnflag = 'R' THEN CAST(CAST(price * CAST(0.25 AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS VARCHAR(20))
       ELSE CAST(CAST(price * keep AS DECIMAL(12,2)) AS VARCHAR(20)) END AS allowed_amt,
  CONCAT('Z', CAST(l_partkey % 90 + 10 AS VARCHAR(4))) AS diag_code_1,
  CASE WHEN l_partkey % 7 = 0 THEN 'E11.9' END AS diag_code_2,
  CASE WHEN l_partkey % 14 = 0 THEN 'I10' END AS diag_code_3,
  CASE WHEN l_partkey % 21 = 0 THEN 'F41.1' END AS diag_code_4,
  CASE WHEN l_partkey % 28 = 0 THEN '' END AS diag_code_5,
  code AS claim_code,
  CASE WHEN code IN ('97110','97140') THEN CONCAT('therapy ', code) ELSE CONCAT('service ', code) END AS proc_desc,
  CASE l_linenumber WHEN 1 THEN 'gt' WHEN 2 THEN '95' WHEN 3 THEN 'PT' END AS claim_code_modifier,
  CASE WHEN l_linenumber = 1 AND l_partkey % 7 = 0 THEN '59' END AS claim_code_modifier_2,
  CASE WHEN l_partkey % 53 = 0 THEN NULL WHEN l_partkey % 59 = 0 THEN '2.7'
       WHEN l_partkey % 61 = 0 THEN '0' WHEN l_partkey % 67 = 0 THEN 'x' ELSE CAST(qty AS VARCHAR(6)) END AS units,
  CASE l_returnflag WHEN 'A' THEN 'Y' WHEN 'N' THEN 'y' ELSE CASE WHEN l_linenumber > 3 THEN 'N' END END AS oi_in_network,
  CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE s_name END AS service_provider,
  CASE WHEN l_suppkey % 50 = 49 THEN NULL
       WHEN l_suppkey % 4 = 0 THEN CONCAT('12 MAIN ST - 1', LPAD(CAST(l_suppkey AS VARCHAR(20)), CAST(GREATEST(9, LENGTH(CAST(l_suppkey AS VARCHAR(20)))) AS INT), '0'))
       WHEN l_suppkey % 4 = 1 THEN CONCAT('8885 VENICE BLVD STE 104 - 9', LPAD(CAST(l_suppkey AS VARCHAR(20)), CAST(GREATEST(8, LENGTH(CAST(l_suppkey AS VARCHAR(20)))) AS INT), '0'))
       WHEN l_suppkey % 4 = 2 THEN CONCAT('STE 2', LPAD(CAST(l_suppkey AS VARCHAR(20)), CAST(GREATEST(9, LENGTH(CAST(l_suppkey AS VARCHAR(20)))) AS INT), '0'), ' BLDG 7')
       ELSE 'PO BOX 95970' END AS service_address_3,
  CASE WHEN l_suppkey % 17 = 0 THEN n_name
       ELSE CONCAT(n_name, ', ', CASE s_nationkey % 8 WHEN 0 THEN 'NY' WHEN 1 THEN 'CA' WHEN 2 THEN 'TX'
            WHEN 3 THEN 'IL' WHEN 4 THEN 'FL' WHEN 5 THEN 'WA' WHEN 6 THEN 'NJ' ELSE 'HI' END) END AS service_address_2
FROM coded
""".replace("{copies}", COPIES_SQL)


# HotSpot leaves methods of more than 8,000 bytes of bytecode uncompiled, and Spark makes one method of the
# selection: its lookups, dates and paddings are written shorter here, with the same values.
_CODES = re.search(r"CASE l_partkey % 16\s.*?'36415' END", LENS_SQL, re.S).group()
_STATES = re.search(r"CASE s_nationkey % 8 .*?'HI' END", LENS_SQL, re.S).group()
_SLASHED = re.search(r"CONCAT\(CAST\(MONTH\(.*?VARCHAR\(4\)\)\)", LENS_SQL, re.S).group()
_ADDRESSES = re.search(r"WHEN l_suppkey % 4 = 0 .*? BLDG 7'\)", LENS_SQL, re.S).group()
_PADDED = re.compile(r"LPAD\((CAST\((?:\w+|CAST\(\w+ AS INT\)) AS STRING\)), CAST\(GREATEST\((\d+), LENGTH\(\1\)\) AS INT\), '0'\)")


def _lookup(case: str) -> str:
    """A CASE over the remainders from 0 on as an array's entries."""
    of, arms, last = re.fullmatch(r"CASE (\S+ % \d+)\s(.*) ELSE ('\w+') END", case, re.S).groups()
    return f"COALESCE(GET(ARRAY({', '.join(re.findall(r"WHEN \d+ THEN ('\w+')", arms))}), CAST({of} AS INT)), {last})"


SPARK_FORMS = {
    COPIES_SQL: SPARK_COPIES_SQL,
    _CODES: _lookup(_CODES),
    _STATES: _lookup(_STATES),
    _SLASHED: "DATE_FORMAT(DATE '2020-01-01' + CAST(l_orderkey % 1096 AS INT), 'M/d/yyyy')",
    _ADDRESSES: """WHEN l_suppkey % 4 IN (0, 1, 2) THEN CONCAT(GET(ARRAY('12 MAIN ST - 1', '8885 VENICE BLVD STE 104 - 9', 'STE 2'), CAST(l_suppkey % 4 AS INT)),
         REPEAT('0', GET(ARRAY(9, 8, 9), CAST(l_suppkey % 4 AS INT)) - LENGTH(CAST(l_suppkey AS STRING))), CAST(l_suppkey AS STRING),
         GET(ARRAY('', '', ' BLDG 7'), CAST(l_suppkey % 4 AS INT)))""",
}


def spark_lens_sql() -> str:
    """The lens text with table names as DataFrame placeholders for ``spark.sql``."""
    sql = LENS_SQL
    for portable, short in SPARK_FORMS.items():
        sql = sql.replace(portable, short)
    sql = re.sub(r"VARCHAR\(\d+\)", "STRING", sql)
    sql = _PADDED.sub(r"CONCAT(REPEAT('0', \2 - LENGTH(\1)), \1)", sql)
    for t in LENS_TABLES:
        sql = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", sql)
    return sql


def read_tables(spark: SparkSession, sf_dir: str, names=LENS_TABLES) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


def raw_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw claim lines (20 text columns) derived from the tables in ``sf_dir``."""
    return spark.sql(spark_lens_sql(), **read_tables(spark, sf_dir))
