"""Inputs the given tables do not have as such: entry rows, delimited lines, file names, logs.

Each comes as a flow and as the SQL that derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settleflow.queries.registry import Tables
from settleflow.schema import schema_of

ENTRIES_SQL = """(
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE l_returnflag WHEN 'A' THEN '1' WHEN 'N' THEN '2' ELSE '3' END AS rt,
         CAST(l_linenumber AS VARCHAR) AS dir,
         CASE l_linestatus WHEN 'F' THEN 'P' ELSE 'S' END AS sendpay,
         '1' || strftime(l_shipdate + INTERVAL 25 YEAR, '%y%m%d') AS setdate,
         l_extendedprice AS rec_prin,
         l_extendedprice * (1 - l_discount) AS pay_prin,
         l_extendedprice * l_tax AS clear_fx,
         l_quantity AS rec_charges,
         l_quantity * l_discount AS clear_charges,
         l_extendedprice * (l_discount - 0.05) AS basic
  FROM lineitem)"""


def entries(t: Tables) -> DataFrame:
    """Settlement entries out of lineitem."""
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    shifted = F.col("l_shipdate") + F.expr("INTERVAL 25 YEAR")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.when(F.col("l_returnflag") == "A", "1").when(F.col("l_returnflag") == "N", "2").otherwise("3").alias("rt"),
        F.col("l_linenumber").cast("string").alias("dir"),
        F.when(F.col("l_linestatus") == "F", "P").otherwise("S").alias("sendpay"),
        F.concat(F.lit("1"), F.date_format(shifted, "yyMMdd")).alias("setdate"),
        price.alias("rec_prin"),
        (price * (1 - discount)).alias("pay_prin"),
        (price * F.col("l_tax")).alias("clear_fx"),
        F.col("l_quantity").alias("rec_charges"),
        (F.col("l_quantity") * discount).alias("clear_charges"),
        (price * (discount - F.lit(0.05))).alias("basic"),
    )


ORDER_SPEC = [
    {"name": "o_orderkey", "type": "id_Long", "key": True, "nullable": False},
    {"name": "o_custkey", "type": "id_Long"},
    {"name": "o_orderstatus", "type": "id_String", "length": 1},
    {"name": "o_totalprice", "type": "id_Double"},
    {"name": "o_orderdate", "type": "id_Date", "pattern": "yyyy-MM-dd"},
    {"name": "o_orderpriority", "type": "id_String"},
]
ORDER_SCHEMA = schema_of(ORDER_SPEC)

# Every tenth line lacks its last field, every seventh has a bad date.
LINES_SQL = """(
  SELECT o_orderkey AS k,
         CAST(o_orderkey AS VARCHAR) || '|' || CAST(o_custkey AS VARCHAR) || '| ' || o_orderstatus || ' |'
         || CAST(o_totalprice AS VARCHAR) || '|'
         || CASE WHEN o_orderkey % 7 = 0 THEN 'bad' ELSE strftime(o_orderdate, '%Y-%m-%d') END
         || CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE '|' || o_orderpriority END AS line
  FROM orders)"""


def lines(t: Tables) -> DataFrame:
    """Orders as delimited lines."""
    key = F.col("o_orderkey")
    day = F.when(key % 7 == 0, "bad").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    last = F.when(key % 10 == 0, "").otherwise(F.concat(F.lit("|"), "o_orderpriority"))
    return t.orders.select(
        key.alias("k"),
        F.concat(
            key.cast("string"),
            F.lit("|"),
            F.col("o_custkey").cast("string"),
            F.lit("| "),
            "o_orderstatus",
            F.lit(" |"),
            F.col("o_totalprice").cast("string"),
            F.lit("|"),
            day,
            last,
        ).alias("line"),
    )


FILES_SQL = """(
  SELECT '/in/' || CASE WHEN c_custkey % 2 = 0 THEN 'ST' ELSE 'AC' END || '/' || name AS path, name
  FROM (SELECT c_custkey,
               CASE WHEN c_custkey % 2 = 0 THEN 'STLMTP_' ELSE 'ACTIV_' END
               || CAST(c_nationkey + 100 AS VARCHAR) || '_' || CAST(c_custkey AS VARCHAR)
               || CASE WHEN c_custkey % 9 = 0 THEN '.csv' ELSE '.txt' END AS name
        FROM customer))"""


def files(t: Tables) -> DataFrame:
    """A file manifest out of customers."""
    key = F.col("c_custkey")
    even = key % 2 == 0
    name = F.concat(
        F.when(even, "STLMTP_").otherwise("ACTIV_"),
        (F.col("c_nationkey") + 100).cast("string"),
        F.lit("_"),
        key.cast("string"),
        F.when(key % 9 == 0, ".csv").otherwise(".txt"),
    )
    return t.customer.select(even.alias("even"), key, name.alias("name")).select(
        F.concat(F.lit("/in/"), F.when(F.col("even"), "ST").otherwise("AC"), F.lit("/"), "name").alias("path"), "name"
    )


MAPPING_SQL = """(
  SELECT CAST(n_nationkey + 100 AS VARCHAR) AS network_id, CAST(n_nationkey % 20 + 1 AS VARCHAR) AS grp_number
  FROM nation WHERE n_nationkey < 20)"""


def mapping(t: Tables) -> DataFrame:
    """Network ids and groups out of nations; five nations stay unmapped."""
    n = F.col("n_nationkey")
    return t.nation.filter(n < 20).select(
        (n + 100).cast("string").alias("network_id"), (n % 20 + 1).cast("string").alias("grp_number")
    )


LOG_SQL = """(
  SELECT user_id AS run_id, event_type AS step,
         CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'RUNNING' ELSE 'COMPLETED' END AS status,
         CAST(floor(value) AS BIGINT) AS rows_in, event_id % 100 AS rows_out,
         CASE WHEN event_type = 'error' THEN props END AS error, ts AS timestamp,
         event_id % 3 AS st_files, event_id % 2 AS ac_files
  FROM events)"""


def step_log(t: Tables) -> DataFrame:
    """A step log out of events."""
    kind = F.col("event_type")
    return t.events.select(
        F.col("user_id").alias("run_id"),
        kind.alias("step"),
        F.when(kind == "error", "FAILED").when(kind == "view", "RUNNING").otherwise("COMPLETED").alias("status"),
        F.floor("value").cast("bigint").alias("rows_in"),
        (F.col("event_id") % 100).alias("rows_out"),
        F.when(kind == "error", F.col("props")).alias("error"),
        F.col("ts").alias("timestamp"),
        (F.col("event_id") % 3).alias("st_files"),
        (F.col("event_id") % 2).alias("ac_files"),
    )


SIGNED_SQL = """(
  SELECT o_orderkey, o_custkey, o_totalprice AS amount FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, -o_totalprice FROM orders WHERE o_orderkey % 4 = 0)"""


def signed(t: Tables) -> DataFrame:
    """Orders, and for every fourth one the entry that cancels it."""
    rows = t.orders.select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("amount"))
    back = rows.filter(F.col("o_orderkey") % 4 == 0).withColumn("amount", -F.col("amount"))
    return rows.unionByName(back)
