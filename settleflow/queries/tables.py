"""Sources and sinks: tables are written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from settleflow.functions import text as tx
from settleflow.queries.inputs import FILES_SQL, LINES_SQL, MAPPING_SQL, ORDER_SCHEMA, files, lines
from settleflow.queries.registry import Tables, query
from settleflow.schema import schema_of
from settleflow.session import new_folder
from settleflow.sources import (
    BucketTable,
    append_by_name,
    export_parquet,
    fixed_rows,
    group_table_name,
    list_files,
    load_by_name,
    number_files,
    read_all_groups,
    read_delimited,
    read_group_table,
    read_lines,
    read_mapping,
    read_query,
    read_table,
    truncate,
    write_delimited,
    write_groups,
    write_insert,
)

C = F.col
ORDER_COLUMNS = [f.name for f in ORDER_SCHEMA.fields]
_ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
                   CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders"""


def _with_text_date(df):
    return df.withColumn("o_orderdate", C("o_orderdate").cast("string"))


@query("src_01_read_delimited", _ORDERS_SQL)
def _(t: Tables):
    path = new_folder(t.spark, "orders-csv")
    dated = t.orders.withColumn("o_orderdate", C("o_orderdate").cast("date"))
    write_delimited(dated, path, "|", header=True, cols=ORDER_COLUMNS)
    return _with_text_date(read_delimited(t.spark, path, ORDER_SCHEMA, "|", header=1))


@query(
    "src_02_read_options",
    """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE 'n° ' || o_orderpriority END AS note,
         o_orderkey % 10 = 0 AS corrupt FROM orders""",
)
def _(t: Tables):
    path = new_folder(t.spark, "orders-options")
    key = C("o_orderkey")
    cents = F.round(C("o_totalprice") * 100).cast("bigint")
    digits = cents.cast("string")
    euros = F.concat(F.expr("format_number(CAST(round(o_totalprice * 100) AS BIGINT) div 100, 0)"), F.lit(","), F.right(F.lpad(digits, 12, "0"), F.lit(2)))
    amount = F.replace(euros, F.lit(","), F.lit("."))
    # 1.234.56 -> 1.234,56: only the last separator is the decimal one.
    amount = F.regexp_replace(amount, r"\.(\d\d)$", ",$1")
    note = F.when(key % 10 == 0, "").otherwise(F.concat(F.lit(";n° "), "o_orderpriority"))
    text = F.concat(key.cast("string"), F.lit(" ; "), amount, note)
    write_delimited(t.orders.select(text.alias("line")), path, "\u0001", encoding="ISO-8859-1", compression="gzip")
    schema = schema_of(
        [
            {"name": "o_orderkey", "type": "id_Long"},
            {"name": "o_totalprice", "type": "id_Double"},
            {"name": "note", "type": "id_String"},
        ]
    )
    rows = read_delimited(
        t.spark, path, schema, ";", encoding="ISO-8859-1", trim=True, thousands=".", decimal=",", corrupt="raw"
    )
    return rows.withColumn("corrupt", C("raw").isNotNull()).drop("raw")


@query(
    "src_02_header_footer",
    f"SELECT k, line FROM {LINES_SQL}",
)
def _(t: Tables):
    path = new_folder(t.spark, "orders-edges")
    body = lines(t).select(F.expr("k div 4000").alias("file"), F.lit(1).alias("part"), C("k"), "line")
    numbers = body.select("file").distinct()
    head = numbers.select("file", F.lit(0).alias("part"), F.explode(F.sequence(F.lit(0), F.lit(1))).alias("k"))
    head = head.withColumn("line", F.concat(F.lit("header "), C("k").cast("string")))
    foot = numbers.select("file", F.lit(2).alias("part"), F.lit(0).alias("k"), F.lit("footer").alias("line"))
    rows = body.unionByName(head).unionByName(foot).repartition("file").sortWithinPartitions("file", "part", "k")
    rows.select("file", "line").write.partitionBy("file").text(path)
    kept = read_lines(t.spark, path, header=2, footer=1)
    return kept.select(F.split_part("line", F.lit("|"), F.lit(1)).cast("bigint").alias("k"), "line")


@query("src_03_read_lines", f"SELECT line FROM {LINES_SQL}")
def _(t: Tables):
    path = new_folder(t.spark, "lines")
    lines(t).select("line").write.text(path)
    return read_lines(t.spark, path)


@query("src_04_read_table", "SELECT c_custkey, c_name FROM customer")
def _(t: Tables):
    return read_table(t.spark, f"{t.folder}/customer.parquet").select("c_custkey", "c_name")


_GRP = "CAST(c_nationkey % 20 + 1 AS VARCHAR)"


@query("src_05_all_groups", f"SELECT c_custkey, {_GRP} AS grp FROM customer WHERE {_GRP} IN ('3', '7', '16')")
def _(t: Tables):
    path = new_folder(t.spark, "groups")
    write_groups(t.customer.withColumn("grp", (C("c_nationkey") % 20 + 1).cast("string")), path)
    return read_all_groups(t.spark, path, ["3", "7", "16"]).select("c_custkey", "grp")


@query("src_05_group_table", f"SELECT c_custkey, {_GRP} AS grp FROM customer WHERE {_GRP} = '16'")
def _(t: Tables):
    rows = t.customer.filter(C("c_nationkey") % 20 + 1 == 16)
    rows.createOrReplaceTempView(group_table_name("entry_grp{N}", 16, "_test"))
    return read_group_table(t.spark, "entry_grp{N}", 16, "_test").select("c_custkey", "grp")


@query("src_06_read_query", "SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey")
def _(t: Tables):
    sql = "SELECT o_custkey, count(*) AS n FROM {orders} WHERE o_orderstatus = :status GROUP BY o_custkey"
    return read_query(t.spark, sql, {"status": "F"}, orders=t.orders)


@query(
    "src_07_fixed_rows",
    """SELECT c_name AS note, c_mktsegment AS kind, c_custkey AS amount FROM customer
       UNION ALL SELECT CAST(NULL AS VARCHAR), 'ST', 5 FROM range(2)""",
)
def _(t: Tables):
    schema = schema_of(
        [
            {"name": "note", "type": "id_String"},
            {"name": "kind", "type": "id_String", "default": "ST"},
            {"name": "amount", "type": "id_Long"},
        ]
    )
    rows = t.customer.selectExpr("c_name AS note", "c_mktsegment AS kind", "c_custkey AS amount")
    return rows.unionByName(fixed_rows(t.spark, schema, {"amount": 5}, n=2))


@query("src_08_list_files", "SELECT DISTINCT 'o_orderstatus=' || o_orderstatus AS dir, TRUE AS filled FROM orders")
def _(t: Tables):
    path = new_folder(t.spark, "listing")
    t.orders.write.partitionBy("o_orderstatus").parquet(path)
    found = list_files(t.spark, path, "PART-*.parquet", order="mtime", desc=True, exclude="*.crc", recursive=True, case_sensitive=False)
    return found.groupBy(F.element_at(F.split("path", "/"), -2).alias("dir")).agg((F.min("length") > 0).alias("filled"))


@query("src_09_read_mapping", f"SELECT network_id, grp_number FROM {MAPPING_SQL}")
def _(t: Tables):
    n = C("n_nationkey")
    rows = t.nation.select((n + 100).alias("network_id"), F.when(n < 20, n % 20 + 1).alias("grp_number"))
    return read_mapping(t.spark, rows, "network_id", "grp_number")


@query(
    "src_10_number_files",
    f"""SELECT row_number() OVER (ORDER BY name) AS iteration, path, name, regexp_replace(path, '/[^/]*$', '') AS dir
        FROM {FILES_SQL} WHERE starts_with(name, 'STL') ORDER BY name LIMIT 15""",
)
def _(t: Tables):
    return number_files(files(t).filter(tx.mask_match(C("name"), "STL*")), 15)


@query("win_05_limit", "SELECT least(count(*), 1000) AS n, least(count(*), 1000) AS known FROM orders")
def _(t: Tables):
    return _sampled(t, limit=1000)


@query("win_05_random_rows", "SELECT least(count(*), 500) AS n, least(count(*), 500) AS known FROM orders")
def _(t: Tables):
    return _sampled(t, random_rows=500)


def _sampled(t: Tables, **rows):
    path = new_folder(t.spark, "sampled")
    write_delimited(t.orders, path, "|", cols=["o_orderkey"])
    schema = schema_of([{"name": "k", "type": "id_Long"}])
    some = read_delimited(t.spark, path, schema, "|", **rows)
    joined = some.join(t.orders.select("o_orderkey"), C("k") == C("o_orderkey"), "left")
    return joined.agg(F.countDistinct("k").alias("n"), F.count("o_orderkey").alias("known"))


# --- sinks -----------------------------------------------------------------------------------


@query(
    "snk_01_write_insert",
    "SELECT c_custkey, c_name FROM customer UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0",
)
def _(t: Tables):
    path = new_folder(t.spark, "insert")
    write_insert(t.supplier.selectExpr("s_suppkey AS c_custkey", "s_name AS c_name"), path)
    write_insert(t.customer, path, ["c_custkey", "c_name"], mode="overwrite")
    write_insert(t.customer.filter("c_acctbal > 0"), path, ["c_custkey", "c_name"])
    return t.spark.read.parquet(path)


@query("snk_05_write_delimited", "SELECT doc_id, lang, text FROM documents")
def _(t: Tables):
    path = new_folder(t.spark, "documents")
    write_delimited(t.documents.select("doc_id", "lang", "text"), path, ";", header=True, compression="gzip", rows_per_file=300)
    schema = schema_of(
        [{"name": "doc_id", "type": "Long"}, {"name": "lang", "type": "String"}, {"name": "text", "type": "String"}]
    )
    return read_delimited(t.spark, path, schema, ";", header=1, multi_line=True, line_sep="\n")


def _exported(t: Tables):
    broken = t.nation.select(F.raise_error(F.concat(F.lit("bad row "), "n_name")).cast("string").alias("x"))
    folder = new_folder(t.spark, "export")
    tables = {"orders": t.orders, "broken": broken, "customer": t.customer, "lineitem": t.lineitem}
    return export_parquet(t.spark, tables, folder)


@query(
    "snk_06_export_parquet",
    """SELECT 'orders' AS "table", 'ok' AS status, TRUE AS filled, count(*) AS rows FROM orders
       UNION ALL SELECT 'customer', 'ok', TRUE, count(*) FROM customer
       UNION ALL SELECT 'lineitem', 'ok', TRUE, count(*) FROM lineitem
       UNION ALL SELECT 'broken', 'error', FALSE, NULL""",
)
def _(t: Tables):
    done = _exported(t)
    paths = [r["path"] for r in done.filter("status = 'ok'").collect()]
    table = F.regexp_extract(C("_metadata.file_path"), r"/([^/]*)\.parquet/[^/]*$", 1)
    counts = None
    for path in paths:
        one = t.spark.read.parquet(path).groupBy(table.alias("table")).agg(F.count(F.lit(1)).alias("rows"))
        counts = one if counts is None else counts.unionByName(one)
    return done.join(counts, "table", "left").select(
        "table", "status", (F.coalesce("size", F.lit(0)) > 0).alias("filled"), "rows"
    )


@query(
    "snk_07_append_by_name",
    """SELECT c_custkey, c_name, c_acctbal FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
)
def _(t: Tables):
    rows = t.supplier.selectExpr("s_name AS C_Name", "s_nationkey AS other", "s_suppkey AS C_CUSTKEY")
    return append_by_name(rows, t.customer.select("c_custkey", "c_name", "c_acctbal"))


@query(
    "snk_07_load_by_name",
    """SELECT 'orders' AS "table", 'ok' AS status, count(*) AS rows, 2 * count(*) AS total FROM orders
       UNION ALL SELECT 'missing', 'error', NULL, NULL""",
)
def _(t: Tables):
    target, exported = new_folder(t.spark, "target"), new_folder(t.spark, "exported")
    write_insert(t.orders, target)
    write_insert(t.orders.select(*[C(c).alias(c.upper()) for c in t.orders.columns]), exported)
    done = load_by_name(t.spark, {"orders": exported, "missing": exported + "-none"}, {"orders": target, "missing": target})
    total = t.spark.read.parquet(target).agg(F.count(F.lit(1)).alias("total")).withColumn("of", F.lit("orders"))
    return done.join(total, C("table") == C("of"), "left").select("table", "status", "rows", "total")


@query("snk_08_truncate", "SELECT count(*) AS before, CAST(0 AS BIGINT) AS after FROM orders")
def _(t: Tables):
    before, after = new_folder(t.spark, "before"), new_folder(t.spark, "after")
    write_insert(t.orders, before)
    write_insert(truncate(t.spark.read.parquet(before)), after)
    left = t.spark.read.parquet(before).select(F.lit(1).alias("a"), F.lit(0).alias("b"))
    right = t.spark.read.parquet(after).select(F.lit(0).alias("a"), F.lit(1).alias("b"))
    return left.union(right).agg(F.sum("a").cast("bigint").alias("before"), F.sum("b").cast("bigint").alias("after"))


# --- keyed writes in place ----------------------------------------------------------------------

_WIDTH = "(SELECT max(o_orderkey) // 64 + 1 FROM orders)"
_CHANGED = f"""(SELECT l_orderkey AS k, max(l_extendedprice) AS price FROM lineitem
    WHERE l_orderkey // {_WIDTH} IN (3, 40) AND l_orderkey % 5 = 0 GROUP BY l_orderkey)"""


def _bucketed(t: Tables):
    """Orders in 64 ranges of their keys, and the changes of a fifth of two ranges."""
    width = t.orders.agg(F.expr("max(o_orderkey) div 64 + 1")).first()[0]
    rows = t.orders.select(C("o_orderkey").alias("k"), C("o_totalprice").alias("price"))
    table = BucketTable(t.spark, new_folder(t.spark, "buckets"), ["k"], rows.schema, by=F.expr(f"k div {width}L")).create(rows)
    changes = t.lineitem.filter(F.expr(f"l_orderkey div {width}L IN (3, 40) AND l_orderkey % 5 = 0"))
    return table, width, changes.groupBy(C("l_orderkey").alias("k")).agg(F.max("l_extendedprice").alias("price"))


@query(
    "snk_02_update_buckets",
    f"""SELECT o_orderkey AS k, coalesce(price, o_totalprice) AS price,
          o_orderkey // {_WIDTH} IN (SELECT k // {_WIDTH} FROM {_CHANGED}) AS replaced
        FROM orders LEFT JOIN {_CHANGED} ON k = o_orderkey""",
)
def _(t: Tables):
    table, width, changes = _bucketed(t)
    replaced = table.update(changes)
    return table.read().withColumn("replaced", F.expr(f"k div {width}L").isin(*replaced))


@query(
    "snk_03_upsert_buckets",
    f"""SELECT o_orderkey AS k, coalesce(price, o_totalprice) AS price FROM orders LEFT JOIN {_CHANGED} ON k = o_orderkey
        UNION ALL SELECT k + (SELECT max(o_orderkey) FROM orders), price FROM {_CHANGED}""",
)
def _(t: Tables):
    table, _, changes = _bucketed(t)
    last = t.orders.agg(F.max("o_orderkey")).first()[0]
    table.upsert(changes.unionByName(changes.withColumn("k", C("k") + last)))
    return table.read()
