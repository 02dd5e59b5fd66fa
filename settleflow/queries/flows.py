"""Dedup, sequences, joins, row mapping, set operations and merges."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settleflow.functions import settlement as st
from settleflow.functions import text as tx
from settleflow.operators import (
    buffer,
    cap_per_group,
    context_row,
    dup_rows,
    extract_fields,
    keep_lookup,
    link_ids,
    lookup_join,
    lookup_rejects,
    map_rows,
    matched,
    merge_cases,
    merge_flows,
    merge_update,
    merge_upsert,
    net_zero,
    register_routine,
    reject_lines,
    rename,
    route,
    row_program,
    split_rejects,
    sql_row,
    uniq_rows,
    unmatched,
    update_status,
    where,
    with_context,
    with_sequence,
    with_vars,
)
from settleflow.queries.inputs import (
    ENTRIES_SQL,
    FILES_SQL,
    LINES_SQL,
    MAPPING_SQL,
    ORDER_SCHEMA,
    SIGNED_SQL,
    entries,
    files,
    lines,
    mapping,
    signed,
)
from settleflow.queries.registry import Tables, query
from settleflow.schema import apply_schema, schema_rules
from settleflow.session import new_folder
from settleflow.sources import read_route, write_routes

C = F.col

# --- dedup -----------------------------------------------------------------------------------

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_partkey", "l_suppkey"]
LINE_COLS = [*LINE_KEYS, *LINE_ORDER, "l_extendedprice"]
_RANKED = """(SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                          ORDER BY l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem)"""
_LINE_SQL = f"SELECT {', '.join(LINE_COLS)} FROM {_RANKED}"


@query("ded_01_uniq_rows", f"{_LINE_SQL} WHERE rn = 1")
def _(t: Tables):
    return uniq_rows(t.lineitem, LINE_KEYS, LINE_ORDER, LINE_COLS)


@query("ded_02_distinct", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def _(t: Tables):
    return uniq_rows(t.lineitem, cols=["l_suppkey", "l_returnflag", "l_linestatus"])


@query("ded_03_dup_rows", f"{_LINE_SQL} WHERE rn > 1")
def _(t: Tables):
    return dup_rows(t.lineitem, LINE_KEYS, LINE_ORDER, LINE_COLS)


@query("ded_03_dup_rows_once", f"{_LINE_SQL} WHERE rn = 2")
def _(t: Tables):
    return dup_rows(t.lineitem, LINE_KEYS, LINE_ORDER, LINE_COLS, only_once=True)


@query(
    "ded_03_dup_rows_copies",
    """SELECT l_returnflag, l_linenumber, count(*) - 1 AS copies FROM lineitem GROUP BY 1, 2""",
)
def _(t: Tables):
    flags = t.lineitem.select("l_returnflag", "l_linenumber")
    later = dup_rows(flags, ["l_returnflag", "l_linenumber"], ["l_returnflag"])
    return later.groupBy("l_returnflag", "l_linenumber").agg(F.count(F.lit(1)).alias("copies"))


_NETTED = f"""(SELECT *, count(*) OVER (PARTITION BY o_orderkey) > 1
               AND abs(sum(CAST(amount AS DECIMAL(18,4))) OVER (PARTITION BY o_orderkey)) = 0 AS netted FROM {SIGNED_SQL})"""


@query("agg_05_net_zero_kept", f"SELECT o_orderkey, o_custkey, amount FROM {_NETTED} WHERE NOT netted")
def _(t: Tables):
    return net_zero(signed(t), ["o_orderkey"], "amount")[0]


@query("agg_05_net_zero_netted", f"SELECT o_orderkey, o_custkey, amount FROM {_NETTED} WHERE netted")
def _(t: Tables):
    return net_zero(signed(t), ["o_orderkey"], "amount")[1]


# --- sequences, tops -------------------------------------------------------------------------


@query(
    "win_01_row_number",
    """SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n
       FROM orders""",
)
def _(t: Tables):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return with_sequence(rows, "n", ["o_orderdate", "o_orderkey"], partition_by=["o_custkey"]).drop("o_orderdate")


@query(
    "win_02_sequence",
    f"""SELECT {', '.join(LINE_KEYS + LINE_ORDER)},
          row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS n FROM lineitem""",
)
def _(t: Tables):
    rows = t.lineitem.select(*LINE_KEYS, *LINE_ORDER)
    return with_sequence(rows, "n", [*LINE_KEYS, *LINE_ORDER])


@query(
    "win_02_sequence_step",
    """SELECT o_orderkey, o_orderstatus,
         CAST(100 + 5 * (row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) - 1)
              AS BIGINT) AS n
       FROM orders""",
)
def _(t: Tables):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    order = [C("o_totalprice").desc(), C("o_orderkey")]
    return with_sequence(rows, "n", order, 100, 5, ["o_orderstatus"]).drop("o_totalprice")


@query(
    "win_03_ordered_files",
    f"SELECT name, row_number() OVER (ORDER BY name) AS n FROM {FILES_SQL}",
)
def _(t: Tables):
    return with_sequence(files(t).select("name"), "n", ["name"])


@query(
    "win_04_cap_per_group",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, n FROM
         (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_returnflag
                                       ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS n
          FROM lineitem) WHERE n <= 15""",
)
def _(t: Tables):
    order = [C("l_extendedprice").desc(), C("l_orderkey"), C("l_linenumber"), C("l_partkey")]
    top = cap_per_group(t.lineitem, ["l_suppkey", "l_returnflag"], order, 15, rank="n")
    return top.select(*LINE_KEYS, *LINE_ORDER, "n")


# --- joins -----------------------------------------------------------------------------------


@query(
    "jn_01_lookup_left",
    f"""SELECT {', '.join(LINE_COLS)}, o_orderstatus AS o_status, o_totalprice AS o_total
        FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey""",
)
def _(t: Tables):
    open_orders = t.orders.filter("o_orderstatus <> 'P'").select(
        C("o_orderkey").alias("key"), C("o_orderstatus").alias("status"), C("o_totalprice").alias("total")
    )
    return lookup_join(t.lineitem.select(*LINE_COLS), open_orders, [("l_orderkey", "key")], name="o").drop("o_key")


@query(
    "jn_01_lookup_left_salted",
    """SELECT event_id, e.user_id, v.n FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 4 ELSE user_id END AS user_id FROM events) e
       LEFT JOIN (SELECT user_id, count(*) AS n FROM events WHERE user_id % 2 = 0 GROUP BY user_id) v ON e.user_id = v.user_id""",
)
def _(t: Tables):
    """A third of the rows has one key, which is spread over 16 tasks."""
    counts = t.events.filter("user_id % 2 = 0").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    rows = t.events.select("event_id", F.when(C("event_id") % 3 == 0, 4).otherwise(C("user_id")).cast("bigint").alias("user_id"))
    out = lookup_join(rows, counts, [("user_id", "user_id")], name="v", salts=16, hot_rows=100)
    return out.select("event_id", "user_id", C("v_n").alias("n"))


@query(
    "jn_02_lookup_inner",
    """SELECT o_orderkey, c_name, c_mktsegment FROM orders
       JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""",
)
def _(t: Tables):
    solvent = t.customer.filter("c_acctbal > 0").select("c_custkey", "c_name", "c_mktsegment")
    out = lookup_join(t.orders.select("o_orderkey", "o_custkey"), solvent, [("o_custkey", "c_custkey")], "inner")
    return out.select("o_orderkey", "c_name", "c_mktsegment")


@query(
    "jn_03_lookup_expression_keys",
    """SELECT o_orderkey, n_name FROM orders LEFT JOIN nation
       ON o_custkey % 30 = n_nationkey AND o_orderkey % 5 = n_regionkey""",
)
def _(t: Tables):
    on = [("o_custkey % 30", "n_nationkey"), (C("o_orderkey") % 5, "n_regionkey")]
    return lookup_join(t.orders.select("o_orderkey", "o_custkey"), t.nation, on).select("o_orderkey", "n_name")


@query(
    "jn_04_lookup_chain",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, c_name, n_name, r_name FROM lineitem
       LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def _(t: Tables):
    flow = t.lineitem.select(*LINE_KEYS, *LINE_ORDER)
    flow = lookup_join(flow, t.orders.select("o_orderkey", "o_custkey"), [("l_orderkey", "o_orderkey")])
    flow = lookup_join(flow, t.customer.select("c_custkey", "c_name", "c_nationkey"), [("o_custkey", "c_custkey")])
    flow = lookup_join(flow, t.nation, [("c_nationkey", "n_nationkey")])
    flow = lookup_join(flow, t.region, [("n_regionkey", "r_regionkey")])
    return flow.select(*LINE_KEYS, *LINE_ORDER, "c_name", "n_name", "r_name")


@query(
    "jn_05_lookup_first_match",
    """SELECT c_custkey, o_orderkey AS first_order FROM customer LEFT JOIN
         (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
       ON c_custkey = o_custkey AND rn = 1""",
)
def _(t: Tables):
    orders = t.orders.select("o_custkey", "o_orderdate", "o_orderkey")
    out = lookup_join(
        t.customer.select("c_custkey"), orders, [("c_custkey", "o_custkey")], match="first", order_by=["o_orderdate", "o_orderkey"]
    )
    return out.select("c_custkey", C("o_orderkey").alias("first_order"))


@query(
    "jn_05_lookup_last_match",
    """SELECT c_custkey, o_orderkey AS last_order FROM customer LEFT JOIN
         (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
       ON c_custkey = o_custkey AND rn = 1""",
)
def _(t: Tables):
    orders = t.orders.select("o_custkey", "o_orderdate", "o_orderkey")
    out = lookup_join(t.customer.select("c_custkey"), orders, [("c_custkey", "o_custkey")], match="last", order_by=["o_orderdate", "o_orderkey"])
    return out.select("c_custkey", C("o_orderkey").alias("last_order"))


@query(
    "jn_01_lookup_kept",
    "SELECT l_orderkey, l_linenumber, o_orderstatus, o_totalprice FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 3 <> 0) ON o_orderkey = l_orderkey",
)
def _(t: Tables):
    """A lookup kept by key: the join reads its buckets as they are."""
    buckets = max(16, int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    rows = t.orders.filter("o_orderkey % 3 <> 0").select("o_orderkey", "o_orderstatus", "o_totalprice")
    kept = keep_lookup(rows, ["o_orderkey"], f"kept_{uuid.uuid4().hex}", buckets, new_folder(t.spark, "kept"))
    out = lookup_join(t.lineitem.select("l_orderkey", "l_linenumber"), kept, [("l_orderkey", "o_orderkey")])
    return out.select("l_orderkey", "l_linenumber", "o_orderstatus", "o_totalprice")


@query("jn_06_constants", "SELECT o_orderkey, 7 AS ctx_loop, 'ST' AS ctx_kind FROM orders")
def _(t: Tables):
    return with_context(t.orders.select("o_orderkey"), {"loop": F.lit(7), "kind": "'ST'"})


@query(
    "jn_07_unmatched",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def _(t: Tables):
    return unmatched(t.orders, t.lineitem, ["o_orderkey"], ["l_orderkey"]).select("o_orderkey", "o_custkey")


@query(
    "jn_08_matched",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
)
def _(t: Tables):
    back = t.lineitem.filter("l_returnflag = 'R'")
    return matched(t.orders, back, ["o_orderkey"], ["l_orderkey"]).select("o_orderkey", "o_custkey")


@query(
    "jn_09_file_mapping",
    f"""SELECT name, grp_number FROM {FILES_SQL} f JOIN {MAPPING_SQL} m
        ON nullif(regexp_extract(name, '[_](\\d{{3,6}})[_.]', 1), '') = network_id""",
)
def _(t: Tables):
    out = lookup_join(files(t), mapping(t), [(tx.network_id(C("name")), "network_id")], "inner")
    return out.select("name", "grp_number")


# --- rows ------------------------------------------------------------------------------------


@query("prj_01_map_rows", "SELECT o_orderkey, o_totalprice * 2 AS twice, upper(o_orderpriority) AS prio FROM orders")
def _(t: Tables):
    return map_rows(t.orders, {"o_orderkey": None, "twice": "o_totalprice * 2", "prio": F.upper("o_orderpriority")})


@query(
    "prj_02_with_vars",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, net, net * (1 + l_tax) AS gross
       FROM (SELECT *, l_extendedprice * (1 - l_discount) AS net FROM lineitem)""",
)
def _(t: Tables):
    flow = with_vars(t.lineitem, {"net": "l_extendedprice * (1 - l_discount)", "gross": C("net") * (1 + C("l_tax"))})
    return flow.select(*LINE_KEYS, *LINE_ORDER, "net", "gross")


@query("prj_03_where", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000")
def _(t: Tables):
    return where(t.orders, "o_orderstatus = 'F' AND o_totalprice > 200000").select("o_orderkey", "o_totalprice")


def _routed(t: Tables):
    return route(
        t.orders,
        {
            "large": ("o_totalprice > 250000", {"o_orderkey": None, "tag": "'large'"}),
            "final": (C("o_orderstatus") == "F", {"o_orderkey": None, "tag": F.lit("final")}),
            "odd": ("nullif(o_orderstatus, 'P') = 'O' AND o_custkey % 2 = 1", {"o_orderkey": None, "tag": "'odd'"}),
        },
        reject="rest",
    )


@query(
    "prj_04_route",
    """SELECT o_orderkey, 'large' AS tag FROM orders WHERE o_totalprice > 250000
       UNION ALL SELECT o_orderkey, 'final' FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, 'odd' FROM orders WHERE o_orderstatus = 'O' AND o_custkey % 2 = 1""",
)
def _(t: Tables):
    flows = _routed(t)
    return merge_flows(flows["large"], flows["final"], flows["odd"])


@query(
    "prj_05_route_reject",
    """SELECT o_orderkey, o_orderstatus FROM orders
       WHERE NOT (o_totalprice > 250000 OR o_orderstatus = 'F' OR (o_orderstatus = 'O' AND o_custkey % 2 = 1))""",
)
def _(t: Tables):
    return _routed(t)["rest"].select("o_orderkey", "o_orderstatus")


@query(
    "prj_04_routes_written",
    """SELECT 'large' AS output, o_orderkey AS k, o_totalprice / 2 AS half, NULL AS day, 1 + 0 * o_orderkey AS n FROM orders WHERE o_totalprice > 250000
       UNION ALL SELECT 'final', o_orderkey, NULL, strftime(o_orderdate, '%Y-%m-%d'), 1 FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT 'rest', o_orderkey, o_totalprice, NULL, 1 FROM orders WHERE NOT (o_totalprice > 250000 OR o_orderstatus = 'F')
       UNION ALL SELECT 'rows of ' || name, NULL, NULL, NULL, n FROM (
         SELECT 'large' AS name, count(*) AS n FROM orders WHERE o_totalprice > 250000 UNION ALL
         SELECT 'final', count(*) FROM orders WHERE o_orderstatus = 'F' UNION ALL
         SELECT 'none', 0 UNION ALL
         SELECT 'rest', count(*) FROM orders WHERE NOT (o_totalprice > 250000 OR o_orderstatus = 'F'))""",
)
def _(t: Tables):
    """Outputs of different columns, written in one pass, and the counts of the manifest."""
    path = new_folder(t.spark, "routes")
    outputs = {
        "large": ("o_totalprice > 250000", {"k": "o_orderkey", "half": "o_totalprice / 2"}),
        "final": ("o_orderstatus = 'F'", {"k": "o_orderkey", "day": "date_format(o_orderdate, 'yyyy-MM-dd')"}),
        "none": ("o_orderkey < 0", {"k": "o_orderkey"}),
    }
    manifest = write_routes(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate"), outputs, path, reject="rest")
    row = lambda name, **c: read_route(t.spark, path, name).select(
        F.lit(name).alias("output"), C(c.get("k", "k")).alias("k"), c.get("half", F.lit(None).cast("double")).alias("half"),
        c.get("day", F.lit(None).cast("string")).alias("day"), F.lit(1).cast("bigint").alias("n"),
    )
    flows = [row("large", half=C("half")), row("final", day=C("day")), row("none"), row("rest", k="o_orderkey", half=C("o_totalprice"))]
    counts = manifest.select(
        F.concat(F.lit("rows of "), "output").alias("output"), F.lit(None).cast("bigint").alias("k"), F.lit(None).cast("double").alias("half"),
        F.lit(None).cast("string").alias("day"), C("rows").alias("n"),
    )
    return merge_flows(*flows, counts)


@query(
    "prj_06_lookup_rejects",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)",
)
def _(t: Tables):
    solvent = t.customer.filter("c_acctbal > 0")
    return lookup_rejects(t.orders.select("o_orderkey", "o_custkey"), solvent, [("o_custkey", "c_custkey")])


@query(
    "prj_07_row_program",
    f"""SELECT l_orderkey AS id, l_linenumber AS line, l_partkey AS part, l_suppkey AS supp,
          rec_prin - pay_prin - clear_fx AS gain, CASE WHEN rt = '2' THEN -clear_fx ELSE clear_fx END AS fx
        FROM {ENTRIES_SQL}""",
)
def _(t: Tables):
    return row_program(
        entries(t),
        {"diff": "rec_prin - pay_prin", "net": "diff - clear_fx"},
        {
            "id": "l_orderkey",
            "line": "l_linenumber",
            "part": "l_partkey",
            "supp": "l_suppkey",
            "gain": "net",
            "fx": st.rt2_negate(C("rt"), C("clear_fx")),
        },
    )


@query(
    "prj_08_context_row",
    "SELECT c_custkey, 'RUN' AS ctx_mode, 14 AS ctx_loops FROM customer",
)
def _(t: Tables):
    row = context_row(t.spark, {"mode": "'RUN'", "loops": "15 - 1"})
    values = [row.select(c).scalar().alias(c) for c in row.columns]
    return t.customer.select("c_custkey", *values)


_PIECES = """(SELECT k, list_transform(string_split(line, '|'), lambda x: trim(x)) AS p FROM """ + LINES_SQL + ")"


@query(
    "prj_09_extract_fields",
    f"""SELECT k, CAST(p[1] AS BIGINT) AS o_orderkey, CAST(p[2] AS BIGINT) AS o_custkey, p[3] AS o_orderstatus,
          CAST(p[4] AS DOUBLE) AS o_totalprice, CAST(TRY_CAST(p[5] AS DATE) AS VARCHAR) AS o_orderdate, p[6] AS o_orderpriority
        FROM {_PIECES}""",
)
def _(t: Tables):
    out = extract_fields(lines(t), ORDER_SCHEMA, sep="|", keep=["k"], on_error="null")
    return out.withColumn("o_orderdate", C("o_orderdate").cast("string"))


def _checked(t: Tables):
    return reject_lines(lines(t), "line", "|", field_count=6, dates={5: "yyyy-MM-dd"})


@query(
    "prj_10_checked_lines",
    "SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderkey % 7 <> 0",
)
def _(t: Tables):
    return _checked(t)[0].select("k")


@query(
    "prj_10_rejected_lines",
    """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 10 = 0 THEN 'field count' ELSE 'date in field 5' END AS reject_reason
       FROM orders WHERE o_orderkey % 10 = 0 OR o_orderkey % 7 = 0""",
)
def _(t: Tables):
    return _checked(t)[1].select("k", "reject_reason")


@query("prj_11_rename", "SELECT o_orderkey AS id, o_custkey AS customer, o_orderstatus FROM orders")
def _(t: Tables):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    return rename(rows, {"o_orderkey": "id", "o_custkey": "customer"})


@query(
    "prj_12_buffer",
    """SELECT o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 1
       UNION ALL SELECT o_orderpriority, count(*) FROM orders GROUP BY 1""",
)
def _(t: Tables):
    # Two outputs read the buffer; it is freed with the session, as they are evaluated later.
    kept = buffer(t.orders.select("o_orderstatus", "o_orderpriority"))
    counts = [kept.groupBy(C(c).alias("value")).agg(F.count(F.lit(1)).alias("n")) for c in kept.columns]
    return counts[0].unionByName(counts[1])


_FREE_SQL = """SELECT c_nationkey, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM {flow}
               WHERE c_acctbal > {least} GROUP BY c_nationkey"""


@query("prj_13_sql_row", _FREE_SQL.format(flow="customer", least="100"))
def _(t: Tables):
    body = "BEGIN " + _FREE_SQL.format(flow="{flow}", least=":least") + "; END"
    return sql_row(t.spark, body, {"least": 100}, flow=t.customer)


_RAW_ORDERS = """(SELECT CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS o_orderkey,
    CAST(o_custkey AS VARCHAR) AS o_custkey,
    CASE WHEN o_orderkey % 13 = 0 THEN 'long' ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderkey % 7 = 0 THEN 'bad' ELSE CAST(o_totalprice AS VARCHAR) END AS o_totalprice,
    strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders)"""


def _raw_orders(t: Tables):
    key = C("o_orderkey")
    return t.orders.select(
        F.when(key % 11 != 0, key.cast("string")).alias("o_orderkey"),
        C("o_custkey").cast("string").alias("o_custkey"),
        F.when(key % 13 == 0, "long").otherwise(C("o_orderstatus")).alias("o_orderstatus"),
        F.when(key % 7 == 0, "bad").otherwise(C("o_totalprice").cast("string")).alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        "o_orderpriority",
    )


@query(
    "prj_14_apply_schema",
    f"""SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus,
          TRY_CAST(o_totalprice AS DOUBLE) AS o_totalprice, o_orderdate, o_orderpriority FROM {_RAW_ORDERS}""",
)
def _(t: Tables):
    typed = apply_schema(_raw_orders(t), ORDER_SCHEMA)
    return typed.withColumn("o_orderdate", C("o_orderdate").cast("string"))


@query(
    "snk_09_split_rejects",
    f"""SELECT * FROM (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey IS NULL THEN 'o_orderkey: null'
             WHEN length(o_orderstatus) > 1 THEN 'o_orderstatus: too long'
             WHEN o_totalprice = 'bad' THEN 'o_totalprice: not double' END AS reject_reason
           FROM {_RAW_ORDERS}) WHERE reject_reason IS NOT NULL""",
)
def _(t: Tables):
    _, rejects = split_rejects(_raw_orders(t), schema_rules(ORDER_SCHEMA))
    return rejects.select("o_orderkey", "o_custkey", "reject_reason")


# --- set operations --------------------------------------------------------------------------


@query(
    "set_01_merge_flows",
    """SELECT c_custkey AS k, c_name AS name, c_acctbal AS bal FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier
       UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal < 0""",
)
def _(t: Tables):
    buyers = t.customer.selectExpr("c_custkey AS k", "c_name AS name", "c_acctbal AS bal")
    sellers = t.supplier.selectExpr("s_name AS name", "s_suppkey AS k", "s_acctbal AS bal")
    return merge_flows(buyers, sellers, buyers.filter("bal < 0"))


@query("set_02_distinct", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def _(t: Tables):
    return uniq_rows(t.orders, cols=["o_custkey", "o_orderstatus"])


@query(
    "set_03_difference",
    "SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)",
)
def _(t: Tables):
    bulk = t.lineitem.filter("l_quantity > 45")
    return unmatched(t.part, bulk, ["p_partkey"], ["l_partkey"]).select("p_partkey", "p_name")


# --- merges ----------------------------------------------------------------------------------


def _returns(t: Tables):
    """New order totals out of returned lines, several per order."""
    back = t.lineitem.filter("l_returnflag = 'R'")
    return back.selectExpr("l_orderkey AS o_orderkey", "l_extendedprice AS o_totalprice", "l_linenumber", "l_partkey", "l_suppkey")


_FIRST_RETURN = """(SELECT l_orderkey AS k, l_extendedprice AS p, row_number() OVER
    (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem WHERE l_returnflag = 'R')"""


@query(
    "snk_02_merge_update",
    f"""SELECT o_orderkey, o_custkey, CASE WHEN k IS NOT NULL THEN p ELSE o_totalprice END AS o_totalprice
        FROM orders LEFT JOIN (SELECT * FROM {_FIRST_RETURN} WHERE rn = 1) ON o_orderkey = k""",
)
def _(t: Tables):
    target = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return merge_update(target, _returns(t), ["o_orderkey"], ["o_totalprice"], ["l_linenumber", "l_partkey", "l_suppkey"])


@query(
    "snk_03_merge_upsert",
    """SELECT c_custkey + 700 AS k, c_name || '*' AS name FROM customer
       UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT c_custkey + 700 FROM customer)""",
)
def _(t: Tables):
    target = t.customer.selectExpr("c_custkey AS k", "c_name AS name")
    source = t.customer.selectExpr("c_custkey + 700 AS k", "c_name || '*' AS name")
    return merge_upsert(target, source, ["k"])


@query(
    "snk_04_needs_keys",
    "SELECT c_custkey AS k, CASE WHEN c_nationkey < 5 THEN c_name || '*' ELSE c_name END AS name FROM customer",
)
def _(t: Tables):
    target = t.customer.selectExpr("c_custkey AS k", "c_name AS name")
    # Rows whose key is NULL are no update; a write without keys is refused and leaves the table alone.
    source = t.customer.selectExpr("CASE WHEN c_nationkey < 5 THEN c_custkey END AS k", "c_name || '*' AS name")
    try:
        target = merge_update(target, source, [])
    except ValueError:
        target = merge_update(target, source, ["k"])
    return target


@query("pip_04_update_status", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_totalprice > 100000 THEN 'S' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def _(t: Tables):
    out = update_status(t.orders, "P", "S", "o_totalprice > 100000", "o_orderstatus")
    return out.select("o_orderkey", "o_orderstatus")


@query(
    "pip_05_update_cases",
    f"""SELECT o_orderkey,
          CASE WHEN k IS NULL THEN o_orderstatus WHEN p > o_totalprice THEN 'X' WHEN o_orderstatus = 'P' THEN 'S'
               ELSE o_orderstatus END AS o_orderstatus,
          CASE WHEN k IS NULL THEN o_totalprice WHEN p > o_totalprice THEN p WHEN o_orderstatus = 'P' THEN o_totalprice
               WHEN p > 50000 THEN o_totalprice - p ELSE o_totalprice END AS o_totalprice
        FROM orders LEFT JOIN (SELECT * FROM {_FIRST_RETURN} WHERE rn = 1) ON o_orderkey = k""",
)
def _(t: Tables):
    cases = [
        ("s.o_totalprice > t.o_totalprice", {"o_orderstatus": "'X'", "o_totalprice": "s.o_totalprice"}),
        ("t.o_orderstatus = 'P'", {"o_orderstatus": F.lit("S")}),
        (C("s.o_totalprice") > 50000, {"o_totalprice": "t.o_totalprice - s.o_totalprice"}),
    ]
    target = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return merge_cases(target, _returns(t), ["o_orderkey"], cases, ["l_linenumber", "l_partkey", "l_suppkey"])


@query(
    "pip_06_link_ids",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE WHEN o_custkey IS NOT NULL THEN o_custkey ELSE -1 END AS entry_id
       FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') ON l_orderkey = o_orderkey""",
)
def _(t: Tables):
    templates = t.lineitem.select(*LINE_KEYS, *LINE_ORDER, F.lit(-1).cast("bigint").alias("entry_id"))
    found = t.orders.filter("o_orderstatus = 'F'").selectExpr("o_orderkey AS l_orderkey", "o_custkey AS entry_id")
    return link_ids(templates, found, ["l_orderkey"])


@query(
    "pip_07_third_case",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber < 4)",
)
def _(t: Tables):
    early = t.lineitem.filter("l_linenumber < 4")
    return unmatched(t.orders, early, ["o_orderkey"], ["l_orderkey"]).select("o_orderkey", "o_totalprice")


# --- routines --------------------------------------------------------------------------------


@query(
    "udf_01_routine",
    """SELECT c_custkey, CAST(list_sum(list_transform(string_split(right(c_name, 9), ''), lambda x: CAST(x AS INTEGER))) % 10 AS INTEGER) AS digit
       FROM customer""",
)
def _(t: Tables):
    def check_digit(names: pd.Series) -> pd.Series:
        return sum(names.str[i].astype(int) for i in range(-9, 0)) % 10

    register_routine(t.spark, "check_digit", check_digit, T.IntegerType())
    return map_rows(t.customer, {"c_custkey": None, "digit": "check_digit(c_name)"})


