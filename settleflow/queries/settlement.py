"""Group routing, the settlement load and run reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from settleflow.functions import settlement as st
from settleflow.operators import dup_rows, lookup_join, uniq_rows, with_vars
from settleflow.plans import (
    EntrySpec,
    SyncSpec,
    apply_pay_dates,
    apply_type4,
    close_activity,
    elapsed_since,
    final_load,
    group_status,
    post_job,
    post_sync,
    route_files,
    row_counts,
    run_groups,
    run_summary,
    running_count,
    stage_activity,
    stage_entries,
    step_rows,
)
from settleflow.queries.inputs import (
    ENTRIES_SQL,
    FILES_SQL,
    LOG_SQL,
    MAPPING_SQL,
    ORDER_SCHEMA,
    entries,
    files,
    lines,
    mapping,
    step_log,
)
from settleflow.queries.registry import Tables, query
from settleflow.schema import schema_of
from settleflow.sources import truncate

C = F.col

# --- flagship --------------------------------------------------------------------------------

_FIRST_ENTRY = f"""(SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey,
                      rt, dir, rec_prin, pay_prin, clear_fx, basic) AS rn
                    FROM {ENTRIES_SQL})"""


@query(
    "flagship_settlement",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderstatus AS status,
          CASE WHEN rt = '2' THEN -rec_prin ELSE rec_prin END AS principal,
          CASE WHEN dir IN ('2','5') THEN rec_prin - pay_prin - clear_fx WHEN dir IN ('1','4') THEN -clear_fx ELSE 0 END AS fx_usd,
          CASE WHEN rt = '2' AND basic >= 0 THEN -basic ELSE basic END AS basic_charge,
          CASE rt WHEN '2' THEN 'O' WHEN '3' THEN 'P' ELSE 'X' END AS origpay
        FROM {_FIRST_ENTRY} LEFT JOIN orders ON l_orderkey = o_orderkey WHERE rn = 1""",
)
def _(t: Tables):
    read = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "rt", "dir", "rec_prin", "pay_prin", "clear_fx", "basic"]
    first = uniq_rows(entries(t), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"], read)
    orders = t.orders.select(C("o_orderkey"), C("o_orderstatus").alias("status"))
    flow = lookup_join(first, orders, [("l_orderkey", "o_orderkey")])
    flow = with_vars(
        flow,
        {
            "principal": st.rt2_negate(C("rt"), C("rec_prin")),
            "fx_usd": st.share_of_fx_usd(C("dir"), C("rec_prin"), C("pay_prin"), C("clear_fx")),
            "basic_charge": st.basicha(C("rt"), C("basic")),
            "origpay": st.origpay_ind(C("rt")),
        },
    )
    return flow.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "status", "principal", "fx_usd", "basic_charge", "origpay"
    )


# --- groups ----------------------------------------------------------------------------------

_CLASSED = f"""(SELECT *, CASE WHEN path LIKE '/in/ST/%' AND (name LIKE '%.txt' OR name LIKE '%.ST') THEN 'ST'
                              WHEN path LIKE '/in/AC/%' AND upper(name) LIKE '%ACTIV%' THEN 'AC' END AS class FROM {FILES_SQL})"""


@query(
    "grp_01_route_files",
    f"""SELECT grp, class, position, CAST(position AS VARCHAR) || '.' || name AS routed_name, path, name FROM
          (SELECT grp_number AS grp, class, path, name,
             row_number() OVER (PARTITION BY grp_number, class ORDER BY name) AS position
           FROM {_CLASSED} JOIN {MAPPING_SQL} ON nullif(regexp_extract(name, '[_](\\d{{3,6}})[_.]', 1), '') = network_id
           WHERE class IS NOT NULL) WHERE position <= 15""",
)
def _(t: Tables):
    return route_files(files(t), mapping(t))


@query(
    "grp_01_route_files_again",
    f"""SELECT grp, class, position - 15 AS position, CAST(position - 15 AS VARCHAR) || '.' || name AS routed_name, path, name FROM
          (SELECT grp_number AS grp, class, path, name,
             row_number() OVER (PARTITION BY grp_number, class ORDER BY name) AS position
           FROM {_CLASSED} JOIN {MAPPING_SQL} ON nullif(regexp_extract(name, '[_](\\d{{3,6}})[_.]', 1), '') = network_id
           WHERE class IS NOT NULL) WHERE position BETWEEN 16 AND 30""",
)
def _(t: Tables):
    doubled = mapping(t).unionByName(mapping(t))
    return route_files(files(t), doubled, taken=route_files(files(t), doubled))


@query(
    "grp_01_route_files_unmapped",
    f"""SELECT CAST(g AS VARCHAR) AS grp, class, position, CAST(position AS VARCHAR) || '.' || name AS routed_name, path, name FROM
          (SELECT *, row_number() OVER (PARTITION BY class ORDER BY name) AS position FROM {_CLASSED} WHERE class IS NOT NULL),
          range(1, 21) AS r(g) WHERE position <= 15""",
)
def _(t: Tables):
    return route_files(files(t), None, strict=False)


@query(
    "grp_02_run_groups",
    """SELECT grp, o_custkey, o_orderkey FROM
         (SELECT CAST(o_custkey % 20 + 1 AS VARCHAR) AS grp, o_custkey, o_orderkey,
            row_number() OVER (PARTITION BY o_custkey % 20, o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders)
       WHERE rn = 1""",
)
def _(t: Tables):
    rows = t.orders.withColumn("grp", (C("o_custkey") % 20 + 1).cast("string"))
    order = [C("o_orderdate").desc(), C("o_orderkey")]
    return run_groups(rows, lambda df, keys: uniq_rows(df, keys, order, ["grp", "o_custkey", "o_orderkey"]), ["o_custkey"])


# --- staging ---------------------------------------------------------------------------------

ENTRY_FIELDS = ["rt", "dir", "sendpay", "setdate", "rec_prin", "pay_prin", "clear_fx", "rec_charges", "clear_charges", "basic"]
ENTRY_SPEC = EntrySpec(
    schema_of(
        [{"name": n, "type": "id_String"} for n in ENTRY_FIELDS[:4]]
        + [{"name": n, "type": "id_Double", "nullable": False} for n in ENTRY_FIELDS[4:]]
    ),
    keep=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
)
_IDS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _staged(t: Tables):
    """Entries as lines; one in ten lacks its last field, one in eleven has a bad amount."""
    key = C("l_orderkey")
    fields = [C(n).cast("string") for n in ENTRY_FIELDS]
    fields[4] = F.when(key % 11 == 0, "n/a").otherwise(fields[4])
    short, full = F.concat_ws("|", *fields[:-1]), F.concat_ws("|", *fields)
    text = F.when(key % 10 == 0, short).otherwise(full)
    return stage_entries(entries(t).select(*ENTRY_SPEC.keep, text.alias("line")), ENTRY_SPEC)


@query(
    "pip_01_stage_entries",
    f"""SELECT {_IDS}, CASE rt WHEN '2' THEN 'O' WHEN '3' THEN 'P' ELSE 'X' END AS origpay,
          CASE WHEN left(setdate, 3) BETWEEN '121' AND '129' THEN '20' || substr(setdate, 2) ELSE setdate END AS settle_date,
          CASE WHEN dir IN ('2','5') THEN rec_prin - pay_prin - clear_fx WHEN dir IN ('1','4') THEN -clear_fx ELSE 0 END AS fx_usd,
          CASE WHEN dir IN ('2','5') THEN -clear_charges WHEN dir IN ('1','4') THEN rec_charges - clear_charges ELSE 0 END AS charges,
          CASE WHEN sendpay = 'P' AND dir IN ('1','4') THEN -rec_prin ELSE rec_prin END AS principal,
          CASE WHEN rt = '2' AND basic >= 0 THEN -basic ELSE basic END AS basic_charge
        FROM {ENTRIES_SQL} WHERE l_orderkey % 10 <> 0 AND l_orderkey % 11 <> 0""",
)
def _(t: Tables):
    return _staged(t)[0].select(
        *ENTRY_SPEC.keep, "origpay", "settle_date", "fx_usd", "charges", "principal", "basic_charge"
    )


@query(
    "pip_01_stage_entries_rejects",
    f"""SELECT {_IDS}, CASE WHEN l_orderkey % 10 = 0 THEN 'field count' ELSE 'rec_prin: not double' END AS reject_reason
        FROM lineitem WHERE l_orderkey % 10 = 0 OR l_orderkey % 11 = 0""",
)
def _(t: Tables):
    return _staged(t)[1].select(*ENTRY_SPEC.keep, "reject_reason")


@query(
    "pip_02_stage_activity",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate
       FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderkey % 7 <> 0""",
)
def _(t: Tables):
    good, _ = stage_activity(lines(t), EntrySpec(ORDER_SCHEMA))
    return good.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", C("o_orderdate").cast("string"))


@query(
    "pip_03_activity_duplicates",
    """SELECT event_id, user_id, event_type FROM
         (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn > 1""",
)
def _(t: Tables):
    return dup_rows(t.events, ["user_id", "event_type"], ["ts", "event_id"], ["event_id", "user_id", "event_type"])


# --- final load ------------------------------------------------------------------------------

# Two of three orders are in production; the merge table brings them all with doubled amounts, and
# takes back every fourth order production does not have.
_MERGE_SQL = """(SELECT o_orderkey AS k, o_custkey AS cust, o_totalprice * 2 AS amount FROM orders
  UNION ALL SELECT o_orderkey, o_custkey, -(o_totalprice * 2) FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 4 = 0)"""


def _loaded(t: Tables):
    orders = t.orders.selectExpr("o_orderkey AS k", "o_custkey AS cust", "o_totalprice AS amount", "o_orderstatus AS status")
    prod = orders.filter("k % 3 <> 0").drop("status")
    doubled = orders.drop("status").withColumn("amount", C("amount") * 2)
    back = doubled.filter("k % 12 = 0").withColumn("amount", -C("amount"))
    adj = orders.select("k", F.when(C("status") == "F", "2").otherwise("1").alias("rt"), "amount")
    return final_load(doubled.unionByName(back), prod, adj, ["k"], "amount")


@query(
    "pip_08_final_load",
    "SELECT o_orderkey AS k, o_custkey AS cust, o_totalprice * 2 AS amount FROM orders WHERE o_orderkey % 12 <> 0",
)
def _(t: Tables):
    return _loaded(t)["prod"]


@query("pip_08_final_load_netted", f"SELECT k, cust, amount FROM {_MERGE_SQL} WHERE k % 12 = 0")
def _(t: Tables):
    return _loaded(t)["netted"]


@query(
    "pip_08_final_load_adjustments",
    """SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'F' THEN '2' ELSE '1' END AS rt,
         CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END AS amount FROM orders""",
)
def _(t: Tables):
    return _loaded(t)["adj"]


@query(
    "pip_08_final_load_again",
    """SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'F' THEN '2' ELSE '1' END AS rt,
         CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END AS amount FROM orders""",
)
def _(t: Tables):
    # Two loads, of the even and of the odd orders: each adjustment is turned once.
    orders = t.orders.selectExpr("o_orderkey AS k", "o_custkey AS cust", "o_totalprice AS amount", "o_orderstatus AS status")
    adj = orders.select("k", F.when(C("status") == "F", "2").otherwise("1").alias("rt"), "amount")
    prod, rows = orders.drop("status").filter("k < 0"), orders.drop("status")
    first = final_load(rows.filter("k % 2 = 0"), prod, adj, ["k"], "amount")
    return final_load(rows.filter("k % 2 = 1"), first["prod"], first["adj"], ["k"], "amount")["adj"]


# --- post job --------------------------------------------------------------------------------


def _production(t: Tables):
    return t.orders.selectExpr("o_orderkey AS k", "o_orderstatus AS status", "date_format(o_orderdate, 'yyyy-MM-dd') AS pay_date")


def _type4(t: Tables):
    late = t.lineitem.filter("l_linenumber = 4")
    return late.selectExpr(
        "l_orderkey AS k", "l_returnflag AS status", "date_format(l_shipdate, 'yyyy-MM-dd') AS pay_date", "l_partkey", "l_suppkey"
    )


_ORDERED_PARTS = ["l_partkey", "l_suppkey"]
_TYPE4_SQL = """(SELECT l_orderkey AS lk, l_returnflag, strftime(l_shipdate, '%Y-%m-%d') AS ship,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_returnflag, l_shipdate) AS rn
    FROM lineitem WHERE l_linenumber = 4)"""
_JOINED_SQL = f"orders LEFT JOIN (SELECT * FROM {_TYPE4_SQL} WHERE rn = 1) ON o_orderkey = lk"


@query(
    "pip_09_status_from_type4",
    f"""SELECT o_orderkey AS k, CASE WHEN lk IS NULL THEN o_orderstatus ELSE l_returnflag END AS status,
          strftime(o_orderdate, '%Y-%m-%d') AS pay_date FROM {_JOINED_SQL}""",
)
def _(t: Tables):
    return apply_type4(_production(t), _type4(t), ["k"], order_by=_ORDERED_PARTS)


@query(
    "pip_10_pay_dates",
    f"""SELECT o_orderkey AS k, o_orderstatus AS status,
          CASE WHEN lk IS NULL THEN strftime(o_orderdate, '%Y-%m-%d') ELSE ship END AS pay_date FROM {_JOINED_SQL}""",
)
def _(t: Tables):
    return apply_pay_dates(_production(t), _type4(t), ["k"], order_by=_ORDERED_PARTS)[0]


_ACTIVE = "(SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'O')"


def _activity(t: Tables):
    return t.lineitem.filter("l_linestatus = 'O'").select(C("l_orderkey").alias("k"), "l_linenumber", *_ORDERED_PARTS)


@query(
    "pip_11_close_activity",
    f"""SELECT o_orderkey AS k, CASE WHEN o_orderkey IN {_ACTIVE} THEN 'C' ELSE o_orderstatus END AS status,
          strftime(o_orderdate, '%Y-%m-%d') AS pay_date FROM orders""",
)
def _(t: Tables):
    activity = _activity(t)
    return close_activity(_production(t), activity, ["k"], ["l_linenumber", *_ORDERED_PARTS], activity)[0]


@query(
    "pip_11_post_job",
    f"""SELECT o_orderkey AS k,
          CASE WHEN o_orderkey IN {_ACTIVE} THEN 'C' WHEN lk IS NULL THEN o_orderstatus ELSE l_returnflag END AS status,
          CASE WHEN lk IS NULL THEN strftime(o_orderdate, '%Y-%m-%d') ELSE ship END AS pay_date FROM {_JOINED_SQL}""",
)
def _(t: Tables):
    activity = _activity(t).withColumns({"rank": C("l_linenumber")})
    type4 = _type4(t).withColumn("rank", F.lit(0))
    return post_job(_production(t), type4, activity, activity, ["k"], ["rank", *_ORDERED_PARTS])["prod"]


# --- the whole chain -------------------------------------------------------------------------

SYNC = SyncSpec(
    keys=["k"],
    order_by=["line", "part", "supp"],
    cases=[
        ("s.rt = '2' AND s.amount > 50000", {"amount": "t.amount + s.amount", "status": "s.status"}),
        ("s.status = 'S'", {"status": "s.status"}),
    ],
    template_keys=["k"],
    cols=["rt", "amount", "status"],
)


def _synced(t: Tables, staged: bool = True):
    staging = entries(t).select(
        C("l_orderkey").alias("k"),
        C("l_linenumber").alias("line"),
        C("l_partkey").alias("part"),
        C("l_suppkey").alias("supp"),
        "rt",
        F.when(C("dir") == "1", "W").otherwise("N").alias("status"),
        C("rec_prin").alias("amount"),
        F.concat(C("l_orderkey").cast("string"), F.lit("-"), C("l_linenumber").cast("string")).alias("entry_id"),
    )
    prod = t.orders.filter("o_orderkey % 5 <> 0").select(
        C("o_orderkey").alias("k"),
        F.lit(0).alias("line"),
        F.lit(0).cast("bigint").alias("part"),
        F.lit(0).cast("bigint").alias("supp"),
        F.lit("1").alias("rt"),
        C("o_orderstatus").alias("status"),
        C("o_totalprice").alias("amount"),
        F.lit("").alias("entry_id"),
    )
    templates = t.orders.select(C("o_orderkey").alias("k"), F.lit("none").alias("entry_id"))
    adj = prod.select("k", "rt", "amount")
    first = staging if staged else truncate(staging)
    return post_sync(first, staging, prod, templates, adj, SYNC)


_FIRST_STAGED = """(SELECT *, l_orderkey || '-' || l_linenumber AS eid FROM
    (SELECT *, row_number() OVER (PARTITION BY l_orderkey
       ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag, l_extendedprice) AS rn FROM lineitem)
    WHERE rn = 1)"""


@query(
    "pip_12_post_sync",
    f"""SELECT o_orderkey AS k,
          CASE WHEN l_orderkey IS NULL THEN o_orderstatus
               WHEN l_returnflag = 'N' AND l_extendedprice > 50000 THEN CASE WHEN l_linenumber = 1 THEN 'S' ELSE 'N' END
               WHEN l_linenumber = 1 THEN 'S' ELSE o_orderstatus END AS status,
          CASE WHEN l_returnflag = 'N' AND l_extendedprice > 50000 THEN o_totalprice + l_extendedprice ELSE o_totalprice END AS amount
        FROM (SELECT * FROM orders WHERE o_orderkey % 5 <> 0) LEFT JOIN {_FIRST_STAGED} ON o_orderkey = l_orderkey
        UNION ALL
        SELECT l_orderkey, CASE WHEN l_linenumber = 1 THEN 'S' ELSE 'N' END, l_extendedprice FROM lineitem WHERE l_orderkey % 5 = 0""",
)
def _(t: Tables):
    return _synced(t)["prod"].select("k", "status", "amount")


@query(
    "pip_12_post_sync_templates",
    f"SELECT o_orderkey AS k, coalesce(eid, 'none') AS entry_id FROM orders LEFT JOIN {_FIRST_STAGED} ON o_orderkey = l_orderkey",
)
def _(t: Tables):
    return _synced(t)["templates"]


@query(
    "pip_12_early_exit",
    "SELECT o_orderkey AS k, o_orderstatus AS status, o_totalprice AS amount FROM orders WHERE o_orderkey % 5 <> 0",
)
def _(t: Tables):
    return _synced(t, staged=False)["prod"].select("k", "status", "amount")


@query(
    "pip_12_activity_once",
    """SELECT k, line, part, supp FROM (SELECT l_orderkey AS k, l_linenumber AS line, l_partkey AS part, l_suppkey AS supp,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag, l_extendedprice) AS rn FROM lineitem)
       WHERE rn = 1""",
)
def _(t: Tables):
    return _synced(t, staged=False)["activity"].select("k", "line", "part", "supp")


# --- reports ---------------------------------------------------------------------------------

NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
         "pages", "benchmark", "labels", "conversations"]


@query(
    "agg_01_row_counts",
    " UNION ALL ".join(f"""SELECT '{n}' AS "table", count(*) AS rows FROM {n}""" for n in NAMES),
)
def _(t: Tables):
    return row_counts({name: getattr(t, name) for name in NAMES})


@query(
    "agg_01_step_rows",
    f"""SELECT run_id, step, CAST(sum(rows_in) AS BIGINT) AS rows_in, CAST(sum(rows_out) AS BIGINT) AS rows_out
        FROM {LOG_SQL} GROUP BY run_id, step""",
)
def _(t: Tables):
    return step_rows(step_log(t))


@query(
    "agg_02_run_summary",
    f"""SELECT run_id, max(CASE WHEN last = 1 THEN status END) AS status, count(*) AS steps,
          CAST(sum(rows_in) AS BIGINT) AS rows_in, CAST(sum(rows_out) AS BIGINT) AS rows_out, count(error) AS errors,
          CAST(sum(st_files) AS BIGINT) AS st_files, CAST(sum(ac_files) AS BIGINT) AS ac_files,
          strftime(min(timestamp), '%Y-%m-%d %H:%M:%S') AS start, strftime(max(timestamp), '%Y-%m-%d %H:%M:%S') AS "end",
          date_diff('microsecond', min(timestamp), max(timestamp)) / CAST(1000000 AS DOUBLE) AS duration_sec
        FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY timestamp DESC, step DESC, status DESC) AS last FROM {LOG_SQL})
        GROUP BY run_id""",
)
def _(t: Tables):
    day = "yyyy-MM-dd HH:mm:ss"
    out = run_summary(step_log(t))
    return out.withColumns({"start": F.date_format("start", day), "end": F.date_format("end", day),
                            "duration_sec": C("duration_sec").cast("double")})


_RUNS_SQL = f"""(SELECT CAST(run_id % 17 + 1 AS INTEGER) AS grp, *, rows_in AS rows, CAST(rows_out AS DOUBLE) / 4 AS duration_sec,
                  row_number() OVER (PARTITION BY run_id % 17 ORDER BY timestamp DESC, status DESC, step DESC, st_files DESC, ac_files DESC) AS rn
                FROM {LOG_SQL})"""
_STATUS_SQL = f"""SELECT CAST(g AS INTEGER) AS grp, coalesce(status, 'IDLE') AS status, coalesce(step, '—') AS current_step,
    CAST(coalesce(st_files, 0) AS BIGINT) AS st_files, CAST(coalesce(ac_files, 0) AS BIGINT) AS ac_files,
    CAST(coalesce(rows, 0) AS BIGINT) AS rows, coalesce(strftime(timestamp, '%Y-%m-%d %H:%M:%S'), '—') AS last_run,
    coalesce(CAST(duration_sec AS VARCHAR), '—') AS duration
  FROM range(1, 21) AS r(g) LEFT JOIN (SELECT * FROM {_RUNS_SQL} WHERE rn = 1) ON g = grp"""


def _board(t: Tables):
    runs = step_log(t).select(
        (C("run_id") % 17 + 1).alias("grp"),
        "status",
        "step",
        "st_files",
        "ac_files",
        C("rows_in").alias("rows"),
        C("timestamp").alias("start"),
        (C("rows_out").cast("double") / 4).alias("duration_sec"),
    )
    return group_status(t.spark, runs)


@query("agg_03_group_status", _STATUS_SQL)
def _(t: Tables):
    return _board(t)


@query("agg_03_running", f"SELECT count(*) AS running FROM ({_STATUS_SQL}) WHERE status = 'RUNNING'")
def _(t: Tables):
    return running_count(_board(t))


@query(
    "agg_04_elapsed_since",
    """SELECT user_id AS run_id, CAST(date_diff('microsecond', min(ts), TIMESTAMP '2024-02-01 00:00:00') // 1000 AS BIGINT) AS elapsed_ms
       FROM events WHERE event_type = 'error' GROUP BY user_id""",
)
def _(t: Tables):
    return elapsed_since(step_log(t), "error", F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
