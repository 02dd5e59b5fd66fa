"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from settleflow.functions import conditions as cd
from settleflow.functions import dates as dt
from settleflow.functions import numeric as nm
from settleflow.functions import text as tx
from settleflow.queries.registry import query

C = F.col


def _over(name: str, table: str, key: str, column, sql: str, extra: str = "") -> None:
    """Register one function over a table: ``key``, and its value as ``v``."""

    @query(name, f"SELECT {key}, {sql} AS v FROM {table} {extra}")
    def _(t):
        return getattr(t, table).select(key, column().alias("v"))


# Strings
_over("str_01_trim", "part", "p_partkey", lambda: tx.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))), "trim('  ' || p_name || ' ')")
_over("str_02_right", "customer", "c_custkey", lambda: tx.right(C("c_name"), 4), "right(CAST(c_name AS VARCHAR), 4)")
_over("str_03_left", "customer", "c_custkey", lambda: tx.left(C("c_custkey"), 2), "left(CAST(c_custkey AS VARCHAR), 2)")
_over("str_04_length", "documents", "doc_id", lambda: tx.length(C("text")).cast("bigint"), "CAST(length(text) AS BIGINT)")
_over("str_05_substr", "documents", "doc_id", lambda: tx.substr(C("text"), 5, 40), "substr(text, 5, 40)")
_over("str_06_index", "part", "p_partkey", lambda: tx.index(C("p_name"), "ring").cast("bigint"), "CAST(position('ring' IN p_name) AS BIGINT)")
_over("str_07_upcase", "part", "p_partkey", lambda: tx.upcase(C("p_name")), "upper(p_name)")
_over("str_08_downcase", "part", "p_partkey", lambda: tx.downcase(C("p_type")), "lower(p_type)")
_over("str_09_change", "part", "p_partkey", lambda: tx.change(C("p_name"), "i", ".*"), "replace(p_name, 'i', '.*')")
_over("str_10_equals", "orders", "o_orderkey", lambda: tx.equals(C("o_orderstatus"), "F"), "o_orderstatus = 'F'")
_over("str_11_contains", "part", "p_partkey", lambda: tx.contains(C("p_name"), "d w"), "contains(p_name, 'd w')")
_over("str_12_starts_with", "part", "p_partkey", lambda: tx.starts_with(C("p_name"), "red"), "starts_with(p_name, 'red')")
_over("str_13_ends_with", "part", "p_partkey", lambda: tx.ends_with(C("p_name"), "ring"), "suffix(p_name, 'ring')")
_over("str_14_replace_all", "pages", "page_id", lambda: tx.replace_all(C("url"), "[0-9]+", "#"), "regexp_replace(url, '[0-9]+', '#', 'g')")
_over("str_15_replace", "pages", "page_id", lambda: tx.replace(C("url"), "/", "::"), "replace(url, '/', '::')")
_over(
    "str_16_method_calls",
    "part",
    "p_partkey",
    lambda: tx.concat(tx.upcase(tx.trim(C("p_name"))), tx.length(C("p_type")), tx.downcase(C("p_brand"))),
    "upper(trim(p_name)) || CAST(length(p_type) AS VARCHAR) || lower(p_brand)",
)
_over("str_17_is_empty", "part", "p_partkey", lambda: tx.is_empty(tx.replace(C("p_brand"), "Brand#1", "")), "replace(p_brand, 'Brand#1', '') = ''")
_over("str_18_lpad", "orders", "o_orderkey", lambda: tx.lpad(C("o_orderkey"), 4, "0"), "lpad(CAST(o_orderkey AS VARCHAR), 4, '0')")
_over(
    "str_19_split",
    "pages",
    "page_id",
    lambda: F.concat(F.size(tx.split(C("url"), "/")).cast("string"), F.lit(":"), F.array_join(tx.split(C("url"), "."), ",")),
    "CAST(len(string_split(url, '/')) AS VARCHAR) || ':' || array_to_string(string_split(url, '.'), ',')",
)
_over("str_20_concat", "customer", "c_custkey", lambda: tx.concat(C("c_name"), F.lit("-"), C("c_nationkey")), "c_name || '-' || CAST(c_nationkey AS VARCHAR)")
_FILE = lambda: F.concat(F.when(C("c_custkey") % 3 == 0, "X").otherwise("ACTIV_"), (C("c_nationkey") * 7 + 95).cast("string"), F.lit("_"), C("c_custkey").cast("string"))
_FILE_SQL = "CASE WHEN c_custkey % 3 = 0 THEN 'X' ELSE 'ACTIV_' END || CAST(c_nationkey * 7 + 95 AS VARCHAR) || '_' || CAST(c_custkey AS VARCHAR)"
_over("str_21_network_id", "customer", "c_custkey", lambda: tx.network_id(_FILE()), f"nullif(regexp_extract({_FILE_SQL}, '[_](\\d{{3,6}})[_.]', 1), '')")
_over(
    "str_22_strip_prefix",
    "customer",
    "c_custkey",
    lambda: tx.strip_prefix(F.concat((C("c_custkey") % 15 + 1).cast("string"), F.lit(".7."), C("c_name"))),
    "regexp_replace(CAST(c_custkey % 15 + 1 AS VARCHAR) || '.7.' || c_name, '^\\d+\\.', '')",
)
_over("str_23_mask_match", "part", "p_partkey", lambda: tx.mask_match(C("p_name"), "*[a-f]? *g*"), "regexp_matches(p_name, '^.*[a-f]. .*g.*$', 's')")

# Numbers
_over("num_01_smul", "orders", "o_orderkey", lambda: nm.smul(0.5, C("o_totalprice")), "CAST(o_totalprice AS DOUBLE) * CAST(0.5 AS DOUBLE)")
_over("num_02_absolute", "customer", "c_custkey", lambda: nm.absolute(C("c_acctbal")), "abs(CAST(c_acctbal AS DOUBLE))")


@query(
    "num_03_bd_literal",
    "SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(38,4)) + CAST('12.3456' AS DECIMAL(38,4)) AS DOUBLE) AS v FROM customer",
)
def _(t):
    return t.customer.select(
        "c_custkey", nm.bd_add(nm.big_decimal(C("c_acctbal")), nm.bd_literal("12.3456")).cast("double").alias("v")
    )


_over("num_04_big_decimal", "customer", "c_custkey", lambda: nm.big_decimal(C("c_acctbal")).cast("string"), "CAST(CAST(c_acctbal AS DECIMAL(38,4)) AS VARCHAR)")


@query(
    "num_05_arithmetic",
    """SELECT c_custkey,
         CAST(a + b AS DOUBLE) AS plus, CAST(a - b AS DOUBLE) AS minus, CAST(-a AS DOUBLE) AS negated,
         round(CAST(a AS DOUBLE) * CAST(b AS DOUBLE), 4) AS times
       FROM (SELECT c_custkey, CAST(c_acctbal AS DECIMAL(18,4)) AS a, CAST(c_nationkey + 0.25 AS DECIMAL(18,4)) AS b
             FROM customer)""",
)
def _(t):
    a, b = nm.big_decimal(C("c_acctbal")), nm.big_decimal(C("c_nationkey") + 0.25)
    return t.customer.select(
        "c_custkey",
        nm.bd_add(a, b).cast("double").alias("plus"),
        nm.bd_subtract(a, b).cast("double").alias("minus"),
        nm.bd_negate(a).cast("double").alias("negated"),
        F.round(nm.bd_multiply(a, b).cast("double"), 4).alias("times"),
    )


# Amounts with four decimals of about 1, 10**15 and 10**30, as whole numbers of ten-thousandths; c has four decimals below 1.
_UNITS = """(SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS HUGEINT) * 12345 + l_partkey + 1 AS tiny, l_suppkey * 7 + 1234 AS c,
    CASE WHEN l_linenumber % 2 = 0 THEN -1 ELSE 1 END AS turn FROM lineitem)"""


def _said(whole: str, digits: int) -> str:
    """SQL for the text of a whole number of ``10**-digits``."""
    one = f"1{'0' * digits}::HUGEINT"
    return f"""CASE WHEN {whole} < 0 THEN '-' ELSE '' END || CAST(abs({whole}) // {one} AS VARCHAR) || '.'
        || lpad(CAST(abs({whole}) % {one} AS VARCHAR), {digits}, '0')"""


def _units(t):
    tiny = C("l_orderkey").cast("decimal(30,0)") * 12345 + C("l_partkey") + 1
    turn = F.when(C("l_linenumber") % 2 == 0, -1).otherwise(1)
    part = lambda units: (units.cast("decimal(30,0)") * F.lit("0.0001").cast("decimal(4,4)")).cast(nm.DECIMAL)
    at = lambda size: (part(tiny) + nm.bd_literal("1" + "0" * size)).cast(nm.DECIMAL) * turn
    return t.lineitem, part(tiny), part(C("l_suppkey") * 7 + 1234), at


@query(
    "num_05_products",
    f"""SELECT l_orderkey, l_linenumber, {_said("turn * tiny * c", 8)} AS tiny, {_said("turn * (10000000000000000000::HUGEINT + tiny) * c", 8)} AS large,
          {_said("turn * ((2 * (100000000000000000000000000000000::HUGEINT + tiny) * c + 10000) // 20000)", 4)} AS huge
        FROM {_UNITS}""",
)
def _(t):
    rows, tiny, c, at = _units(t)
    turn = F.when(C("l_linenumber") % 2 == 0, -1).otherwise(1)
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        nm.to_text(nm.bd_multiply(tiny * turn, c)).alias("tiny"),
        nm.to_text(nm.bd_multiply(at(15), c)).alias("large"),
        nm.to_text(nm.bd_multiply(at(28), c, 4)).alias("huge"),
    )


@query(
    "num_06_quotients",
    f"""SELECT l_orderkey, l_linenumber, {_said("turn * ((2 * tiny * 100000000 + c) // (2 * c))", 8)} AS tiny,
          {_said("turn * ((2 * (10000000000000000000::HUGEINT + tiny) * 100000000 + c) // (2 * c))", 8)} AS large,
          {_said("turn * ((2 * (10000000000000000000000000000000000::HUGEINT + tiny) + c * 1000) // (2 * c * 1000) )", 4)} AS huge
        FROM {_UNITS}""",
)
def _(t):
    rows, tiny, c, at = _units(t)
    turn = F.when(C("l_linenumber") % 2 == 0, -1).otherwise(1)
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        nm.to_text(nm.bd_divide(tiny * turn, c, 8)).alias("tiny"),
        nm.to_text(nm.bd_divide(at(15), c, 8)).alias("large"),
        nm.to_text(nm.bd_divide(at(30), nm.big_decimal(c * 10_000_000), 4)).alias("huge"),
    )


@query(
    "num_06_bd_divide",
    """SELECT c_custkey, CASE WHEN n > 0 THEN sign(cents) * ((2 * abs(cents) + n) // (2 * n)) / CAST(100 AS DOUBLE) END AS v
       FROM (SELECT c_custkey, CAST(round(c_acctbal * 100) AS BIGINT) AS cents, c_nationkey AS n FROM customer)""",
)
def _(t):
    v = nm.bd_divide(nm.big_decimal(C("c_acctbal")), nm.big_decimal(C("c_nationkey")), 2)
    return t.customer.select("c_custkey", v.cast("double").alias("v"))


_over(
    "num_07_set_scale",
    "lineitem",
    "l_orderkey",
    lambda: nm.set_scale(nm.big_decimal(C("l_extendedprice")), 1).cast("double"),
    "CAST(round(CAST(l_extendedprice AS DECIMAL(18,4)), 1) AS DOUBLE)",
)


@query(
    "num_08_compare_to",
    """SELECT c_custkey, CAST(sign(c_acctbal) AS INTEGER) AS zero,
         CASE WHEN c_acctbal < c_nationkey THEN -1 WHEN c_acctbal = c_nationkey THEN 0 ELSE 1 END AS other
       FROM customer""",
)
def _(t):
    balance = nm.big_decimal(C("c_acctbal"))
    return t.customer.select(
        "c_custkey",
        nm.compare_to(balance, nm.bd_zero()).alias("zero"),
        nm.compare_to(balance, nm.big_decimal(C("c_nationkey"))).alias("other"),
    )


_over("num_09_zero_one", "customer", "c_custkey", lambda: F.when(C("c_acctbal") > 0, nm.bd_one()).otherwise(nm.bd_zero()).cast("double"), "CASE WHEN c_acctbal > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END")
_over("num_10_to_text", "customer", "c_custkey", lambda: nm.to_text(nm.set_scale(nm.big_decimal(C("c_acctbal")), 2)), "CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR)")

# Casts and conditions
_over("cst_01_parse_double", "orders", "o_orderkey", lambda: cd.parse_double(C("o_totalprice").cast("string")), "CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE)")
_over(
    "cst_01_parse_double_lenient",
    "orders",
    "o_orderkey",
    lambda: cd.parse_double(F.when(C("o_orderkey") % 7 == 0, "bad").otherwise(C("o_totalprice").cast("string")), lenient=True),
    "TRY_CAST(CASE WHEN o_orderkey % 7 = 0 THEN 'bad' ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE)",
)
_over("cst_02_parse_int", "orders", "o_orderkey", lambda: cd.parse_int(C("o_custkey").cast("string")), "CAST(CAST(o_custkey AS VARCHAR) AS INTEGER)")
_over("cst_03_value_of", "lineitem", "l_orderkey", lambda: cd.value_of(C("l_linenumber")), "CAST(l_linenumber AS VARCHAR)")
_over("cst_04_to_number", "customer", "c_custkey", lambda: cd.to_number(tx.right(C("c_name"), 5)), "CAST(right(c_name, 5) AS DOUBLE)")
_over(
    "cnd_01_ternary",
    "lineitem",
    "l_orderkey",
    lambda: cd.ternary(
        C("l_linenumber") == 1,
        "one",
        cd.ternary(
            C("l_linenumber") == 2,
            "two",
            cd.ternary(
                C("l_quantity") > 40,
                "many",
                cd.ternary(C("l_returnflag") == "A", "back", cd.ternary(C("l_linestatus") == "O", "open", cd.ternary(C("l_tax") > 0.05, "taxed", "plain"))),
            ),
        ),
    ),
    """CASE WHEN l_linenumber = 1 THEN 'one' WHEN l_linenumber = 2 THEN 'two' WHEN l_quantity > 40 THEN 'many'
       WHEN l_returnflag = 'A' THEN 'back' WHEN l_linestatus = 'O' THEN 'open' WHEN l_tax > 0.05 THEN 'taxed' ELSE 'plain' END""",
)
_over(
    "cnd_02_logic",
    "orders",
    "o_orderkey",
    lambda: cd.any_of(cd.all_of(C("o_orderstatus") == "F", C("o_totalprice") > 100000), cd.negated(C("o_custkey") > 100)),
    "(o_orderstatus = 'F' AND o_totalprice > 100000) OR NOT (o_custkey > 100)",
)


@query(
    "cnd_03_null_tests",
    """SELECT o_orderkey, nullif(o_orderstatus, 'P') IS NULL AS missing, nullif(o_orderstatus, 'P') IS NOT NULL AS present,
         TRUE AS yes, FALSE AS no FROM orders""",
)
def _(t):
    status = cd.null_if(C("o_orderstatus"), "P")
    return t.orders.select(
        "o_orderkey",
        cd.is_null(status).alias("missing"),
        cd.not_null(status).alias("present"),
        cd.literal(True).alias("yes"),
        cd.literal(False).alias("no"),
    )


_over("cnd_04_empty_expression", "orders", "o_orderkey", lambda: cd.literal("").cast("string"), "CAST(NULL AS VARCHAR)")
_over("cnd_05_null_if", "part", "p_partkey", lambda: C("p_retailprice") / cd.null_if(C("p_size") % 3, 0), "p_retailprice / nullif(p_size % 3, 0)")
_over("cnd_06_nvl", "orders", "o_orderkey", lambda: cd.nvl(cd.null_if(C("o_orderstatus"), "P"), "none"), "coalesce(nullif(o_orderstatus, 'P'), 'none')")
_over("cnd_07_is_in", "part", "p_partkey", lambda: cd.is_in(C("p_size"), 1, 5, 11), "p_size IN (1, 5, 11)")

# Dates
_over("dat_01_format_date", "events", "event_id", lambda: dt.format_date("dd/MM/yyyy HH:mm:ss", C("ts")), "strftime(ts, '%d/%m/%Y %H:%M:%S')")
_over("dat_02_get_date", "orders", "o_orderkey", lambda: dt.get_date("dd/MM/yyyy", C("o_orderdate").cast("timestamp_ntz")), "strftime(o_orderdate, '%d/%m/%Y')")
_over("dat_02_get_date_of_events", "events", "event_id", lambda: dt.get_date("yyyy-MM-dd", C("ts").cast("timestamp_ntz")), "strftime(ts, '%Y-%m-%d')")
_over("dat_03_now", "events", "event_id", lambda: C("ts").cast("timestamp") < dt.now(), "ts < now()::TIMESTAMP")
_over(
    "dat_04_parse_date",
    "orders",
    "o_orderkey",
    lambda: F.date_format(dt.parse_date("dd.MM.yyyy", F.date_format("o_orderdate", "dd.MM.yyyy")), "yyyy-MM-dd HH:mm:ss"),
    "strftime(strptime(strftime(o_orderdate, '%d.%m.%Y'), '%d.%m.%Y'), '%Y-%m-%d %H:%M:%S')",
)
_over(
    "dat_05_try_to_timestamp",
    "orders",
    "o_orderkey",
    lambda: F.date_format(dt.try_to_timestamp(F.when(C("o_orderkey") % 7 == 0, "bad").otherwise(F.date_format("o_orderdate", "yyyyMMdd HHmmss")), "YYYYMMDD HH24MISS"), "yyyy-MM-dd HH:mm:ss"),
    "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END",
)
_over(
    "dat_06_to_timestamp",
    "events",
    "event_id",
    lambda: F.date_format(dt.to_timestamp(F.date_format("ts", "yyyy/MM/dd HH-mm-ss"), "YYYY/MM/DD HH24-MI-SS"), "yyyy-MM-dd HH:mm:ss"),
    "strftime(strptime(strftime(ts, '%Y/%m/%d %H-%M-%S'), '%Y/%m/%d %H-%M-%S'), '%Y-%m-%d %H:%M:%S')",
)
_over(
    "dat_07_to_date",
    "orders",
    "o_orderkey",
    lambda: dt.to_date(F.date_format("o_orderdate", "MMddyyyy"), "MMDDYYYY").cast("string"),
    "CAST(CAST(strptime(strftime(o_orderdate, '%m%d%Y'), '%m%d%Y') AS DATE) AS VARCHAR)",
)
_over("dat_08_to_char", "events", "event_id", lambda: dt.to_char(C("ts"), "YYYY-MM-DD HH12:MI:SS HH24"), "strftime(ts, '%Y-%m-%d %I:%M:%S %H')")
_over(
    "dat_09_convert_tz",
    "events",
    "event_id",
    lambda: F.date_format(dt.convert_tz("UTC", "Asia/Tokyo", C("ts")), "yyyy-MM-dd HH:mm:ss"),
    "strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S')",
)
_over(
    "dat_10_run_stamps",
    "events",
    "event_id",
    lambda: F.concat(dt.run_stamp(C("ts")), F.lit("/"), dt.file_stamp(C("ts"))),
    "strftime(ts, '%Y%m%d%H%M%S') || '/' || strftime(ts, '%m%d%Y%H%M%S')",
)

# Arrays and JSON
_over("arr_01_element", "pages", "page_id", lambda: tx.element(tx.split(C("url"), "/"), 5), "string_split(url, '/')[5]")
_over(
    "jsn_01_property",
    "events",
    "event_id",
    lambda: tx.json_property(F.when(C("event_id") % 5 == 0, F.substring("props", 2, 100)).otherwise(C("props")), "K"),
    "CASE WHEN event_id % 5 = 0 THEN '' ELSE coalesce(props ->> '$.K', props ->> '$.k', '') END",
)
_over("jsn_01_property_exact", "events", "event_id", lambda: tx.json_property(C("props"), "k"), "coalesce(props ->> '$.k', '')")
