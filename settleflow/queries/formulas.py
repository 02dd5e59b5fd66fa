"""Settlement formulas over the entries."""

from __future__ import annotations

from pyspark.sql import functions as F

from settleflow.functions import settlement as st
from settleflow.operators.sequence import generate_id
from settleflow.queries.inputs import ENTRIES_SQL, entries
from settleflow.queries.registry import query

C = F.col
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _over(name: str, column, sql: str) -> None:
    @query(name, f"SELECT {', '.join(KEYS)}, {sql} AS v FROM {ENTRIES_SQL}")
    def _(t):
        return entries(t).select(*KEYS, column().alias("v"))


_over("biz_01_rt2_negate", lambda: st.rt2_negate(C("rt"), C("rec_prin")), "CASE WHEN rt = '2' THEN -rec_prin ELSE rec_prin END")
_over(
    "biz_02_share_of_fx_usd",
    lambda: st.share_of_fx_usd(C("dir"), C("rec_prin"), C("pay_prin"), C("clear_fx")),
    "CASE WHEN dir IN ('2','5') THEN rec_prin - pay_prin - clear_fx WHEN dir IN ('1','4') THEN -clear_fx ELSE 0 END",
)
_over(
    "biz_03_share_of_fx_loc_rec",
    lambda: st.share_of_fx_loc_rec(C("dir"), C("rec_prin"), C("pay_prin"), C("clear_fx")),
    "CASE WHEN dir IN ('2','5') THEN -clear_fx WHEN dir IN ('1','4') THEN rec_prin - pay_prin - clear_fx ELSE 0 END",
)
_over(
    "biz_04_share_of_charges",
    lambda: st.share_of_charges(C("dir"), C("rec_charges"), C("clear_charges")),
    "CASE WHEN dir IN ('2','5') THEN -clear_charges WHEN dir IN ('1','4') THEN rec_charges - clear_charges ELSE 0 END",
)
_over(
    "biz_05_clear_principal",
    lambda: st.clear_principal(C("sendpay"), C("dir"), C("rec_prin")),
    "CASE WHEN sendpay = 'P' AND dir IN ('1','4') THEN -rec_prin ELSE rec_prin END",
)
_over("biz_06_origpay_ind", lambda: st.origpay_ind(C("rt")), "CASE rt WHEN '2' THEN 'O' WHEN '3' THEN 'P' ELSE 'X' END")
_over(
    "biz_07_century_date_fix",
    lambda: st.century_date_fix(C("setdate")),
    "CASE WHEN left(setdate, 3) BETWEEN '121' AND '129' THEN '20' || substr(setdate, 2) ELSE setdate END",
)
_over(
    "biz_08_basicha",
    lambda: st.basicha(C("rt"), C("basic")),
    "CASE WHEN rt = '2' AND basic >= 0 THEN -basic ELSE basic END",
)
_over("biz_09_shacha", lambda: st.shacha(C("rec_charges"), C("clear_charges")), "rec_charges - clear_charges")


@query(
    "biz_10_generate_id",
    """SELECT o_orderkey, '20240305060708' || o_orderstatus || CAST(o_custkey % 20 + 1 AS VARCHAR)
         || lpad(CAST(row_number() OVER (ORDER BY o_orderkey) AS VARCHAR), 6, '0') AS entry_id
       FROM orders""",
)
def _(t):
    made = generate_id(
        t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"),
        C("o_orderstatus"),
        C("o_custkey") % 20 + 1,
        ["o_orderkey"],
        now=F.lit("2024-03-05 06:07:08").cast("timestamp_ntz"),
    )
    return made.select("o_orderkey", "entry_id")
