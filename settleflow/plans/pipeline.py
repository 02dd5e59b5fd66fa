"""The settlement load: staging, post-sync, final load and post job.

The steps and their order are given; which columns, keys and conditions they use are parameters,
because every table set has its own. Each function returns new snapshots and writes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settleflow.functions import settlement, text
from settleflow.operators.dedup import dup_rows, net_zero, uniq_rows
from settleflow.operators.joins import unmatched
from settleflow.operators.keyjoin import key_join
from settleflow.operators.merge import link_ids, merge_cases, merge_update, update_status
from settleflow.operators.rows import Expression, line_rules, split_lines, split_rejects, with_vars
from settleflow.schema import cast_to, schema_rules
from settleflow.sources.sinks import truncate


@dataclass
class EntrySpec:
    """Layout of an entry file and the columns its formulas read."""

    schema: T.StructType
    sep: str = "|"
    line: str = "line"
    keep: Sequence[str] = ()
    rt: str = "rt"
    direction: str = "dir"
    sendpay: str = "sendpay"
    setdate: str = "setdate"
    rec: str = "rec_prin"
    pay: str = "pay_prin"
    fx: str = "clear_fx"
    rec_charges: str = "rec_charges"
    clear_charges: str = "clear_charges"
    basic: str = "basic"


@dataclass
class SyncSpec:
    """Keys, order and update cases of the post-sync steps."""

    keys: Sequence[str]
    order_by: Sequence[Column | str]
    cases: Sequence[tuple[Expression, Mapping[str, Expression]]]
    template_keys: Sequence[str]
    id_col: str = "entry_id"
    status: str = "status"
    status_condition: Expression | None = None
    amount: str = "amount"
    rt: str = "rt"
    net_keys: Sequence[str] = field(default_factory=tuple)
    cols: Sequence[str] | None = None  # source columns the cases read; all unless they are named


def _parsed(lines: DataFrame, spec: EntrySpec) -> tuple[DataFrame, DataFrame]:
    """Typed rows and rejected lines. A line is rejected for its field count or a value that does not fit."""
    fields = spec.schema.fields
    pieces = [F.trim(text.element(F.col("_pieces"), i)) for i, _ in enumerate(fields, start=1)]
    raw = F.struct(*[p.alias(f.name) for p, f in zip(pieces, fields)])
    typed = F.struct(*[cast_to(p, f).alias(f.name) for p, f in zip(pieces, fields)])
    # One row per line out of an explode: the rules below read each value, none casts it again.
    both = F.explode(F.array(F.struct(raw.alias("raw"), typed.alias("typed"))))
    rows = split_lines(lines, spec.line, spec.sep).withColumn("_row", both)
    rules = {
        **line_rules(F.col("_pieces"), field_count=len(fields)),
        **schema_rules(spec.schema, "_row.raw.", "_row.typed."),
    }
    good, rejects = split_rejects(rows, rules)
    return good.select(*spec.keep, "_row.typed.*"), rejects.select(*spec.keep, spec.line, "reject_reason")


def stage_entries(lines: DataFrame, spec: EntrySpec) -> tuple[DataFrame, DataFrame]:
    """Entry lines to staging rows with the settlement amounts, and the rejected lines."""
    typed, rejects = _parsed(lines, spec)
    c = F.col
    staged = with_vars(
        typed,
        {
            "origpay": settlement.origpay_ind(c(spec.rt)),
            "settle_date": settlement.century_date_fix(c(spec.setdate)),
            "fx_usd": settlement.share_of_fx_usd(c(spec.direction), c(spec.rec), c(spec.pay), c(spec.fx)),
            "fx_local": settlement.share_of_fx_loc_rec(c(spec.direction), c(spec.rec), c(spec.pay), c(spec.fx)),
            "charges": settlement.share_of_charges(c(spec.direction), c(spec.rec_charges), c(spec.clear_charges)),
            "principal": settlement.clear_principal(c(spec.sendpay), c(spec.direction), c(spec.rec)),
            "basic_charge": settlement.basicha(c(spec.rt), c(spec.basic)),
        },
    )
    return staged, rejects


def stage_activity(lines: DataFrame, spec: EntrySpec) -> tuple[DataFrame, DataFrame]:
    """Activity lines to typed rows, and the rejected lines."""
    return _parsed(lines, spec)


def final_load(
    merge: DataFrame,
    prod: DataFrame,
    adj: DataFrame,
    keys: Sequence[str],
    amount: str,
    rt: str = "rt",
    net_keys: Sequence[str] | None = None,
    order_by: Sequence[Column | str] | None = None,
    scale: int = 4,
) -> dict[str, DataFrame]:
    """Bring the merge table into production.

    1. Merge rows whose keys production has update it. 2. Of the others, entries that cancel out
    within ``net_keys`` are taken away. 3. What is left is inserted. 4. The amount of adjustments
    of record type 2 changes its sign, if their ``keys`` are among the merge rows: the adjustments of
    other loads stay as they are. 5. The merge table is emptied.

    A repeated key that production lacks is inserted as often; one that production has needs an order. Amounts of the merge
    table that are doubles have at most ``scale`` decimals, else the job ends (see :func:`net_zero`). Production is read twice and the merge
    table three times.
    """
    # With an order one row per key is taken; without, only rows that do update must be unique.
    updated = merge_update(prod, merge, keys, order_by=order_by, check="matched")
    turned = _turned(adj, merge, keys, amount, rt)
    within = list(net_keys or keys)
    if set(keys) <= set(within):
        # Rows that cancel out share their keys: production has all of them or none, so they are summed without asking it.
        kept, netted = (unmatched(rows, prod, keys) for rows in net_zero(merge, within, amount, scale=scale))
    else:
        kept, netted = net_zero(unmatched(merge, prod, keys), within, amount, scale=scale)
    return _inserted(kept, netted, updated, turned) | {"merge": truncate(merge)}


def _turned(adj: DataFrame, loaded: DataFrame, keys: Sequence[str], amount: str, rt: str) -> DataFrame:
    """Adjustments with the sign of type 2 turned where their keys are being loaded."""
    names = [f"_k{i}" for i in range(len(keys))]
    now = loaded.select(*[F.col(k).alias(n) for k, n in zip(keys, names)]).distinct().withColumn("_now", F.lit(True))
    turned = F.when(F.col("_now"), settlement.rt2_negate(F.col(rt), F.col(amount))).otherwise(F.col(amount))
    return key_join(adj, now, keys, names, "left").withColumn(amount, turned).select(*adj.columns)


def _inserted(kept: DataFrame, netted: DataFrame, prod: DataFrame, adj: DataFrame) -> dict[str, DataFrame]:
    """Steps 2 and 3: the new rows that do not cancel out are inserted."""
    return {"prod": prod.unionByName(kept.select(*prod.columns)), "netted": netted, "adj": adj}


def post_sync(
    staging: DataFrame,
    activity: DataFrame,
    prod: DataFrame,
    templates: DataFrame,
    adj: DataFrame,
    spec: SyncSpec,
) -> dict[str, DataFrame]:
    """Everything between staging and the final load, and the final load itself.

    Staging is read by several outputs: buffer it when it is costly to compute. Nothing staged
    leaves every table as it is, but duplicate activity rows are set aside in a run with activity
    files only too. Otherwise: duplicate activity rows are set aside and the others returned as ``activity``,
    waiting rows become settled, staging updates production by the first case that holds, templates
    get the ids of their entries, staging rows production lacks go to the merge table, and that
    table is loaded.
    """
    if staging.isEmpty():
        return {
            "duplicates": dup_rows(activity, list(spec.keys), spec.order_by),
            "activity": uniq_rows(activity, list(spec.keys), spec.order_by),
            "staging": staging,
            "prod": prod,
            "templates": templates,
            "netted": truncate(staging),
            "adj": adj,
            "merge": truncate(staging),
        }
    keys = list(spec.keys)
    duplicates = dup_rows(activity, keys, spec.order_by)
    once = uniq_rows(activity, keys, spec.order_by)
    settled = update_status(staging, "W", "S", spec.status_condition, spec.status)
    updated = merge_cases(prod, settled, keys, spec.cases, spec.order_by, spec.cols)
    linked = link_ids(templates, settled, list(spec.template_keys), spec.id_col, spec.order_by)
    # The merge table holds the rows production lacks, so its load has nothing left to update.
    third = unmatched(settled, prod, keys)
    turned = _turned(adj, third, keys, spec.amount, spec.rt)
    kept, netted = net_zero(third, spec.net_keys or keys, spec.amount)
    loaded = _inserted(kept, netted, updated, turned)
    return {
        "duplicates": duplicates,
        "activity": once,
        "staging": settled,
        "templates": linked,
        "merge": truncate(third),
        **loaded,
    }


def apply_type4(
    prod: DataFrame, type4: DataFrame, keys: Sequence[str], status: str = "status",
    order_by: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Status of production rows from record type 4."""
    return merge_update(prod, type4, keys, [status], order_by)


def apply_pay_dates(
    prod: DataFrame, type4: DataFrame, keys: Sequence[str], pay_date: str = "pay_date",
    order_by: Sequence[Column | str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Pay dates of production rows from record type 4, and its emptied staging table."""
    return merge_update(prod, type4, keys, [pay_date], order_by), truncate(type4)


def close_activity(
    prod: DataFrame,
    activity: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column | str],
    duplicates: DataFrame,
    status: str = "status",
    closed: str = "C",
) -> tuple[DataFrame, DataFrame]:
    """Production rows with activity are closed; the duplicates table is emptied."""
    first = uniq_rows(activity, keys, order_by).select(*keys)
    done = merge_cases(prod, first, keys, [(F.lit(True), {status: F.lit(closed)})])
    return done, truncate(duplicates)


def post_job(
    prod: DataFrame,
    type4: DataFrame,
    activity: DataFrame,
    duplicates: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column | str],
    status: str = "status",
    pay_date: str = "pay_date",
) -> dict[str, DataFrame]:
    """Status from record type 4, pay dates, then closing by activity.

    Status and pay date come from the same type-4 row, so they are set in one join.
    """
    dated = merge_update(prod, type4, keys, [status, pay_date], order_by)
    closed, emptied = close_activity(dated, activity, keys, order_by, duplicates, status)
    return {"prod": closed, "type4": truncate(type4), "duplicates": emptied}
