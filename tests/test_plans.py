"""What the physical plans of the operators must look like, and the composite jobs."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from settleflow import intermediates
from settleflow.operators import dup_rows, lookup_join, merge_update, observe_rows, unmatched, uniq_rows, with_sequence
from settleflow.plans import final_load, group_status, post_sync, route_files, run_groups
from settleflow.queries.registry import Tables
from settleflow.queries.settlement import SYNC, _staged
from settleflow.sources import truncate

from conftest import SMALL, bag


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan adaptive execution ended with."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def tables(spark):
    return Tables(spark, SMALL)


def test_first_rows_are_cut_before_the_shuffle(tables):
    text = plan(uniq_rows(tables.lineitem, ["l_orderkey"], ["l_linenumber"], ["l_orderkey", "l_linenumber"]))
    below = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in below and "row_number(), 1, Partial" in below
    assert "l_extendedprice" not in text


def test_duplicates_take_two_scans_and_two_shuffles(tables):
    text = final_plan(dup_rows(tables.events, ["user_id", "event_type"], ["ts", "event_id"], ["event_id", "user_id"]))
    assert text.count("FileScan") == 2 and text.count("Exchange hashpartitioning") == 2


def test_final_load_reads_production_twice(tables):
    prod = tables.orders.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("amount"))
    merge = tables.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.sum("l_tax").cast("decimal(18,2)").cast("double").alias("amount"))
    adj = tables.orders.selectExpr("o_orderkey AS k", "'2' AS rt", "o_totalprice AS amount")
    loaded = plan(final_load(merge, prod, adj, ["k"], "amount")["prod"])
    assert loaded.count("o_orderkey") and loaded.count("orders.parquet") == 2 and loaded.count("lineitem.parquet") == 3


@pytest.mark.parametrize("net_keys", [None, ["k", "part"], ["part"]])
def test_final_load_by_any_net_keys(spark, net_keys):
    schema = "k int, part string, amount double"
    prod = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0)], schema)
    rows = [(1, "b", 9.0), (3, "a", 5.0), (3, "a", -5.0), (4, "a", 7.0), (4, "b", -7.0), (5, "b", 7.0), (None, "a", 1.0), (None, "a", -1.0)]
    merge = spark.createDataFrame(rows, schema)
    adj = spark.createDataFrame([(3, "2", 4.0), (9, "2", 4.0)], "k int, rt string, amount double")
    out = final_load(merge, prod, adj, ["k"], "amount", net_keys=net_keys)
    new = [r for r in rows if r[0] not in (1, 2)]
    at = {None: lambda r: (r[0],), ("k", "part"): lambda r: r[:2], ("part",): lambda r: (r[1],)}[net_keys and tuple(net_keys)]
    groups = {}
    for row in new:
        if None not in at(row):
            groups.setdefault(at(row), []).append(row[2])
    gone = [r for r in new if len(groups.get(at(r), [])) > 1 and sum(groups[at(r)]) == 0]
    left = [r for r in new if r not in gone]
    assert bag(out["netted"]) == sorted(gone, key=repr)
    assert bag(out["prod"]) == sorted([(1, "b", 9.0), (2, "a", 2.0), *left], key=repr)
    assert bag(out["adj"]) == [(3, "2", -4.0), (9, "2", 4.0)]
    # A repeated key matters only where production has it, unless an order says which row counts.
    twice = merge.union(spark.createDataFrame([(1, "c", 8.0)], schema))
    with pytest.raises(PySparkException, match="repeated key"):
        final_load(twice, prod, adj, ["k"], "amount", net_keys=net_keys)["prod"].collect()
    first = final_load(twice, prod, adj, ["k"], "amount", net_keys=net_keys, order_by=["amount"])["prod"]
    assert first.filter("k = 1").collect()[0]["part"] == "c"


def test_filter_and_columns_reach_the_scan(tables):
    lines = tables.lineitem.filter("l_shipdate > TIMESTAMP_NTZ '2000-01-01 00:00:00'")
    text = plan(unmatched(tables.orders, lines, ["o_orderkey"], ["l_orderkey"]).select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThan(l_shipdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_small_lookup_is_broadcast_and_a_large_one_is_not(tables, conf):
    join = lambda: lookup_join(tables.orders, tables.customer, [("o_custkey", "c_custkey")])
    assert "BroadcastHashJoin" in plan(join())
    conf(autoBroadcastJoinThreshold="1KB")
    assert "SortMergeJoin" in plan(join()) and "Broadcast" not in plan(join())


def test_no_python_and_no_lone_window(tables):
    flows = [
        dup_rows(tables.lineitem, ["l_orderkey"], ["l_linenumber"]),
        merge_update(tables.orders, tables.orders, ["o_orderkey"]),
        _staged(tables)[0],
    ]
    for text in map(plan, flows):
        assert "EvalPython" not in text and "PythonUDF" not in text
        assert "SinglePartition" not in text and "CartesianProduct" not in text


def test_intermediate_tables_go_when_their_owner_is_done(spark, tables, tmp_path):
    outside = with_sequence(tables.nation, "n", ["n_nationkey"])
    with intermediates(spark) as outer:
        with intermediates(spark) as made:
            numbered = with_sequence(tables.nation, "n", ["n_name"])
            assert len(made) == 1 and os.path.isdir(made[0])
            numbered.write.parquet(str(tmp_path / "kept"))
        assert not os.path.exists(made[0]) and outer == []
        later = with_sequence(tables.nation, "n", ["n_name"])
        assert bag(spark.read.parquet(str(tmp_path / "kept"))) == bag(later)
    with pytest.raises(RuntimeError):
        with intermediates(spark) as failed:
            with_sequence(tables.nation, "n", ["n_name"])
            raise RuntimeError
    assert not any(os.path.exists(folder) for folder in outer + failed)
    assert outside.count() == 25


def test_sequence_keeps_rows_apart(tables):
    text = plan(with_sequence(tables.lineitem, "n", ["l_orderkey", "l_linenumber", "l_partkey"]))
    # The one window without a partition runs over partition sizes, below the broadcast.
    assert text.count("Window ") == 1
    assert text.index("BroadcastExchange") < text.index("Window ")


def test_hot_left_key_is_split(spark, conf):
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive_skewJoin_skewedPartitionThresholdInBytes="20KB",
        adaptive_skewJoin_skewedPartitionFactor="2",
        adaptive_advisoryPartitionSizeInBytes="20KB",
    )
    i = F.col("id")
    rows = spark.range(0, 200_000, 1, 8).select(F.when(i % 3 == 0, -1).otherwise(i).alias("k"), i.alias("v"))
    some = rows.filter("v % 2 = 0").select("k", F.lit("x").alias("note"))
    for flow in (
        unmatched(rows, some, ["k"]),
        merge_update(rows.withColumn("note", F.lit("")), some, ["k"], order_by=["note"]),
        lookup_join(rows, some.distinct(), [("k", "k")], name="s", match="first", order_by=["note"]),
    ):
        assert "skew=true" in final_plan(flow)


def test_route_needs_a_mapping_when_strict(spark):
    manifest = spark.createDataFrame(
        [(f"/in/ST/STL_{n}_{i}.txt", f"STL_{n}_{i}.txt") for n in (101, 102) for i in range(20)]
        + [("/in/ST/x.csv", "x.csv"), ("/in/AC/activ_101_a.dat", "activ_101_a.dat"), ("/in/AC/STL_101_a.txt", "STL_101_a.txt")],
        "path string, name string",
    )
    empty = spark.createDataFrame([], "network_id string, grp_number string")
    for mapping in (None, empty):
        with pytest.raises(ValueError):
            route_files(manifest, mapping)
    assert route_files(manifest, empty, strict=False, groups=3).count() == 3 * 16
    known = spark.createDataFrame([("101", "4")], empty.schema)
    routed = route_files(manifest, known)
    assert sorted((r["class"], r["position"]) for r in routed.collect()) == [("AC", 1)] + [("ST", n) for n in range(1, 16)]
    assert routed.filter("position = 1 AND class = 'ST'").first()["routed_name"] == "1.STL_101_0.txt"
    again = route_files(manifest, known, taken=routed)
    assert again.count() == 5 and again.join(routed, "path", "left_semi").count() == 0
    twice = spark.createDataFrame([("101", "4"), ("101", "5")], empty.schema)
    with pytest.raises(Exception, match="several values"):
        route_files(manifest, twice).collect()
    near = spark.createDataFrame([("/in/TEST/STL_101_1.txt", "STL_101_1.txt")], manifest.schema)
    assert route_files(near, known).count() == 0


def test_groups_run_in_one_plan(spark):
    rows = spark.createDataFrame([("1", 1, 5), ("1", 1, 3), ("2", 1, 9)], "grp string, k int, v int")
    out = run_groups(rows, lambda df, keys: uniq_rows(df, keys, ["v"]), ["k"])
    assert bag(out) == [("1", 1, 3), ("2", 1, 9)]
    with pytest.raises(ValueError):
        run_groups(rows.drop("grp"), lambda df, keys: df)


def test_nothing_staged_changes_nothing(spark):
    prod = spark.createDataFrame([(1, 0, 0, 0, "1", "N", 2.0, "e")], "k int, line int, part int, supp int, rt string, status string, amount double, entry_id string")
    out = post_sync(truncate(prod), prod, prod, prod, prod, SYNC)
    assert out["prod"] is prod and out["adj"] is prod
    assert out["merge"].count() == 0 and out["duplicates"].count() == 0


def test_rows_are_counted_on_the_way(spark):
    flow, seen = observe_rows(spark.range(7), "seven")
    flow.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 7


def test_status_board_has_every_group(spark):
    runs = spark.createDataFrame(
        [(2, "RUNNING", "s", 1, 1, 10, "2024-01-01 00:00:00", 1.5), (2, "FAILED", "t", 2, 2, 20, "2024-01-02 00:00:00", 2.5)],
        "grp int, status string, step string, st_files int, ac_files int, rows bigint, start string, duration_sec double",
    ).withColumn("start", F.col("start").cast("timestamp_ntz"))
    board = {r["grp"]: r for r in group_status(spark, runs).collect()}
    assert len(board) == 20 and board[2]["status"] == "FAILED" and board[1]["status"] == "IDLE"
    assert board[1]["duration"] == "—" and board[2]["duration"] == "2.5"
