"""Properties of the operators, with ties, copies, NULL keys and hot keys."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from settleflow.operators import (
    cap_per_group,
    dedup,
    dup_rows,
    extract_fields,
    link_ids,
    lookup_join,
    matched,
    merge_cases,
    merge_update,
    merge_upsert,
    net_zero,
    reject_lines,
    route,
    row_program,
    split_rejects,
    sql_row,
    uniq_rows,
    unmatched,
    with_sequence,
    with_vars,
)
from settleflow.operators.keyjoin import hot_keys, salted_join
from settleflow.schema import apply_schema, key_columns, schema_of, schema_rules

from conftest import bag


@pytest.fixture
def skewed(spark):
    """A third of the rows on one key and half of those the same row; NULL keys; ties."""
    i = F.col("id")
    key = F.when(i % 3 == 0, 7).when(i % 50 == 1, None).otherwise(i % 400 + 1000)
    copy = (i % 6 == 0)
    return spark.range(0, 6000, 1, 8).select(
        key.cast("bigint").alias("k"),
        F.when(copy, 0).otherwise(i % 11).alias("o"),
        F.when(copy, "same").otherwise(i.cast("string")).alias("v"),
    )


def test_uniq_and_dup_cover_the_input(skewed):
    first, later = uniq_rows(skewed, ["k"], ["o"]), dup_rows(skewed, ["k"], ["o"])
    assert first.count() == skewed.select("k").distinct().count()
    assert bag(first.unionByName(later)) == bag(skewed)


def test_duplicates_keep_the_sign_of_zero(spark):
    rows = spark.createDataFrame([(1, 1.0, -0.0), (1, 2.0, -0.0), (1, 3.0, 0.0), (1, 3.0, -0.0), (1, 4.0, None)], "k int, o double, v double")
    assert sorted(repr(r["v"]) for r in dup_rows(rows, ["k"], ["o"]).collect()) == ["-0.0", "-0.0", "0.0", "None"]


def test_first_row_is_the_least(skewed):
    least = skewed.groupBy("k").agg(F.min(F.struct("o", "v")).alias("m")).select("k", "m.*")
    assert bag(uniq_rows(skewed, ["k"], ["o"])) == bag(least)


def test_long_runs_of_copies_are_shared(skewed, monkeypatch):
    monkeypatch.setattr(dedup, "COPIES_PER_TASK", 100)
    first, later = uniq_rows(skewed, ["k"], ["o"]), dup_rows(skewed, ["k"], ["o"])
    assert bag(first.unionByName(later)) == bag(skewed)


def test_dup_once_is_the_second(skewed):
    once = dup_rows(skewed, ["k"], ["o"], only_once=True)
    repeated = skewed.groupBy("k").count().filter("count > 1").count()
    assert once.count() == repeated


def test_order_is_required(skewed):
    for call in (lambda: uniq_rows(skewed, ["k"]), lambda: with_sequence(skewed, "n", []), lambda: cap_per_group(skewed, ["k"], [], 3)):
        with pytest.raises(ValueError):
            call()


def test_sequence_is_dense_in_order(skewed):
    numbered = with_sequence(skewed, "n", ["o", "v"]).orderBy("n").collect()
    assert [r["n"] for r in numbered] == list(range(1, 6001))
    assert [(r["o"], r["v"]) for r in numbered] == sorted((r["o"], r["v"]) for r in numbered)


def test_sequence_per_group(skewed):
    numbered = with_sequence(skewed, "n", ["o", "v"], 10, 5, ["k"])
    wrong = numbered.groupBy("k").agg(F.count(F.lit(1)).alias("c"), F.countDistinct("n").alias("d"), F.min("n").alias("a"), F.max("n").alias("z"))
    assert wrong.filter("d <> c OR a <> 10 OR z <> 10 + 5 * (c - 1)").count() == 0
    assert numbered.count() == 6000


def test_cap_above_the_window_limit(skewed, conf):
    small = cap_per_group(skewed, ["k"], ["o", "v"], 20, rank="n")
    conf(optimizer_windowGroupLimitThreshold="5")
    assert bag(cap_per_group(skewed, ["k"], ["o", "v"], 20, rank="n")) == bag(small)


@pytest.mark.parametrize("limit", ["1000", "1"])
def test_ties_of_a_cap_do_not_depend_on_the_limit_or_the_partitions(spark, conf, limit):
    conf(optimizer_windowGroupLimitThreshold=limit)
    rows = [(1, 7, v) for v in (5, 7, 1, 9, 2, 3)]
    for parts in (1, 3, 5):
        tied = spark.createDataFrame(rows, "k int, o int, v int").repartition(parts)
        assert bag(cap_per_group(tied, ["k"], ["o"], 2)) == [(1, 7, 1), (1, 7, 2)]
        assert [r["v"] for r in with_sequence(tied, "n", ["o"]).orderBy("n").collect()] == [1, 2, 3, 5, 7, 9]


def test_net_zero_parts_cover_the_input(spark):
    rows = spark.createDataFrame(
        [(1, 0.1), (1, 0.2), (1, -0.3), (2, 5.0), (2, -4.0), (3, 0.0), (None, 2.0), (None, -2.0)], "k int, amount double"
    )
    kept, netted = net_zero(rows, ["k"], "amount")
    assert bag(netted) == bag(rows.filter("k = 1"))
    assert bag(kept.unionByName(netted)) == bag(rows)
    assert bag(net_zero(rows, ["k"], "amount", tol=1)[1]) == bag(rows.filter("k IN (1, 2)"))


def test_net_zero_is_exact_and_keeps_what_is_unknown(spark):
    rows = spark.createDataFrame([(1, 2.0), (1, -2.0), (1, None), (2, 0.00004), (2, -0.00003)], "k int, amount double")
    few = rows.filter("k = 1")
    assert bag(net_zero(few, ["k"], "amount")[1]) == bag(few.filter("amount IS NOT NULL"))
    with pytest.raises(Exception, match="more than 4 decimals"):
        net_zero(rows, ["k"], "amount")[0].collect()
    assert net_zero(rows.filter("k = 2"), ["k"], "amount", scale=5)[1].count() == 0
    small = rows.select("k", F.col("amount").cast("decimal(20,8)").alias("amount"))
    assert net_zero(small.filter("k = 2"), ["k"], "amount")[1].count() == 0


def test_matched_and_unmatched_cover_the_source(skewed):
    other = skewed.filter("k < 1200").select("k", F.lit(1).alias("x"))
    both = matched(skewed, other, ["k"]).unionByName(unmatched(skewed, other, ["k"]))
    assert bag(both) == bag(skewed)
    assert matched(skewed, other, ["k"]).filter("k IS NULL").count() == 0


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_lookup_equals_the_plain_one(skewed, spark, conf, how):
    i = F.col("id")
    lookup = spark.range(0, 900, 1, 4).select(F.when(i % 3 == 0, 1001).otherwise(i % 300 + 900).cast("bigint").alias("k"), i.alias("w"))
    plain = bag(lookup_join(skewed, lookup, [("k", "k")], how, name="l"))
    assert bag(lookup_join(skewed, lookup, [("k", "k")], how, name="l", salts=5)) == plain
    conf(autoBroadcastJoinThreshold="-1")
    assert bag(lookup_join(skewed, lookup, [("k", "k")], how, name="l", salts=5)) == plain
    side = lookup.withColumnsRenamed({"k": "lk", "w": "lw"})
    for least in (1, 100, 2000):  # hot on both sides, on the left only, nowhere
        assert bag(salted_join(skewed, side, ["k"], ["lk"], how, 5, least)) == plain


def test_a_unique_lookup_copies_no_row_of_the_main_flow(skewed, spark):
    lookup = skewed.select(F.col("k").alias("lk")).distinct().filter("lk IS NOT NULL")
    kind = [skewed.schema["k"].dataType]
    assert hot_keys(skewed, ["k"], kind, 100).count() > 0
    assert hot_keys(lookup, ["lk"], kind, 100).count() == 0
    joined = salted_join(skewed, lookup, ["k"], ["lk"], "left", 8, 100)
    assert joined.count() == skewed.count()


def test_hot_keys_are_found(skewed):
    kind = [skewed.schema["k"].dataType]
    assert [r["_hot"] for r in hot_keys(skewed, ["k"], kind, 1000).collect()] == ["1:7"]
    assert hot_keys(skewed, ["k"], kind).count() == 0


def test_first_match_keeps_one_row_per_main_row(skewed):
    out = lookup_join(skewed.select("k", "v"), skewed.select("k", "o"), [("k", "k")], name="l", match="first", order_by=["o"])
    assert out.count() == 6000


def test_lookup_needs_names_and_keys(skewed):
    with pytest.raises(ValueError):
        lookup_join(skewed, skewed, [("k", "k")])
    with pytest.raises(ValueError):
        lookup_join(skewed, skewed, [], name="l")


def test_keys_of_other_types_still_match(spark):
    ints, texts = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([("1",), ("3",)], "k string")
    longs = spark.createDataFrame([(1,)], "k bigint")
    assert matched(ints, texts, ["k"]).count() == 1
    assert matched(ints, longs, ["k"]).count() == 1


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (None, "n", 9.0)], "k int, name string, x double")


def test_update_takes_nulls_and_leaves_the_rest(spark, target):
    source = spark.createDataFrame([(1, None, 5.0), (4, "d", 4.0), (None, "m", 0.0)], "k int, name string, x double")
    assert bag(merge_update(target, source, ["k"])) == bag(
        spark.createDataFrame([(1, None, 5.0), (2, "b", 2.0), (None, "n", 9.0)], target.schema)
    )
    assert bag(merge_update(target, source, ["k"], ["x"]).select("name")) == bag(target.select("name"))


def test_upsert_twice_is_upsert_once(spark, target):
    source = spark.createDataFrame([(2, "B", 0.0), (3, "c", 3.0)], target.schema)
    once = merge_upsert(target, source, ["k"])
    assert bag(merge_upsert(once, source, ["k"])) == bag(once)
    assert once.count() == 4


def test_repeated_source_keys(spark, target):
    source = spark.createDataFrame([(1, "p", 1.0), (1, "q", 2.0)], target.schema)
    for call in (merge_update, merge_upsert):
        with pytest.raises(PySparkException, match="repeated key"):
            call(target, source, ["k"]).collect()
    assert merge_update(target, source, ["k"], order_by=[F.col("x").desc()]).filter("k = 1").first()["name"] == "q"


def test_keys_are_required(target):
    for call in (merge_update, merge_upsert, link_ids):
        with pytest.raises(ValueError):
            call(target, target, [])
    with pytest.raises(ValueError):
        merge_upsert(target, target.drop("x"), ["k"])


def test_first_true_case_wins(spark, target):
    source = spark.createDataFrame([(1, 10.0), (2, 0.0)], "k int, x double")
    cases = [("s.x > 5", {"name": "'big'"}), ("s.x >= 0", {"name": "'small'", "x": "t.x - s.x"})]
    out = {r["k"]: (r["name"], r["x"]) for r in merge_cases(target, source, ["k"], cases).collect()}
    assert out == {1: ("big", 1.0), 2: ("small", 2.0), None: ("n", 9.0)}


def test_routes_and_reject_cover_the_input(spark, target):
    flows = route(target, {"low": ("x < 1.5", None), "named": (F.nullif("name", F.lit("n")) == "b", {"k": None})}, reject="rest")
    assert [flows[n].count() for n in ("low", "named", "rest")] == [1, 1, 1]
    assert flows["rest"].first()["name"] == "n"


def test_variables_see_earlier_ones(target):
    out = with_vars(target, {"y": "x * 2", "z": "y + 1"}).filter("k = 2").first()
    assert (out["y"], out["z"]) == (4.0, 5.0)
    assert row_program(target, {"y": "x * 2"}, {"only": "y"}).columns == ["only"]


SPEC = [
    {"name": "id", "type": "id_Long", "key": True, "nullable": False},
    {"name": "code", "type": "id_String", "length": 2},
    {"name": "amount", "type": "id_BigDecimal", "length": 10, "precision": 2},
    {"name": "day", "type": "id_Date", "pattern": "dd.MM.yyyy"},
    {"name": "flag", "type": "id_Boolean", "default": "true"},
]


def test_schema_of_declarations():
    schema = schema_of(SPEC)
    assert schema.simpleString() == "struct<id:bigint,code:string,amount:decimal(10,2),day:date,flag:boolean>"
    assert key_columns(schema) == ["id"]
    assert schema_of([{"name": "x", "type": "id_Strange"}])["x"].dataType.simpleString() == "string"


def test_apply_schema_and_its_rejects(spark):
    schema = schema_of(SPEC)
    raw = spark.createDataFrame(
        [("1", "ab", "1.239", "31.01.2024", None), (None, "a", "1", None, "false"), ("3", "abc", "1", None, None), ("4", None, "x", "2024", None)],
        "id string, code string, amount string, day string, flag string",
    )
    good, rejects = split_rejects(raw, schema_rules(schema))
    assert [r["reject_reason"] for r in rejects.orderBy("id").collect()] == ["id: null", "code: too long", "amount: not decimal(10,2)"]
    row = apply_schema(good, schema).first()
    assert (row["id"], str(row["amount"]), str(row["day"]), row["flag"]) == (1, "1.24", "2024-01-31", True)
    with pytest.raises(PySparkException):
        split_rejects(raw, schema_rules(schema), on_error="fail")[0].collect()


def test_extract_fields(spark):
    lines = spark.createDataFrame([("1; a ;1.234,5;31.01.2024",), ("x;b",), (None,)], "line string")
    schema = schema_of(
        [{"name": "id", "type": "Long"}, {"name": "c", "type": "String"}, {"name": "n", "type": "Double"},
         {"name": "d", "type": "Date", "pattern": "dd.MM.yyyy"}]
    )
    out = extract_fields(lines, schema, sep=";", thousands=".", decimal=",", on_error="null").collect()
    assert [tuple(map(str, r)) for r in out] == [
        ("1", "a", "1234.5", "2024-01-31"), ("None", "b", "None", "None"), ("None", "None", "None", "None")
    ]
    with pytest.raises(PySparkException):
        extract_fields(lines, schema, sep=";").collect()


def test_reject_lines(spark):
    lines = spark.createDataFrame([("a,2024-01-01",), ("a",), ("a,x",)], "line string")
    good, rejects = reject_lines(lines, field_count=2, dates={2: "yyyy-MM-dd"})
    assert good.columns == ["line"] and good.count() == 1
    assert sorted(r["reject_reason"] for r in rejects.collect()) == ["date in field 2", "field count"]


def test_free_sql_is_unwrapped(spark, target):
    assert sql_row(spark, '"SELECT max(x) AS m FROM {t} WHERE x < :top;"', {"top": 5}, t=target).first()["m"] == 2.0
    assert sql_row(spark, "begin\nSELECT count(*) AS n FROM {t}\nend;", t=target).first()["n"] == 3


def test_unknown_routine_fails_at_analysis(target):
    with pytest.raises(PySparkException):
        target.select(F.expr("no_such_routine(x)"))


def test_routes_are_written_in_one_pass(spark, tmp_path):
    from settleflow.operators.rows import tagged
    from settleflow.sources import read_route, write_routes

    (tmp_path / "in").mkdir()
    spark.range(100).selectExpr("id AS a", "CASE WHEN id % 4 = 0 THEN NULL ELSE id % 3 END AS b").write.mode("overwrite").parquet(str(tmp_path / "in"))
    rows = spark.read.parquet(str(tmp_path / "in"))
    outputs = {"one": ("b = 1", {"x": "a * 2", "b": None}), "large": ("a >= 50", None), "never": ("a < 0", {"y": "a"})}
    flows = route(rows, outputs, reject="rest")
    manifest = {r["output"]: r for r in write_routes(rows, outputs, str(tmp_path / "out"), reject="rest").collect()}
    assert set(manifest) == {"one", "large", "never", "rest"}
    for name, flow in flows.items():
        got = read_route(spark, str(tmp_path / "out"), name)
        assert got.columns == flow.columns and bag(got) == bag(flow)
        assert manifest[name]["rows"] == flow.count() and manifest[name]["path"].endswith(f"output={name}")
    plan = tagged(rows, outputs, "rest")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    opened = read_route(spark, str(tmp_path / "out"), "one").inputFiles()
    assert opened and all("output=one" in f for f in opened)


def test_the_last_match_is_the_first_of_the_reverse_order(spark):
    main = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k long")
    lookup = spark.createDataFrame([(1, "a", 1), (1, "b", 1), (1, None, 2), (2, "c", None), (2, "d", None), (None, "e", 1)], "k2 long, v string, o int")
    joined = lambda match: bag(lookup_join(main, lookup, [("k", "k2")], match=match, order_by=["o"]).select("k", "v"))
    assert joined("last") == sorted([(1, None), (2, "d"), (3, None), (None, None)], key=repr)
    assert joined("first") == sorted([(1, "a"), (2, "c"), (3, None), (None, None)], key=repr)
    for wrong in ({"match": "last"}, {"match": "last", "order_by": [F.col("o").desc()]}, {"match": "some"}):
        with pytest.raises(ValueError):
            lookup_join(main, lookup, [("k", "k2")], **wrong)


def test_a_kept_lookup_is_not_shuffled_again(spark, tmp_path, conf):
    from settleflow.operators import keep_lookup

    rows = spark.range(1000).selectExpr("id % 300 AS k", "id AS v")
    kept = keep_lookup(spark.range(500).selectExpr("id AS key", "id * 2 AS w"), ["key"], "kept_for_a_test", 16, str(tmp_path / "kept"))
    conf(autoBroadcastJoinThreshold="-1")
    joined = lookup_join(rows, kept, [("k", "key")])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "kept_for_a_test" in plan
    assert bag(joined) == sorted(((i % 300, i, i % 300, i % 300 * 2) for i in range(1000)), key=repr)
    spark.sql("DROP TABLE kept_for_a_test")


def test_a_hot_key_is_salted(spark):
    rows = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 4 ELSE id END AS k", "id AS v")
    lookup = spark.range(100).selectExpr("id AS k2", "id * 2 AS w")
    joined = lookup_join(rows, lookup, [("k", "k2")], salts=8, hot_rows=500)
    assert bag(joined) == bag(lookup_join(rows, lookup, [("k", "k2")]))
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert "_salt" in plan
    from settleflow.operators.keyjoin import hot_keys
    from pyspark.sql import types as T

    assert hot_keys(rows, ["k"], [T.LongType()], 500).count() == 1 and hot_keys(rows, ["k"], [T.LongType()], 5000).count() == 0
