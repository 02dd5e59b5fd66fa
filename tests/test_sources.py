"""Files and tables, read and written."""

import random
import duckdb
import csv
import gzip

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from settleflow.operators import merge_upsert
from settleflow.schema import schema_of
from settleflow.sources import (
    append_by_name,
    export_parquet,
    fixed_rows,
    group_table_name,
    list_files,
    load_by_name,
    number_files,
    read_all_groups,
    read_delimited,
    read_lines,
    read_mapping,
    write_delimited,
    write_groups,
    write_insert,
    write_snapshot,
)

from conftest import bag

PAIR = schema_of([{"name": "a", "type": "id_Long"}, {"name": "b", "type": "id_String"}])


@pytest.mark.parametrize("split", ["64", "1000", "128MB"])
@pytest.mark.parametrize("header, footer", [(3, 0), (0, 2), (2, 1)])
def test_edge_lines_are_dropped_whatever_the_splits(spark, conf, tmp_path, split, header, footer):
    conf(files_maxPartitionBytes=split)
    for name in ("x", "y"):
        body = [f"{name}{n:03d}" for n in range(100)]
        (tmp_path / f"{name}.txt").write_text("\n".join(["head"] * header + body + ["foot"] * footer) + "\n")
    got = sorted(r["line"] for r in read_lines(spark, str(tmp_path), header=header, footer=footer).collect())
    assert got == sorted(f"{name}{n:03d}" for name in "xy" for n in range(100))


def test_edge_lines_of_short_and_empty_files(spark, conf, tmp_path):
    conf(files_maxPartitionBytes="16")
    for n in range(6):
        (tmp_path / f"{n}.txt").write_text("".join(f"{n} line {i}\n" for i in range(n)))
    got = sorted(r["line"] for r in read_lines(spark, str(tmp_path), header=2, footer=2).collect())
    assert got == ["5 line 2"]
    got = sorted(r["line"] for r in read_lines(spark, str(tmp_path), header=1, footer=0).coalesce(1).collect())
    assert got == sorted(f"{n} line {i}" for n in range(6) for i in range(1, n))
    assert read_lines(spark, str(tmp_path), header=9, footer=9).count() == 0


def test_edge_lines_stay_in_the_jvm_and_no_line_is_shuffled(spark, conf, tmp_path, monkeypatch):
    from settleflow.sources import delimited

    (tmp_path / "x.txt").write_text("".join(f"{i}\n" for i in range(1000)))
    rows = read_lines(spark, str(tmp_path), header=2, footer=1)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan
    bulk = plan.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in bulk and "Exchange hashpartitioning" not in bulk
    # More edge lines than are broadcast: the same rows by a shuffle.
    monkeypatch.setattr(delimited, "BROADCAST_EDGES", 0)
    conf(autoBroadcastJoinThreshold=-1, files_maxPartitionBytes="100")
    shuffled = read_lines(spark, str(tmp_path), header=2, footer=1)
    assert sorted(int(r["line"]) for r in shuffled.collect()) == list(range(2, 999))


@pytest.mark.parametrize("header", [0, 1, 2])
def test_empty_lines_are_rows_of_one_scan(spark, tmp_path, header):
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text("head\n" * header + '1,x\n\n2,"y,z"\n   \n')
    rows = read_delimited(spark, str(tmp_path), PAIR, header=header, remove_empty_rows=False, corrupt="raw")
    expected = [(1, "x", None), (2, "y,z", None), (None, None, None), (None, None, None)] * 2
    assert bag(rows) == sorted(expected, key=repr)
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan text") == (2 if header else 1)
    kept = read_delimited(spark, str(tmp_path), PAIR, header=header)
    assert bag(kept) == sorted([(1, "x"), (2, "y,z")] * 2, key=repr)


def test_delimited_with_edges_and_gzip(spark, tmp_path):
    with gzip.open(tmp_path / "x.csv.gz", "wt") as out:
        out.write("title\na|b\n1|x\n\n2|'y|z'\nbad|w\ntotal\n")
    rows = read_delimited(spark, str(tmp_path), PAIR, "|", header=2, footer=1, quote="'", on_error="null")
    assert bag(rows) == bag(spark.createDataFrame([(1, "x"), (2, "y|z"), (None, "w")], "a bigint, b string"))


def test_bad_rows_are_kept_or_fail(spark, tmp_path):
    (tmp_path / "x.csv").write_text("1,x\n2\nz,y\n")
    rows = read_delimited(spark, str(tmp_path), PAIR, corrupt="raw")
    assert sorted(r["raw"] for r in rows.collect() if r["raw"]) == ["2", "z,y"]
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_delimited(spark, str(tmp_path), PAIR).collect()


def test_empty_rows(spark, tmp_path):
    (tmp_path / "x.csv").write_text("1,x\n\n \n2,y\n")
    assert read_delimited(spark, str(tmp_path), PAIR, trim=True, on_error="null").filter("a IS NOT NULL").count() == 2
    assert read_delimited(spark, str(tmp_path), PAIR, trim=True, remove_empty_rows=False, on_error="null").count() >= 4


def test_limit_and_random_rows(spark, tmp_path):
    (tmp_path / "x.csv").write_text("".join(f"{n},x\n" for n in range(50)))
    assert read_delimited(spark, str(tmp_path), PAIR, limit=7).count() == 7
    assert read_delimited(spark, str(tmp_path), PAIR, random_rows=9).distinct().count() == 9


def test_write_options(spark, tmp_path):
    rows = spark.range(10).selectExpr("id AS a", "'t' AS b", "1 AS other").coalesce(1)
    write_delimited(rows, str(tmp_path / "o"), ";", header=True, cols=["a", "b"], rows_per_file=4)
    assert len(list((tmp_path / "o").glob("*.csv"))) == 3
    write_delimited(rows, str(tmp_path / "o"), ";", header=True, cols=["a", "b"], append=True)
    assert read_delimited(spark, str(tmp_path / "o"), PAIR, ";", header=1).count() == 20


def test_listing(spark, tmp_path):
    for name, size in (("b.ST", 3), ("a.ST", 9), ("c.txt", 1), ("d.st", 2)):
        (tmp_path / name).write_text("x" * size)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "e.ST").write_text("xx")
    names = lambda **o: [r["name"] for r in list_files(spark, str(tmp_path), **o).collect()]
    assert names(mask="*.ST") == ["a.ST", "b.ST"]
    assert names(mask="*.ST", order="size") == ["b.ST", "a.ST"]
    assert names(mask="*.st", case_sensitive=False, exclude="a*") == ["b.ST", "d.st"]
    assert names(mask="*.ST", recursive=True, desc=True) == ["e.ST", "b.ST", "a.ST"]
    plan = list_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
    numbered = number_files(list_files(spark, str(tmp_path)), 2).collect()
    assert [(r["iteration"], r["name"]) for r in numbered] == [(1, "a.ST"), (2, "b.ST")]
    assert number_files(list_files(spark, str(tmp_path)), None).count() == 4


def test_groups_are_partitions(spark, tmp_path):
    rows = spark.range(100).select("id", (F.col("id") % 4 + 1).cast("string").alias("grp"))
    write_groups(rows, str(tmp_path / "g"))
    some = read_all_groups(spark, str(tmp_path / "g"), ["2", "3"])
    assert some.count() == 50 and some.schema["grp"].dataType.simpleString() == "string"
    assert "PartitionFilters: [grp" in some._jdf.queryExecution().executedPlan().toString()
    assert group_table_name("entry_grp", 7) == "entry_grp7"
    assert group_table_name("entry_grp{N}_x", 7, "_test") == "entry_grp7_x_test"


def test_fixed_rows_and_mapping(spark):
    schema = schema_of([{"name": "a", "type": "id_Integer", "default": "3"}, {"name": "b", "type": "id_String"}])
    assert bag(fixed_rows(spark, schema, {}, 2)) == [(3, None), (3, None)]
    pairs = spark.createDataFrame([(1, 5), (1, 6), (2, None)], "k int, v int")
    assert bag(read_mapping(spark, pairs.filter("v = 6 OR v IS NULL"), "k", "v")) == [("1", "6")]
    with pytest.raises(Exception, match="several values"):
        read_mapping(spark, pairs, "k", "v").collect()


def test_insert_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    for mode, rows in (("append", 3), ("append", 6), ("overwrite", 3)):
        write_insert(spark.range(3), path, mode=mode)
        assert spark.read.parquet(path).count() == rows


def test_export_and_load_isolate_failures(spark, tmp_path):
    good = spark.range(5).withColumnRenamed("id", "K")
    bad = spark.range(1).select(F.raise_error(F.lit("no")).cast("string").alias("x"))
    done = {r["table"]: r for r in export_parquet(spark, {"bad": bad, "good": good}, str(tmp_path / "e")).collect()}
    assert done["good"]["status"] == "ok" and done["good"]["size"] > 0
    assert done["bad"]["status"] == "error" and done["bad"]["error"]
    write_insert(spark.range(2).withColumnRenamed("id", "k"), str(tmp_path / "t"))
    loaded = load_by_name(spark, {"good": done["good"]["path"], "bad": "/none"}, {"good": str(tmp_path / "t"), "bad": str(tmp_path / "t")})
    assert {r["table"]: (r["status"], r["rows"]) for r in loaded.collect()} == {"good": ("ok", 5), "bad": ("error", None)}
    assert spark.read.parquet(str(tmp_path / "t")).count() == 7


def test_names_differing_by_case_are_refused(spark):
    target = spark.createDataFrame([(1,)], "k int")
    twins = spark.createDataFrame([(1, 2)], "a int, b int").toDF("k", "K")
    with pytest.raises(ValueError):
        append_by_name(twins, target)


def test_a_merge_goes_to_a_new_snapshot(spark, tmp_path):
    first = write_snapshot(spark.range(5).selectExpr("id AS k", "'old' AS v"), str(tmp_path))
    source = spark.range(3, 8).selectExpr("id AS k", "'new' AS v")
    second = write_snapshot(merge_upsert(spark.read.parquet(first), source, ["k"]), str(tmp_path))
    assert spark.read.parquet(first).count() == 5
    assert bag(spark.read.parquet(second)) == [(k, "old" if k < 3 else "new") for k in range(8)]


def _quoted_rows(rng, count):
    word = lambda: "".join(rng.choice('ab "\n,;é') for _ in range(rng.randrange(0, 12)))
    rows = [(str(n), word(), "\r\n" if n % 9 == 0 else word(), "x" * rng.randrange(0, 40)) for n in range(count)]
    return rows + [(str(count), "\n" * 300, '"' * 50, "a\r\nb"), (str(count + 1), "", "", "")]


@pytest.mark.parametrize("split", [48, 333, 4096, 1 << 27])
def test_records_that_span_lines_at_every_split(spark, tmp_path, conf, split):
    rng = random.Random(split)
    written = {}
    for name, end in (("a.csv", "\n"), ("b.csv", "\r\n"), ("c.csv", "\n")):
        written[name] = _quoted_rows(rng, 150 if name != "c.csv" else 0)
        with open(tmp_path / name, "w", newline="") as file:
            writer = csv.writer(file, lineterminator=end)
            writer.writerow(["n", "two", "three\nlines" if name == "a.csv" else "three", "four"])
            writer.writerows(written[name])
    schema = schema_of([{"name": n, "type": "id_String"} for n in ("n", "two", "three", "four")])
    conf(files_maxPartitionBytes=str(split), files_openCostInBytes="0")
    if split == 48:  # a header of several splits is not the reader's to skip
        (tmp_path / "a.csv").unlink()
        written.pop("a.csv")
    got = read_delimited(spark, str(tmp_path), schema, header=1, multi_line=True, remove_empty_rows=False)
    expected = [tuple(v if v else None for v in row) for rows in written.values() for row in rows]
    assert bag(got) == sorted(expected, key=repr)
    if split < 4096:
        assert got.rdd.getNumPartitions() > len(written)  # several tasks a file


def test_records_equal_those_of_another_reader(spark, tmp_path, conf):
    rng = random.Random(5)
    with open(tmp_path / "a.csv", "w", newline="") as file:
        csv.writer(file, lineterminator="\n").writerows((str(n), "".join(rng.choice('a"\n,') for _ in range(rng.randrange(1, 30)))) for n in range(3000))
    conf(files_maxPartitionBytes="2000", files_openCostInBytes="0")
    schema = schema_of([{"name": n, "type": "id_String"} for n in ("n", "v")])
    got = read_delimited(spark, str(tmp_path / "a.csv"), schema, multi_line=True)
    other = duckdb.connect().execute(f"SELECT * FROM read_csv('{tmp_path}/a.csv', header=false, columns={{'n': 'VARCHAR', 'v': 'VARCHAR'}}, quote='\"', escape='\"', delim=',')")
    assert bag(got) == sorted((tuple(row) for row in other.fetchall()), key=repr)


def test_empty_lines_inside_and_between_records(spark, tmp_path):
    (tmp_path / "x.csv").write_text('1,"a\n\n\nb"\n\n2,c\n')
    rows = read_delimited(spark, str(tmp_path), PAIR, multi_line=True, remove_empty_rows=False)
    assert bag(rows) == sorted([(1, "a\n\n\nb"), (None, None), (2, "c")], key=repr)
    assert bag(read_delimited(spark, str(tmp_path), PAIR, multi_line=True)) == [(1, "a\n\n\nb"), (2, "c")]
    (tmp_path / "x.csv").write_text('1,"a\\"\nb"\n2,"c\\\\"\n')
    assert bag(read_delimited(spark, str(tmp_path), PAIR, multi_line=True, escape="\\")) == [(1, 'a"\nb'), (2, "c\\")]
    with pytest.raises(ValueError):
        read_delimited(spark, str(tmp_path), PAIR, multi_line=True, footer=1)
