"""Versions of tables per batch, files admitted and archived, first rows of a shuffled stream, writes to buckets."""

import json
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from settleflow.operators import dup_rows, merge_update, merge_upsert, uniq_rows
from settleflow.queries import QUERIES, streams
from settleflow.sources import BucketTable
from settleflow.streaming import (
    VersionedTables,
    archive_committed,
    first_rows_stream,
    stream_admitted,
    stream_lines,
    stream_load,
    stream_pipeline,
)

from conftest import bag


def _lines(folder, files):
    for name, lines in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("".join(f"{line}\n" for line in lines))


def _counted(spark, tmp_path, **options):
    tables = VersionedTables(spark, str(tmp_path / "tables"))
    tables.create({"sums": spark.createDataFrame([("a", 0)], "k string, n long"), "other": spark.range(3)})

    def step(batch, now):
        more = batch.groupBy(F.col("line").alias("k")).agg(F.count(F.lit(1)).alias("n"))
        return {"sums": now["sums"].unionByName(more).groupBy("k").agg(F.sum("n").alias("n"))}

    def run(step=step):
        stream = stream_lines(spark, str(tmp_path / "in"), max_files=1, file="file", recursive=True)
        return stream_pipeline(stream, tables, step, str(tmp_path / "cp"), interval=None, file="file")

    return tables, step, run


def test_every_batch_leaves_a_version(spark, tmp_path):
    _lines(tmp_path / "in", {"1.txt": "ab", "2.txt": "a", "3.txt": "c"})
    tables, _, run = _counted(spark, tmp_path)
    run().awaitTermination()
    assert tables.committed() == 2
    assert bag(tables.read()["sums"]) == [("a", 2), ("b", 1), ("c", 1)]
    assert bag(tables.read(-1)["sums"]) == [("a", 0)]
    assert sum(r["n"] for r in tables.read(0)["sums"].collect()) < 4
    assert tables.read()["other"].count() == 3  # a table no batch changed
    assert sorted((r["batch_id"], r["rows"]) for r in tables.files().collect())[-1][0] == 2
    assert Counter(Path(r["path"]).name for r in tables.files().collect()) == {"1.txt": 1, "2.txt": 1, "3.txt": 1}


def test_a_batch_killed_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch):
    _lines(tmp_path / "in", {"1.txt": "ab", "2.txt": "a"})
    tables, step, run = _counted(spark, tmp_path)
    calls = []

    def killed(batch, now):
        if calls:  # the second batch: its tables are written, then the driver is gone
            folder = f"{tables.root}/versions/batch-1-killed"
            step(batch, now)["sums"].write.parquet(f"{folder}/sums")
            raise RuntimeError("killed")
        calls.append(1)
        return step(batch, now)

    with pytest.raises(Exception, match="killed"):
        run(killed).awaitTermination()
    assert tables.committed() == 0
    before = bag(tables.read()["sums"])
    run().awaitTermination()  # goes on with the batch that failed
    assert tables.committed() == 1 and bag(tables.read()["sums"]) == [("a", 2), ("b", 1)] and bag(tables.read(0)["sums"]) == before
    assert tables.vacuum(keep=2) == 2  # what the killed batch left, and the first version
    assert bag(tables.read()["sums"]) == [("a", 2), ("b", 1)] and bag(tables.read(0)["sums"]) == before
    assert tables.vacuum(keep=1) >= 1 and bag(tables.read()["sums"]) == [("a", 2), ("b", 1)]
    assert tables.files().count() == 2


def test_a_committed_batch_that_runs_again_changes_nothing(spark, tmp_path):
    _lines(tmp_path / "in", {"1.txt": "ab"})
    tables, step, run = _counted(spark, tmp_path)
    run().awaitTermination()
    for name in (tmp_path / "cp" / "commits").glob("*"):
        name.unlink()  # Spark does not know that the batch is done
    run().awaitTermination()
    assert bag(tables.read()["sums"]) == [("a", 1), ("b", 1)] and tables.files().count() == 1
    assert not tables.commit(0, {"sums": spark.range(1)})


def test_files_of_committed_batches_are_archived(spark, tmp_path):
    _lines(tmp_path / "in", {"ST/1.a.txt": "ab", "ST/2.b.ST": "a", "ST/3.c.dat": "c", "AC/1.d.csv": "d", "AC/2.d.csv": "e", "XX/1.e.txt": "f"})
    tables, _, run = _counted(spark, tmp_path)
    run().awaitTermination()
    _lines(tmp_path / "in", {"ST/9.late.txt": "z"})  # read by no batch
    archive = {kind: str(tmp_path / "archive" / kind) for kind in ("ST", "AC")}
    moved = archive_committed(tables, archive)
    held = sorted(str(p.relative_to(tmp_path / "archive")) for p in (tmp_path / "archive").rglob("*") if p.is_file() and p.suffix != ".crc")
    assert held[:1] == ["AC/d.csv"] and held[1].startswith("AC/d.csv.") and held[2:] == ["ST/a.txt", "ST/b.ST"]
    assert len(moved) == 4 and {batch for batch, _, _ in moved} <= set(range(6))
    left = sorted(p.name for p in (tmp_path / "in").rglob("*") if p.is_file() and p.suffix != ".crc")
    assert left == ["1.e.txt", "3.c.dat", "9.late.txt"]
    assert archive_committed(tables, archive) == []  # done before


def _admitted(spark, tmp_path, cap):
    mapping = spark.createDataFrame([("101", "1"), ("102", "2"), ("103", "1")], "network_id string, grp_number string")
    stream = stream_admitted(spark, str(tmp_path / "in"), mapping, str(tmp_path / "ledger"), cap=cap)
    load = stream_load(stream, str(tmp_path / "out"), str(tmp_path / "cp"), interval="0 seconds")
    load.processAllAvailable()
    load.stop()
    return spark.read.parquet(str(tmp_path / "out/good")).collect()


def test_admission_keeps_its_cap_and_takes_every_file_once(spark, tmp_path):
    files = {f"ST/STL_101_{n:02d}.txt": [f"one {n}", "two"] for n in range(7)}
    files |= {f"ST/STL_103_{n}.ST": [f"three {n}"] for n in range(3)}
    files |= {f"AC/ACTIV_102_{n}.csv": [f"four {n}\r"] for n in range(5)}
    files |= {"ST/STL_999_0.txt": ["unknown"], "ST/STL_101.dat": ["no class"], "AC/other_101_1.csv": ["no class"], "ST/STL_102_9.txt": []}
    _lines(tmp_path / "in", files)
    rows = _admitted(spark, tmp_path, 3)
    batches = Counter((r["batch_id"], r["class"], r["grp"]) for r in {(r["batch_id"], r["path"]): r for r in rows}.values())
    assert max(batches.values()) == 3 and len({b for b, _, _ in batches}) == 4
    assert Counter(r["line"] for r in rows) == Counter([f"one {n}" for n in range(7)] + ["two"] * 7 + [f"three {n}" for n in range(3)] + [f"four {n}" for n in range(5)])
    first = {Path(r["path"]).name for r in rows if r["batch_id"] == 0 and r["class"] == "ST"}
    assert first == {"STL_101_00.txt", "STL_101_01.txt", "STL_101_02.txt"}
    assert all(1 <= r["position"] <= 3 for r in rows)

    _lines(tmp_path / "in", {"ST/STL_101_00a.txt": ["late"], "ST/STL_101_99.txt": ["last"]})  # a name before those taken counts too
    again = _admitted(spark, tmp_path, 3)  # a new run goes on from the offset
    assert Counter(r["line"] for r in again) - Counter(r["line"] for r in rows) == {"late": 1, "last": 1}
    taken = [file[0] for name in sorted((tmp_path / "ledger").glob("*.json")) for file in json.loads(name.read_text())["files"]]
    assert len(taken) == len(set(taken)) == 7 + 3 + 5 + 1 + 2  # the empty file too


def test_a_batch_that_runs_again_has_the_files_it_had(spark, tmp_path):
    _lines(tmp_path / "in", {f"ST/STL_101_{n}.txt": [str(n)] for n in range(4)})
    rows = sorted((r["batch_id"], r["line"]) for r in _admitted(spark, tmp_path, 2))
    last = max((tmp_path / "cp" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    for name in (tmp_path / "cp" / "commits").glob(f".{last.name}.crc"):
        name.unlink()
    _lines(tmp_path / "in", {"ST/STL_101_0a.txt": ["new"]})
    again = sorted((r["batch_id"], r["line"]) for r in _admitted(spark, tmp_path, 2))
    assert again == [*rows, (2, "new")]


def test_first_rows_of_a_shuffled_stream_are_those_of_the_batch(spark, tmp_path):
    rows = [(k, f"2024-01-01 00:{(k * 7 + n * 13) % 60:02d}:00", (n * 5) % 4, f"v{n}", None if n % 3 else 1.5) for k in range(6) for n in range(9)]
    rows += rows[:4] + [(None, "2024-01-01 00:00:01", 1, "x", None), (None, "2024-01-01 00:00:02", 1, None, None)]
    schema = "k long, at string, place int, v string, x double"
    table = spark.createDataFrame(rows, schema).withColumn("at", F.to_timestamp("at"))
    parts = table.repartition(4, F.xxhash64("v", "at", "k")).collect()
    for i in range(4):
        spark.createDataFrame(parts[i::4], table.schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    end = spark.createDataFrame([(-1, "2025-01-01 00:00:00", 0, "end", None)], schema).withColumn("at", F.to_timestamp("at"))
    end.write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    told = first_rows_stream(stream, ["k"], ["place", "at"], "at", "30 days")
    for _ in range(2):  # a second run finds nothing to do
        stream_load(told, str(tmp_path / "out"), str(tmp_path / "cp"), interval=None).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out/good")).filter("k >= 0 OR k IS NULL").drop("batch_id")
    assert bag(got.filter("NOT later").drop("later")) == bag(uniq_rows(table, ["k"], ["place", "at"]))
    assert bag(got.filter("later").drop("later")) == bag(dup_rows(table, ["k"], ["place", "at"]))


def test_first_rows_keep_one_state_per_bucket(spark, tmp_path):
    """Keys of a bucket share its state and its timer, and expire each at its own time; a null key is one of them."""
    kind = "k long, at string, v string"
    batches = [
        [(1, "2024-01-01", "a"), (1, "2024-01-02", "b"), (2, "2024-01-05", "c"), (None, "2024-01-03", "d"), *[(k, "2024-01-04", "e") for k in range(10, 90)]],
        [(2, "2024-01-04", "f"), (None, "2024-01-06", "g"), (3, "2024-01-14", "h")],
        [(3, "2024-01-13", "i"), (1, "2024-01-14", "j"), (3, "2024-01-25", "k")],  # the watermark has passed key 1
    ]
    schema = spark.createDataFrame([], kind).withColumn("at", F.to_timestamp("at")).schema
    for n, rows in enumerate(batches):
        table = spark.createDataFrame(rows, kind).withColumn("at", F.to_timestamp("at"))
        table.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        load = stream_load(first_rows_stream(stream, ["k"], ["at"], "at", "5 days", buckets=2), str(tmp_path / "out"), str(tmp_path / "cp"), interval=None)
        load.awaitTermination()
        assert sum(op["numRowsTotal"] for p in load.recentProgress[-1:] for op in json.loads(p.json)["stateOperators"]) <= 2 * 3  # the rows and the timer, twice
    got = spark.read.parquet(str(tmp_path / "out/good")).where("k < 10 OR k IS NULL").select("k", "v", "later")
    told = {(r["k"], r["v"]): r["later"] for r in got.collect()}
    assert told == {(1, "a"): False, (1, "b"): True, (2, "c"): True, (2, "f"): False, (None, "d"): False, (None, "g"): True, (1, "j"): False, (3, "h"): True, (3, "i"): False} | (
        {(3, "k"): True}
    )


def test_the_staged_rows_of_a_batch_are_kept_while_its_tables_are_made(spark, tmp_path, monkeypatch):
    lines = spark.range(60).selectExpr(
        "id div 3 + 1 AS l_orderkey", "CAST(id % 3 + 1 AS INT) AS l_linenumber", "id AS l_partkey", "id % 7 AS l_suppkey", "'N' AS l_returnflag",
        "'F' AS l_linestatus", "TIMESTAMP_NTZ '1995-01-02 00:00:00' AS l_shipdate", "60000D AS l_extendedprice", "0.05D AS l_discount", "0.01D AS l_tax", "2D AS l_quantity",
    )
    orders = spark.range(1, 21).selectExpr("id AS o_orderkey", "'O' AS o_orderstatus", "100D AS o_totalprice")
    for name, table in (("lineitem", lines), ("orders", orders)):
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    seen, post_sync = [], streams.post_sync

    def spied(staging, *rest):
        seen.append(staging.storageLevel.useMemory)
        return post_sync(staging, *rest)

    monkeypatch.setattr(streams, "post_sync", spied)
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    got = QUERIES["stm_02_batch_pipeline"](spark, str(tmp_path))
    assert len(seen) > 1 and all(seen) and len(spark.sparkContext._jsc.getPersistentRDDs()) == before
    good = [k for k in range(1, 21) if k % 10 and k % 11]  # the others are rejects
    updated = {(k, "S", 60100.0) for k in good if k % 5} | {(k, "O", 100.0) for k in (11,)}
    added = [(k, s, 60000.0) for k in good if k % 5 == 0 for s in ("S", "N", "N")]
    assert bag(got) == sorted([*updated, *added], key=repr)


def _files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


@pytest.mark.parametrize("by", [None, F.expr("k div 100")])
def test_merges_replace_only_touched_buckets(spark, tmp_path, by):
    rows = spark.range(1600).select(F.col("id").alias("k"), (F.col("id") % 7).cast("string").alias("v"), F.lit(1.5).alias("x"))
    table = BucketTable(spark, str(tmp_path / "t"), ["k"], rows.schema, by=by, buckets=16).create(rows)
    before = _files(tmp_path / "t")
    assert bag(table.read()) == bag(rows)
    # One in a hundred of the keys, as another type, all of one range; a key the table lacks; a null key.
    source = spark.createDataFrame([(n, "new") for n in range(200, 216)] + [(299_999, "lacking"), (None, "null")], "k int, v string")
    expected = bag(merge_update(rows, source, ["k"]))
    touched = table.update(source)
    after = _files(tmp_path / "t")
    assert bag(table.read()) == expected
    unlike = {name.split("/")[0] for name in before.keys() ^ after.keys()}
    assert unlike <= {f"bucket={b}" for b in touched}
    if by is not None:
        assert touched == [2, 2999] and unlike == {"bucket=2"}
        assert all(before[name] == after[name] for name in before if not name.startswith("bucket=2/"))
        assert set(table.read([2]).select(F.expr("k div 100")).distinct().toPandas().iloc[:, 0]) == {2}
    # The same again leaves the same rows; an upsert adds what is new, rows without a key too.
    table.update(source)
    assert bag(table.read()) == expected
    full = source.withColumn("k", F.col("k").cast("long")).withColumn("x", F.lit(None).cast("double"))
    expected = bag(merge_upsert(table.read(), full, ["k"]))
    table.upsert(full)
    assert bag(table.read()) == expected and table.update(source.limit(0)) == []


def test_bucket_tables_are_refused_without_keys_or_with_repeated_ones(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a")], "k long, v string")
    with pytest.raises(ValueError):
        BucketTable(spark, str(tmp_path / "t"), [], rows.schema)
    table = BucketTable(spark, str(tmp_path / "t"), ["k"], rows.schema).create(rows)
    with pytest.raises(Exception, match="repeated key"):
        table.update(rows.unionByName(rows))
    assert bag(table.read()) == [(1, "a")]
