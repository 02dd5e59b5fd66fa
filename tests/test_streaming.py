"""The stream leaves what the batch leaves, also when a batch runs twice."""

from pyspark.sql import functions as F

from settleflow.operators import split_rejects, uniq_rows
from settleflow.schema import schema_of
from settleflow.streaming import stream_files, stream_lines, stream_load, uniq_rows_stream

from conftest import bag

ROW = schema_of([{"name": "k", "type": "id_Long"}, {"name": "at", "type": "id_Timestamp"}, {"name": "v", "type": "id_String"}])


def _files(folder, lines_per_file):
    folder.mkdir()
    for n, lines in enumerate(lines_per_file):
        (folder / f"f{n}.csv").write_text("\n".join(lines) + "\n")


def test_files_in_batches(spark, tmp_path):
    _files(tmp_path / "in", [[f"{n},2024-01-01 00:00:0{n},x"] for n in range(5)])
    stream = stream_files(spark, str(tmp_path / "in"), ROW, max_files=2)
    stream_load(stream, str(tmp_path / "out"), str(tmp_path / "cp"), interval=None).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out/good"))
    assert out.select("batch_id").distinct().count() == 3
    assert sorted(r["k"] for r in out.collect()) == [0, 1, 2, 3, 4]


def test_new_files_are_loaded_once(spark, tmp_path):
    source, sink, offsets = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    _files(source, [["1,2024-01-01 00:00:00,x"]])
    step = lambda df: split_rejects(df, {"no value": F.col("v").isNull()})
    for extra in (None, "2,2024-01-01 00:00:00,\n"):
        if extra:
            (source / "later.csv").write_text(extra)
        stream_load(stream_files(spark, str(source), ROW), sink, offsets, step, interval=None).awaitTermination()
    assert spark.read.parquet(sink + "/good").count() == 1
    assert spark.read.parquet(sink + "/rejects").first()["reject_reason"] == "no value"


def test_a_repeated_batch_leaves_the_same_rows(spark, tmp_path):
    _files(tmp_path / "in", [["a", "b"]])
    for _ in range(2):  # a lost checkpoint runs batch 0 again
        stream = stream_lines(spark, str(tmp_path / "in"))
        stream_load(stream, str(tmp_path / "out"), str(tmp_path / f"cp{_}"), interval=None).awaitTermination()
    assert bag(spark.read.parquet(str(tmp_path / "out/good")).select("line")) == [("a",), ("b",)]


def test_dedup_across_batches_equals_batch(spark, tmp_path):
    rows = [f"{n % 7},2024-01-01 00:00:{n:02d},x" for n in range(30)]
    _files(tmp_path / "in", [rows[:10], rows[10:20], rows[20:]])
    stream = stream_files(spark, str(tmp_path / "in"), ROW, max_files=1).withColumn("at", F.col("at").cast("timestamp"))
    writer = uniq_rows_stream(stream, ["k"], "at", "1 day").writeStream.format("parquet")
    writer = writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
    writer.start(str(tmp_path / "out")).awaitTermination()
    batch = spark.read.schema(ROW).csv(str(tmp_path / "in"))
    assert bag(spark.read.parquet(str(tmp_path / "out")).select("k")) == bag(uniq_rows(batch, ["k"], ["at"]).select("k"))


def test_finished_files_are_archived(spark, tmp_path):
    _files(tmp_path / "in", [[f"{n},2024-01-01 00:00:00,x"] for n in range(4)])
    archive = tmp_path / "archive"
    stream = stream_files(spark, str(tmp_path / "in"), ROW, max_files=1, archive_dir=str(archive))
    stream_load(stream, str(tmp_path / "out"), str(tmp_path / "cp"), interval=None).awaitTermination()
    moved, left = list(archive.rglob("*.csv")), list((tmp_path / "in").glob("*.csv"))
    assert moved and len(moved) + len(left) == 4
    assert spark.read.parquet(str(tmp_path / "out/good")).count() == 4
