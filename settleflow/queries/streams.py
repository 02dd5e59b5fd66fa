"""The load as a stream: given tables are laid out as files, streamed and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settleflow.operators import buffer, dup_rows, split_rejects, uniq_rows
from settleflow.plans import EntrySpec, post_sync, stage_activity, stage_entries
from settleflow.queries.inputs import MAPPING_SQL, ORDER_SCHEMA, entries, lines, mapping
from settleflow.queries.registry import ORACLES, Tables, query
from settleflow.queries.settlement import ENTRY_FIELDS, SYNC
from settleflow.schema import schema_of
from settleflow.session import new_folder
from settleflow.sources import list_files, write_delimited
from settleflow.streaming import (
    VersionedTables,
    archive_committed,
    first_rows_stream,
    stream_admitted,
    stream_files,
    stream_lines,
    stream_load,
    stream_pipeline,
    uniq_rows_stream,
)

C = F.col
EVENTS = schema_of(
    [
        {"name": "event_id", "type": "id_Long"},
        {"name": "ts", "type": "id_Timestamp"},
        {"name": "user_id", "type": "id_Long"},
        {"name": "event_type", "type": "id_String"},
        {"name": "value", "type": "id_Double"},
    ]
)
EVENT_COLUMNS = [f.name for f in EVENTS.fields]


# Rows of an input file: the number of files, and so of tasks and batches, grows with the tables.
ROWS = 40_000


def _files_of(rows: DataFrame) -> int:
    """Files of about ``ROWS`` rows, three at least, so that there are several batches."""
    return max(3, -(-rows.count() // ROWS))


def _event_files(t: Tables, copies: int = 1) -> str:
    folder = new_folder(t.spark, "events-in")
    for _ in range(copies):
        write_delimited(t.events.repartition(_files_of(t.events)), folder, "|", cols=EVENT_COLUMNS, append=True)
    return folder


def _batches(files: int) -> int:
    """Files per batch for a handful of batches."""
    return max(1, -(-files // 4))


@query("stm_01_stream_files", "SELECT event_id, user_id, event_type, value FROM events")
def _(t: Tables):
    stream = stream_files(t.spark, _event_files(t), EVENTS, max_files=_batches(_files_of(t.events)), sep="|")
    sink = new_folder(t.spark, "events-out")
    stream_load(stream, sink, new_folder(t.spark, "offsets"), interval=None).awaitTermination()
    return t.spark.read.parquet(f"{sink}/good").select("event_id", "user_id", "event_type", "value")


@query(
    "stm_02_batch_load",
    """SELECT event_id, user_id, event_type FROM
         (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""",
)
def _(t: Tables):
    """First and later rows of each batch; the first of the firsts of all batches are the result."""
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    stream = stream_files(t.spark, _event_files(t), EVENTS, max_files=_batches(_files_of(t.events)), sep="|")
    sink = new_folder(t.spark, "events-out")
    step = lambda batch: (uniq_rows(batch, keys, order), dup_rows(batch, keys, order))
    stream_load(stream, sink, new_folder(t.spark, "offsets"), step, interval=None).awaitTermination()
    return uniq_rows(t.spark.read.parquet(f"{sink}/good"), keys, order, ["event_id", "user_id", "event_type"])


@query("stm_03_stream_dedup", "SELECT event_id, user_id, event_type FROM events")
def _(t: Tables):
    stream = stream_files(t.spark, _event_files(t, copies=2), EVENTS, max_files=_batches(2 * _files_of(t.events)), sep="|")
    # The watermark needs an instant, not a wall-clock time.
    stream = stream.withColumn("at", C("ts").cast("timestamp"))
    sink = new_folder(t.spark, "events-once")
    once = uniq_rows_stream(stream, ["event_id"], "at", "60 days")
    writer = once.writeStream.format("parquet").option("checkpointLocation", new_folder(t.spark, "offsets"))
    writer.trigger(availableNow=True).start(sink).awaitTermination()
    return t.spark.read.parquet(sink).select("event_id", "user_id", "event_type")


@query(
    "stm_04_stream_rejects",
    """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 10 = 0 THEN 'field count' WHEN o_orderkey % 7 = 0
         THEN 'o_orderdate: not date' ELSE 'good' END AS outcome FROM orders""",
)
def _(t: Tables):
    folder = new_folder(t.spark, "lines-in")
    lines(t).select("line").repartition(_files_of(t.orders)).write.text(folder)
    stream = stream_lines(t.spark, folder, max_files=_batches(_files_of(t.orders)), archive_dir=new_folder(t.spark, "archive"))
    sink = new_folder(t.spark, "lines-out")
    spec = EntrySpec(ORDER_SCHEMA)
    step = lambda batch: stage_activity(batch, spec)
    stream_load(stream, sink, new_folder(t.spark, "offsets"), step, interval=None).awaitTermination()
    good = t.spark.read.parquet(f"{sink}/good").select(C("o_orderkey").alias("k"), F.lit("good").alias("outcome"))
    bad = t.spark.read.parquet(f"{sink}/rejects")
    key = F.split_part("line", F.lit("|"), F.lit(1)).cast("bigint")
    return good.unionByName(bad.select(key.alias("k"), C("reject_reason").alias("outcome")))


@query(
    "snk_10_stream_corrupt_rows",
    """SELECT o_orderkey % 10 = 0 OR o_orderkey % 7 = 0 AS bad, count(*) AS n FROM orders GROUP BY 1""",
)
def _(t: Tables):
    folder = new_folder(t.spark, "lines-in")
    lines(t).select("line").repartition(_files_of(t.orders)).write.text(folder)
    schema = schema_of(
        [{"name": f.name, "type": "id_String"} for f in ORDER_SCHEMA.fields[:4]]
        + [{"name": "o_orderdate", "type": "id_Date"}, {"name": "prio", "type": "id_String"}, {"name": "raw", "type": "id_String"}]
    )
    stream = stream_files(t.spark, folder, schema, _batches(_files_of(t.orders)), "|", archive_dir=new_folder(t.spark, "archive"), corrupt="raw")
    sink = new_folder(t.spark, "lines-out")
    step = lambda batch: split_rejects(batch, {"unreadable": C("raw").isNotNull()})
    stream_load(stream, sink, new_folder(t.spark, "offsets"), step, interval=None).awaitTermination()
    good = t.spark.read.parquet(f"{sink}/good").select(F.lit(False).alias("bad"))
    bad = t.spark.read.parquet(f"{sink}/rejects").select(F.lit(True).alias("bad"))
    return good.union(bad).groupBy("bad").agg(F.count(F.lit(1)).alias("n"))


# --- versions, admission, archive ---------------------------------------------------------------

_GOOD = "(SELECT * FROM lineitem WHERE l_orderkey % 10 <> 0 AND l_orderkey % 11 <> 0) AS lineitem"
LINE_SPEC = EntrySpec(
    schema_of(
        [{"name": n, "type": "id_Long"} for n in ("k", "line_no", "part", "supp")]
        + [{"name": n, "type": "id_String"} for n in ENTRY_FIELDS[:4]]
        + [{"name": n, "type": "id_Double", "nullable": False} for n in ENTRY_FIELDS[4:]]
    )
)


@query("stm_02_batch_pipeline", ORACLES["pip_12_post_sync"].replace("FROM lineitem", f"FROM {_GOOD}"))
def _(t: Tables):
    """Entry lines in several batches through staging, post-sync and final load, a version of all tables per batch.

    All lines of an order are in one file, so a load in batches has to give what one load of all files gives.
    """
    key = C("l_orderkey")
    fields = [C(n).cast("string") for n in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *ENTRY_FIELDS)]
    fields[8] = F.when(key % 11 == 0, "n/a").otherwise(fields[8])
    text = F.when(key % 10 == 0, F.concat_ws("|", *fields[:-1])).otherwise(F.concat_ws("|", *fields))
    folder, files = new_folder(t.spark, "entries-in"), _files_of(t.lineitem)
    entries(t).select("l_orderkey", text.alias("line")).repartition(files, "l_orderkey").select("line").write.text(folder)

    prod = t.orders.filter("o_orderkey % 5 <> 0").select(
        C("o_orderkey").alias("k"), F.lit(0).alias("line"), F.lit(0).cast("bigint").alias("part"), F.lit(0).cast("bigint").alias("supp"),
        F.lit("1").alias("rt"), C("o_orderstatus").alias("status"), C("o_totalprice").alias("amount"), F.lit("").alias("entry_id"),
    )
    tables = VersionedTables(t.spark, new_folder(t.spark, "versions"))
    tables.create({"prod": prod, "templates": t.orders.select(C("o_orderkey").alias("k"), F.lit("none").alias("entry_id")), "adj": prod.select("k", "rt", "amount")})

    kept: list[DataFrame] = []

    def release() -> None:
        while kept:
            kept.pop().unpersist()

    def step(batch: DataFrame, now: dict[str, DataFrame]) -> dict[str, DataFrame]:
        good, rejects = stage_entries(batch, LINE_SPEC)
        staging = good.select(
            "k", C("line_no").cast("int").alias("line"), "part", "supp", "rt", F.when(C("dir") == "1", "W").otherwise("N").alias("status"),
            C("rec_prin").alias("amount"), F.concat_ws("-", C("k").cast("string"), C("line_no").cast("string")).alias("entry_id"),
        )
        release()
        kept.append(buffer(staging))  # every table reads it: lines are parsed once, not for each
        done = post_sync(staging, staging, now["prod"], now["templates"], now["adj"], SYNC)
        return {name: done[name] for name in ("prod", "templates", "adj")} | {"rejects": rejects}

    stream = stream_lines(t.spark, folder, max_files=_batches(files), file="file")
    try:
        stream_pipeline(stream, tables, step, new_folder(t.spark, "offsets"), interval=None, file="file").awaitTermination()
    finally:
        release()
    return tables.read()["prod"].select("k", "status", "amount")


def _named_files(t: Tables, rows: DataFrame, name: Column, folder: str) -> None:
    """Lines (``line``) as files of given names in the folders ``ST`` and ``AC`` (``class``): one file per class and name."""
    staged = new_folder(t.spark, "named")
    rows.select("class", name.alias("name"), "line").repartition("class", "name").write.partitionBy("class", "name").text(staged)
    path = t.spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(t.spark._jsc.hadoopConfiguration())
    for row in list_files(t.spark, staged, recursive=True).select("path").toLocalIterator():
        *_, kind, file, _ = row["path"].split("/")
        target = path(f"{folder}/{kind.removeprefix('class=')}/{file.removeprefix('name=')}")
        fs.mkdirs(target.getParent())
        fs.rename(path(row["path"]), target)


_CLASS = "CASE WHEN o_orderkey % 3 = 0 THEN 'AC' ELSE 'ST' END"


def _filed(t: Tables) -> DataFrame:
    """Orders as lines with the class, the network and the number of the file they go to."""
    kind = F.when(C("o_orderkey") % 3 == 0, "AC").otherwise("ST")
    return t.orders.select(
        kind.alias("class"), (C("o_custkey") % 25 + 100).alias("network"), (C("o_orderkey") % 4).alias("n"), C("o_orderkey").cast("string").alias("line")
    )


@query(
    "stm_01_admitted_files",
    f"""SELECT o_orderkey AS k, {_CLASS} AS class, grp_number AS grp, CAST(o_orderkey % 4 + 1 AS INTEGER) AS turn
        FROM orders JOIN {MAPPING_SQL} AS m ON network_id = CAST(o_custkey % 25 + 100 AS VARCHAR)""",
)
def _(t: Tables):
    """One file of each class and group per batch: the files of a network, by name, come in as many batches."""
    folder, sink = new_folder(t.spark, "admitted-in"), new_folder(t.spark, "admitted-out")
    name = F.concat(F.when(C("class") == "AC", "ACTIV_").otherwise("STLMTP_"), C("network").cast("string"), F.lit("_"), C("n").cast("string"), F.lit(".txt"))
    _named_files(t, _filed(t), name, folder)
    stream = stream_admitted(t.spark, folder, mapping(t), new_folder(t.spark, "ledger"), cap=1)
    load = stream_load(stream, sink, new_folder(t.spark, "offsets"), interval="0 seconds")
    load.processAllAvailable()
    load.stop()
    rows = t.spark.read.parquet(f"{sink}/good")
    return rows.select(C("line").cast("bigint").alias("k"), "class", "grp", (C("batch_id") + 1).cast("int").alias("turn"))


@query(
    "snk_10_archive",
    f"""SELECT class, name, count(*) AS n_read, CASE WHEN class = 'AC' OR name NOT LIKE '%.dat' THEN count(*) END AS n_archived
        FROM (SELECT {_CLASS} AS class, {_CLASS} || '_' || CAST(o_custkey % 25 + 100 AS VARCHAR)
                || CASE o_orderkey % 4 WHEN 0 THEN '.txt' WHEN 1 THEN '.ST' WHEN 2 THEN '.csv.txt' ELSE '.dat' END AS name FROM orders)
        GROUP BY class, name""",
)
def _(t: Tables):
    """The ledger of a load beside the archive: every file read, and what of it the archive holds under its own name."""
    folder, archive = new_folder(t.spark, "archived-in"), new_folder(t.spark, "archive")
    ending = F.element_at(F.array(*[F.lit(x) for x in (".txt", ".ST", ".csv.txt", ".dat")]), (C("n") + 1).cast("int"))
    name = F.concat((C("n") * 5 + 1).cast("string"), F.lit("."), "class", F.lit("_"), C("network").cast("string"), ending)
    _named_files(t, _filed(t), name, folder)
    tables = VersionedTables(t.spark, new_folder(t.spark, "versions"))
    stream = stream_lines(t.spark, folder, max_files=60, file="file", recursive=True)
    step = lambda batch, now: {}
    stream_pipeline(stream, tables, step, new_folder(t.spark, "offsets"), interval=None, file="file").awaitTermination()
    archive_committed(tables, {kind: f"{archive}/{kind}" for kind in ("ST", "AC")})
    split = lambda path: F.split(path, "/")
    plain = lambda path: F.regexp_replace(F.element_at(split(path), -1), r"^\d+\.", "")
    read = tables.files().select(F.element_at(split(C("path")), -2).alias("class"), plain(C("path")).alias("name"), C("rows").alias("n_read"))
    held = t.spark.read.option("recursiveFileLookup", True).text(archive).select(C("_metadata.file_path").alias("path"))
    held = held.groupBy(F.element_at(split(C("path")), -2).alias("class"), F.element_at(split(C("path")), -1).alias("name")).agg(F.count(F.lit(1)).alias("n_archived"))
    return read.join(held, ["class", "name"], "left")


@query(
    "stm_03_first_and_later_rows",
    """SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) > 1 AS later FROM events""",
)
def _(t: Tables):
    """Events in shuffled order, told apart into first and later rows per key as a batch would."""
    folder, files = new_folder(t.spark, "shuffled-in"), _files_of(t.events)
    rows = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    rows.repartition(files, F.xxhash64("event_id")).write.parquet(folder)
    # Time goes on: an event long after all others, in a file of its own, lets the watermark pass them.
    end = t.events.select(F.lit(-1).cast("bigint").alias("event_id"), (F.max("ts") + F.expr("INTERVAL 400 DAYS")).alias("ts"))
    end.select("event_id", "ts", F.lit(-1).cast("bigint").alias("user_id"), F.lit("end").alias("event_type"), F.lit(0.0).alias("value")).write.mode("append").parquet(folder)
    stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", _batches(files)).parquet(folder)
    told = first_rows_stream(stream.withColumn("ts", C("ts").cast("timestamp")), ["user_id", "event_type"], ["ts", "event_id"], "ts", "180 days")
    sink = new_folder(t.spark, "told")
    stream_load(told, sink, new_folder(t.spark, "offsets"), interval=None).awaitTermination()
    return t.spark.read.parquet(f"{sink}/good").filter("event_id >= 0").select("event_id", "user_id", "event_type", "later")
