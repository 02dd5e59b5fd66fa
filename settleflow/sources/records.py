"""Records that span lines, of files that are read in splits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_PLACE = ["_file", "_block"]
#: What the assembler gives out: whole records, or the parts of records that lie in several splits.
WHOLE, PARTS = "whole", "parts"


def _quotes(line: Column, quote: str, escape: str | None) -> Column:
    """Quotes of a line that open or close a value; a doubled one counts twice, which is as good as not at all."""
    if escape and escape != quote:
        line = F.replace(F.replace(line, F.lit(escape * 2), F.lit("")), F.lit(escape + quote), F.lit(""))
    return F.char_length(line) - F.char_length(F.replace(line, F.lit(quote), F.lit("")))


def _assembler(odd: frozenset, skip: int, give: str):
    """Joins lines to records; ``odd`` are the splits that begin inside quotes. Made here to travel by value.

    The lines of a split arrive together and in file order. A record begins at a line before which the number of quotes
    is even. Lines before the first such one belong to a record of an earlier split, an open record at the end of a split
    goes on in the next one.
    """

    class Split:
        def __init__(self, place: tuple):
            self.place, self.inside, self.open, self.seen = place, place in odd, [], 0
            self.tail = self.inside  # what is open began in an earlier split

        def add(self, lines: list[str], quotes: np.ndarray) -> list[tuple]:
            after = (np.cumsum(quotes) + self.inside) % 2 == 1
            out = []
            for line, inside in zip(lines, after.tolist()):
                self.open.append(line)
                if not inside:
                    if self.tail:
                        out.append((*self.place, 0, "\n".join(self.open)))
                    elif give == WHOLE:
                        if self.place[1] or self.seen >= skip:
                            out.append((*self.place, None, "\n".join(self.open)))
                        self.seen += 1
                    self.open, self.tail = [], False
            self.inside = bool(after[-1]) if len(after) else self.inside
            return out

        def end(self) -> list[tuple]:
            """What is left: the beginning of a record, or the middle of one."""
            return [(*self.place, 0 if self.tail else 1, "\n".join(self.open))] if self.open else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.string()]
        names = ["_file", "_block", "_part", "record"]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            rows = [row for row in rows if (row[2] is None) == (give == WHOLE)]
            columns = list(zip(*rows)) or [(), (), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        split = None
        for batch in batches:
            if not batch.num_rows:
                continue
            file, block = batch.column(1).to_pylist(), batch.column(2).to_numpy()
            quotes, lines = batch.column(3).to_numpy(), batch.column(0).to_pylist()
            fresh = [0, *(i for i in range(1, len(lines)) if block[i] != block[i - 1] or file[i] != file[i - 1]), len(lines)]
            rows = []
            for at, to in zip(fresh, fresh[1:]):
                place = (file[at], int(block[at]))
                if split is None or split.place != place:
                    rows += split.end() if split else []
                    split = Split(place)
                rows += split.add(lines[at:to], quotes[at:to])
            yield batch_of(rows)
        if split:
            yield batch_of(split.end())

    return run


def read_records(
    spark: SparkSession, path: str | list[str], quote: str = '"', escape: str | None = None, skip: int = 0, encoding: str | None = None
) -> DataFrame:
    """``record``: the records of text files, where a line break inside quotes is part of a value.

    A file is read in as many splits as its size asks for. Quotes are counted per split first and their sums are added up
    over the splits before, so every task knows whether its split begins inside quotes and finds where records start. Only the
    parts of records that lie in several splits meet again, by file. ``skip`` leaves out the first records of each
    file. A carriage return before the end of a record goes with it, inside quotes it stays. Quotes count wherever
    they stand: a value that has one must be quoted itself.
    """
    reader = spark.read.option("lineSep", "\n")
    if encoding:
        reader = reader.option("encoding", encoding)
    lines = reader.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), _quotes(F.col("value"), quote, escape).alias("_quotes")
    )
    # One row per split.
    sums = lines.groupBy(*_PLACE).agg((F.sum("_quotes") % 2).alias("_odd"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    known = sums.withColumn("_start", F.coalesce(F.sum("_odd").over(before), F.lit(0)) % 2)
    edges = known.filter("_start = 1 OR _odd = 1").select(*_PLACE, "_start").collect()
    odd = frozenset((row["_file"], row["_block"]) for row in edges if row["_start"])
    kind = "_file string, _block long, _part int, record string"
    columns = ["value", *_PLACE, "_quotes"]
    records = lines.select(*columns).mapInArrow(_assembler(odd, skip, WHOLE), kind).select("record")
    if edges:
        ends = spark.createDataFrame([tuple(row)[:2] for row in edges], "_f string, _b long")
        some = lines.join(F.broadcast(ends), (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b")), "left_semi")
        parts = some.select(*columns).mapInArrow(_assembler(odd, skip, PARTS), kind)
        number = F.sum("_part").over(Window.partitionBy("_file").orderBy("_block", "_part"))
        pieces = F.sort_array(F.collect_list(F.struct("_block", "_part", "record")))
        joined = parts.withColumn("_number", number).groupBy("_file", "_number").agg(pieces.alias("_pieces"))
        records = records.unionByName(joined.select(F.array_join("_pieces.record", "\n").alias("record")))
    return records.select(F.regexp_replace("record", r"\r\z", "").alias("record"))
