"""First rows per key and the rows after them, over a stream whose rows arrive in any order."""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Where the state of keys is kept: on disk, written through to the checkpoint.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Groups that the keys are dealt to by hash. The state of a group is read and written at once.
BUCKETS = 1024
# Spark hands rows over as named tuples, whose names do not begin with a line.
_BUCKET, _EXPIRY = "bucket__", "expiry__"


class _FirstByOrder(StatefulProcessor):
    """Of the keys of one bucket: the first row of each by order so far, until the watermark has passed its time and the delay.

    A call of the state costs as much as thousands of rows, so the rows of a bucket are kept as one value and told apart
    together, as many at a time as Spark hands over. One timer stands for the smallest expiry of the bucket.
    """

    def __init__(self, names: Sequence[str], keys: Sequence[str], order_by: Sequence[str]):
        self.names, self.keys, self.order_by = list(names), list(keys), list(order_by)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", "rows binary, timer bigint")

    def _keep(self, first: pd.DataFrame, before: int | None) -> None:
        timer = int(first[_EXPIRY].min())
        self.first.update((pickle.dumps(first), timer))
        if timer != before:
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(timer)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first, before = None, None
        if self.first.exists():
            held, before = self.first.get()
            first = pickle.loads(held)
        for batch in rows:  # one row of each key is held back, all others are later ones of some row
            batch = batch[[*self.names, _EXPIRY]]
            both = batch if first is None else pd.concat([first, batch], ignore_index=True)
            both = both.sort_values(self.order_by, kind="stable", na_position="first")
            again = both.duplicated(self.keys)
            first, rest = both[~again], both.loc[again, self.names]
            if len(rest):
                yield rest.assign(later=True)
        self._keep(first, before)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, timer = self.first.get()
        first = pickle.loads(held)
        passed = (first[_EXPIRY] <= timer) | (first[_EXPIRY] < timerValues.getCurrentWatermarkInMs())
        if passed.all():
            self.first.clear()
        else:  # the timer that brought us here is gone
            self._keep(first[~passed], None)
        yield first.loc[passed, self.names].assign(later=False)

    def close(self) -> None:
        pass


def first_rows_stream(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], ts: str, delay: str, buckets: int = BUCKETS
) -> DataFrame:
    """All rows with ``later``: False for the first row of a key by ``order_by``, True for every row after it.

    What :func:`settleflow.operators.dedup.uniq_rows` and ``dup_rows`` give for a table, for a stream whose rows come in any order. The
    first row is known when the watermark (``delay`` behind the largest ``ts``) has passed its own ``ts`` and the delay, and is
    written then; later rows are written as they come, and so is a row that a smaller one takes the place of. The state holds
    one row per key for as long; a row that comes after that begins a new one. Rows later than the watermark are left
    out, as in any stream. Rows the order leaves tied are ordered by their other columns. Equal rows are told apart by nothing:
    one of them is the first. Null keys are one key; rows without ``ts`` end the job.

    Keys are dealt to ``buckets`` by hash, and a batch reads and writes the state of every bucket it has rows of: more buckets
    suit many keys and small batches. A checkpoint goes on only with the number it began with.

    The state lies in RocksDB, which is switched on for the session.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    millis = int(spark.sql(f"SELECT unix_millis(timestamp_millis(0) + INTERVAL {delay})").first()[0])
    rest = [f.name for f in df.schema.fields if f.name not in (*order_by, *keys)]
    processor = _FirstByOrder(df.columns, keys, [*order_by, *rest])
    out = T.StructType([*[T.StructField(f.name, f.dataType) for f in df.schema.fields], T.StructField("later", T.BooleanType())])
    return (
        df.filter(F.when(F.col(ts).isNotNull(), True).otherwise(F.raise_error(F.lit(f"{ts} is null")).cast("boolean")))
        .withColumns(
            {
                _EXPIRY: F.unix_millis(F.col(ts).cast("timestamp")) + millis,
                _BUCKET: F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"),
            }
        )
        .withWatermark(ts, delay)
        .groupBy(_BUCKET)
        .transformWithStateInPandas(processor, outputStructType=out, outputMode="append", timeMode="EventTime")
    )
