"""First record per key by ingestion time, with state that is corrected and forgotten in time."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: State needs this store; set it on the session that runs the stream.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

# Names with a leading underscore are lost on the way to the processor.
AT, TIE, KEY, GROUP, MISSING = "order_at", "order_tie", "order_key", "order_group", "order_missing"

# The processor travels with the query, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _Earliest(StatefulProcessor):
    """Keeps, for the keys of a group, the order of their best records: the time and, among equals, the tie
    breaker. A call to the state costs far more than a key does, so a group's keys are read, compared and
    stored together."""

    def __init__(self, out: list[str], keep_ms: int):
        self.out, self.keep_ms = out, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", T.StructType([T.StructField("keys", T.BinaryType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = pd.concat(list(rows), ignore_index=True).sort_values([AT, TIE]).drop_duplicates(KEY)
        known = self._known()
        place = pd.Index(known[KEY]).get_indexer(first[KEY])
        seen, at, tie = place >= 0, first[AT].to_numpy(), first[TIE].to_numpy()
        taken = ~seen
        known_at, known_tie = (known[c].to_numpy()[place[seen]] for c in (AT, TIE))
        taken[seen] = (at[seen] < known_at) | ((at[seen] == known_at) & (tie[seen] < known_tie))
        if not taken.any():
            return
        found = first[taken]
        self._keep(pd.concat([known[~known[KEY].isin(found[KEY])], found[[KEY, AT, TIE]]], ignore_index=True))
        yield found[self.out].assign(correction=seen[taken])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = self._known()
        ends = known[AT] // 1000 + self.keep_ms
        self._keep(known[(ends > expiredTimerInfo.getExpiryTimeInMs()) & (ends >= timerValues.getCurrentWatermarkInMs())])
        yield from ()

    def close(self) -> None:
        pass

    def _known(self) -> pd.DataFrame:
        if not self.best.exists():
            return pd.DataFrame({KEY: pd.Series([], dtype=object), AT: pd.Series([], dtype="int64"), TIE: pd.Series([], dtype="int64")})
        with pa.ipc.open_stream(self.best.get()[0]) as stored:
            return stored.read_pandas()

    def _keep(self, known: pd.DataFrame) -> None:
        """Stores the keys; the timer is at the end of the first of them."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if known.empty:
            self.best.clear()
            return
        table = pa.table({KEY: pa.array(known[KEY], pa.string()), AT: known[AT].to_numpy(), TIE: known[TIE].to_numpy()})
        packed = pa.BufferOutputStream()
        with pa.ipc.new_stream(packed, table.schema) as stored:
            stored.write_table(table)
        self.best.update((packed.getvalue().to_pybytes(),))
        self.handle.registerTimer(int(known[AT].min()) // 1000 + self.keep_ms)


def _key_text(df: DataFrame, keys: Sequence[str]) -> Column:
    """Keys as one text, equal where the keys are."""
    # A negative zero groups with zero.
    parts = [F.col(k) + F.lit(0.0).cast(df.schema[k].dataType) if isinstance(df.schema[k].dataType, (T.FloatType, T.DoubleType)) else F.col(k) for k in keys]
    exact = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return F.to_json(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(parts)]), exact)


def first_by_ingestion(stream: DataFrame, keys: Sequence[str], time: str = "ingestion_timestamp", tie: Sequence[str] = (),
                       within: str = "7 days", groups: int = 1024) -> DataFrame:
    """The first record of every key in the order of ``time``, then of ``tie`` (a number; else the content).

    A key's first arrival is handed on at once; an earlier record that arrives later follows with
    ``correction`` true, and replaces it in a sink that keeps one row a key. The state of a key is the key and
    two numbers; it is kept with those of its group of keys. ``groups`` is fixed for the life of a stream:
    some thousands of keys a group are handled best. A key's state is dropped by an event-time timer once the watermark, ``within`` behind the latest time,
    has passed the record by as much again; records older than the watermark are dropped by Spark.
    Rows without a time take no part."""
    spark = stream.sparkSession
    if spark.conf.get(STORE[0], "") != STORE[1]:
        raise RuntimeError(f"set {STORE[0]} to {STORE[1]}")
    keep_ms = int(spark.sql(f"SELECT unix_millis(timestamp '1970-01-01 00:00:00Z' + interval '{within}') AS ms").first().ms)
    columns = [F.col(f"`{c}`") for c in stream.columns]
    tied = F.col(tie[0]).cast("long") if tie else F.xxhash64(*columns)
    text = _key_text(stream, keys)
    rows = stream.where(F.col(time).isNotNull()).withColumns({
        AT: F.unix_micros(time), TIE: F.coalesce(tied, F.lit((1 << 63) - 1)), KEY: text, GROUP: F.pmod(F.xxhash64(text), F.lit(groups)),
    }).withWatermark(time, within)
    # Whole numbers with nulls among them would become doubles in pandas: the nulls travel beside them.
    whole = [f.name for f in stream.schema.fields if isinstance(f.dataType, T.IntegralType)]
    flags = {c: f"{MISSING}_{i}" for i, c in enumerate(whole)}
    rows = rows.withColumns({flag: F.col(f"`{c}`").isNull() for c, flag in flags.items()})
    rows = rows.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(0).cast(stream.schema[c].dataType)) for c in whole})
    out = [*stream.columns, *flags.values()]
    made = T.StructType([*stream.schema.fields, *[T.StructField(f, T.BooleanType()) for f in flags.values()], T.StructField("correction", T.BooleanType())])
    found = rows.groupBy(GROUP).transformWithStateInPandas(_Earliest(out, keep_ms), made, "update", "eventTime")
    back = [F.when(~F.col(flags[c]), F.col(f"`{c}`")).alias(c) if c in flags else F.col(f"`{c}`") for c in stream.columns]
    return found.select(*back, "correction")
