"""A table kept up to date by a stream of changes, one state per key.

The state of a key is its last change, deletions too: an older change that comes after a newer one, or
after a deletion, is told by its sequence number and passed over. The state store is the table; it is
read as a table itself, so no log of changes is read again. Each batch also writes the rows it changed.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import StructType

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, off the heap; the session stays as it was."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_STORE)
        else:
            spark.conf.set(_STORE, before)


class LastChange(StatefulProcessor):
    """Keeps the change with the greatest sequence number; of equal ones that which came first, within a
    batch the one whose values sort last. ``seq`` and ``rest`` are the columns of a change besides its key."""

    def __init__(self, keys: list[str], seq: str, rest: list[str], schema: StructType):
        self.keys, self.seq, self.rest, self.schema = keys, seq, rest, schema

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        best = None
        for part in rows:
            part = part[part[self.seq].notna()]
            if len(part):
                top = part[part[self.seq] == part[self.seq].max()][[self.seq, *self.rest]]
                # Nulls as None, and the greatest of equal numbers by its values.
                found = [tuple(None if pd.isna(v) else v for v in r) for r in top.itertuples(index=False, name=None)]
                found = max(found, key=lambda r: tuple((v is not None, v) if not isinstance(v, str) else (True, v) for v in r[1:]))
                if best is None or found[0] > best[0] or (found[0] == best[0] and str(found) > str(best)):
                    best = found
        if best is None:
            return
        if self.last.exists() and self.last.get()[0] >= best[0]:
            return
        self.last.update((int(best[0]), *best[1:]))
        yield pd.DataFrame([[*key, *best]], columns=[*self.keys, self.seq, *self.rest])


def keep_table(changes: DataFrame, keys: list[str], seq: str, out: str) -> StreamingQuery:
    """Bring the table at ``out`` up to date with the changes that are available now. ``changes`` is a
    stream with the keys, a whole-number ``seq``, an ``op`` and other columns; a change without a sequence
    number is passed over. ``out/changed/batch=N`` has the keys that batch N changed, as they are then.
    """
    rest = [c for c in changes.columns if c not in (*keys, seq)]
    schema = changes.schema
    state = StructType([schema[seq], *[schema[c] for c in rest]])
    result = StructType([*[schema[k] for k in keys], schema[seq], *[schema[c] for c in rest]])
    changed = changes.groupBy(*keys).transformWithStateInPandas(LastChange(keys, seq, rest, state), result, "Update", "None")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/changed/batch={number}")

    with _rocksdb(changes.sparkSession):
        return (
            changed.writeStream.foreachBatch(write)
            .outputMode("update")
            .option("checkpointLocation", f"{out}/state")
            .trigger(availableNow=True)
            .start()
        )


def kept_table(spark: SparkSession, out: str, op: str = "op", delete: str = "delete") -> DataFrame:
    """The table as the state store has it: the last change of every key that is not deleted."""
    with _rocksdb(spark):
        rows = spark.read.format("statestore").option("stateVarName", "last").load(f"{out}/state")
    return rows.select("key.*", "value.*").filter(~F.col(op).eqNullSafe(F.lit(delete))).drop(op)
