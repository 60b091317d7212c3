"""A change feed with its own memory: the newest change of each key is kept in the state store.

``jobs.current_of_feed`` reads every stored batch again to tell which change of a key is the newest. Here
the sequence number of a key's newest change lies in the state store, so a change that comes late or twice
stops there, and what goes on are real changes, one of a key in a batch. They are merged into a table in
key buckets, of which a batch reads and writes those that it hits.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from partledger.context import RunContext
from partledger.schemas import TableSpec
from partledger.sinks import Lake
from partledger.streaming.jobs import finish

# For the query alone: a session's other streams keep theirs. Batches without data are left out, for with
# an expiry there is always one more of them; each batch with data removes what has expired.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
TOMBSTONE_DAYS = 30

# The processor is sent to the executors itself, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class NewestChange(StatefulProcessor):
    """Lets the newest change of a key pass if it is newer than all that came before.

    A row of state is a sequence number: that of a key that is there, or that of its deletion, which expires
    so that deleted keys do not stay for ever. Of a batch only the best row so far is held. The deletion of
    a key that is not there passes nothing on, but is remembered.
    """

    def __init__(self, lsn: str, op: str, delete: str, tombstone_days: float):
        self.lsn, self.op, self.delete = lsn, op, delete
        self.keep_ms = max(1, int(tombstone_days * 86_400_000))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.there = handle.getValueState("there", "lsn long")
        self.gone = handle.getValueState("gone", "lsn long", ttlDurationMs=self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest = max((r for r in rows if r[self.lsn] is not None), key=lambda r: (r[self.lsn], repr(r)), default=None)
        if newest is None:
            return
        there, gone = self.there.get(), self.gone.get()
        known = there or gone
        if known is not None and newest[self.lsn] <= known[0]:
            return
        if newest[self.op] == self.delete:
            self.there.clear()
            self.gone.update((newest[self.lsn],))
            if there is None:
                return
        else:
            self.gone.clear()
            self.there.update((newest[self.lsn],))
        yield newest

    def close(self) -> None:
        pass


def real_changes(feed: DataFrame, keys: Sequence[str], lsn: str, op: str, delete: str = "delete",
                 tombstone_days: float = TOMBSTONE_DAYS) -> DataFrame:
    """The changes of a feed that change the table it makes, at most one of a key in a batch, with the feed's columns.

    Rows without a sequence number are dropped. Rows of one key and number count as one change: that
    which sorts last. A change that comes more than ``tombstone_days`` after its key was deleted, and is
    older than the deletion, is not told from a new key.
    """
    return feed.groupBy(*keys).transformWithState(
        NewestChange(lsn, op, delete, tombstone_days), feed.schema, "Update", "ProcessingTime")


def apply_changes(feed: DataFrame, lake: Lake, spec: TableSpec, ctx: RunContext, checkpoint: str, lsn: str, op: str,
                  delete: str = "delete", tombstone_days: float = TOMBSTONE_DAYS) -> None:
    """Bring a table in key buckets up to date with everything that the feed has, then stop.

    The table keeps the feed's columns without ``op``. A batch repeated after a failure starts from the
    state before it, passes the same changes on and ends at the same table.
    """
    if not spec.buckets:
        raise ValueError(f"{spec.id} has no key buckets")
    spark = feed.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        lake.apply(batch, spec, ctx, F.col(op).eqNullSafe(F.lit(delete)), [op])

    former = {name: spark.conf.get(name, None) for name in SETTINGS}
    try:
        for name, value in SETTINGS.items():
            spark.conf.set(name, value)
        changes = real_changes(feed, spec.keys, lsn, op, delete, tombstone_days)
        query = changes.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(
            availableNow=True).foreachBatch(merge).start()
    finally:
        for name, value in former.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    finish(query)
