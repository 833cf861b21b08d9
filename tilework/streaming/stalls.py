"""Stalled jobs by event-time timers: a job that says nothing for the limit is stale, and stays so."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: State stores that hold timers.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Stalls(StatefulProcessor):
    """Holds a job's activity and one timer at a time or few: at the limit behind the first event that no other follows within the limit.
    When that is behind the watermark, all that could have come in between is there, so what is found doesn't depend on the
    order of arrival.  A batch of a job costs a few calls to the state store, however many events it has."""

    def __init__(self, limit_ms: int) -> None:
        self.limit = limit_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getListState("seen", "at long, final boolean")
        self.done = handle.getValueState("done", "done boolean")

    def _quiet(self, times: list[int]) -> int:
        """The first of the sorted times that none follows within the limit."""
        return next((a for a, b in itertools.pairwise(times) if b - a >= self.limit), times[-1])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if not self.done.exists():
            events = [(int(at), bool(final)) for batch in rows for at, final in zip(batch["at_ms"], batch["final"], strict=True)]
            if events:
                self.seen.appendList(events)
                self.handle.registerTimer(self._quiet(sorted({at for at, _ in events})) + self.limit)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if self.done.exists():
            return
        events, past = list(self.seen.get()), expiredTimerInfo.getExpiryTimeInMs() - self.limit
        at = self._quiet(sorted({then for then, _ in events}))
        if at > past and at + self.limit > timerValues.getCurrentWatermarkInMs():  # the silence was filled: wait for the next one
            self.seen.put([e for e in events if e[1] or e[0] > past])
            self.handle.registerTimer(at + self.limit)
            return
        self._finish()
        if not any(final and then <= at for then, final in events):
            yield pd.DataFrame({"job": [key[0]], "last_ms": [at], "stalled_ms": [at + self.limit]})

    def _finish(self) -> None:
        self.done.update((True,))
        self.seen.clear()

    def close(self) -> None:
        pass


def stalled(events: DataFrame, job: str, at: str, final: Column, limit_s: int, lateness: str) -> DataFrame:
    """(job, last_ms, stalled_ms) of a stream's jobs that were silent for limit_s seconds or more before a final state: once a job, in
    append mode, when the watermark is past that moment.

    Terminal states stay: a job that reached a final state never stalls, a stalled one never comes back.  The state holds a job's
    events of the limit and the lateness; sets the session's state store to one with timers.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    kind = events.schema[job].dataType.simpleString()
    rows = events.select(F.col(job).alias("job"), F.col(at).alias("at"), F.unix_millis(at).alias("at_ms"), final.alias("final")).withWatermark("at", lateness)
    return rows.groupBy("job").transformWithStateInPandas(_Stalls(1000 * limit_s), f"job {kind}, last_ms long, stalled_ms long", "Append", "EventTime")


def stalled_batch(events: DataFrame, job: str, at: str, final: Column, limit_s: int, now_ms: int) -> DataFrame:
    """The same of a table, as of now_ms: the first silence of the limit before a final state."""
    from pyspark.sql import Window

    rows = events.select(F.col(job).alias("job"), F.unix_millis(at).alias("at"), final.alias("final"))
    ends = F.min(F.when(F.col("final"), F.col("at"))).over(Window.partitionBy("job"))
    following = F.min("at").over(Window.partitionBy("job").orderBy("at").rangeBetween(1, Window.unboundedFollowing))
    quiet = rows.select("job", "at", ends.alias("ends"), following.alias("next")).filter((F.coalesce("next", F.lit(now_ms)) - F.col("at") >= 1000 * limit_s) & (F.col("at") + 1000 * limit_s <= now_ms))
    return quiet.filter(F.col("ends").isNull() | (F.col("at") < F.col("ends"))).groupBy("job").agg(F.min("at").alias("last_ms"), (F.min("at") + 1000 * limit_s).alias("stalled_ms"))
