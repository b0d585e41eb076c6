"""Incremental loads on Structured Streaming: each batch of signals is a tick over a published store.

``keyed`` keeps what is open in keyed state: a key's oldest unanswered signal, with a timer that ages it
out.  What a tick finds out about a key goes to a folder of outcomes, which the same stream reads beside the
signals: a key that neither side has is asked for again in the next tick, without a scan of all that
wait.  Where a document lies in the warehouse is read from its bucket of the store's tree, so a tick
reads what its keys touch, however much is published.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tallyloom.operators.changes import LOOK_BACK, classify, window_bounds
from tallyloom.plans.publish import Store
from tallyloom.staged import staged


def in_bounds(signals: DataFrame, watermark: Column, now: Column, at: str = "updated_at") -> DataFrame:
    """Signals of the next window: from the watermark less an overlap to now less the clock's skew [STR-01]."""
    start, end = window_bounds(watermark, now)
    return signals.where((F.col(at) >= start) & (F.col(at) < end))


def classified(asked: DataFrame, source_keys: DataFrame, had: DataFrame, now: Column, look_back: str = LOOK_BACK) -> DataFrame:
    """(uid, since, state) of the keys of a tick [STR-02, STR-03].

    ``asked`` has each key with the time of its oldest open signal.  A key is ready if it is at the
    source; deleted if only the warehouse has it; pending if neither has, and aged when it has been so
    for longer than the look-back: then it is asked for no more.  Empty keys are invalid.
    """
    states = classify(asked, source_keys).join(asked.select("uid", "since"), "uid")
    states = states.join(had.select(F.col("uid").alias("__had")).distinct(), F.col("uid") == F.col("__had"), "left")
    waiting = F.when(F.col("__had").isNotNull(), "deleted").when(F.col("since") < now - F.expr(look_back), "aged").otherwise("pending")
    return states.select("uid", "since", F.when(F.col("state") == "pending", waiting).otherwise(F.col("state")).alias("state"))


def tick(store: Store, key: str, fetch: Callable[[DataFrame], DataFrame], exists: Callable[[DataFrame], DataFrame], pending_path: str, now: Callable[[], Column] = F.current_timestamp, look_back: str = LOOK_BACK) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function [STR-01, STR-02, STR-03, STR-05, SNK-17].

    A batch's keys and those still pending are classified: what is at the source is fetched and
    patched in, what the warehouse has but the source lost is deleted, and what neither has stays
    pending in a table of its own, to be asked for again until it ages out.  The first batch over an
    empty store publishes what it fetches.  Running a batch twice gives the same rows.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, time = batch.sparkSession, now()
        at = F.col("updated_at") if "updated_at" in batch.columns else time
        signalled = batch.select(F.col("uid").cast("string").alias("uid"), at.cast("timestamp").alias("since"))
        if batch_id > 0:
            signalled = signalled.union(spark.read.parquet(f"{pending_path}/{batch_id - 1}").select("uid", "since"))
        states = answer(store, key, fetch, exists, signalled, time, look_back)
        states.where("state = 'pending'").select("uid", "since").write.mode("overwrite").parquet(f"{pending_path}/{batch_id}")

    return run


def answer(store: Store, key: str, fetch: Callable[[DataFrame], DataFrame], exists: Callable[[DataFrame], DataFrame], signalled: DataFrame, time: Column, look_back: str) -> DataFrame:
    """(uid, since, state) of the keys of (uid, since), after what they ask for has been done to the store.

    To classify, only the keys' buckets of the store's tree are read; rows are read of touched partitions alone.
    """
    spark = signalled.sparkSession
    signalled = staged(signalled.where("uid is not null").groupBy("uid").agg(F.min("since").alias("since")), "asked")
    at = store.snapshot()
    had = None
    if at.parts:
        kind = store.documents(at=at).schema[key].dataType
        had = store.documents(signalled.select(F.col("uid").try_cast(kind).alias(key)).where(F.col(key).isNotNull()), at)
    had = spark.createDataFrame([], "uid string") if had is None else had.select(F.col(key).cast("string").alias("uid"))
    states = staged(classified(signalled, exists(signalled), had, time, look_back), "tick")
    ready = states.where("state = 'ready'").select("uid")
    if not at.parts:
        fresh = staged(fetch(ready), "tick-rows")
        if parts := sorted(r[0] for r in fresh.select(store.spec.partition).distinct().collect()):
            store.publish(fresh, parts, base=at)
        return states
    changed = states.where("state in ('ready', 'deleted')").select(F.col("uid").cast(kind).alias(key))
    if not changed.isEmpty():
        store.apply(changed, staged(fetch(ready), "tick-rows"))
    return states


class OpenKeys(StatefulProcessor):
    """A key's oldest open signal; asks for it, and gives it up when its timer runs out."""

    def __init__(self, look_back_s: float):
        self.look_back_ms = int(look_back_s * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.since = handle.getValueState("since", "micros bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        since = self.since.get()[0] if self.since.exists() else None
        rows = list(rows)  # of one key in one tick
        for r in rows:  # answers to what was asked come first
            if r.kind not in ("signal", "pending") and since is not None and r["at"] >= since:
                self._forget()
                since = None
        signals = [r["at"] for r in rows if r.kind == "signal"]
        waits = [r["at"] for r in rows if r.kind == "pending"]
        if since is None and not signals:
            return
        if signals and (since is None or min(signals) < since):
            self._forget()
            since = min(signals)
            self.since.update((since,))
            self.handle.registerTimer(max(since // 1000 + self.look_back_ms, timerValues.getCurrentProcessingTimeInMs() + 1))
        if signals or waits:
            yield Row(uid=key[0], since=since, state="ask")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.since.exists():
            since = self.since.get()[0]
            self._forget()
            yield Row(uid=key[0], since=since, state="aged")

    def _forget(self) -> None:
        self.since.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)

    def close(self) -> None:
        pass


def keyed(signals: DataFrame, store: Store, key: str, fetch: Callable[[DataFrame], DataFrame], exists: Callable[[DataFrame], DataFrame], home: str, look_back: str = LOOK_BACK, every: str | None = None) -> StreamingQuery:
    """Ticks over a stream of (uid, updated_at), their open keys in keyed state with timers [STR-01, STR-02, STR-03, STR-05].

    Started with ``every`` it ticks at that interval until it is stopped; without, it takes what has come
    and stops, and the next start goes on from the checkpoint in ``home``.  A key that neither the source nor the
    store has is asked for once a tick until its timer, ``look_back`` after its oldest signal, gives it up.
    A batch that is run again after a failure does the same once more, which changes nothing.
    """
    spark = signals.sparkSession
    outcomes = f"{home}/outcomes"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    # a timer has its turn in the next batch that has rows, and open keys bring rows to every tick
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    seconds = spark.sql(f"SELECT unix_micros(timestamp_seconds(0) + {look_back}) / 1e6").first()[0]
    kinds = "uid string, since timestamp, state string"
    spark.createDataFrame([], kinds).write.mode("append").parquet(f"{outcomes}/none")
    answers = spark.readStream.schema(kinds).parquet(f"{outcomes}/*").select("uid", F.unix_micros("since").alias("at"), F.col("state").alias("kind"))
    events = signals.select(F.col("uid").cast("string").alias("uid"), F.unix_micros(F.col("updated_at").cast("timestamp")).alias("at"), F.lit("signal").alias("kind")).where("uid is not null and at is not null").union(answers)
    asks = events.groupBy("uid").transformWithState(statefulProcessor=OpenKeys(seconds), outputStructType="uid string, since bigint, state string", outputMode="Append", timeMode="ProcessingTime")

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = staged(batch.withColumn("since", F.timestamp_micros("since")), "asks")
        asked = batch.where("state = 'ask'").select("uid", "since")
        # ageing is the timer's work, so nothing here is too old
        states = answer(store, key, fetch, exists, asked, F.lit("0001-01-01").cast("timestamp"), "INTERVAL 0 DAYS")
        states.select("uid", "since", "state").write.mode("overwrite").parquet(f"{outcomes}/{batch_id}")
        batch.where("state = 'aged'").write.mode("overwrite").parquet(f"{home}/aged/{batch_id}")

    writer = asks.writeStream.foreachBatch(run).option("checkpointLocation", f"{home}/checkpoint")
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def follow(signals: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """All signals that have come, batch by batch, then stops; the checkpoint is the watermark."""
    return signals.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
