"""Structured Streaming over event files: windows, deduplication and task states kept by key, and running a stream to its end."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupState

from ..session import ship


def source(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """A stream of Parquet event files; ts is read as an instant in the session's zone, so that it can have a watermark."""
    schema = spark.read.parquet(f"{path}*").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(f"{path}*")  # a pattern, as a stream takes no single file
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def first_of_each(stream: DataFrame, keys: list[str], late: str = "1 hour") -> DataFrame:
    """The first event of each key within the watermark; state older than that is dropped."""
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def _shared(spark: SparkSession) -> str:
    return spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "streams")


def _append(spark: SparkSession, stream: DataFrame, out: str, state: str, mode: str = "append") -> None:
    def keep(batch: DataFrame, number: int) -> None:
        # A batch that is tried again writes the same folder again, so no row is there twice.
        batch.write.mode("overwrite").parquet(out if mode == "complete" else f"{out}/batch={number}")

    name, kept = "spark.sql.streaming.stateStore.providerClass", spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")  # timers need it
    try:
        stream.writeStream.outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    finally:
        spark.conf.set(name, kept)


def run_once(spark: SparkSession, path: str, plan: Callable[[DataFrame], DataFrame], mode: str = "append", files_per_trigger: int = 100) -> DataFrame:
    """Runs a plan over all files that are there, and returns the result as a batch table in the shared folder."""
    shared = _shared(spark)
    name = uuid.uuid4().hex
    out = f"{shared}/stream-{name}"

    stream = plan(source(spark, path, files_per_trigger))
    _append(spark, stream, out, f"{shared}/state-{name}", mode)
    return spark.read.schema(stream.schema).parquet(out if mode == "complete" else f"{out}/batch=*")


def run_twice(spark: SparkSession, path: str, plan: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Runs a plan that appends, to its end, and again with the same checkpoint: the second run finds nothing new, as after a restart."""
    shared, name = _shared(spark), uuid.uuid4().hex
    for _ in range(2):
        _append(spark, plan(source(spark, path)), f"{shared}/stream-{name}", f"{shared}/state-{name}")
    return spark.read.schema(plan(source(spark, path)).schema).parquet(f"{shared}/stream-{name}/batch=*")


def tasks(stream: DataFrame, key: str, event: str, order: list[str], begins: str, fails: str, ends: str, retries: int = 2) -> DataFrame:
    """Updates of each task's state: key, state, attempts, seen (events so far), one row for each trigger that has events of the task.

    pending and failed tasks begin (in_progress, one attempt more); one in progress ends (done) or fails (failed, or dead_letter once all
    retries are used); done and dead_letter stay; other events change nothing. Between triggers a task is three small values in the state
    store. A task's events of one trigger are put in order together, so maxFilesPerTrigger bounds them; later triggers count as later.
    """
    narrow = stream.where(F.col(event).isin(begins, fails, ends)).select(key, event, *order)
    kind = narrow.schema[key].dataType.simpleString()

    def run(found: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        status, attempts, seen = state.get if state.exists else ("pending", 0, 0)
        rows = pd.concat(list(frames)).sort_values(order)
        for what in rows[event]:
            if status in ("pending", "failed") and what == begins:
                status, attempts = "in_progress", attempts + 1
            elif status == "in_progress" and what == ends:
                status = "done"
            elif status == "in_progress" and what == fails:
                status = "failed" if attempts <= retries else "dead_letter"
        state.update((status, attempts, seen + len(rows)))
        yield pd.DataFrame({key: [found[0]], "state": [status], "attempts": [attempts], "seen": [seen + len(rows)]})

    return narrow.groupBy(key).applyInPandasWithState(run, f"{key} {kind}, state string, attempts long, seen long", "state string, attempts long, seen long", "update", "NoTimeout")


def arranged(df: DataFrame, arrives: str) -> str:
    """A folder in which each value of a column (a few whole numbers) is files of its own, written in order; returns the start of their paths, for source()."""
    folder = f"{_shared(df.sparkSession)}/arrivals-{uuid.uuid4().hex}"
    kept = df.select("*").persist()
    for k, row in enumerate(kept.select(arrives).distinct().orderBy(arrives).collect()):
        kept.where(F.col(arrives) == row[0]).drop(arrives).coalesce(1).write.parquet(f"{folder}/b{k:06d}")
    kept.unpersist()
    return f"{folder}/b"


class Reminders(StatefulProcessor):
    """Keeps, for each key, when its open task was last heard of, how many nudges it has had, and its timer; see reminders().

    Each call on the handle or the state is a message to the JVM, so a key's state is read once and written once, however many events it has.
    """

    def __init__(self, event: str, ends: str, every_us: int, most: int) -> None:
        self.event, self.ends, self.every, self.most = event, ends, every_us, most

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("open", "heard long, nudges int, timer long")

    def _run(self, key: tuple, events: list[tuple], now_us: int) -> Iterator[Row]:
        """Events in order, and what falls due between them and up to now: nudges, and after the last one the failure, which closes the task."""
        kept = self.state.get()
        heard, nudges, timer = kept or (None, 0, None)
        for us, what, last in [*((*e, False) for e in events), (now_us, None, True)]:
            while heard is not None and (at := heard + (nudges + 1) * self.every) <= us:
                if nudges == self.most:
                    yield Row(key=key[0], kind="failed", n=nudges, at=at)
                    heard = None
                else:
                    nudges += 1
                    yield Row(key=key[0], kind="nudge", n=nudges, at=at)
            if last:
                break
            if what != self.ends:
                heard, nudges = us, 0
            elif heard is not None:
                yield Row(key=key[0], kind="done", n=0, at=us)
                heard = None
        due = None if heard is None else (heard + (nudges + 1) * self.every + 999) // 1000
        _move_timer(self.handle, timer, due)
        if heard is not None:
            self.state.update((heard, nudges, due))
        elif kept is not None:
            self.state.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        yield from self._run(key, sorted((r["us"], r[self.event]) for r in rows), 1000 * timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._run(key, [], 1000 * timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def _move_timer(handle, old: int | None, new: int | None) -> None:
    """A key has one timer at most; one that went off just now may be deleted again."""
    if old != new:
        if old is not None:
            handle.deleteTimer(old)
        if new is not None:
            handle.registerTimer(new)


def reminders(stream: DataFrame, key: str, event: str, ends: str, every: str, most: int = 3, late: str = "1 hour") -> DataFrame:
    """key, kind (nudge, failed or done), n, at: an open task that isn't heard of for so long is nudged, again after the same time, and fails after so many nudges.

    Any event opens its key's task or counts as a sign of it, but for one that ends it. What falls due does so by event time, without a new
    event of its key: timers go off once the watermark passes them, and only open tasks have state. A key's events of one trigger are put in
    order together; events behind the watermark are dropped.
    """
    ship(stream.sparkSession)
    every_us = int(pd.Timedelta(every).total_seconds() * 1_000_000)
    narrow = stream.withWatermark("ts", late).select(F.col(key).alias("key"), event, "ts", F.unix_micros("ts").alias("us"))
    kind = narrow.schema["key"].dataType.simpleString()
    made = narrow.groupBy("key").transformWithState(Reminders(event, ends, every_us, most), f"key {kind}, kind string, n int, at long", "Append", "EventTime")
    return made.select(F.col("key").alias(key), "kind", "n", F.timestamp_micros("at").alias("at"))


class Slots(StatefulProcessor):
    """Who holds a place of each resource, until when, and the resource's timer; read once and written once for a resource's events, as in Reminders. See leases()."""

    def __init__(self, holder: str, takes: str, event: str, ttl_us: int, places: int) -> None:
        self.holder, self.takes, self.event, self.ttl, self.places = holder, takes, event, ttl_us, places

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("held", "holders array<string>, untils array<long>, timer long")

    def _run(self, key: tuple, events: list[tuple], now_us: int) -> Iterator[Row]:
        """Events in order, and the places that fall free between them and up to now."""
        kept = self.state.get()
        holders, untils, timer = kept or ((), (), None)
        held = dict(zip(holders, untils, strict=True))
        first = min(untils, default=None)  # no place falls free before
        for us, name, what in [*events, (now_us, None, None)]:
            if first is not None and first <= us:
                for until, who in sorted((u, w) for w, u in held.items() if u <= us):
                    del held[who]
                    yield Row(key=key[0], holder=who, kind="expired", at=until)
                first = min(held.values(), default=None)
            if name is None:
                continue
            if what != self.takes:
                if held.pop(name, None) is not None:
                    yield Row(key=key[0], holder=name, kind="released", at=us)
            elif name in held or len(held) < self.places:
                held[name] = us + self.ttl
                first = held[name] if first is None else min(first, held[name])
                yield Row(key=key[0], holder=name, kind="granted", at=us)
            else:
                yield Row(key=key[0], holder=name, kind="refused", at=us)
        due = (min(held.values()) + 999) // 1000 if held else None
        _move_timer(self.handle, timer, due)
        if held:
            self.state.update((list(held), list(held.values()), due))
        elif kept is not None:
            self.state.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        yield from self._run(key, sorted((r["us"], str(r[self.holder]), r[self.event]) for r in rows), 1000 * timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._run(key, [], 1000 * timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def leases(stream: DataFrame, resource: str, holder: str, event: str, takes: str, ttl: str, places: int, late: str = "1 hour") -> DataFrame:
    """resource, holder, kind (granted, refused, released or expired), at: each resource has so many places, held for so long unless asked for again or released.

    A place falls free by event time, without a new event of its resource, once the watermark passes its end.
    """
    ship(stream.sparkSession)
    ttl_us = int(pd.Timedelta(ttl).total_seconds() * 1_000_000)
    narrow = stream.withWatermark("ts", late).select(F.col(resource).alias("key"), holder, event, "ts", F.unix_micros("ts").alias("us"))
    kind = narrow.schema["key"].dataType.simpleString()
    made = narrow.groupBy("key").transformWithState(Slots(holder, takes, event, ttl_us, places), f"key {kind}, holder string, kind string, at long", "Append", "EventTime")
    return made.select(F.col("key").alias(resource), "holder", "kind", F.timestamp_micros("at").alias("at"))


def matched(tasks: DataFrame, results: DataFrame, key: str, within: str, late: str = "1 hour") -> DataFrame:
    """Two streams (key, ts and columns of their own) joined: each task with each result of its key that comes so soon after it, or alone once none can come any more.

    Both have watermarks; state older than these allow is dropped.
    """
    left = tasks.withWatermark("ts", late).alias("t")
    right = results.withColumnRenamed(key, "_key").withColumnRenamed("ts", "result_ts").withWatermark("result_ts", late)
    soon = F.expr(f"_key = {key} and result_ts >= ts and result_ts <= ts + interval {within}")
    return left.join(right, soon, "left_outer").drop("_key")


def windowed(stream: DataFrame, keys: list[str], width: str, slide: str | None = None, late: str = "1 day") -> DataFrame:
    """keys, start, n: events by tumbling or sliding windows, each given once, when the watermark has passed its end; events of windows given in triggers before are dropped."""
    window = F.window("ts", width, slide).alias("w")
    counted = stream.withWatermark("ts", late).groupBy(*keys, window).agg(F.count("*").alias("n"))
    return counted.select(*keys, F.col("w.start").alias("start"), "n")


def split_late(spark: SparkSession, path: str, late: str, files_per_trigger: int = 1) -> tuple[DataFrame, DataFrame]:
    """The events of a stream that were in time, and those that were late: behind the latest event of all triggers before theirs by more than so much.

    Each trigger writes both parts and its latest time into folders of its number, so one that is tried again writes the same again.
    """
    folder = f"{_shared(spark)}/split-{uuid.uuid4().hex}"
    stream = source(spark, path, files_per_trigger)
    marks = spark.createDataFrame([], "at timestamp, batch int")

    def keep(batch: DataFrame, number: int) -> None:
        seen = spark.read.schema("at timestamp, batch int").parquet(f"{folder}/marks") if number else marks
        before = seen.where(F.col("batch") < number).agg(F.max("at").alias("_before"))  # one row
        behind = F.coalesce(F.col("ts") < F.col("_before") - F.expr(f"interval {late}"), F.lit(False))
        told = batch.join(F.broadcast(before), F.lit(True)).withColumn("late", behind.cast("int")).drop("_before")
        told.write.mode("overwrite").partitionBy("late").parquet(f"{folder}/rows/batch={number}")
        batch.agg(F.max("ts").alias("at")).write.mode("overwrite").parquet(f"{folder}/marks/batch={number}")

    stream.writeStream.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    rows = spark.read.parquet(f"{folder}/rows").drop("batch")
    return rows.where("late = 0").drop("late"), rows.where("late = 1").drop("late")
