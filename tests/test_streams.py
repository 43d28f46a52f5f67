"""Timers and places of streams against plain loops, over several triggers."""

import datetime as dt
import random

from pyspark.sql import functions as F

from gristmill.streaming import events as streams

START = dt.datetime(2024, 1, 1)


def table(spark, rows):
    made = spark.createDataFrame([(k, START + dt.timedelta(minutes=m), *r) for k, (m, *r) in enumerate(rows)], "event_id long, ts timestamp, k string, who string, kind string")
    return made.withColumn("trigger", F.floor(F.col("event_id") / 9))


def minutes(at):
    return (at - START).total_seconds() / 60


def test_silent_keys_are_nudged_and_fail(spark):
    rows = [(0, "silent", "-", "view"), (1, "done", "-", "view"), (20, "done", "-", "end")] + [(10 * m, f"clock{m % 3}", "-", "view") for m in range(1, 60)]
    rows.sort(key=lambda r: r[0])
    path = streams.arranged(table(spark, rows), "trigger")
    plan = lambda e: streams.reminders(e, "k", "kind", "end", "1 hour", most=3, late="5 minutes")
    got = {(r["k"], r["kind"], r["n"], minutes(r["at"])) for r in streams.run_once(spark, path, plan, files_per_trigger=1).collect()}
    assert got == {("silent", "nudge", n, 60.0 * n) for n in (1, 2, 3)} | {("silent", "failed", 3, 240.0), ("done", "done", 0, 20.0)}


def test_places_fall_free(spark):
    rng = random.Random(2)
    rows = sorted((rng.randrange(0, 900) + k / 1000, "ab"[k % 2], f"h{rng.randrange(5)}", rng.choice(("take", "take", "take", "give"))) for k in range(120))
    path = streams.arranged(table(spark, rows), "trigger")
    plan = lambda e: streams.leases(e, "k", "who", "kind", "take", "40 minutes", 2, late="0 seconds")
    got = sorted((r["k"], r["holder"], r["kind"], round(minutes(r["at"]), 3)) for r in streams.run_once(spark, path, plan, files_per_trigger=1).collect())
    held, want = {"a": {}, "b": {}}, []

    def expire(k, now):
        for end, who in sorted((e, w) for w, e in held[k].items()):
            if end <= now:
                del held[k][who]
                want.append((k, who, "expired", round(end, 3)))

    for m, k, who, kind in rows:
        expire(k, m)
        if kind == "give":
            if held[k].pop(who, None) is not None:
                want.append((k, who, "released", round(m, 3)))
        elif who in held[k] or len(held[k]) < 2:
            held[k][who] = m + 40
            want.append((k, who, "granted", round(m, 3)))
        else:
            want.append((k, who, "refused", round(m, 3)))
    for k in "ab":
        expire(k, rows[-1][0])
    assert got == sorted(want) and {w[2] for w in want} == {"granted", "refused", "released", "expired"}


class Counted:
    """A state and a handle that count the calls made on them; each call is a message to the JVM in a real stream."""

    def __init__(self):
        self.calls, self.value, self.timers = 0, None, set()

    def __getattr__(self, name):
        def call(*args):
            self.calls += 1
            match name:
                case "getValueState" | "getMapState":
                    return self
                case "get":
                    return self.value
                case "update":
                    self.value = args[0]
                case "clear":
                    self.value = None
                case "registerTimer":
                    self.timers.add(args[0])
                case "deleteTimer":
                    self.timers.discard(args[0])
                case _:
                    raise AssertionError(f"{name} is a call for each event or timer")
        return call

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return 0


def test_a_key_takes_few_calls_however_many_events_it_has():
    hour, rows = 3_600_000_000, [{"us": 60_000_000 * k, "who": "h", "kind": "end" if k % 7 == 6 else "take"} for k in range(5000)]
    for made in (streams.Reminders("kind", "end", hour, 3), streams.Slots("who", "take", "kind", hour, 1)):
        store = Counted()
        made.init(store)
        got = list(made.handleInputRows(("a",), iter(rows), store))
        assert store.calls <= 5 and len(store.timers) == 1
        assert sum(r["kind"] in ("done", "released") for r in got) == 5000 // 7
