"""Stalled jobs: the stream with timers, restarted once, against its batch form and a plain model."""

import datetime
import random

from pyspark.sql import functions as F

from tilework.streaming import stalls

SCHEMA = "job string, at timestamp, state string"
ZERO = datetime.datetime(2026, 1, 1, tzinfo=datetime.timezone.utc)


def rows_of(events):
    return [(job, ZERO + datetime.timedelta(seconds=s), state) for job, s, state in events]


def model(events, limit, now):
    out = {}
    for job in {e[0] for e in events}:
        own = sorted((s, state == "done") for j, s, state in events if j == job)
        ends = min((s for s, final in own if final), default=None)
        for s, _ in own:
            following = min((x for x, _ in own if x > s), default=now)
            if following - s >= limit and s + limit <= now and (ends is None or s < ends):
                out[job] = s
                break
    return out


def run(spark, where, batches):
    """Each list of batches is a run of the stream from its checkpoint."""
    source, out = f"{where}/in", f"{where}/out"
    n = 0
    for some in batches:
        for rows in some:
            n += 1
            spark.createDataFrame(rows_of(rows), SCHEMA).coalesce(1).write.mode("append").parquet(f"{source}/b{n:02d}")
        stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(source)
        found = stalls.stalled(stream, "job", "at", F.col("state") == "done", 480, "60 seconds")
        q = found.writeStream.outputMode("append").format("json").option("path", out).option("checkpointLocation", f"{where}/state").trigger(availableNow=True).start()
        q.awaitTermination()
    rows = spark.read.schema("job string, last_ms long, stalled_ms long").json(out).collect()
    assert all(r["stalled_ms"] - r["last_ms"] == 480_000 for r in rows) and len({r["job"] for r in rows}) == len(rows)
    return {r["job"]: (r["last_ms"] - int(ZERO.timestamp() * 1000)) // 1000 for r in rows}


def test_a_stream_that_is_restarted_equals_its_batch_form(spark, tmp_path):
    rng = random.Random(9)
    events = [("silent", 0, "run"), ("below", 0, "run"), ("below", 479, "run"), ("at", 0, "run"), ("at", 480, "run"), ("ended", 0, "run"), ("ended", 100, "done"), ("late_end", 0, "run"), ("late_end", 700, "done"), ("back", 0, "run"), ("back", 900, "run")]
    events += [("below", s, "run") for s in range(900, 3000, 400)] + [("again", 10, "run"), ("again", 2990, "run")]
    events += [(f"r{k}", rng.randrange(2900), rng.choice(["run"] * 9 + ["done"])) for k in range(12) for _ in range(rng.randrange(1, 9))]
    events += [("clock", s, "run") for s in range(0, 3001, 100)]
    ordered = sorted(events, key=lambda e: e[1] + rng.uniform(0, 50))  # out of order within the lateness
    parts = [ordered[k : k + 25] for k in range(0, len(ordered), 25)]
    got = run(spark, tmp_path, [parts[:2], parts[2:]])
    now = max(s for _, s, _ in events) - 60
    want = model(events, 480, now)
    assert got == want
    assert "silent" in got and "at" in got and "late_end" in got and got["back"] == 0 and "ended" not in got and "clock" not in got
    batch = stalls.stalled_batch(spark.createDataFrame(rows_of(events), SCHEMA), "job", "at", F.col("state") == "done", 480, int(ZERO.timestamp() * 1000) + 1000 * now)
    assert {r["job"]: (r["last_ms"] - int(ZERO.timestamp() * 1000)) // 1000 for r in batch.collect()} == want


def test_a_batch_of_a_job_costs_few_calls():
    import pandas as pd

    from tilework.streaming.stalls import _Stalls

    calls = []

    class State:
        def exists(self):
            return False

        def appendList(self, rows):  # noqa: N802
            calls.append(len(rows))

    class Handle:
        def registerTimer(self, at):  # noqa: N802
            calls.append(at)

    stalls = _Stalls(10)
    stalls.handle, stalls.seen, stalls.done = Handle(), State(), State()
    stalls.handleInputRows(("a",), iter([pd.DataFrame({"at_ms": range(1000, 2000, 5), "final": False}), pd.DataFrame({"at_ms": [3000], "final": [True]})]), None)
    assert calls == [201, 2005]
