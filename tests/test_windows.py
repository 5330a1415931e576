"""Event-time windows: the stream gives the rows of the table, also after a restart."""

import datetime as dt
import random

from pyspark.sql import functions as F

from visitwise.streaming import windows as W

SCHEMA = "id long, ts timestamp_ntz, kind string, v long"
T0 = dt.datetime(2024, 3, 30, 22)
KEYS = ["window_start", "window_end", "kind"]


def per():
    return {"n": F.count(F.lit(1)), "total": F.sum("v")}


def rows(n, seed=1, hours=10):
    rng = random.Random(seed)
    return [(i, T0 + dt.timedelta(seconds=rng.randrange(hours * 3600)), "hot" if rng.random() < 0.7 else "cold", rng.randrange(9))
            for i in range(n)]


def land(spark, folder, name, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def found(df):
    return sorted(map(repr, map(tuple, df.collect())))


def stream_windows(spark, landing, slide=None, delay="100 hours", row_id=None):
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = W.event_stream(spark, f"{landing}/*", schema, "ts", delay, row_id, files_per_batch=1)
    return W.event_windows(stream, "ts", ["kind"], "1 hour", slide, **per())


def read(spark, out, like):
    got = W.latest(spark, out, like.schema, KEYS)
    return got.withColumns({c: W.wall_clock(c) for c in KEYS[:2]})


def test_stream_equals_table_after_a_restart(spark, tmp_path):
    data = rows(300)
    landing, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for k in range(2):
        land(spark, landing, f"f{k}", data[k * 75:(k + 1) * 75])
    windows = stream_windows(spark, landing, "30 minutes")
    W.run_windows(windows, out, state)
    for k in range(2, 4):  # more files land; another query takes up from the checkpoint
        land(spark, landing, f"f{k}", data[k * 75:(k + 1) * 75])
    W.run_windows(stream_windows(spark, landing, "30 minutes"), out, state)
    table = spark.createDataFrame(data + [(999, None, "hot", 1)], SCHEMA)
    want = W.event_windows(table, "ts", ["kind"], "1 hour", "30 minutes", **per())
    assert found(read(spark, out, windows)) == found(want)
    before = found(read(spark, out, windows))
    W.run_windows(stream_windows(spark, landing, "30 minutes"), out, state)  # nothing new
    assert found(read(spark, out, windows)) == before


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    landing, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    first = rows(50, hours=1)
    late = [(1000 + i, T0 - dt.timedelta(hours=5), "hot", 1) for i in range(7)]
    last = [(2000 + i, T0 + dt.timedelta(hours=9), "cold", 1) for i in range(3)]
    windows = stream_windows(spark, landing, delay="1 hour")
    for k, part in enumerate((first, last, late)):
        land(spark, landing, f"f{k}", part)
        query = W.run_windows(stream_windows(spark, landing, delay="1 hour"), out, state)
    assert W.late_rows(query) == 1  # rows are counted as they reach the state: seven, combined to one in their task
    table = spark.createDataFrame(first + last, SCHEMA)
    assert found(read(spark, out, windows)) == found(W.event_windows(table, "ts", ["kind"], "1 hour", **per()))


def test_repeated_rows_count_once(spark, tmp_path):
    landing, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    data = rows(40)
    land(spark, landing, "a", data)
    land(spark, landing, "b", data[:20])
    windows = stream_windows(spark, landing, row_id="id")
    W.run_windows(windows, out, state)
    table = spark.createDataFrame(data, SCHEMA)
    assert found(read(spark, out, windows)) == found(W.event_windows(table, "ts", ["kind"], "1 hour", **per()))


def test_session_stream_equals_split_sessions(spark, tmp_path):
    from visitwise.operators import scans
    landing, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    data = rows(200)
    for k in range(2):
        land(spark, landing, f"f{k}", data[k::2])
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = W.event_stream(spark, f"{landing}/*", schema, "ts", "10 minutes")
    windows = W.session_windows(stream, "ts", ["kind"], "5 minutes", **per())
    assert windows.isStreaming
    batch = W.session_windows(spark.read.schema(schema).parquet(f"{landing}/*"), "ts", ["kind"], "5 minutes", **per())
    split = scans.sessions(spark.createDataFrame(data, SCHEMA), ["kind"], "ts", "id", 300, **per())
    cols = ["kind", "session_start", "session_end", "n", "total"]
    assert found(batch.select(cols)) == found(split.select(cols))
    # in append mode a session comes out once the watermark has passed its end
    schema_out = windows.schema
    W.run_windows(windows, out, state, mode="append")
    land(spark, landing, "end", [(10 ** 6, T0 + dt.timedelta(days=30), "end", 0)])
    W.run_windows(W.session_windows(W.event_stream(spark, f"{landing}/*", schema, "ts", "10 minutes"), "ts", ["kind"],
                                    "5 minutes", **per()), out, state, mode="append")
    got = spark.read.schema(schema_out).parquet(f"{out}/batch=*")
    got = got.withColumns({c: W.wall_clock(c) for c in ("session_start", "session_end")})
    assert found(got.select(cols)) == found(split.select(cols))
