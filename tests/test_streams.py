import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tidewell.sources import folders
from tidewell.streaming import alerts, inbox


def run(stream, out, checkpoint):
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()


def feed(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")


@pytest.fixture
def provider(spark):
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    alerts.use_rocksdb(spark)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)


T0 = dt.datetime(2024, 5, 1, 8, 0)


def test_gap_stream_equals_batch(spark, provider, tmp_path):
    """Shuffled within the watermark, some rows twice, stopped and started again after every few files."""
    rnd, schema = random.Random(2), "extension long, call_id long, start timestamp, seconds long"
    rows, at = [], {1: T0, 2: T0}
    for k in range(60):
        e = rnd.choice([1, 2])
        at[e] += dt.timedelta(seconds=rnd.choice([10, 40, 200, 900]))
        rows.append((e, k, at[e], rnd.choice([0, 5, 30, None])))
    last = max(r[2] for r in rows)
    rows.sort(key=lambda r: r[2].timestamp() + rnd.uniform(0, 200))
    rows = [r for k in rows for r in ([k, k] if rnd.random() < 0.2 else [k])]
    closing = [(9, 1000 + k, last + dt.timedelta(hours=2 + k), 0) for k in range(2)]
    parts = [rows[k : k + 25] for k in range(0, len(rows), 25)] + [closing[:1], closing[1:]]
    out, check, src = (str(tmp_path / x) for x in ("out", "check", "src"))
    for k, part in enumerate(parts):
        feed(spark, src, f"p{k}", part, schema)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
        run(alerts.gap_alerts(stream, 1.0, "10 minutes"), out, check)
    got = sorted(tuple(r) for r in spark.read.parquet(out).filter("extension < 9").select("extension", "call_id", "gap_seconds").collect())
    want = sorted(tuple(r) for r in alerts.gap_alerts_batch(spark.createDataFrame(rows, schema), 1.0).select("extension", "call_id", "gap_seconds").collect())
    assert got == want and len(want) > 10


def test_logout_stream_equals_batch(spark, provider, tmp_path):
    rnd, schema = random.Random(3), "extension long, poll_id long, at timestamp, online boolean"
    rows = [(e, 100 * k + e, T0 + dt.timedelta(minutes=7 * k + e), rnd.choice([True, True, False, None])) for k in range(300) for e in (1, 2)]
    last = rows[-1][2]
    rows.sort(key=lambda r: r[2].timestamp() + rnd.uniform(0, 300))
    parts = [rows[:250], rows[250:500], rows[500:], [(9, 0, last + dt.timedelta(hours=2), True)], [(9, 1, last + dt.timedelta(hours=3), True)]]
    out, check, src = (str(tmp_path / x) for x in ("out", "check", "src"))
    for k, part in enumerate(parts):
        feed(spark, src, f"p{k}", part, schema)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
        run(alerts.logout_alerts(stream, ("08:00", "18:00")), out, check)
    shape = lambda df: sorted((r["extension"], r["day"], r["out_at"], str(r["back_at"])) for r in df.filter("extension < 9").collect())
    got, want = shape(spark.read.parquet(out)), shape(alerts.logout_alerts_batch(spark.createDataFrame(rows, schema), ("08:00", "18:00")))
    assert got == want and len(want) > 20


def test_inbox_appends_once(spark, tmp_path):
    src, log, check, bad = (str(tmp_path / x) for x in ("in", "log", "check", "bad"))
    (tmp_path / "in").mkdir()
    put = lambda name, text: (tmp_path / "in" / name).write_text(text)
    go = lambda: inbox.append_once(inbox.inbox_stream(spark, src, "call_id string, text string"), log, check, lambda df: df.select("call_id", F.length("text").alias("n"), "file"), bad).awaitTermination()
    put("a.json", json.dumps({"call_id": "1", "text": "hello"}))
    put("b.json", '{"call_id": "2", "te')
    go()
    go()
    put("c.json", json.dumps({"call_id": "1", "text": "again"}, indent=1))
    go()
    assert sorted((r["call_id"], r["n"], r["file"]) for r in inbox.read_log(spark, log).collect()) == [("1", 5, "a.json"), ("1", 5, "c.json")]
    assert [(r["call_id"], r["file"]) for r in inbox.read_log(spark, log, "call_id").collect()] == [("1", "a.json")]
    assert [r["file"] for r in spark.read.parquet(bad).collect()] == ["b.json"]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    """The batch's rows were written, but not the commit: it comes again under its number."""
    src, log, check = (str(tmp_path / x) for x in ("in", "log", "check"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps({"call_id": "1"}))
    tries = []

    def flaky(df):
        tries.append(1)
        if len(tries) == 1:
            df.drop("_bad").write.mode("overwrite").parquet(f"{log}/batch=0")
            raise RuntimeError("lost")
        return df

    for _ in range(2):
        query = inbox.append_once(inbox.inbox_stream(spark, src, "call_id string"), log, check, flaky)
        try:
            query.awaitTermination()
        except Exception as e:  # the first try
            assert "lost" in str(e)
    assert len(tries) == 2 and inbox.read_log(spark, log).count() == 1


def test_result_folders_and_resume(spark, tmp_path):
    import gzip

    for folder in ("now", "before"):
        (tmp_path / folder).mkdir()
    put = lambda where, what: (tmp_path / where).write_text(what if isinstance(what, str) else json.dumps(what))
    put("now/r1.json", {"v": "new"})
    put("now/r2.json", '{"v": "half')
    put("now/x.json", {"v": "no row"})
    put("before/r1.json", {"v": "old"})
    put("before/r2.json", {"v": "older"})
    (tmp_path / "before" / "r3.json.gz").write_bytes(gzip.compress(b'{"v": "zipped"}'))
    got = folders.read_results(spark, [str(tmp_path / f) for f in ("now", "gone", "before")], "v string")
    assert sorted((r["key"], r["source"], r["v"]) for r in got.collect()) == [("r1", 0, "new"), ("r2", 2, "older"), ("r3", 2, "zipped")]
    assert folders.read_results(spark, [str(tmp_path / "gone")], "v string").count() == 0
    (tmp_path / "done.jsonl").write_text('{"key": "a"}\n{"key": "b"}\nnoise\n{"key": "c')
    done = folders.read_json_lines(spark, str(tmp_path / "done.jsonl"), "key string")
    assert done.count() == 2 and folders.read_json_lines(spark, str(tmp_path / "none.jsonl"), "key string").count() == 0
    work = spark.createDataFrame([(k,) for k in "abcdefgh"], "key string")
    shares = [{r["key"] for r in folders.left_to_do(work, done, "key", k, 3).collect()} for k in range(3)]
    assert set.union(*shares) == set("cdefgh") and sum(map(len, shares)) == 6
