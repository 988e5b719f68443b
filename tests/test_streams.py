"""The stateful stream and the ledgered sink: restarts, replays, batches that failed half-way."""

import json

import pytest
from pyspark.sql import functions as F

from newslode.streaming import audit, breaker, ledger

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, ROCKS)
    yield spark
    spark.conf.set(key, before)


def run(spark, tmp_path):
    rows = spark.readStream.schema("host string, ts timestamp, status int").option("maxFilesPerTrigger", 1).json(f"file://{tmp_path}/in")
    q = breaker.circuit_breaker(rows, quiet_hours=5).writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/c").start()
    q.processAllAvailable()
    q.stop()


def put(tmp_path, name, rows):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / f"{name}.json").write_text("\n".join(json.dumps({"host": h, "ts": f"2026-04-07T{t}Z", "status": s}) for h, t, s in rows))


def test_breaker_over_restarts(rocks, tmp_path):
    """A pause is held over a restart, refuses what comes in it, ends by its timer alone; other failures count without a pause; quiet hosts are forgotten."""
    put(tmp_path, "a", [("h", "10:00:00", 403), ("h", "10:01:00", 200), ("g", "10:00:30", 500), (None, "10:00:00", 403), ("z", "10:00:00", 429)])
    run(rocks, tmp_path)
    put(tmp_path, "b", [("g", "10:10:00", 403)])  # only time passes for h and z
    run(rocks, tmp_path)
    put(tmp_path, "c", [("h", "10:12:00", 429), ("h", "10:15:00", 200), ("h", "10:17:00", 200), ("g", "10:13:00", 200)])
    run(rocks, tmp_path)
    put(tmp_path, "d", [("g", "17:00:00", 200)])
    run(rocks, tmp_path)
    put(tmp_path, "e", [("z", "17:30:00", 401)])
    run(rocks, tmp_path)
    out = rocks.read.parquet(f"file://{tmp_path}/out").select("host", F.date_format("ts", "HH:mm:ss").alias("t"), "status", "failures", F.date_format("blocked_until", "HH:mm").alias("until"), "kind")
    got = sorted((tuple(r) for r in out.collect()), key=str)
    want = [
        ("h", "10:00:00", 403, 1, "10:02", "allowed"), ("h", "10:01:00", 200, 1, "10:02", "refused"), ("h", "10:02:00", None, 1, None, "reopened"), ("h", "10:12:00", 429, 2, "10:16", "allowed"), ("h", "10:15:00", 200, 2, "10:16", "refused"), ("h", "10:17:00", 200, 0, None, "allowed"),
        ("g", "10:00:30", 500, 1, None, "allowed"), ("g", "10:10:00", 403, 2, "10:14", "allowed"), ("g", "10:13:00", 200, 2, "10:14", "refused"), ("g", "10:14:00", None, 2, None, "reopened"), ("g", "17:00:00", 200, 0, None, "allowed"),
        ("z", "10:00:00", 429, 1, "10:02", "allowed"), ("z", "10:02:00", None, 1, None, "reopened"), ("z", "17:30:00", 401, 1, "17:32", "allowed"),
    ]
    assert got == sorted(want, key=str)


def test_pause_grows_to_its_limit():
    failures, until = 0, 0
    for n in range(1, 14):
        failures, until = breaker.step(failures, 429, 1000)
        assert (failures, until) == (n, 1000 + 60_000 * min(20, 2 * n))
    assert breaker.step(3, 500, 1000) == (4, 0) and breaker.step(3, 302, 1000) == (0, 0)


def test_replayed_and_broken_batches(spark, tmp_path):
    path = f"file://{tmp_path}/sink"
    batch = lambda *rows: spark.createDataFrame(rows, "UniqueKey string, n int")
    keys = lambda: sorted(tuple(r) for r in ledger.rows(spark, path).collect())
    write = ledger.ledgered_sink(path, buckets=4)
    assert ledger.rows(spark, path) is None
    write(batch(("a", 1), ("b", 2), ("b", 2)), 0)
    assert keys() == [("a", 1), ("b", 2)]
    write(batch(("a", 1), ("b", 2)), 0)  # the same batch again
    write(batch(("a", 9), ("z", 9)), 0)  # and with other rows: its number is in the ledger
    write(batch(("b", 7), ("c", 3)), 1)
    assert keys() == [("a", 1), ("b", 2), ("c", 3)]
    # batch 2 wrote some of its rows and died
    half = batch(("d", 4)).withColumn(ledger.BUCKET, F.pmod(F.xxhash64("UniqueKey"), F.lit(4)).cast("int")).withColumn(ledger.BATCH, F.lit(2).cast("long"))
    half.write.mode("append").partitionBy(ledger.BUCKET, ledger.BATCH).parquet(f"{path}/rows")
    assert keys() == [("a", 1), ("b", 2), ("c", 3)]
    write(batch(("d", 4), ("a", 5), ("e", 5)), 2)
    assert keys() == [("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 5)]
    write(batch().limit(0), 3)
    assert sorted(r[0] for r in ledger.batches(spark, path).collect()) == [0, 1, 2, 3]


def test_stream_replay(spark, tmp_path):
    log, path = tmp_path / "log", f"file://{tmp_path}/out"
    log.mkdir()
    (log / "a.json").write_text('{"stage":"run_started","ts":"2026-04-07T01:00:00Z","unique_key":"k"}\n{"stage":"unknown","ts":"2026-04-07T02:00:00Z","unique_key":"k"}\n')
    for _ in range(2):
        q = audit.dedup_stream(audit.replay(spark, f"file://{log}").where("ts is not null"), "unique_key").select("stage", F.col("unique_key").alias("UniqueKey")).writeStream.foreachBatch(ledger.ledgered_sink(path)).option("checkpointLocation", f"file://{tmp_path}/c").start()
        q.processAllAvailable()
        q.stop()
        (log / "b.json").write_text('{"stage":"run_finished","ts":"2026-04-07T03:00:00Z","unique_key":"k"}\n{"stage":"run_finished","ts":"2026-04-07T03:00:00Z","unique_key":"l"}\n')
    assert sorted(r.UniqueKey for r in ledger.rows(spark, path).collect()) == ["k", "l"]
