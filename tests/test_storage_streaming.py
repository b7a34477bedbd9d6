"""Write dispositions and Structured Streaming lifecycle (restart, replay, idempotence)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from presslens.operators import upsert as UP
from presslens.streaming import jobs as J

T0 = dt.datetime(2024, 1, 1)
COLS = "seq long, source string, country_target string, title string, summary string, url string, " \
       "published_at timestamp_ntz, extracted_at timestamp_ntz"


def _rows(spark, rows):
    return spark.createDataFrame(rows, COLS)


def _r(seq, url, minutes, title="t"):
    return (seq, "s", "DE", title, None, url, None, T0 + dt.timedelta(minutes=minutes))


def test_merge_batch_wins_and_is_idempotent(spark):
    table = _rows(spark, [_r(1, "u1", 50, "old"), _r(2, "u2", 0)])
    # the batch wins even with an older extracted_at
    batch = _rows(spark, [_r(3, "u1", 5, "new"), _r(4, "u3", 5)])
    merged = UP.merge_latest(table, batch)
    once = sorted((r.url, r.title) for r in merged.collect())
    twice = sorted((r.url, r.title) for r in UP.merge_latest(merged, batch).collect())
    assert once == twice == [("u1", "new"), ("u2", "t"), ("u3", "t")]


def test_latest_snapshot_skips_staging(spark, tmp_dir):
    df = spark.createDataFrame([(1, "rss_raw_20240101"), (2, "rss_raw_20240102"), (3, "rss_raw_20240103_staging"),
                                (4, "other_20250101")], "id int, snapshot string")
    path = os.path.join(tmp_dir, "snaps")
    UP.write_snapshots(df, path)
    assert [r.id for r in UP.read_latest_snapshot(spark, path, "rss_raw").collect()] == [2]


def test_incremental_load_appends_only_new_rows(spark, tmp_dir):
    path = os.path.join(tmp_dir, "inc")
    allr = _rows(spark, [_r(i, f"u{i}", i) for i in range(10)])
    UP.incremental_load(spark, path, allr.filter("seq < 4"))
    UP.incremental_load(spark, path, allr)
    UP.incremental_load(spark, path, allr)  # nothing new the second time
    assert sorted(r.seq for r in spark.read.parquet(path).collect()) == list(range(10))


def test_stream_restart_processes_only_new_files(spark, tmp_dir):
    topic, ckpt, table = (os.path.join(tmp_dir, x) for x in ("topic", "ckpt", "table"))
    first = _rows(spark, [_r(i, f"u{i % 3}", i) for i in range(6)])
    second = _rows(spark, [_r(i, f"u{i % 3}", i) for i in range(6, 12)])
    J.publish(first, os.path.join(topic, "a"), files=2)

    def run_once():
        msgs = J.decode(J.read_messages(spark, topic + "/*", max_files=1)).drop("value", J.CORRUPT, "body")
        J.run(msgs, ckpt, path=table)

    run_once()
    assert spark.read.parquet(table).count() == 6
    J.publish(second, os.path.join(topic, "b"), files=2)
    run_once()  # same checkpoint: only the new files are read
    out = {r.url: r.seq for r in J.read_newest(spark, table, ["url"], ["extracted_at", "seq"]).collect()}
    assert out == {"u0": 9, "u1": 10, "u2": 11}
    raw = spark.read.parquet(table)
    assert raw.count() == 12  # every message landed exactly once


def test_quarantine_routes_bad_messages(spark, tmp_dir):
    topic, ckpt = os.path.join(tmp_dir, "topic"), os.path.join(tmp_dir, "ckpt")
    rows = _rows(spark, [_r(i, f"u{i}", i) for i in range(10)])
    J.publish(rows, topic, files=1, corrupt_when=F.col("seq") % 5 == 0)
    msgs = J.decode(J.read_messages(spark, topic))
    good, bad = os.path.join(tmp_dir, "good"), os.path.join(tmp_dir, "bad")
    J.run(msgs, ckpt, sink=J.quarantine_sink(good, bad))
    assert spark.read.parquet(good).count() == 8
    assert spark.read.parquet(bad).count() == 2


def test_absent_published_at_key_decodes_to_null(spark):
    raw = spark.createDataFrame([('{"url": "https://x/1", "extracted_at": "2024-01-01T00:00:00.000000"}',)],
                                "value string")
    r = J.decode(raw).first()
    assert r.url == "https://x/1" and r.published_at is None and r[J.CORRUPT] is None


def test_incremental_load_independent_of_session_zone(spark, tmp_dir):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        path = os.path.join(tmp_dir, "inc_tz")
        allr = _rows(spark, [_r(i, f"u{i}", i * 60) for i in range(10)])
        UP.incremental_load(spark, path, allr.filter("seq < 4"))
        UP.incremental_load(spark, path, allr)
        assert sorted(r.seq for r in spark.read.parquet(path).collect()) == list(range(10))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_newest_per_key_whatever_the_arrival_order(spark, tmp_dir):
    table = os.path.join(tmp_dir, "t")
    for rows in ([_r(3, "u1", 5), _r(2, "u2", 0)], [_r(1, "u1", 0)], [_r(4, "u2", 9), _r(5, "u3", 1)]):
        UP.append(_rows(spark, rows), table)
    out = {r.url: r.seq for r in J.read_newest(spark, table, ["url"], ["extracted_at", "seq"]).collect()}
    assert out == {"u1": 3, "u2": 4, "u3": 5}


def test_progress_listener_and_counters(spark, tmp_dir):
    topic, ckpt = os.path.join(tmp_dir, "topic"), os.path.join(tmp_dir, "ckpt")
    J.publish(_rows(spark, [_r(i, f"u{i}", i) for i in range(20)]), topic, files=4)
    rec = J.ProgressRecorder(spark)
    try:
        msgs = J.decode(J.read_messages(spark, topic, max_files=1)).drop("value", J.CORRUPT, "body")
        sink = J.counting_sink(J.versioned_sink(os.path.join(tmp_dir, "t")), os.path.join(tmp_dir, "p"))
        J.run(msgs, ckpt, sink=sink)
        import time
        deadline = time.time() + 30  # listener events are delivered asynchronously
        while sum(r["rows"] for r in rec.records) < 20 and time.time() < deadline:
            time.sleep(0.2)
    finally:
        rec.close()
    counters = spark.read.parquet(os.path.join(tmp_dir, "p"))
    assert counters.agg({"messages": "sum"}).first()[0] == 20
    assert counters.select("batch_id").distinct().count() == 4
    assert sum(r["rows"] for r in rec.records) == 20


def test_state_partitions_do_not_leak_into_the_session(spark, tmp_dir):
    topic = os.path.join(tmp_dir, "topic")
    J.publish(_rows(spark, [_r(i, f"u{i % 2}", i) for i in range(6)]), topic, files=1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    agg = J.decode(J.read_messages(spark, topic)).groupBy("url").count()
    J.run(agg, os.path.join(tmp_dir, "ckpt"), sink=J.versioned_sink(os.path.join(tmp_dir, "agg")),
          output_mode="update", state_partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    state = os.path.join(tmp_dir, "ckpt", "state", "0")
    assert len([d for d in os.listdir(state) if d.isdigit()]) == 3


def test_rocksdb_state_store_for_dedup(spark, tmp_dir):
    topic, ckpt, out = (os.path.join(tmp_dir, x) for x in ("topic", "ckpt", "out"))
    J.publish(_rows(spark, [_r(i, f"u{i % 4}", i) for i in range(12)]), topic, files=1)
    before = spark.conf.get(J.STATE_PROVIDER_KEY, None)
    msgs = J.with_event_time(J.decode(J.read_messages(spark, topic)))
    J.run(msgs.dropDuplicatesWithinWatermark(["url"]).select("url"), ckpt, path=out,
          state_partitions=2, state_store="rocksdb")
    assert spark.conf.get(J.STATE_PROVIDER_KEY, None) == before
    assert sorted(r.url for r in spark.read.parquet(out).collect()) == ["u0", "u1", "u2", "u3"]
    files = [f for _, _, fs in os.walk(os.path.join(ckpt, "state")) for f in fs]
    assert any(f.endswith(".zip") for f in files), files  # RocksDB snapshot files


def test_updates_of_a_replayed_batch_count_once(spark, tmp_dir):
    base = os.path.join(tmp_dir, "agg")
    sink = J.versioned_sink(base)
    sink(spark.createDataFrame([("DE", 1), ("US", 2)], "c string, n long"), 0)
    sink(spark.createDataFrame([("DE", 4)], "c string, n long"), 1)
    sink(spark.createDataFrame([("DE", 5)], "c string, n long"), 1)  # the same batch again
    sink(spark.createDataFrame([("US", 7), ("IT", 1)], "c string, n long"), 2)
    got = {r.c: r.n for r in J.read_updates(spark, base, ["c"]).collect()}
    assert got == {"DE": 5, "US": 7, "IT": 1}
    assert spark.read.parquet(base).count() == 5


def _three_months(spark, days):
    rows = [(i, f"u{i % 3}", d) for i, d in enumerate(days)]
    return spark.createDataFrame(rows, "seq long, url string, extracted_at string").withColumn(
        "extracted_at", F.col("extracted_at").cast("timestamp"))


def test_newest_row_wins_over_several_months(spark):
    first = _three_months(spark, ["2024-01-20", "2024-02-03", "2024-02-19"])
    second = _three_months(spark, ["2024-02-25", "2024-03-05", "2024-03-16"])
    got = {r.url: r.extracted_at.strftime("%m-%d") for r in UP.merge_latest(first, second).collect()}
    assert got == {"u0": "02-25", "u1": "03-05", "u2": "03-16"}


def test_incremental_load_keeps_late_rows(spark, tmp_dir):
    days = ["2024-01-20", "2024-02-03", "2024-02-19", "2024-03-05", "2024-01-02", "2024-03-30"]
    everything = _three_months(spark, days)
    path = f"{tmp_dir}/late"
    UP.incremental_load(spark, path, everything.filter("seq < 3"), key="seq")
    for _ in range(2):
        UP.incremental_load(spark, path, everything, key="seq")
    assert sorted(r.seq for r in spark.read.parquet(path).collect()) == list(range(6))


def test_unseen_keys_are_appended_once_and_later_columns_show(spark, tmp_dir):
    path = f"{tmp_dir}/clean"
    UP.append_unseen(spark, path, spark.createDataFrame([("u1", "a"), ("u2", "b")], "url string, title string"))
    later = spark.createDataFrame([("u2", "x", "de"), ("u3", "c", "fr")], "url string, title string, language string")
    for _ in range(2):  # the second run adds nothing
        table = UP.append_unseen(spark, path, later)
    got = sorted((r.url, r.title, r.language) for r in table.collect())
    assert got == [("u1", "a", None), ("u2", "b", None), ("u3", "c", "fr")]
