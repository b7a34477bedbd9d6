"""Streams: restart and replay, idle exit, progress, watermark dedup, sightings, heat and rate, in several groupings of files."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from presslens.plans import streams as ST
from presslens.streaming import jobs as J

SMOKE = "/root/testdata/sf0.001"
BEGIN = dt.datetime(2024, 1, 1)


def table(spark, rows):
    """rows: (seq, url, hours after BEGIN, source, country)."""
    data = [(seq, source, country, f"t{seq}", None, url, None, BEGIN + dt.timedelta(hours=hours)) for seq, url, hours, source, country in rows]
    return spark.createDataFrame(
        data, "seq long, source string, country_target string, title string, summary string, url string, published_at timestamp_ntz, extracted_at timestamp_ntz")


def test_files_hold_at_most_so_many_messages(spark, tmp_dir):
    J.publish(table(spark, [(i, f"u{i}", i, "s", "DE") for i in range(1200)]), f"{tmp_dir}/topic", files=1, rows_per_file=500)
    sizes = [r["count"] for r in spark.read.text(f"{tmp_dir}/topic").groupBy(F.input_file_name()).count().collect()]
    assert sorted(sizes) == [200, 500, 500]
    batches = []
    msgs = J.decode(J.read_messages(spark, f"{tmp_dir}/topic", 1))
    J.run(msgs, f"{tmp_dir}/ckpt", sink=lambda batch, i: batches.append(batch.count()))
    assert sorted(batches) == [200, 500, 500]


def test_a_topic_takes_few_micro_batches(spark, tmp_dir):
    rows = spark.range(60_000).select(
        F.col("id").alias("seq"), F.concat(F.lit("u"), "id").alias("url"), F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, id)").alias("extracted_at"))
    J.publish(rows, f"{tmp_dir}/topic", files=2)
    batches = []
    msgs = J.decode(J.read_messages(spark, f"{tmp_dir}/topic", ST.MAX_FILES))
    J.run(msgs, f"{tmp_dir}/ckpt", sink=lambda batch, i: batches.append(batch.count()))
    assert batches == [60_000]


def test_any_format_by_its_options(spark, tmp_dir):
    stream = J.read_messages(spark, fmt="rate", options={"rowsPerSecond": "5"})
    assert stream.isStreaming and stream.columns == ["value"] and dict(stream.dtypes)["value"] == "string"
    with pytest.raises(Exception, match="(?i)kafka"):
        J.read_messages(spark, fmt="kafka", options={"subscribe": "t", "kafka.bootstrap.servers": "x:1"})


def test_restart_reads_the_rest_and_replay_reads_everything(spark):
    got = {r.run: (r.messages, r.urls) for r in ST.q_stream_replay(spark, SMOKE).collect()}
    n = spark.read.parquet(f"{SMOKE}/events.parquet").count()
    assert got["first"][0] + got["restart"][0] == got["replay"][0] == n and got["restart"][0] > 0


def test_a_replayed_batch_lands_once(spark, tmp_dir):
    """A consumer that dies after it wrote a batch and before it noted so writes that batch again."""
    J.publish(table(spark, [(i, f"u{i}", i, "s", "DE") for i in range(6)]), f"{tmp_dir}/topic", files=1, rows_per_file=2)
    write, died = J.versioned_sink(f"{tmp_dir}/out"), []

    def dying(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 1 and not died:
            died.append(batch_id)
            raise RuntimeError("lost")

    def consume():
        J.run(J.decode(J.read_messages(spark, f"{tmp_dir}/topic", 1)).drop("value"), f"{tmp_dir}/ckpt", sink=dying)

    with pytest.raises(Exception, match="lost"):
        consume()
    consume()
    assert sorted(r.seq for r in spark.read.parquet(f"{tmp_dir}/out").collect()) == list(range(6))


def test_stops_when_idle(spark, tmp_dir):
    topic = f"{tmp_dir}/topic"
    os.makedirs(topic)
    J.publish(table(spark, [(i, f"u{i}", i, "s", "DE") for i in range(4)]), topic, files=2)
    started = time.monotonic()
    q = J.run(J.decode(J.read_messages(spark, topic, 1)).drop("value"), f"{tmp_dir}/ckpt", path=f"{tmp_dir}/out",
              available_now=False, processing_time="300 milliseconds", idle_seconds=2)
    assert not q.isActive and 2 <= time.monotonic() - started < 90
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 4


def test_progress_by_country_total_and_rate(spark, tmp_dir):
    rows = [(i, f"u{i}", i, "s", ["DE", "US", None][i % 3]) for i in range(9)]
    J.publish(table(spark, rows), f"{tmp_dir}/topic", files=1, rows_per_file=2)
    msgs = J.decode(J.read_messages(spark, f"{tmp_dir}/topic", 1)).drop("value")
    J.run(msgs, f"{tmp_dir}/ckpt", sink=J.counting_sink(J.versioned_sink(f"{tmp_dir}/t"), f"{tmp_dir}/p"))
    got = J.progress(spark.read.parquet(f"{tmp_dir}/p")).collect()
    assert {(r.country_target, r.messages, r.total) for r in got} == {("DE", 3, 9), ("US", 3, 9), ("?", 3, 9)}
    assert all(r.rate > 0 for r in got)


def dedup(spark, base, stretches, window, files):
    for rows in stretches:
        J.publish(table(spark, rows), f"{base}/topic", files=1, rows_per_file=2)
        time.sleep(1.1)  # files are read in order of their time
    return sorted(r.seq for r in ST.dedup_within(spark, base, window, files).collect())


def test_watermark_dedup_forgets_and_drops_late_messages(spark, tmp_dir):
    stretches = [
        [(0, "a", 0, "s", "DE"), (1, "b", 1, "s", "DE")],
        [(2, "a", 2, "s", "DE"), (3, "c", 3, "s", "DE")],  # a again, within the window
        [(4, "d", 40, "s", "DE"), (5, "e", 41, "s", "DE")],  # moves the watermark past a and b
        [(8, "d", 42, "s", "DE"), (9, "g", 43, "s", "DE")],  # the new watermark takes effect
        [(6, "a", 44, "s", "DE"), (7, "f", 5, "s", "DE")],  # a after it was forgotten; f is late
    ]
    # five micro-batches
    assert dedup(spark, f"{tmp_dir}/x", stretches, "10 hours", 1) == [0, 1, 3, 4, 5, 6, 9]


def test_watermark_dedup_of_the_events_in_any_grouping(spark, monkeypatch):
    results = []
    for files in (1, 2, 8):
        monkeypatch.setattr(ST, "MAX_FILES", files)
        results.append(sorted(map(tuple, ST.q_stream_dedup_window(spark, SMOKE).collect())))
    assert results[0] == results[1] == results[2] and {n for _, n in results[0]} == {1}


def test_sightings_heat_and_rate_in_any_grouping(spark, monkeypatch):
    queries = (ST.q_stream_sightings, ST.q_stream_country_totals, ST.q_stream_arrival_rate)
    results = []
    for files in (1, 2, 8):
        monkeypatch.setattr(ST, "MAX_FILES", files)
        results.append([sorted(map(tuple, q(spark, SMOKE).collect())) for q in queries])
    assert results[0] == results[1] == results[2]


def test_announcements(spark):
    day = dt.timedelta(days=1)
    seen = [("old", BEGIN), ("old2", BEGIN + day / 2)] + [(f"s{i}", BEGIN + day + day / 10 * (9 - i)) for i in range(8)] + [("z", BEGIN + 3 * day)]
    got = [tuple(r) for r in ST.announcements(spark.createDataFrame(seen, "source string, first_seen timestamp_ntz")).orderBy("refresh", "position").collect()]
    first, last = (BEGIN + day).date(), (BEGIN + 3 * day).date()
    assert got == [(first, i + 1, f"s{i}") for i in range(6)] + [(last, 1, "z")]


def test_heat_and_rate_of_the_last_minute(spark):
    at = lambda s: BEGIN + dt.timedelta(seconds=s)
    seconds = spark.createDataFrame(
        [("DE", at(0), 5, at(0.5)), ("DE", at(60), 2, at(60)), ("US", at(119), 3, at(119)), (None, at(120), 4, at(120.5)), ("IT", at(10), 1, at(10))],
        "country_target string, sec timestamp_ntz, n long, latest timestamp_ntz")
    heat = {r.country_target: (r.articles, r.recent) for r in ST.country_heat(seconds).collect()}
    assert heat == {"DE": (7, 0), "US": (3, 3), "IT": (1, 0)}
    rate = ST.arrival_rate(seconds.groupBy("sec").agg(F.sum("n").alias("n"))).first()
    assert (rate.arrivals, rate.seconds, rate.rate) == (9, 3, 3.0)
    assert ST.arrival_rate(seconds.filter("n > 9").select("sec", "n")).count() == 0
