"""Streams end in the state of the batch; only a watermark drops rows that come too late."""

import datetime as dt
import random

import pytest
from conftest import rows

from laurel.streaming import weekly

SCHEMA = "id int, ts timestamp, k string, v int"


def at(text):
    return dt.datetime.fromisoformat(text)


def test_weekly_totals_drop_late_rows(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def arrive(*data):
        spark.createDataFrame(list(data), SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = weekly.read_new_files(spark, source, SCHEMA)
        return weekly.keep_updates(weekly.weekly_totals(stream, "ts", ["k"], "v", delay="1 day"), target, checkpoint)

    assert arrive((1, at("2024-01-01 00:00"), "a", 1), (2, at("2024-01-07 23:59"), "a", 2)) == 0
    assert arrive((3, at("2024-01-20 12:00"), "a", 4)) == 0
    # The watermark stands at 2024-01-19, so the first week is closed.
    assert arrive((4, at("2024-01-03 12:00"), "a", 100), (5, at("2024-01-19 13:00"), "a", 8)) == 1
    got = weekly.latest(spark, target, ["week_start", "k"])
    assert rows(got, "week_start", "total") == [(dt.date(2024, 1, 1), 3), (dt.date(2024, 1, 15), 12)]


def test_added_weekly_totals_take_a_backlog_in_any_order(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    days = [5, 33, 1, 20, 6, 34]
    for i, day in enumerate(days):
        data = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(days=day - 1), "a", 10**i)]
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    # One file is one batch.
    stream = weekly.read_new_files(spark, source, SCHEMA, files_per_batch=1)
    weekly.add_weekly_totals(stream, "ts", ["k"], "v", target, checkpoint)
    got = weekly.summed_totals(spark, target, ["k"])
    assert rows(got, "week_start", "rows", "total") == [
        (dt.date(2024, 1, 1), 3, 10101), (dt.date(2024, 1, 15), 1, 1000), (dt.date(2024, 1, 29), 2, 100010),
    ]


def test_ingest_reads_each_file_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for i in range(3):
        spark.createDataFrame([(i, at("2024-01-01"), "a", i)], SCHEMA).write.mode("append").parquet(source)
        weekly.ingest(weekly.read_new_files(spark, source, SCHEMA), target, checkpoint)
    assert rows(spark.read.parquet(target), "id") == [(0,), (1,), (2,)]


def test_prior_sums_carry_over_batches(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    batches = [[(1, "a", 1), (2, "b", 5), (3, "a", 2)], [(4, "a", 3), (5, "c", 9)], [(6, "b", 1), (7, "a", 1)]]
    for batch in batches:
        data = [(i, at(f"2024-01-0{i}"), k, v) for i, k, v in batch]
        spark.createDataFrame(data, SCHEMA).write.mode("append").parquet(source)
        stream = weekly.read_new_files(spark, source, SCHEMA)
        weekly.prior_sums(stream, ["k"], ["ts", "id"], "v", target, checkpoint)
    got = weekly.running_rows(spark, target)
    assert rows(got, "id", "prior_sum") == [(1, 0), (2, 0), (3, 1), (4, 3), (5, 0), (6, 5), (7, 6)]
    # Nothing came late, so no key was written twice.
    assert spark.read.parquet(f"{target}/rows").count() == 7


@pytest.mark.parametrize("most_folders", [16, 2])
def test_prior_sums_correct_late_rows(spark, tmp_path, most_folders):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    rng = random.Random(5)
    data = [(i, at("2024-01-01") + dt.timedelta(hours=rng.randint(0, 40)), rng.choice(["a", "b", "c", None]), rng.randint(1, 9)) for i in range(40)]
    for start in range(0, 40, 8):
        spark.createDataFrame(data[start : start + 8], SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = weekly.read_new_files(spark, source, SCHEMA)
        weekly.prior_sums(stream, ["k"], ["ts", "id"], "v", target, checkpoint, buckets=3, most_folders=most_folders)
    expected = [(i, sum(w for j, u, l, w in data if l == k and (u, j) < (ts, i))) for i, ts, k, _ in data]
    assert sorted(rows(weekly.running_rows(spark, target), "id", "prior_sum")) == expected


def test_prior_sums_of_thirty_batches_read_the_late_bucket_only(spark, tmp_path, monkeypatch):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    data = [(i, at("2024-01-01") + dt.timedelta(hours=i), f"k{i % 5}", i % 7 + 1) for i in range(60)]
    # The row of batch 20 comes before all others of its key.
    data[41] = (41, at("2023-12-01"), data[41][2], 5)
    for start in range(0, 60, 2):
        # Files are taken up in the order of their times.
        path = spark.createDataFrame(data[start : start + 2], SCHEMA).coalesce(1)
        path.write.mode("append").parquet(source)
    read = []
    whole = weekly._stored_folders
    monkeypatch.setattr(weekly, "_stored_folders", lambda s, t, kind, folders: read.append((kind, list(folders))) or whole(s, t, kind, folders))
    stream = weekly.read_new_files(spark, source, SCHEMA, files_per_batch=1)
    weekly.prior_sums(stream, ["k"], ["ts", "id"], "v", target, checkpoint, buckets=4, most_folders=100)
    late = [folders for kind, folders in read if kind == "rows"]
    assert len(late) == 1 and len({f.rpartition("=")[2] for f in late[0]}) == 1
    expected = sorted((i, sum(w for j, u, l, w in data if l == k and (u, j) < (ts, i))) for i, ts, k, _ in data)
    assert sorted(rows(weekly.running_rows(spark, target), "id", "prior_sum")) == expected
    # Of the states of each bucket the newest is left, and what the last batch replaced.
    import glob

    states = [f.rpartition("=")[2] for f in glob.glob(f"{target}/state/batch=*/_bucket=*")]
    assert all(states.count(b) <= 2 for b in states)
    assert len(glob.glob(f"{target}/index/batch=*")) == 2


def test_prior_sums_keep_their_buckets(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for buckets in (4, 5):
        spark.createDataFrame([(1, at("2024-01-01"), "a", 1)], SCHEMA).write.mode("append").parquet(source)
        stream = weekly.read_new_files(spark, source, SCHEMA)
        if buckets == 4:
            weekly.prior_sums(stream, ["k"], ["ts", "id"], "v", target, checkpoint, buckets=buckets)
        else:
            with pytest.raises(Exception, match="4 buckets, not 5"):
                weekly.prior_sums(stream, ["k"], ["ts", "id"], "v", target, checkpoint, buckets=buckets)
