"""Streaming counts against counts over all pages at once."""

import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from conftest import rows

from passagecraft.streaming.counts import stream_counts, window_counts

rng = random.Random(8)
DAY = datetime(2024, 3, 1, tzinfo=timezone.utc)
HOUR = timedelta(hours=1)


@pytest.fixture
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def land(spark, folder, pages, hour):
    frame = spark.createDataFrame([(u, t, DAY + hour * HOUR) for u, t in pages], "url string, fetched timestamp, landed timestamp")
    frame.write.mode("append").partitionBy("landed").parquet(f"{folder}/landed")


def batch(landings, delay=2):
    n, late, newest = Counter(), Counter(), max(min(t, DAY + h * HOUR) for pages, h in landings for _, t in pages if t)
    for pages, hour in landings:
        for url, t in pages:
            if t is None:
                continue
            t = min(t, DAY + hour * HOUR)
            start = t.replace(minute=0, second=0)
            host = url.split("/")[2] if url else ""
            (late if start + (1 + delay) * HOUR <= DAY + hour * HOUR else n)[host, start] += 1
    closed = {k: v for k, v in n.items() if k[1] + HOUR <= newest - delay * HOUR}
    return sorted((h, s.replace(tzinfo=None), closed.get((h, s), 0), late[h, s]) for h, s in {*closed, *late})


def test_landings_late_pages_and_restarts(spark, tmp_path, few_partitions):
    """Pages up to nine hours late, one host with most pages, and clocks that are ahead."""
    landings = []
    for hour in (3, 6, 12, 13):
        times = [DAY + (hour - rng.choice([0.2, 0.8, 1.5, 2.5, 3.5, 9])) * HOUR for _ in range(150)]
        pages = [(f"http://h{rng.choice([0] * 9 + [1, 2])}.org/x", t.replace(microsecond=0)) for t in times]
        landings.append((pages + [(None, DAY + hour * HOUR), ("http://ahead.org/", DAY + 90 * HOUR), ("http://never.org/", None)], hour))
    for i, (pages, hour) in enumerate(landings):
        land(spark, tmp_path, pages, hour)
        for _ in range(2 if i == 1 else 1):
            stream_counts(spark, f"{tmp_path}/landed", f"{tmp_path}/out", f"{tmp_path}/state", landed="landed")
        got = [tuple(r) for r in rows(window_counts(spark, f"{tmp_path}/out"), "host", "start", "n", "n_late")]
        assert got == batch(landings[: i + 1])
    assert sum(r[3] for r in got) > 50 and sum(r[2] for r in got) > 100


def test_file_times_and_empty_folders(spark, tmp_path, few_partitions):
    """Without a landing column a page lands with its file, so what was fetched years ago is late."""
    pages = spark.createDataFrame([("http://a.org", datetime(2020, 1, 1, 5)), ("http://a.org", datetime(2020, 1, 1, 5, 30))], "url string, fetched timestamp")
    pages.limit(0).write.parquet(f"{tmp_path}/landed")
    stream_counts(spark, f"{tmp_path}/landed", f"{tmp_path}/out", f"{tmp_path}/state")
    pages.write.mode("append").parquet(f"{tmp_path}/landed")
    stream_counts(spark, f"{tmp_path}/landed", f"{tmp_path}/out", f"{tmp_path}/state")
    assert rows(window_counts(spark, f"{tmp_path}/out"), "host", "n", "n_late") == [("a.org", 0, 2)]
