"""Streams with late, repeated and equal rows; a repeated micro-batch; a table that was there before."""

import datetime as dt

import pytest

from conftest import rows
from tallyhouse.sinks import tables
from tallyhouse.streaming.ingest import ingest_new, ingest_newer

DDL = "org string, id int, v string, t timestamp"
T0 = dt.datetime(2024, 1, 1)


def make(spark, *data):
    return spark.createDataFrame([(o, i, v, None if d is None else T0 + dt.timedelta(days=d)) for o, i, v, d in data], DDL)


def feed(spark, landing, *data):
    make(spark, *data).coalesce(1).write.mode("append").parquet(landing)
    return spark.readStream.schema(DDL).parquet(landing)


@pytest.mark.parametrize("seen", [True, False])
def test_newer_rows_by_state(spark, tmp_path, seen):
    landing, path, mark = (str(tmp_path / x) for x in ("in", "out", "ck"))
    tables.append_rows(make(spark, ("007", 1, "stored", 3), ("007", 1, "older", 1), (None, 5, "stored", 3)), path, ["org"])

    def run(*data):
        ingest_newer(feed(spark, landing, *data), path, ["org", "id"], "t", mark, include_unseen=seen,
                     available_now=True).awaitTermination()
        return [(r[0], r[1]) for r in rows(tables.read_table(spark, path), "v", "org")]

    first = run(("007", 1, "late", 2), ("007", 1, "new", 4), ("007", 1, "new", 4), ("007", 1, "newer", 5), ("7", 1, "unseen", 0),
                (None, 5, "null org", 4), ("7", 2, "no time", None), ("007", 1, "also no time", None))
    old = [("older", "007"), ("stored", "007"), ("stored", None)]
    want = [*old, ("new", "007"), ("newer", "007"), ("null org", None)] + ([("unseen", "7"), ("no time", "7")] if seen else [])
    assert sorted(first, key=str) == sorted(want, key=str)
    # The state knows what was appended: late and repeated rows of the next batch stay out.
    second = run(("007", 1, "between", 4), ("007", 1, "newer", 5), ("007", 1, "newest", 6), ("7", 1, "unseen", 0), ("7", 1, "after", 1))
    want += [("newest", "007")] + ([("after", "7")] if seen else [])
    assert sorted(second, key=str) == sorted(want, key=str)
    assert sorted(run(), key=str) == sorted(want, key=str)


def test_a_repeated_micro_batch_adds_nothing(spark, tmp_path):
    landing, path, mark = (str(tmp_path / x) for x in ("in", "out", "ck"))
    ingest_newer(feed(spark, landing, ("a", 1, "x", 0), ("a", 2, "y", 0)), path, ["id"], "t", mark, available_now=True).awaitTermination()
    # The driver was lost after the append and before the stream noted it.
    for left_over in (tmp_path / "ck" / "commits").iterdir():
        left_over.unlink()
    (tmp_path / "ck" / "appends" / "0.ended").unlink()
    (tmp_path / "ck" / "appends" / ".0.ended.crc").unlink(missing_ok=True)
    ingest_newer(feed(spark, landing, ("a", 1, "z", 1)), path, ["id"], "t", mark, available_now=True).awaitTermination()
    assert rows(spark.read.parquet(path), "id", "v") == [(1, "x"), (1, "z"), (2, "y")]


def test_new_keys_keep_the_last_row(spark, tmp_path):
    landing, path, mark = (str(tmp_path / x) for x in ("in", "out", "ck"))
    ingest_new(feed(spark, landing, ("a", 1, "x", 1), ("a", 1, "w", 2), ("a", 1, "v", 2), ("b", 2, "y", 0)), path, ["id"], mark,
               order_by=["t"], available_now=True).awaitTermination()
    ingest_new(feed(spark, landing, ("a", 1, "late", 9), ("c", 3, "z", 0)), path, ["id"], mark, order_by=["t"],
               available_now=True).awaitTermination()
    assert rows(spark.read.parquet(path), "id", "v") == [(1, "w"), (2, "y"), (3, "z")]
