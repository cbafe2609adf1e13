import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from tallyhouse.sinks import incremental as inc
from tallyhouse.sinks import tables
from tallyhouse.streaming.ingest import ingest_new

DDL = "org string, id int, v string, t timestamp"
T0 = dt.datetime(2024, 1, 1)


def make(spark, *data):
    return spark.createDataFrame([(o, i, v, T0 + dt.timedelta(days=d)) for o, i, v, d in data], DDL)


def stored(spark, path):
    return rows(spark.read.parquet(path), "org", "id", "v")


def test_append_new_and_newer(spark, tmp_path, caplog):
    path = str(tmp_path / "t")
    tables.append_new(make(spark, ("a", 1, "x", 0)), path, ["id"])
    with caplog.at_level("INFO", logger="tallyhouse"):
        tables.append_new(make(spark, ("a", 1, "y", 1), ("a", 2, "z", 1)), path, ["id"])
    assert "dropped 1 rows" in caplog.text
    assert stored(spark, path) == [("a", 1, "x"), ("a", 2, "z")]
    batch = make(spark, ("a", 1, "n", 5), ("a", 2, "old", 0), ("a", 3, "new", 0))
    known = inc.newer_rows(batch, spark.read.parquet(path), ["id"], "t", include_unseen=False)
    assert rows(known, "id", "v") == [(1, "n")]
    tables.append_newer(batch, path, ["id"], "t")
    assert stored(spark, path) == [("a", 1, "n"), ("a", 1, "x"), ("a", 2, "z"), ("a", 3, "new")]


def test_dimension(spark, tmp_path):
    path = str(tmp_path / "d")
    one = spark.createDataFrame([("k",)], "brand string")
    two = spark.createDataFrame([("k",), ("m",)], "brand string")
    tables.append_dimension(one, path, "brand", F.lit("2024-01-01").cast("date"))
    tables.append_dimension(two, path, "brand", F.lit("2024-01-02").cast("date"))
    assert rows(spark.read.parquet(path), "brand", "date_added") == [
        ("k", dt.date(2024, 1, 1)), ("m", dt.date(2024, 1, 2))]


def test_replace_upsert_update_drop(spark, tmp_path):
    path = str(tmp_path / "p")
    tables.append_rows(make(spark, ("a", 1, "x", 0), ("b", 2, "y", 0), ("c", 3, "z", 0)), path,
                       ["org"])
    tables.replace_partition(make(spark, ("a", 9, "new", 0)), path, "org")
    assert stored(spark, path) == [("a", 9, "new"), ("b", 2, "y"), ("c", 3, "z")]
    # Key 2 moves from b to a, which empties b.
    tables.upsert_by_key(make(spark, ("a", 2, "moved", 0), ("d", 4, "w", 0)), path, ["id"], "org")
    assert stored(spark, path) == [("a", 2, "moved"), ("a", 9, "new"), ("c", 3, "z"),
                                   ("d", 4, "w")]
    source = spark.createDataFrame([(9, None), (3, "z"), (5, "q")], "id int, v string")
    tables.update_from(source, path, "id", ["v"], "org")
    assert stored(spark, path) == [("a", 2, "moved"), ("a", 9, None), ("c", 3, "z"),
                                   ("d", 4, "w")]
    tables.drop_inactive(spark.createDataFrame([("a",), ("d",)], "org string"), path, "org")
    assert stored(spark, path) == [("a", 2, "moved"), ("a", 9, None), ("d", 4, "w")]


def test_stream_appends_each_key_once(spark, tmp_path):
    landing, path = str(tmp_path / "in"), str(tmp_path / "out")
    for n in range(2):
        make(spark, ("a", 1, "x", 0), ("a", 2 + n, "y", 0)).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(DDL).parquet(landing)
        ingest_new(stream, path, ["id"], str(tmp_path / "ck"), available_now=True).awaitTermination()
    assert rows(spark.read.parquet(path), "id") == [(1,), (2,), (3,)]


def parts(spark, path):
    return rows(tables.read_table(spark, path), "id", "v", "org")


def test_null_typed_and_escaped_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    table = spark.createDataFrame([(1, "x", None), (2, "y", None), (3, "z", "b"), (4, "w", "007"), (5, "q", "a/b")],
                                  "id int, v string, org string")
    tables.replace_partition(table, path, "org")
    tables.upsert_by_key(spark.createDataFrame([(2, "new", None)], table.schema), path, ["id"], "org")
    assert parts(spark, path) == rows(spark.createDataFrame(
        [(1, "x", None), (2, "new", None), (3, "z", "b"), (4, "w", "007"), (5, "q", "a/b")], table.schema))
    tables.upsert_by_key(spark.createDataFrame([(1, "moved", "b"), (5, "moved", "b")], table.schema), path, ["id"], "org")
    assert parts(spark, path) == rows(spark.createDataFrame(
        [(1, "moved", "b"), (2, "new", None), (3, "z", "b"), (4, "w", "007"), (5, "moved", "b")], table.schema))
    tables.update_from(spark.createDataFrame([(2, "again")], "id int, v string"), path, "id", ["v"], "org")
    assert (2, "again", None) in parts(spark, path)
    tables.drop_inactive(spark.createDataFrame([("b",), (None,)], "org string"), path, "org")
    assert [r[0] for r in parts(spark, path)] == [1, 2, 3, 5]
    tables.drop_inactive(spark.createDataFrame([("b",)], "org string"), path, "org")
    assert [r[0] for r in parts(spark, path)] == [1, 3, 5]


def test_null_keys_are_stored_once(spark, tmp_path):
    path = str(tmp_path / "n")
    batch = spark.createDataFrame([(None, "a"), (1, "b")], "id int, v string")
    for _ in range(2):
        tables.append_new(batch, path, ["id"])
    assert spark.read.parquet(path).count() == 2


def test_append_compares_partition_values_as_written(spark, tmp_path):
    path, ddl = str(tmp_path / "typed"), "id int, org string, day date, t timestamp"
    day = dt.date(2024, 1, 1)
    first = [(1, "007", day, T0), (2, "7", day, T0), (3, None, day, T0)]
    tables.append_new(spark.createDataFrame(first, ddl), path, ["id", "org"], ["org", "day"])
    assert tables.partition_columns(spark, path) == ["org", "day"]
    second = [(1, "7", day, T0), (3, "007", day, T0), (3, None, day, T0), (3, "", day, T0), (4, "x", None, T0), (5, "a/b", day, T0)]
    tables.append_new(spark.createDataFrame(second, ddl), path, ["id", "org"])
    want = [*first, second[0], second[1], second[4], second[5]]
    got = tables.read_table(spark, path)
    assert rows(got, "id", "org") == rows(spark.createDataFrame(want, ddl), "id", "org")
    later = [(i, o, d, T0 + dt.timedelta(days=1)) for i, o, d, _ in want]
    tables.append_newer(spark.createDataFrame([*want, later[0], later[4], (9, "y", day, T0)], ddl), path, ["id", "org", "day"], "t")
    got = tables.read_table(spark, path).where("t > '2024-01-01'")
    assert rows(got, "id", "org") == rows(spark.createDataFrame([later[0], later[4]], ddl), "id", "org")
    assert tables.read_table(spark, path).where("org = 'y'").count() == 1
    try:
        tables.append_new(spark.createDataFrame(first, ddl), path, ["id"], ["day"])
        raise AssertionError("another layout was accepted")
    except ValueError:
        pass


def test_batch_ids_do_not_depend_on_partitions(spark, tmp_path):
    ddl = "package int, t timestamp, batchid long, batchname string"
    data = [(i % 37, T0 + dt.timedelta(hours=i % 5), None if i % 3 else i, None if i % 3 else f"b{i}") for i in range(500)]
    want = {}
    order = sorted(set(data), key=lambda r: (r[0], r[1], r[2] is not None, r[2] or 0, r[3] or ""))
    for number, (package, t, batch, name) in enumerate(order, 1):
        made = int(t.replace(tzinfo=dt.UTC).timestamp()) + number
        want[package, t, made if batch is None else batch, name or str(made)] = 1
    for pieces in (1, 7, 40):
        path = str(tmp_path / f"b{pieces}")
        batch = spark.createDataFrame(data, ddl).repartition(pieces)
        tables.append_newer(batch, path, ["package"], "t", batch_id="batchid", batch_name="batchname")
        got = [tuple(r) for r in spark.read.parquet(path).select("package", F.col("t"), "batchid", "batchname").collect()]
        assert sorted(got) == sorted(want)
    days = spark.createDataFrame([(1, dt.date(1970, 1, 11), None), (2, dt.date(1970, 1, 11), 5), (None, None, None)],
                                 "k int, d date, batchid int")
    assert rows(inc.with_batch_ids(days, "d", ["k"], "batchid", None), "k", "batchid") == [(1, 12), (2, 5), (None, None)]
