"""Landed payloads: one parse, pruned reads, nothing lost."""

from conftest import rows
from tallyhouse.sources import variants

GOOD = '[{"brandId": 7, "brandName": "x", "new": {"a": 1}, "list": [{"q": 1}]}, {"brandId": "8", "brandName": 5}]'


def test_landing_keeps_everything(spark, tmp_path):
    path = str(tmp_path / "landed")
    text = [GOOD, '{"brandId": 9}', "no json", '[{"brandId": 1}, 3]', "[]", "", None, "5", '{"brandId": [1]}', '{"brandId": 1e30}']
    frame = spark.createDataFrame([(t, "o", "s") for t in text], "raw string, org string, store string")
    variants.land_payloads(frame, "raw", path)
    got = variants.read_landed(spark, path, "Brand")
    assert got.columns[-2:] == ["org", "store"]
    assert rows(got, "brandId", "brandName") == [(7, "x"), (8, "5"), (9, None), (None, None), (None, None)]
    assert rows(variants.rejected_landed(spark, path), "rejected") == [("5",), ('[{"brandId": 1}, 3]',), ("no json",)]
    extra = dict(rows(variants.undeclared_fields(spark, path, "Brand")))
    assert extra["new"] == "OBJECT" and extra["list"] == "ARRAY" and "brandName" not in extra and "new.a" not in extra
    # A second load adds to the table; another one by default does not overwrite it.
    variants.land_payloads(frame.limit(1), "raw", path, mode="append")
    assert variants.read_landed(spark, path, "Brand").count() == 7


def test_reads_are_pruned(spark, tmp_path):
    path = str(tmp_path / "landed")
    variants.land_payloads(spark.createDataFrame([(GOOD, "o", "s")], "raw string, org string, store string"), "raw", path)
    one = variants.read_landed(spark, path, "Brand").select("brandId", "org")
    plan = one._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "payload:struct<0:bigint>" in schema and "store" not in schema


def test_nothing_landed(spark, tmp_path):
    path = str(tmp_path / "empty")
    variants.land_payloads(spark.createDataFrame([], "raw string, org string, store string"), "raw", path)
    assert variants.read_landed(spark, path, "Brand").count() == 0
    assert variants.undeclared_fields(spark, path, "Brand").count() == 0


def test_schema_text():
    shape = variants._shape("OBJECT<a: BIGINT, `b c`: ARRAY<OBJECT<d: DECIMAL(2,1), e: VARIANT>>, `f``g`: OBJECT<>, h: ARRAY<VOID>>")
    assert shape == {"": "OBJECT", "a": "BIGINT", "b c": "ARRAY", "b c[]": "OBJECT", "b c[].d": "DECIMAL(2,1)", "b c[].e": "VARIANT",
                     "f`g": "OBJECT", "h": "ARRAY", "h[]": "VOID"}
