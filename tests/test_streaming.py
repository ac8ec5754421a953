from cells import cell
from pyspark.sql import functions as F

from siltbed import schema
from siltbed.operators.sink import TableTarget
from siltbed.streaming import merge


def test_late_cells_change_nothing(spark, tmp_path):
    batches = [[cell(0, "a", 10, "x"), cell(0, "b", 1, "y")], [cell(1, "a", 5, "late"), cell(1, "b", 2, "z")]]
    for rows in batches:
        spark.createDataFrame(rows, schema.cells()).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema.cells()).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = merge.latest_of_stream(stream).writeStream.format("memory").queryName("newest").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {r["name"]: bytes(r["value"]) for r in spark.table("newest").collect()} == {"a": b"x", "b": b"z"}


def test_each_key_is_loaded_once(spark, tmp_path):
    kind = "key int, v string, expiry long"
    for rows in ([(1, "a", None), (2, "b", 5)], [(1, "again", None), (3, "c", 2000)]):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    target = TableTarget(spark, str(tmp_path / "out"), kind, ["key"])
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    alive = merge.expire_stream(stream, F.lit(1000))
    merge.load_stream(alive, target, str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(120)
    got = {r["key"]: r["v"] for r in target.read().collect()}
    assert set(got) == {1, 3} and target.read().count() == 2
