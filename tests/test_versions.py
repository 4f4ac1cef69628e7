"""Version differences and their streaming twin."""

import pytest
from pyspark.sql import functions as F

from lodestar.operators import versions
from lodestar.streaming import trials


def test_change_score_weights(spark):
    rows = [([("primary_endpoint_text", "H"), ("title", "L")],), ([],)]
    df = spark.createDataFrame(rows, "c array<struct<path:string,severity:string>>")
    got = [r.s for r in df.select(versions.change_score(F.col("c"), {"primary_endpoint": 3.0}).alias("s")).collect()]
    assert got == [pytest.approx((3.0 * 1.0 + 0.3) / 4), 0.0]


@pytest.mark.parametrize(("old", "new", "material"), [(100, 130, False), (100, 131, True), (0, 5, False), (None, 5, False)])
def test_numbers_matter_beyond_thirty_percent(spark, old, new, material):
    df = spark.createDataFrame([(old, new)], "a int, b int")
    assert df.select(versions.is_material("other", F.col("a"), F.col("b"), "number").alias("m")).first().m == material


def test_json_diff(spark):
    df = spark.createDataFrame([('{"a": 1, "b": [1, 2], "c": null}', '{"b": [1, 2], "c": 3, "d": "x"}')], "o string, n string")
    got = [(d.key, d.type, d.old, d.new) for d in df.select(versions.json_diff(F.col("o"), F.col("n")).alias("d")).first().d]
    assert got == [("a", "removed", "1", None), ("c", "modified", None, "3"), ("d", "added", None, "x")]


def test_endpoint_changes_over_batches(spark, tmp_path):
    schema = "trial_id long, version_id long, captured_at timestamp, endpoint string, completion date"
    one = [(1, 1, "2024-01-01", "Overall survival", "2024-03-01"), (2, 1, "2024-01-01", "Response rate", "2026-01-01")]
    two = [(1, 2, "2024-01-02", "Response rate", "2024-03-01"), (2, 2, "2024-01-02", "Overall survival", "2026-01-01"), (1, 3, "2024-01-03", "Response rate", "2024-03-01")]
    for name, rows in (("a", one), ("b", two)):
        spark.createDataFrame([(a, b, str(c), d, str(e)) for a, b, c, d, e in rows], "trial_id long, version_id long, c string, endpoint string, d string").selectExpr("trial_id", "version_id", "cast(c as timestamp) as captured_at", "endpoint", "cast(d as date) as completion").coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
        query = trials.endpoint_changes(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination(120)
    got = [(r.trial_id, r.version_id) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert got == [(1, 2)]
