"""The snapshot's order and its document."""

import datetime
import json

from pyspark.sql import functions as F

from ledgerline.operators.ranking import numbered
from ledgerline.plans import pipeline
from ledgerline.plans.files import write_ordered

from .test_operators import rows

WHEN = datetime.datetime(2024, 1, 1)


def test_numbers_have_no_gap(spark):
    df = spark.range(100_000).select("id", F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id") % 1000)).alias("country"), F.when(F.col("id") % 5 > 0, (F.col("id") * 7919 % 100).cast("string")).alias("city"), F.lit(1).alias("pos"), F.lit(2).alias("at"))
    out = numbered(df, ["country", "city", "id"], "n")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and out.columns == [*df.columns, "n"]
    got = out.collect()
    assert [r.n for r in got] == list(range(1, 100_001))
    key = lambda r: (r.country, r.city is None, r.city or "", r.id)
    assert [r.id for r in got] == [r.id for r in sorted(df.collect(), key=key)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    same = numbered(spark.range(20_000).select(F.lit("x").alias("k"), F.lit(None).cast("string").alias("v")), ["v", "k"])
    assert sorted(r.pos for r in same.collect()) == list(range(1, 20_001))
    assert max(same.groupBy(F.spark_partition_id()).count().toPandas()["count"]) < 12_000  # equal rows are spread
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert numbered(df.limit(0), ["id"]).count() == 0


def test_document_in_pieces_is_the_document(spark, tmp_path):
    for n in (0, 1, 300):
        gold = rows(spark, range(n)).drop("pos").withColumn("country", F.when(F.col("source_record_id").cast("int") % 3 > 0, F.col("country")))
        head, body, tail = pipeline.document_lines(gold, WHEN)
        write_ordered(body, head, tail, f"file://{tmp_path}/out/latest/part-00000.json")
        text = (tmp_path / "out/latest/part-00000.json").read_text()
        assert text == pipeline.document(gold, WHEN).first().value + "\n" and json.loads(text)["meeting_count"] == n
        assert [p.name for p in (tmp_path / "out/latest").iterdir() if not p.name.endswith(".crc")] == ["part-00000.json"]


def test_a_failed_write_leaves_the_old_document(spark, tmp_path):
    path = f"file://{tmp_path}/part-00000.json"
    lines = spark.createDataFrame([("é", 1)], "value string, pos long")
    write_ordered(lines, ["{"], ["}"], path)
    bad = lines.select(F.raise_error(F.lit("lost")).cast("string").alias("value"))
    try:
        write_ordered(bad, ["["], ["]"], path)
    except Exception:
        pass
    else:
        raise AssertionError
    assert (tmp_path / "part-00000.json").read_text() == "{\né\n}\n"
    assert [r.value for r in spark.read.text(str(tmp_path)).collect()] == ["{", "é", "}"]
