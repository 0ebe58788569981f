"""First use in a fresh session, and samples."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import common, language, quality

REPO = Path(__file__).resolve().parents[2]
FIRST = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local-cluster[1,2,1024]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", "file://{shared}").config("spark.executor.memory", "900m").getOrCreate()
docs = spark.createDataFrame([(i, "one two three four five six seven eight nine ten " * 3, "en", "s", 1) for i in range(4)], "doc_id long, text string, lang string, source string, n_chars long")
vecs = spark.createDataFrame([(i * 100, [float(i)] * 8, 1) for i in range(4)], "vec_id long, embedding array<float>, label int")
from ledgerline.llm import {module}
print("ROWS", {call}.count())
"""


@pytest.mark.parametrize("call,rows", [("near_dedup.keep_first(docs)", 1), ("packing.pack(docs)", 4), ("language.identify(docs, language.train(docs))", 4), ("topk_search.digest(vecs)", 12)])
def test_first_call_in_a_fresh_session_elsewhere(tmp_path, call, rows):
    """Executors start without the package: they must get it before the first call's plan is made."""
    code = FIRST.format(repo=str(REPO), shared=tmp_path, module=call.split(".")[0], call=call)
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert f"ROWS {rows}" in out.stdout, out.stderr[-2000:]


@pytest.mark.parametrize("one_id", range(4))
def test_no_language_is_lost_whatever_ids_its_rows_have(spark, one_id):
    rows = [(i, f"the quick brown fox number {i} jumps over that dog", "en") for i in range(100, 400)]
    rows += [(one_id, f"el zorro rojo numero {i} salta sobre aquel perro", "es") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").filter(~language.held_out(F.col("doc_id")))
    model = language.train(docs)
    assert model.langs == (["en", "es"] if docs.filter("lang = 'es'").count() else ["en"])
    rare = spark.createDataFrame([*rows[:300], (5, "solo un texto", "es")], "doc_id long, text string, lang string").filter(~language.held_out(F.col("doc_id")))
    assert language.train(rare, per_lang=3).langs == sorted({r.lang for r in rare.select("lang").distinct().collect()})


def test_a_class_under_one_id_is_learned(spark):
    good = "This line has a number of plain words in it.\nAnd here is another one that reads well."
    docs = spark.createDataFrame([(i, good + f" {i}") for i in range(300)] + [(1000, "MENU | HOME | LOGIN\n$$ ### 11")] * 200, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(300)] + [(1000, 0, 0)] * 200, "doc_id long, quality int, toxic int")
    assert quality.train(docs, labels, per_class=20) is not None


def test_sample_is_bounded_and_keeps_every_label(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 1000).alias("text"), F.when(F.col("id") == 7, "b").otherwise("a").alias("lang"))
    got = common.bounded_sample(rows, "lang", "text", 50)
    assert got.columns == rows.columns
    n = {r.lang: r["count"] for r in got.groupBy("lang").count().collect()}
    assert n["b"] == 1 and n["a"] <= 100 and got.select("text", "lang").distinct().count() == got.count()
    assert common.bounded_sample(rows.limit(0), "lang", "text", 50).count() == 0
    with pytest.raises(ValueError):
        common.bounded_sample(rows, "text", "lang", 5, max_labels=10)
