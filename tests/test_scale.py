"""What larger tables need: work dealt over all cores, no joins that a row's own columns answer, keys beyond a million."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import crawl
from ledgerline.plans import driver_queries
from ledgerline.sources import extract, html


def _against_sql(spark, name, folder, **tables):
    db = duckdb.connect()
    for t, df in tables.items():
        df.write.parquet(f"{folder}/{t}.parquet")
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    got = driver_queries.queries()[name](spark, str(folder))
    want = db.execute(f"SELECT {', '.join(got.columns)} FROM ({driver_queries.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
    return got


def test_pages_of_one_partition_are_dealt_over_all_cores(spark):
    page = "<table><tr><th>Day<th>Time<th>City</tr><tr><td>Monday</td><td>7 pm</td><td>Cork</td></tr></table><a href='x'>x</a>"
    pages = spark.range(400).coalesce(1).select(F.col("id").alias("page_id"), F.lit("https://x.org").alias("url"), F.lit(page).alias("html"))
    for out in (extract.extract(pages), extract.links(pages), extract.css_rows(pages, "tr", {"city": "td"}), extract.page_parts(pages, "url")):
        assert out.withColumn("task", F.spark_partition_id()).select("task").distinct().count() > 1
    assert extract.extract(pages).count() == 400
    assert extract.extract(pages.limit(0)).count() == 0


def test_selectors_by_the_index_equal_a_walk():
    rng = random.Random(3)
    tags, names = ("div", "p", "b", "ul", "li", "td", "tr", "table"), ("m", "day", "m day", "card", "")
    css = ("div", ".m", "b, .day", "ul > li", "div p.m", "*", "[id]", "#a", "td, th, .m", "li + li", "b ~ p", ".m .day", "tr td", "div, div")
    for _ in range(60):
        text = "".join(rng.choice((f"<{t} class='{rng.choice(names)}' id={rng.choice('ab')}>", f"</{t}>", f"<{t}>", "x")) for t in rng.choices(tags, k=60))
        root = html.parse(text)
        for n in root.walk():
            for c in css:
                chains = [html._parse(s) for s in c.split(",")]
                assert n.select(c) == [x for x in n.walk() if x is not n and any(html._matches(x, chain, n) for chain in chains)]


def test_days_by_shared_beginnings_equal_the_plain_list():
    import re

    words = [d for d in (*extract.WEEKDAYS, *extract.DAILY_NAMES) if d != "today"]
    plain = re.compile(r"\b(?:" + "|".join(sorted(words, key=len, reverse=True)) + r")\b", re.I)
    clock = re.compile(extract.TIME)
    rng = random.Random(4)
    bits = [*words, *(w.upper() for w in words), "x", "-", " ", ",", "7:30", "7", "pm", "p.m.", "Kl. 19.30", "noon", "12 NOON", "midnight", "19h", "today"]
    for _ in range(4000):
        s = rng.choice(("", " ")).join(rng.choices(bits, k=5))
        for fast, slow in ((extract.DAY, plain), (extract.CLOCK, clock)):
            assert [m.span() for m in fast.finditer(s)] == [m.span() for m in slow.finditer(s)], s


def test_links_with_keys_beyond_a_million_keep_their_order(spark, tmp_path):
    orders = spark.range(999_950, 1_000_050).select(F.col("id").alias("o_orderkey"), (F.col("id") % 3).alias("o_custkey"))
    _against_sql(spark, "prioritized_links", tmp_path, orders=orders)


@pytest.mark.parametrize("name", ["common_path_guesses", "crawl_frontier", "remembered_pages"])
def test_sources_are_not_joined_to_their_own_pages(spark, tmp_path, name):
    got = _against_sql(spark, name, tmp_path, customer=spark.range(200).select(F.col("id").alias("c_custkey")))
    assert "Join" not in got._jdf.queryExecution().toString()


def test_guesses_of_odd_sources(spark):
    urls = ["HTTPS://H.org/Meetings/", "ftp://h.org/x", "h.org/x", "", None, " https://h.org/reuniões ", "https:///x", "http://u@h.org:80?q#f"]
    s = spark.createDataFrame([(u, i) for i, u in enumerate(urls)], "source_url string, i int")
    rows = s.select("source_url", "i", F.posexplode(F.array(*map(F.lit, crawl.COMMON_PATHS))).alias("pos", "path"))
    url = F.concat(crawl.urls.part(F.col("source_url"), 1), F.lit("://"), crawl.urls.part(F.col("source_url"), 2), "path")
    want = rows.withColumn("url", url).filter((crawl.path_key(F.col("url")) != crawl.path_key(F.col("source_url"))) & crawl.urls.admissible(F.col("source_url"), F.col("url"))).select("i", "pos", "url")
    assert sorted(map(tuple, crawl.guesses(s, "i").select("i", "pos", "url").collect())) == sorted(map(tuple, want.collect()))


def test_few_pages_at_a_time_become_python_values(spark):
    pages = spark.range(3 * extract.PAGES_AT_ONCE).coalesce(1).select(F.col("id").alias("page_id"), F.lit("<p>x</p>").alias("html"))
    parts = extract.page_parts(pages)
    assert parts.select("page_id").distinct().count() == 3 * extract.PAGES_AT_ONCE
    assert "MapInArrow" in parts._jdf.queryExecution().toString()
