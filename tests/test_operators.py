import pytest
from pyspark.sql import functions as F

from ledgerline.functions import schedule, text, urls
from ledgerline.operators import consolidate, fuzzy, location, merge
from ledgerline.plans import pipeline
from ledgerline.plans.store import Store
from ledgerline.streaming import runs


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(("raw", "want"), [("noon", "12:00 pm"), ("kl. 19.30", "19:30"), ("19h", "19:00"), ("7p", "7pm"), ("7:00 - 8:00 pm", "7:00"), ("1930pm", "19:30pm"), ("14:00 pm", "14:00"), ("7", "7:00"), ("7.30 p.m.", "7:30 pm"), ("midnight", "12:00 am")])
def test_clean_time(spark, raw, want):
    assert one(spark, schedule.clean_time, raw) == want


@pytest.mark.parametrize(("raw", "want"), [("7 pm", 1140), ("12 am", 0), ("13 pm", None), ("19:30:15", 1170), ("24:00", None), ("", None), (None, None), ("7:30 A.M.", 450)])
def test_parse_time(spark, raw, want):
    assert one(spark, schedule.parse_time, raw) == want


def test_first_time(spark):
    assert one(spark, schedule.first_time, "from 7:00-8:30 pm on") == "7:00pm"
    assert one(spark, schedule.first_time, "Doors 19:15 sharp") == "19:15"


@pytest.mark.parametrize(("raw", "want"), [("HTTP://Ex.org", "http://ex.org/"), ("https://ex.org/a/?b=2&a=1#f", "https://ex.org/a?a=1&b=2"), ("https://ex.org/?q=a+b&q=%41", "https://ex.org/?q=A&q=a+b"), ("//ex.org/x//", "https://ex.org/x")])
def test_normalize_url(spark, raw, want):
    assert one(spark, urls.normalize_url, raw) == want


def test_text_keys(spark):
    assert one(spark, text.key_text, "12 Main St. – Zoë") == "12 main street zo"
    assert one(spark, text.address_key, "1 Oak Rd, Cork, Munster") == "1 oak road cork"
    assert one(spark, text.place_field, "Wheelchair accessible.") is None
    assert one(spark, text.odd_capitals, "McDonald eBay iOS") == 2


def test_token_set_ratio():
    r = fuzzy.token_set_ratio
    assert r("a b c", "c b a d") == 100 and r("", "a") == 0 and r("abc", "abd") == pytest.approx(200 * 2 / 6)


CASES = [
    ({"address_line1": "12 Main St, Tulsa, OK 74103"}, ("United States", "Oklahoma", "Tulsa", "74103", "12 Main St")),
    ({"address_line1": "5 High St, Cork, Ireland", "city": "Co. Cork"}, ("Ireland", "Cork", None, None, "5 High St")),
    ({"address_line1": "7 King St, Toronto, ON M5V 2T6"}, ("Canada", "Ontario", "Toronto", "M5V 2T6", "7 King St")),
    ({"address_line1": "Hall", "country": "Polska", "region": "Polska"}, ("Poland", None, None, None, "Hall")),
    ({"address_line1": "Hall", "city": "Wheelchair accessible", "country": "us", "region": "tx"}, ("United States", "Texas", None, None, "Hall")),
    ({"address_line1": None, "city": "Oslo", "country": None}, (None, None, "Oslo", None, None)),
]


@pytest.mark.parametrize(("given", "want"), CASES)
def test_normalize_location(spark, given, want):
    names = ("venue_name", "address_line1", "address_line2", "city", "region", "postal_code", "country")
    df = spark.createDataFrame([tuple(given.get(n) for n in names)], ", ".join(f"{n} string" for n in names))
    r = location.normalize_location(df).first()
    assert (r.country, r.region, r.city, r.postal_code, r.address_line1) == want


def rows(spark, ids, city="Cork"):
    occ = "array<struct<day_of_week:int,start_minute:int,end_minute:int,timezone:string>>"
    data = [("s", str(i), "https://u", "aa", "in_person", f"Group {i // 2}", "Hall", None, None, city, None, None, "Ireland", None, None, None, None, [(1, 600 + i, None, "Europe/Dublin")], ["O"], None, i) for i in ids]
    return spark.createDataFrame(data, f"source_id string, source_record_id string, source_url string, fellowship string, meeting_type string, name string, venue_name string, address_line1 string, address_line2 string, city string, region string, postal_code string, country string, online_url string, phone_join_info string, latitude double, longitude double, occurrences {occ}, formats array<string>, last_verified_at string, pos int")


def test_runs_mark_missing_and_flag_drops(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/db")
    src = spark.createDataFrame([("s",)], "source_id string")
    for run, ids in enumerate([range(10), range(5), range(5), range(5), range(6)]):
        c, f = pipeline.ingest(rows(spark, ids))
        pipeline.persist(store, f"r{run}", f"2024-01-0{run + 1}", c, f, src)
    got = {r.source_record_id: (r.status, r.missing_run_count, r.first_seen_at) for r in store.read("canonical_meetings").collect()}
    assert got["0"] == ("active", 0, "2024-01-01") and got["5"] == ("active", 0, "2024-01-01") and got["9"] == ("inactive", 3, "2024-01-01")
    flags = [(r.code, r.status) for r in store.read("review_flags").collect()]
    assert flags == [("source_large_drop", "resolved")]
    pipeline.persist(store, "bad", "2024-02-01", rows(spark, []), f, src, failed=True)
    assert store.read("import_runs").filter("status = 'failed'").count() == 1 and store.read("canonical_meetings").count() == 10


def test_snapshot_consolidates_and_gates(spark, tmp_path):
    import datetime

    c = rows(spark, range(6)).withColumn("status", F.lit("active"))
    sources = spark.createDataFrame([("s", "{}")], "id string, config string")
    flags = spark.createDataFrame([("s", "5", "open", "error"), ("s", None, "open", "error")], "source_id string, source_record_id string, status string, severity string")
    gold = pipeline.snapshot(c.drop("pos"), sources, flags)
    out = {r["name"]: r for r in gold.collect()}
    assert {k: r.n_members for k, r in out.items()} == {"Group 0": 2, "Group 1": 2, "Group 2": 1}
    assert [o.start_minute for o in out["Group 0"].occurrences] == [600, 601]
    when = datetime.datetime(2024, 1, 1)
    assert not pipeline.publish(spark, gold, f"file://{tmp_path}/out", when, minimum=99)["written"] and not (tmp_path / "out").exists()
    assert pipeline.publish(spark, gold, f"file://{tmp_path}/out", when)["written"] and (tmp_path / "out" / "latest").is_dir()


def test_a_snapshot_with_duplicates_is_not_published(spark, tmp_path):
    import datetime
    import json

    gold, when = rows(spark, range(40)), datetime.datetime(2024, 1, 1)
    report = pipeline.publish(spark, gold, f"file://{tmp_path}/out", when)
    assert report["removed"] == 20 and not report["passed"] and not report["written"] and not (tmp_path / "out").exists()
    merged = consolidate.consolidate(gold)
    store = Store(spark, f"file://{tmp_path}/db")
    report = pipeline.publish(spark, merged, f"file://{tmp_path}/out", when)
    pipeline.record_snapshot(store, report)
    assert report["written"] and [(r.meeting_count, r.status) for r in store.read("snapshots").collect()] == [(20, "published")]
    (part,) = (tmp_path / "out" / "latest").glob("part-*")
    doc = json.loads(part.read_text())
    assert doc["meeting_count"] == 20 == len(doc["meetings"]) and list(doc["meetings"][0]) == sorted(doc["meetings"][0]) and [m["name"] for m in doc["meetings"]] == sorted(m["name"] for m in doc["meetings"])


def test_a_crash_before_the_pointer_leaves_the_store(spark, tmp_path, monkeypatch):
    store = Store(spark, f"file://{tmp_path}/db")
    store.commit({"t": spark.range(3)})
    (tmp_path / "db" / "t" / "v2").mkdir()  # a version written by a run that ended before its pointer
    (tmp_path / "db" / "NEXT.json").write_text("{half")
    again = Store(spark, f"file://{tmp_path}/db")
    assert again.read("t").count() == 3
    again.commit({"t": spark.range(5), "u": spark.range(1)})
    assert again.read("t").count() == 5 and Store(spark, f"file://{tmp_path}/db").read("u").count() == 1


def test_zero_source_report(spark, tmp_path):
    from ledgerline.plans import listing_queries

    audited = listing_queries._audited(spark, "/root/testdata/sf0.001").drop("html", "text", "error")
    pipeline.zero_source_report(audited, f"file://{tmp_path}/a", "na")
    ids = spark.read.text(f"file://{tmp_path}/a/retry_ids").count()
    (command,) = (r.value for r in spark.read.text(f"file://{tmp_path}/a/retry_command").collect())
    assert ids == command.count("--source-id ") > 0 and spark.read.json(f"file://{tmp_path}/a/audit").count() == audited.count()
    (part,) = (tmp_path / "a" / "report").glob("part-*")
    lines = part.read_text().split("\n")
    assert lines[0] == "# Zero-source audit" and lines[1].startswith("- ") and lines[-2].startswith("| 5 |")
    counts, few = pipeline.audit_snapshot(rows(spark, range(8)).withColumn("country", F.lit("Poland")))
    assert {r.code: r.n for r in counts.filter("level = 'code'").collect()} == {"timezone_country_mismatch": 8} and few.count() == 5


def test_invalid_and_unsure_rows_become_flags(spark):
    c = rows(spark, range(3)).withColumns({"confidence": F.col("pos") * 0.3 + 0.2, "name": F.when(F.col("pos") == 1, " ").otherwise(F.col("name"))})
    kept, flags = pipeline.ingest(c)
    assert [r.source_record_id for r in kept.collect()] == ["2"]
    assert sorted((r.source_record_id, r.code) for r in flags.collect()) == [("0", "scrape_very_low_confidence"), ("1", "scrape_low_confidence"), ("1", "scrape_normalization_failed")]


def test_stream_of_runs(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/db")
    for k, ids in enumerate([range(4), range(2)]):
        rows(spark, ids).withColumn("seen_at", F.lit(f"2024-01-0{k + 1}")).write.mode("append").json(f"{tmp_path}/in")
        stream = spark.readStream.schema(rows(spark, []).withColumn("seen_at", F.lit("")).schema).json(f"{tmp_path}/in")
        runs.merge_stream(stream, store, f"{tmp_path}/ck").awaitTermination()
    assert {r.source_record_id: r.status for r in store.read("canonical_meetings").collect()} == {"0": "active", "1": "active", "2": "stale", "3": "stale"}


def test_merge_details(spark):
    got = spark.range(1).select(F.to_json(merge.merge_json(F.lit('{"a":"1","b":"2"}'), F.lit('{"b":"3"}'))).alias("j"), F.to_json(merge.merge_json(F.lit(None).cast("string"), F.lit('{"x":"1"}'))).alias("k")).first()
    assert got.j == '{"a":"1","b":"3"}' and got.k == '{"x":"1"}'
    tables = {"sources": spark.createDataFrame([("a",), ("b",)], "id string"), "flags": spark.createDataFrame([("a", 1), ("b", 2)], "source_id string, n int")}
    left = merge.delete_sources(tables, spark.createDataFrame([("a",)], "id string"))
    assert [r.id for r in left["sources"].collect()] == ["b"] and [r.n for r in left["flags"].collect()] == [2]
    kids = merge.replace_children(tables["flags"], spark.createDataFrame([("a", 9)], "source_id string, n int"), ["source_id"])
    assert sorted(map(tuple, kids.collect())) == [("a", 9), ("b", 2)]


def test_merged_occurrences_are_sorted_and_different(spark):
    """Lists with repeats and nulls, against a set; structs aren't compared all with all."""
    import itertools
    import random

    from pyspark.sql import functions as F

    rng = random.Random(8)
    each = [(d, s, e, z) for d, s, e, z in itertools.product(range(3), (0, 60, None), (30, None, 1440), ("UTC", None))]
    lists = [[rng.choice(each) for _ in range(rng.randint(0, 9))] for _ in range(40)]
    df = spark.createDataFrame([(lists,), ([],), ([[]],)], "c array<array<struct<day_of_week:int,start_minute:int,end_minute:int,timezone:string>>>")
    merged = consolidate.merged_occurrences(F.col("c"))
    got = [[tuple(o) for o in r[0]] for r in df.select(merged).collect()]
    low = lambda x: (x is not None, x if x is not None else 0)
    order = lambda o: (low(o[0]), low(o[1]), 1440 if o[2] is None else o[2], (o[3] is not None, o[3] or ""), low(o[2]))
    assert got == [sorted({o for x in lists for o in x}, key=order), [], []]
    assert "array_distinct" not in df.select(merged)._jdf.queryExecution().analyzed().toString()
