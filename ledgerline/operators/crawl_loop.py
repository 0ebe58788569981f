"""A crawl of many sources over captured pages, with budgets, stop rules, guessed paths and fall-backs inside the loop.

Each source has a first-in-first-out queue. Pages of one generation of the queue don't change each other's order, so one round takes a whole
generation of all sources at once: windows over a source's entries give each page's number, the entries that the budget leaves, and the
first page that ends the source; what comes after it was never visited. Only ids and flags go through the loop; every round's
tables are checkpointed, and the loop ends when no source has an entry left, at whatever depth that is.

Rules: an entry is skipped if its url was visited or is where an earlier page ended up, or if it ends up where an earlier one did (a page that
others redirect to is taken to answer itself); urls that weren't captured are skipped. Skipped entries cost no budget. Pages at depth -1
(remembered ones) end the source if they gave what they gave before and no remembered page is waiting, and lead on only if they gave
rows. A world listing leads nowhere. An empty directory ends a source at depth 0 and below; a good page does too, unless a remembered one is
waiting (that doesn't matter at the last depth). A root without links puts the guessed paths in the queue; after two guessed paths that aren't found
the rest of them and the fall-backs are dropped. If the queue has run empty above the last depth and no page gave rows, the source's
fall-backs are visited at depth 1, once.

Edge cases: null flags count as false and null counts as 0; repeated entries count once, at their first place; a source without an entry and empty
tables give nothing; ties of `pos` go by url. A page's links are cut to twice the budget, of which a crawl can use no more, so a hub
with millions of links costs one bounded window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

ENTRY = ("source_id", "parent", "pos", "url", "depth", "guess")


def _first(df: DataFrame, *keys: str) -> DataFrame:
    """The first entry of each key, in the order of the queue."""
    w = Window.partitionBy(*keys).orderBy("parent", "pos", "url")
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def _flag(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def _stops(max_depth: int) -> Column:
    """Does this page end its source?"""
    good = _flag("good") & (~F.col("waiting") | ((F.col("depth") >= max_depth) & ~_flag("world")))
    remembered = (F.col("depth") < 0) & _flag("as_before") & ~F.col("waiting")
    leads = (F.col("depth") >= 0) | (F.col("rows") > 0)
    return remembered | (leads & good) | ((F.col("depth") >= 0) & ~_flag("world") & _flag("empty"))


def crawl_sources(sources: DataFrame, entries: DataFrame, pages: DataFrame, links: DataFrame, guesses: DataFrame, fall_backs: DataFrame, max_pages: int = 30, max_depth: int = 2) -> DataFrame:
    """source_id, number (from 1), url, depth of every page that is visited, and whether it ended its source.

    sources: source_id, world. entries: source_id, pos, url, depth (-1 remembered, 0 the source). pages: url, final_url, rows,
    good, empty, as_before (gave what it gave before), not_found. links: source_id, page (its url), pos, url, by priority. guesses,
    fall_backs: source_id, pos, url."""
    order = Window.partitionBy("source_id").orderBy("parent", "pos", "url")
    by_link = Window.partitionBy("source_id", "page").orderBy("pos", "url")
    links = links.groupBy("source_id", "page", "url").agg(F.min("pos").alias("pos"))
    links = cut_lineage(links.withColumn("rank", F.row_number().over(by_link)).filter(F.col("rank") <= 2 * max_pages).select("source_id", "page", F.col("rank").alias("pos"), "url"))
    pages = pages.select("url", F.coalesce("final_url", "url").alias("final"), F.coalesce(F.col("rows"), F.lit(0)).alias("rows"), "good", "empty", "as_before", "not_found")
    last = entries.filter("depth < 0").groupBy("source_id").agg(F.max("pos").alias("last_remembered"))
    waiting = F.coalesce((F.col("depth") < 0) & (F.col("pos") < F.col("last_remembered")), F.lit(False))
    queue = entries.join(last, "source_id", "left").select("source_id", F.lit(0).alias("parent"), F.col("pos").cast("long").alias("pos"), "url", "depth", F.lit(False).alias("guess"), waiting.alias("waiting"))
    state = cut_lineage(sources.select("source_id", _flag("world").alias("world"), F.lit(0).alias("n"), F.lit(0).alias("lost"), F.lit(False).alias("guessed"), F.lit(False).alias("fell_back"), F.lit(False).alias("ended"), F.lit(False).alias("found"), F.lit(0).alias("deepest")).dropDuplicates(["source_id"]))
    seen = None
    queue = cut_lineage(queue)
    while not queue.isEmpty():
        open_ = queue.join(state.filter(~F.col("ended") & (F.col("n") < max_pages)).select("source_id", "world", "n", "lost", "guessed", "fell_back"), "source_id")
        fresh = _first(open_, "source_id", "url").join(pages, "url")
        if seen is not None:
            fresh = fresh.join(seen.select("source_id", "url"), ["source_id", "url"], "left_anti")
            for at in ("url", "final"):
                fresh = fresh.join(seen.select("source_id", F.col("final").alias(at)), ["source_id", at], "left_anti")
        fresh = cut_lineage(fresh)
        # earlier entries of this generation: where they end up is no place to go to, nor to end up at, again
        spot = F.row_number().over(order)
        fresh = fresh.withColumn("spot", spot)
        ends = fresh.groupBy("source_id", F.col("final").alias("url")).agg(F.min("spot").alias("end_spot"))
        fresh = fresh.join(ends, ["source_id", "url"], "left").filter(F.col("end_spot").isNull() | (F.col("end_spot") >= F.col("spot"))).drop("end_spot", "spot")
        fresh = _first(fresh, "source_id", "final")
        # guessed paths after two that weren't found are dropped
        gone = (F.col("guess") & _flag("not_found") & (F.col("rows") <= 0)).cast("int")
        before = F.coalesce(F.sum(gone).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("lost")
        fresh = fresh.withColumns({"gone": gone, "before": before}).filter(~F.col("guess") | (F.col("before") < 2)).drop("before")
        fresh = fresh.withColumn("number", (F.col("n") + F.row_number().over(order)).cast("int")).filter(F.col("number") <= max_pages)
        fresh = fresh.withColumn("stop", _stops(max_depth))
        first_stop = F.min(F.when(F.col("stop"), F.col("number"))).over(Window.partitionBy("source_id"))
        visited = cut_lineage(fresh.withColumn("first_stop", first_stop).filter(F.col("first_stop").isNull() | (F.col("number") <= F.col("first_stop"))))
        done = visited.select("source_id", "number", "url", "final", "depth", "stop")
        seen = cut_lineage(done if seen is None else seen.unionByName(done))
        step = visited.groupBy("source_id").agg(F.max("number").alias("n_"), F.sum("gone").alias("gone_"), F.max("stop").alias("stop_"), F.max(F.col("rows") > 0).alias("found_"), F.max_by("depth", "number").alias("deepest_"))
        leads = visited.filter(~F.col("stop") & ~F.col("world") & (F.col("depth") < max_depth) & ((F.col("depth") >= 0) | (F.col("rows") > 0)))
        linked = leads.join(links.select("source_id", F.col("page").alias("url"), F.col("pos").alias("link_pos"), F.col("url").alias("link")), ["source_id", "url"])
        follow = linked.select("source_id", F.col("number").alias("parent"), F.col("link_pos").cast("long").alias("pos"), F.col("link").alias("url"), (F.col("depth") + 1).alias("depth"), F.lit(False).alias("guess"))
        bare = leads.filter("depth = 0 and not guessed").join(linked.select("source_id", "url").distinct(), ["source_id", "url"], "left_anti").groupBy("source_id").agg(F.min("number").alias("parent"))
        guessing = guesses.join(bare, "source_id").select("source_id", "parent", F.col("pos").cast("long").alias("pos"), "url", F.lit(1).alias("depth"), F.lit(True).alias("guess"))
        state = state.join(step, "source_id", "left").join(bare.select("source_id", F.lit(True).alias("guessed_")), "source_id", "left")
        state = cut_lineage(state.select(
            "source_id", "world", F.coalesce("n_", "n").alias("n"), (F.col("lost") + F.coalesce("gone_", F.lit(0))).alias("lost"), (F.col("guessed") | F.coalesce("guessed_", F.lit(False))).alias("guessed"), "fell_back",
            (F.col("ended") | F.coalesce("stop_", F.lit(False))).alias("ended"), (F.col("found") | F.coalesce("found_", F.lit(False))).alias("found"), F.coalesce("deepest_", "deepest").alias("deepest"),
        ))
        live = state.filter(~F.col("ended") & (F.col("n") < max_pages)).select("source_id")
        next_ = follow.unionByName(guessing).join(live, "source_id", "left_semi").join(seen.select("source_id", "url"), ["source_id", "url"], "left_anti").withColumn("waiting", F.lit(False)).select(*queue.columns)
        next_ = cut_lineage(next_)
        # a source whose queue holds nothing that was captured and has no rows yet takes its fall-backs
        alive = next_.join(pages.select("url"), "url", "left_semi").select("source_id").distinct()
        idle = state.filter("guessed and not fell_back and not ended and not found and lost < 2").filter((F.col("n") < max_pages) & (F.col("n") > 0) & (F.col("deepest") < max_depth)).join(alive, "source_id", "left_anti").select("source_id", "n")
        idle = cut_lineage(idle)
        more = fall_backs.join(idle, "source_id").select("source_id", F.col("n").alias("parent"), F.col("pos").cast("long").alias("pos"), "url", F.lit(1).alias("depth"), F.lit(False).alias("guess"), F.lit(False).alias("waiting"))
        state = cut_lineage(state.join(idle.select("source_id", F.lit(True).alias("fell")), "source_id", "left").withColumn("fell_back", F.col("fell_back") | F.coalesce("fell", F.lit(False))).drop("fell"))
        queue = cut_lineage(next_.join(idle, "source_id", "left_anti").unionByName(more.select(*queue.columns)))
    if seen is None:
        return sources.sparkSession.createDataFrame([], f"source_id {sources.schema['source_id'].dataType.simpleString()}, number int, url {entries.schema['url'].dataType.simpleString()}, depth int, stop boolean")
    return seen.select("source_id", "number", "url", "depth", "stop")
