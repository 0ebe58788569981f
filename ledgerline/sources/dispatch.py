"""Captured answers to candidates, each by its source's adapter."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from . import extract, feeds, static_html

SILVER = ("source_id", "source_record_id", "name", "meeting_type", "venue_name", "address_line1", "city", "country", "occurrences")


def _guide(answers: DataFrame, sources: DataFrame) -> DataFrame:
    return feeds.normalize_a(feeds.raw_records(_objects(answers), ("slug", "id"), F.lit("")).filter("error is null"))


def _bmlt(answers: DataFrame, sources: DataFrame) -> DataFrame:
    return feeds.normalize_b(feeds.raw_records(_objects(answers), ("id_bigint", "id"), F.lit("")).filter("error is null"))


def _objects(answers: DataFrame) -> DataFrame:
    return answers.select("source_id", F.explode(F.from_json("body", "array<string>")).alias("payload"))


def _page(answers: DataFrame, sources: DataFrame) -> DataFrame:
    pages = answers.join(sources.select(F.col("id").alias("source_id"), "url", "config"), "source_id").select(F.xxhash64("source_id").alias("page_id"), "source_id", "url", F.col("body").alias("html"), "config")
    rows = extract.extract(pages).join(pages.select("page_id", "source_id"), "page_id")
    return static_html.normalize(rows.drop("page_id", "pos", "kind", "floor"), sources)


ADAPTERS: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {"meeting_guide": _guide, "bmlt": _bmlt, "static_html": _page, "form_http": _page, "playwright_browser": _page}


def candidates(answers: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(candidates, refused) of captured answers (source_id, body) and their sources: each adapter reads its own sources' answers;
    sources of other kinds are refused with a reason."""
    kinds = sources.select(F.col("id").alias("source_id"), "adapter_type")
    typed = answers.join(kinds, "source_id")
    parts = [f(typed.filter(F.col("adapter_type") == k).select("source_id", "body"), sources.filter(F.col("adapter_type") == k)).select(*SILVER) for k, f in ADAPTERS.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    refused = typed.filter(~F.col("adapter_type").isin(*ADAPTERS)).select("source_id", F.concat(F.lit("unsupported adapter: "), "adapter_type").alias("error"))
    return out, refused
