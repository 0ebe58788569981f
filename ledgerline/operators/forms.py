"""Which form or button of a captured page a visitor would use, by SQL functions over a table of the page's elements.

``elements`` cuts pages into tags and numbers them; an element runs from its start tag to the end tag of the same name at the same
level among tags of that name, so unclosed elements of other names don't matter. A control belongs to the last form before it that is
still open. Everything about a page after the first exchange stays in its partition; text is cut out of the page by offsets.

Edge cases: of several rows with one page_id the one with the least html counts; null html is an empty page; an empty table gives an
empty result; comments, scripts, styles, templates and noscript parts hold no elements; a form or link that is never closed lasts until the next
one; a tag with over 200 quoted values, or with a quote that never closes, is text; ties go to the first element of the page; other columns of the pages
aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

HIDDEN = r"(?is)<!--.*?-->|<(script|style|template|noscript)\b.*?</\1\s*>"
TAG = r"""<(/?[A-Za-z][A-Za-z0-9-]*)((?:"[^"]*"|'[^']*'|[^>"']++){0,400}+)>([^<]*)"""
ATTRIBUTE = r"""[^\s"'<>/=]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'=<>`]+))?"""
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
#: Kinds of input that take no text.
NO_TEXT = ("hidden", "checkbox", "radio", "submit", "button", "file", "image", "reset")

# Fixed values, in order of preference: what a search field's name or hint holds, and the forms whose search field is taken.
FIELD_NAMES = ("city", "location", "postcode", "zip", "search", "query")
FIELD_NAME = "s"
FIELD_NAMES_LAST = ("keyword",)
FIELD_HINTS = ("city", "location", "postcode", "zip", "search")
SEARCH_FORMS = (("aria-label", "meeting"), ("id", "meeting"), ("class", "meeting"), ("id", "group"), ("class", "group"))
# Fixed values, in order: what else makes a form worth sending, and the words on its button.
FORM_INPUTS = ("meeting", "group", "location", "city")
FORM_SELECTS = ("day", "type")
SEND_WORDS = ("search", "find", "filter", "show")
# Fixed values, in order: the words on buttons that are tried on a page.
BUTTON_WORDS = (
    "meetings", "meeting list", "meeting locations", "groups", "aa groups", "a.a. groups", "find a meeting", "find meeting", "find meetings", "search", "filter", "list", "list view",
    "load more", "more meetings", "next", "show more",
)


def attribute(name: str) -> Column:
    """An element's attribute, null if it has none; the first one counts if it is repeated."""
    at = F.array_position("names", name)
    return F.when(at > 0, F.get("values", (at - 1).cast("int")))


def _holds(c: Column, word: str) -> Column:
    return F.coalesce(F.contains(F.lower(c), F.lit(word)), F.lit(False))


def _is(c: Column, word: str) -> Column:
    return F.coalesce(F.lower(c) == word, F.lit(False))


def _page_rows(pages: DataFrame) -> DataFrame:
    one = pages.groupBy("page_id").agg(F.min(F.coalesce("html", F.lit(""))).alias("html"))
    return one.select("page_id", F.regexp_replace("html", HIDDEN, "").alias("html"))


def elements(pages: DataFrame) -> DataFrame:
    """page_id, n (the start tag's number), end (the end tag's, null if it is never closed), tag, names and values of the attributes, and the
    element's text in the page's text: from_char and to_char."""
    part = lambda i: F.regexp_extract("raw", TAG, i)
    tags = _page_rows(pages).select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(TAG), F.lit(0))).alias("n", "raw"))
    tags = tags.select("page_id", "n", F.lower(part(1)).alias("name"), part(2).alias("attributes"), F.length(part(3)).alias("size"))
    tags = tags.select("page_id", "n", F.ltrim("name", F.lit("/")).alias("tag"), F.col("name").startswith("/").alias("closes"), "attributes", "size")
    in_page = Window.partitionBy("page_id").orderBy("n")
    tags = tags.withColumn("from_char", F.coalesce(F.sum("size").over(in_page.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    of_name = Window.partitionBy("page_id", "tag").orderBy("n")
    void = F.col("tag").isin(*VOID)
    step = F.when(void, 0).when(F.col("closes"), -1).otherwise(1)
    tags = tags.withColumn("level", F.sum(step).over(of_name.rowsBetween(Window.unboundedPreceding, 0)) + F.when(F.col("closes") & ~void, 1).otherwise(0))
    at_level = Window.partitionBy("page_id", "tag", "level").orderBy("n")
    after = F.lead(F.struct("n", "closes", "from_char")).over(at_level)
    tags = tags.withColumn("after", after).filter(~F.col("closes"))
    closed = F.col("after.closes") & ~void
    piece = F.regexp_extract_all("attributes", F.lit(ATTRIBUTE), F.lit(0))
    value = lambda p: F.regexp_replace(F.when(F.contains(p, F.lit("=")), F.substring(p, F.instr(p, "=") + 1, F.length(p))).otherwise(""), r"""^\s*["']?|["']?$""", "")
    return tags.select(
        "page_id", "n", F.when(void, F.col("n")).when(closed, F.col("after.n")).alias("end"), "tag", F.transform(piece, lambda p: F.lower(F.trim(F.substring_index(p, "=", 1)))).alias("names"), F.transform(piece, value).alias("values"),
        "from_char", F.when(void, F.col("from_char")).when(closed, F.col("after.from_char")).alias("to_char"),
    )


def controls(pages: DataFrame) -> DataFrame:
    """Forms, inputs, selects, buttons and what acts as a button, with the form they belong to, whether they are in a link, and their text."""
    w = Window.partitionBy("page_id").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    last = lambda cond: F.last(F.when(cond, F.struct("n", "end", attribute("id").alias("id"), attribute("class").alias("class"), attribute("aria-label").alias("aria-label"))), ignorenulls=True).over(w)
    open_ = lambda s: F.col(s).isNotNull() & (F.col(f"{s}.end").isNull() | (F.col(f"{s}.end") >= F.col("n")))
    button = (F.col("tag") == "button") | _is(attribute("role"), "button")
    found = elements(pages).filter(F.col("tag").isin("form", "input", "select", "a") | button)
    found = found.withColumns({"form": last(F.col("tag") == "form"), "link": last((F.col("tag") == "a") & F.array_contains("names", "href"))})
    found = found.withColumns({"form": F.when(open_("form"), F.col("form")), "in_link": F.coalesce(open_("link"), F.lit(False)), "is_button": button}).drop("link").filter((F.col("tag") != "a") | F.col("is_button"))
    text = _page_rows(pages).select(F.col("page_id").alias("text_id"), F.array_join(F.regexp_extract_all("html", F.lit(TAG), F.lit(3)), "").alias("text"))
    said = F.substring("text", F.col("from_char") + 1, F.coalesce(F.col("to_char"), F.length("text")) - F.col("from_char"))
    words = found.join(text, F.col("is_button") & F.col("page_id").eqNullSafe(F.col("text_id")), "left")
    return words.withColumn("says", F.coalesce(F.lower(F.trim(F.regexp_replace(said, r"\s+", " "))), F.lit(""))).drop("text", "text_id")


def _first_rule(rules: list[Column]) -> Column:
    return F.coalesce(*(F.when(c, F.lit(i)) for i, c in enumerate(rules)))


def field_rules() -> list[Column]:
    """What makes an input of a form the one to search with, best first."""
    name, hint = attribute("name"), attribute("placeholder")
    by_name = [*(_holds(name, x) for x in FIELD_NAMES), _is(name, FIELD_NAME), *(_holds(name, x) for x in FIELD_NAMES_LAST)]
    by_form = [_is(attribute("type"), "search") & _holds(F.col(f"form.{a}"), x) for a, x in SEARCH_FORMS]
    return [*by_name, *(_holds(hint, x) for x in FIELD_HINTS), *by_form]


def form_choices(pages: DataFrame) -> DataFrame:
    """What is done with a page's forms: page_id, action (`fill` a field with the page's `seed` and send it, or `submit` a form by its button), rule (number of
    the rule, from 0), button_rule, form and control (numbers of their start tags), control_id (id or name), works (false for a field that takes no text).

    A field is looked for only where there is a seed; without one, the first form of each form rule is looked at in turn, until one has a button.
    Pages where nothing is to be done have no row."""
    c = controls(pages.select("page_id", "html")).filter("form is not null")
    label = F.coalesce(attribute("id"), attribute("name"))
    kind = F.lower(F.coalesce(attribute("type"), F.lit("text")))
    field = F.when(F.col("tag") == "input", _first_rule(field_rules()))
    send = [(F.col("tag") == "button") & _is(attribute("type"), "submit"), (F.col("tag") == "input") & _is(attribute("type"), "submit"), *((F.col("tag") == "button") & F.contains("says", F.lit(x)) for x in SEND_WORDS)]
    has = [(F.col("tag") == t) & _holds(attribute("name"), x) for t, xs in (("input", FORM_INPUTS), ("select", FORM_SELECTS)) for x in xs]
    rules = [*(_holds(F.col(f"form.{a}"), x) for a, x in SEARCH_FORMS), *has]
    c = c.withColumns({"field": field, "send": _first_rule(send)})
    forms = c.groupBy("page_id", F.col("form.n").alias("form")).agg(
        F.array(*map(F.max, rules)).alias("rules"), F.min(F.when(F.col("send").isNotNull(), F.struct(F.col("send").alias("rule"), "n", label.alias("label")))).alias("button"),
        F.min(F.when(F.col("field").isNotNull(), F.struct(F.col("field").alias("rule"), "n", F.col("form.n").alias("form"), label.alias("label"), (~kind.isin(*NO_TEXT)).alias("works")))).alias("field"),
    )
    page = forms.groupBy("page_id").agg(F.min("field").alias("f"), F.sort_array(F.collect_list(F.struct("form", "rules", "button"))).alias("forms"))
    # the first form of each rule, if it has a button
    first = lambda i: F.get(F.filter("forms", lambda x: x["rules"][i]), F.lit(0))
    sent = [F.when(first(i)["button"].isNotNull(), F.struct(F.lit(i).alias("rule"), first(i)["form"].alias("form"), first(i)["button"].alias("button"))) for i in range(len(rules))]
    seeds = pages.groupBy(F.col("page_id").alias("seed_id")).agg(F.max(F.trim(F.coalesce("seed", F.lit(""))) != "").alias("has_seed"))
    out = page.select("page_id", "f", F.array_min(F.array(*sent)).alias("s")).join(seeds, F.col("page_id").eqNullSafe(F.col("seed_id")))
    fill = F.col("has_seed") & F.col("f").isNotNull()
    either = lambda a, b: F.when(fill, a).otherwise(b)
    return out.filter(fill | F.col("s").isNotNull()).select(
        "page_id", either(F.lit("fill"), F.lit("submit")).alias("action"), either(F.col("f.rule"), F.col("s.rule")).alias("rule"), either(F.lit(None), F.col("s.button.rule")).alias("button_rule"), either(F.col("f.form"), F.col("s.form")).alias("form"),
        either(F.col("f.n"), F.col("s.button.n")).alias("control"), either(F.col("f.label"), F.col("s.button.label")).alias("control_id"), either(F.col("f.works"), F.lit(True)).alias("works"),
    )


def button_rules() -> list[Column]:
    """What makes a button one to click, in order."""
    role = _is(attribute("role"), "button")
    tag = F.col("tag") == "button"
    folded = _is(attribute("aria-expanded"), "false")
    return [tag & folded, role & folded, tag & F.array_contains("names", "aria-controls"), *(kind & F.contains("says", F.lit(x)) for x in BUTTON_WORDS for kind in (tag, role))]


def button_clicks(pages: DataFrame, limit: int = 3) -> DataFrame:
    """page_id, rank (from 1), rule, control, control_id of the buttons to click: for each rule the first button that it fits, if that isn't hidden
    and not in a link; the first `limit` of a page (a browser's budget of actions). A button may come under several rules."""
    c = controls(pages.select("page_id", "html")).filter("is_button")
    rules = F.array(*button_rules())
    seen = ~(F.array_contains("names", "hidden") | F.coalesce(F.replace(F.lower(attribute("style")), F.lit(" "), F.lit("")).contains("display:none"), F.lit(False)))
    each = c.select("page_id", "n", "in_link", seen.alias("seen"), F.coalesce(attribute("id"), attribute("name")).alias("label"), F.posexplode(rules).alias("rule", "yes")).filter("yes")
    first = each.groupBy("page_id", "rule").agg(F.min(F.struct("n", "label", "seen", "in_link")).alias("b")).filter("b.seen and not b.in_link")
    rank = F.row_number().over(Window.partitionBy("page_id").orderBy("rule"))
    return first.select("page_id", rank.alias("rank"), "rule", F.col("b.n").alias("control"), F.col("b.label").alias("control_id")).filter(F.col("rank") <= limit)
