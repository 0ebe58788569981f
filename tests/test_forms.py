"""Forms and buttons of captured pages, against a reader that walks each page's tags one by one."""

import random
from html.parser import HTMLParser

from ledgerline.operators import forms


class Reader(HTMLParser):
    """Elements with their parents, in the order of the page."""

    def __init__(self):
        super().__init__()
        self.all, self.open = [], []

    def handle_starttag(self, tag, attrs):
        seen = {}
        for k, v in attrs:
            seen.setdefault(k, v or "")
        e = {"tag": tag, "a": seen, "up": [*self.open], "text": ""}
        self.all.append(e)
        if tag not in forms.VOID:
            self.open.append(e)

    def handle_endtag(self, tag):
        for e in reversed(self.open):
            if e["tag"] == tag:
                self.open.remove(e)
                break

    def handle_data(self, data):
        for e in self.open:
            e["text"] += data


def read(html):
    r = Reader()
    r.feed(html)
    for e in r.all:
        e["form"] = next((u for u in reversed(e["up"]) if u["tag"] == "form"), None)
        e["says"] = " ".join(e["text"].lower().split())
    return r.all


def has(e, name, word):
    return word in e["a"].get(name, "").lower()


def name_of(e):
    return e["a"].get("id", e["a"].get("name"))


def choice(html, seed):
    found = read(html)
    inputs = [e for e in found if e["tag"] == "input" and e["form"]]
    fields = [lambda e, x=x: has(e, "name", x) for x in forms.FIELD_NAMES] + [lambda e: e["a"].get("name", "").lower() == "s", lambda e: has(e, "name", "keyword")]
    fields += [lambda e, x=x: has(e, "placeholder", x) for x in forms.FIELD_HINTS] + [lambda e, a=a, x=x: e["a"].get("type", "").lower() == "search" and has(e["form"], a, x) for a, x in forms.SEARCH_FORMS]
    if (seed or "").strip():
        for i, rule in enumerate(fields):
            for e in inputs:
                if rule(e):
                    return "fill", i, None, name_of(e)
    inside = lambda f: [e for e in found if e["form"] is f]
    kinds = [lambda f, a=a, x=x: has(f, a, x) for a, x in forms.SEARCH_FORMS]
    kinds += [lambda f, t=t, x=x: any(e["tag"] == t and has(e, "name", x) for e in inside(f)) for t, xs in (("input", forms.FORM_INPUTS), ("select", forms.FORM_SELECTS)) for x in xs]
    buttons = [lambda e, t=t: e["tag"] == t and e["a"].get("type", "").lower() == "submit" for t in ("button", "input")] + [lambda e, x=x: e["tag"] == "button" and x in e["says"] for x in forms.SEND_WORDS]
    for i, rule in enumerate(kinds):
        for f in [f for f in found if f["tag"] == "form" and rule(f)][:1]:
            for j, fits in enumerate(buttons):
                for e in inside(f):
                    if fits(e):
                        return "submit", i, j, name_of(e)
    return None


def clicks(html, limit):
    found, out = read(html), []
    tag, role = (lambda e: e["tag"] == "button"), (lambda e: e["a"].get("role", "").lower() == "button")
    rules = [lambda e, k=k: k(e) and e["a"].get("aria-expanded", "").lower() == "false" for k in (tag, role)] + [lambda e: tag(e) and "aria-controls" in e["a"]]
    rules += [lambda e, k=k, x=x: k(e) and x in e["says"] for x in forms.BUTTON_WORDS for k in (tag, role)]
    for i, rule in enumerate(rules):
        for e in [e for e in found if rule(e)][:1]:
            linked = any(u["tag"] == "a" and "href" in u["a"] for u in [*e["up"], e])
            if "hidden" not in e["a"] and "display:none" not in e["a"].get("style", "").replace(" ", "") and not linked:
                out.append((i, name_of(e)))
    return out[:limit]


def page(r):
    n = iter(range(999))
    pick = lambda *xs: r.choice(xs)
    quoted = lambda v: pick(f'"{v}"', f"'{v}'")

    def button():
        words = pick("Search", "Find  a\n meeting", "S<b>how</b> more", "Go", "FILTER", "next", "<i>Load</i> <span>more</span>", "a < b find")
        extra = pick("", " type=submit", " TYPE='Submit'", " aria-expanded=false", " aria-controls", " hidden", ' style="display: none"', " role=button")
        b = f"<{pick('button', 'button', 'div')} id=b{next(n)}{extra}>"
        end = b[1:].split()[0]
        b = f"{b}{words}</{end}>"
        return pick(b, b, f"<a href='/x?a>b'>{b}</a>", f"<a name=x>{b}</a>")

    def control():
        name = pick("City", "zip_code", "q", "s", "S2", "keyword", "location", "group", "meeting-day", "foo", "")
        return pick(
            f"<input name={quoted(name)} id='i{next(n)}' placeholder={quoted(pick('Your city', 'Search > all', 'x', ''))} type={pick('search', 'text', 'Submit', 'hidden')}>",
            f"<select name={quoted(pick('Day', 'types', 'x'))} id=s{next(n)}><option>Find</select>", button(), "<p>some <b>words", "<!-- <form><button id=no>search</button> -->", "<script>if (a) '<button id=no2>find</button>'</script>",
        )

    def form():
        attrs = pick("", " id='Meeting-finder'", ' class="x groups"', " aria-label='All Meetings'", " id=f", " data-class=meeting")
        return f"<form{attrs}>{''.join(control() for _ in range(r.randrange(6)))}</form>"

    return "".join(pick(form, form, control)() for _ in range(r.randrange(6)))


def test_choices_equal_a_reader(spark):
    r = random.Random(5)
    rows = [(i, page(r).replace("a < b", "a &lt; b"), r.choice(["Cork", "", None])) for i in range(500)]
    df = spark.createDataFrame(rows, "page_id long, html string, seed string")
    got = {x.page_id: (x.action, x.rule, x.button_rule, x.control_id) for x in forms.form_choices(df).collect()}
    want = {i: w for i, html, seed in rows if (w := choice(html, seed))}
    assert got == want and len({w[:3] for w in want.values()}) > 25
    found = {}
    for x in forms.button_clicks(df, 4).orderBy("page_id", "rank").collect():
        found.setdefault(x.page_id, []).append((x.rule, x.control_id))
    assert found == {i: c for i, html, _ in rows if (c := clicks(html, 4))}


def test_odd_pages(spark):
    html = '<form id=meeting><input name=city type=hidden id=c><button>Find'
    rows = [(1, html, "x", "a"), (1, html, None, "b"), (None, html, " ", "c"), (2, None, "x", "d"), (3, "", "x", "e"), (4, "<form" * 1000 + '"' * 5001 + ">" + "<" * 20000, "x", "f"), (5, "<p>" * 100000 + html, None, "g")]
    df = spark.createDataFrame(rows, "page_id long, html string, seed string, form string")
    got = {x.page_id: (x.action, x.works) for x in forms.form_choices(df).collect()}
    assert got == {1: ("fill", False), None: ("submit", True), 5: ("submit", True)}
    assert forms.form_choices(df.limit(0)).count() == 0 and forms.button_clicks(df.limit(0)).count() == 0
    plan = forms.form_choices(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
