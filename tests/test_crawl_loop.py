"""The crawl of all sources at once against one queue after another."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.crawl_loop import crawl_sources

PAGE = "url string, final_url string, rows int, good boolean, empty boolean, as_before boolean, not_found boolean"


def one_by_one(sources, entries, pages, links, guesses, fall_backs, max_pages, max_depth):
    page = {p[0]: p for p in pages}
    out = []
    for sid, world in sources:
        queue = deque((u, d, False) for _, _, u, d in sorted((e for e in entries if e[0] == sid), key=lambda e: (e[1], e[2])))
        visited, finals, got, lost, guessed, fell, found = set(), set(), 0, 0, False, False, False
        while queue and got < max_pages:
            url, depth, guess = queue.popleft()
            if url in visited or url in finals or url not in page:
                continue
            _, final, rows, good, empty, before, missing = page[url]
            if (final or url) in finals or (guess and lost >= 2):
                continue
            visited.add(url)
            finals.add(final or url)
            got += 1
            found |= rows > 0
            waiting = any(d < 0 for _, d, _ in queue)
            lost += guess and missing and rows <= 0
            stop = (depth < 0 and before and not waiting)
            leads = not (depth < 0 and rows <= 0)
            if not stop and leads:
                if world:
                    stop = good and not waiting
                elif depth >= 0 and empty:
                    stop = True
                elif depth >= max_depth:
                    stop = good
                else:
                    stop = good and not waiting
            out.append((sid, got, url, depth, bool(stop)))
            if stop:
                break
            if leads and not world and depth < max_depth:
                mine = sorted((pos, u) for s, p, pos, u in links if s == sid and p == url)
                queue.extend((u, depth + 1, False) for _, u in mine)
                if not mine and depth == 0 and not guessed:
                    guessed = True
                    queue.extend((u, 1, True) for _, u in sorted((pos, u) for s, pos, u in guesses if s == sid))
            rest = [u for u, _, g in queue if u in page and u not in visited]
            if not rest and depth < max_depth and guessed and not found and not fell and lost < 2:
                fell = True
                queue = deque((u, 1, False) for _, u in sorted((pos, u) for s, pos, u in fall_backs if s == sid))
    return sorted(out)


def web(seed, n_sources=25):
    rng = random.Random(seed)
    sources, entries, pages, links, guesses, falls = [], [], [], [], [], []
    for s in range(n_sources):
        names = [f"s{s}/{i}" for i in range(rng.randint(1, 40))]
        sources.append((s, rng.random() < 0.1))
        target = {u: rng.choice(names) if rng.random() < 0.1 else u for u in names}
        fixed = set(target.values())
        for u in names:
            rows = rng.choice([0, 0, 0, 1, 5]) if s % 3 else 0
            pages.append((u, u if u in fixed else target[u], rows, rows > 0 and rng.random() < 0.15, rows == 0 and rng.random() < 0.02, rows > 0 and rng.random() < 0.5, rng.random() < 0.3))
        for i in range(rng.randint(0, 3)):
            entries.append((s, i, rng.choice(names + [f"s{s}/gone"]), -1))
        entries.append((s, 100, names[0], 0))
        if rng.random() < 0.7:
            for u in names:
                links += [(s, u, i, v) for i, v in enumerate(rng.sample(names, min(len(names), rng.randint(0, 6))))]
        guesses += [(s, i, u) for i, u in enumerate(rng.sample(names, min(len(names), 5)))]
        falls += [(s, i, u) for i, u in enumerate(rng.sample(names, min(len(names), 4)))]
    return sources, entries, pages, links, guesses, falls


def frames(spark, w):
    kinds = ["source_id int, world boolean", "source_id int, pos int, url string, depth int", PAGE, "source_id int, page string, pos int, url string", "source_id int, pos int, url string", "source_id int, pos int, url string"]
    return [spark.createDataFrame(rows, k) for rows, k in zip(w, kinds)]


@pytest.mark.parametrize("seed,max_pages,max_depth", [(1, 8, 2), (2, 30, 3)])
def test_all_sources_at_once_visit_what_one_after_another_does(spark, seed, max_pages, max_depth):
    w = web(seed)
    got = sorted((r.source_id, r.number, r.url, r.depth, r.stop) for r in crawl_sources(*frames(spark, w), max_pages, max_depth).collect())
    assert got == one_by_one(*w, max_pages, max_depth) and len(got) > 100


def test_no_source_and_a_hub(spark):
    w = [[(1, False)], [], [], [], [], []]
    assert crawl_sources(*frames(spark, w)).count() == 0
    w = [[(1, False)], [(1, 0, "hub", 0)], [(u, None, 0, None, None, None, None) for u in ["hub", *(f"p{i}" for i in range(50))]], [(1, "hub", i, f"p{i}") for i in range(50)], [], []]
    assert [r.url for r in crawl_sources(*frames(spark, w), max_pages=4).orderBy("number").collect()] == ["hub", "p0", "p1", "p2"]
