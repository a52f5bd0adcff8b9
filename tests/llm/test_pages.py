from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from terrane.llm.neighbours import Graph, nearest_neighbours
from terrane.llm.queries import URL_RULES
from terrane.llm.url_filter import judge_urls

URLS = [
    "http://Example.COM/en/1", "https://www.example.com/en/", "http://a.b.www.example.com/en/x?y",
    "http://x.net/es/", "http://x.net/es", "http://x.net/fr/1#z", "nonsense", None, "http://", "",
    "a://b?c://d.com/", "http://com/", "http://notexample.com/en/1", "http://example.com?/en/",
    "http://listed.org/page?x=1", "http://listed.org/other", "http://x.net/es/listed",
    "http://" + "a." * 30_000 + "net/es/" + "p" * 30_000, "HTTP://listed.org/page\nmore",
]


def judged(url, listed):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        at = min([k for k in map(rest.find, "/?#") if k >= 0], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:at])
        path = rest[at:].split("?")[0].split("#")[0]
    best = None
    for rule_host, rule_path, verdict in URL_RULES:
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            best = max(best or (0,), (len(rule_host + rule_path), rule_host + rule_path, verdict))
    if best:
        return host, path, best[1], best[2]
    return host, path, None, "block" if host and (host, path) in listed else "allow"


def test_judge_urls(spark):
    pages = spark.createDataFrame(
        [(k % 17, url, "<p>", "x", 1) for k, url in enumerate(URLS + URLS[:4])],
        "page_id long, url string, html string, host string, key int",
    )
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    listed = spark.createDataFrame([("http://LISTED.org/page#top",), (None,), ("http://x.net/es/listed",)], "url string")
    known = {("listed.org", "/page"), ("x.net", "/es/listed")}
    found = judge_urls(pages, rules, listed).collect()
    expected = Counter((k % 17, *judged(url, known)) for k, url in enumerate(URLS + URLS[:4]))
    assert Counter(map(tuple, found)) == expected
    assert judge_urls(pages.limit(0), rules, listed).count() == 0
    bare = judge_urls(pages, rules.limit(0), listed.limit(0)).collect()
    assert {(row.rule, row.verdict) for row in bare} == {(None, "allow")}


def exact(rows, query, most):
    ids = np.array([key for key, _ in rows])
    vectors = np.array([vector for _, vector in rows], float)
    own = vectors[ids == query][0]
    distance = np.sqrt(((vectors - own) ** 2).sum(axis=1))
    order = [k for k in np.lexsort((ids, distance)) if ids[k] != query][:most]
    return [(int(ids[k]), float(distance[k])) for k in order]


def test_neighbours_of_a_random_table(spark):
    random = np.random.default_rng(1)
    rows = [(k, random.standard_normal(16).round(3).tolist()) for k in range(1500)]
    rows += [(2000 + k, rows[7][1]) for k in range(300)]  # copies of one vector
    odd = [(3000, None), (3001, [0.0] * 16), (3002, [float("nan")] * 16), (3003, [float("inf")] + [1.0] * 15)]
    odd += [(3004, []), (3005, [1.0]), (3006, [None] + [1.0] * 15), (None, [1.0] * 16)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    table = table.selectExpr("vec_id", "embedding", "1 AS node", "2 AS distance", "3 AS query")
    wanted = table.filter("vec_id % 25 = 0").select("vec_id")
    graph = Graph(degree=12, trees=2, leaf=100, beam=60)
    found = nearest_neighbours(table, wanted, 10, graph=graph).collect()
    by_query = {}
    for row in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        by_query.setdefault(row.query_id, []).append((row.vec_id, row.score))
    usable = [(k, np.float32(v).tolist()) for k, v in rows]
    assert sorted(by_query) == sorted(k for k, _ in rows if k % 25 == 0)
    hits = 0
    for query, near in by_query.items():
        truth = exact(usable, query, 10)
        assert len(near) == 10
        hits += len({k for k, _ in near} & {k for k, _ in truth})
        known = dict(exact(usable, query, len(rows)))
        assert all(abs(known[k] - score) < 1e-9 for k, score in near)
        assert near == sorted(near, key=lambda pair: (pair[1], pair[0]))
    assert hits >= 0.95 * 10 * len(by_query)


@pytest.mark.parametrize("far", [1e9, 1e200])
def test_neighbours_beside_a_far_vector(spark, far):
    random = np.random.default_rng(2)
    centres = random.standard_normal((60, 16))
    vectors = (centres[random.integers(0, 60, 3000)] + 0.3 * random.standard_normal((3000, 16))).round(4)
    rows = [(k, row) for k, row in enumerate(vectors.tolist())]
    table = spark.createDataFrame([*rows, (5000, [far] + [0.5] * 15)], "vec_id long, embedding array<double>")
    graph = Graph(degree=8, trees=3, leaf=80, rounds=3, beam=20, steps=3)  # sees a small part of the table
    found = nearest_neighbours(table, table.filter("vec_id % 50 = 0 AND vec_id < 3000"), 10, graph=graph).collect()
    truth = {k: {near for near, _ in exact(rows, k, 10)} for k in range(0, 3000, 50)}
    assert len(found) == 600
    assert sum(row.vec_id in truth[row.query_id] for row in found) >= 0.9 * 600


def test_neighbours_of_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert nearest_neighbours(spark.createDataFrame([], schema), spark.createDataFrame([(1,)], "vec_id long")).count() == 0
    few = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [4.0, 6.0])], schema)
    found = nearest_neighbours(few, few.select("vec_id")).collect()
    pairs = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found)
    assert pairs == [
        (1, 1, 2, 0.0), (1, 2, 3, 5.0), (2, 1, 1, 0.0), (2, 2, 3, 5.0), (3, 1, 1, 5.0), (3, 2, 2, 5.0),
    ]
