from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from oracle import compare, connect

from terrane.llm.common import KeyFilter
from terrane.llm.decontamination import contamination, drop_contaminated
from terrane.llm.queries import ORACLES, QUERIES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def by_hand(docs, items, window):
    windows = {}
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for k in range(len(words) - size + 1 if size else 0):
            windows.setdefault(tuple(words[k : k + size]), set()).add(item)
    found = []
    for doc_id, text in docs:
        words, hit, ids = words_of(text), set(), set()
        for size in sorted({len(w) for w in windows}):
            for k in range(len(words) - size + 1):
                if tuple(words[k : k + size]) in windows:
                    hit.update(range(k, k + size))
                    ids |= windows[tuple(words[k : k + size])]
        ids = tuple(sorted(str(item) for item in ids if item is not None))
        found.append((doc_id, len(words), len(hit), ids))
    return Counter(found)


def found_by(spark, docs, items, window):
    result = contamination(docs, items, window=window)
    sets = {row.item_set: tuple(row.item_ids) for row in result.item_sets.collect()}
    rows = result.documents.collect()
    for row in rows:
        spans = row.spans or []
        assert sum(end - start for start, end in spans) == row.n_hit
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    return Counter((r.doc_id, r.n_words, r.n_hit, sets.get(r.item_set, ())) for r in rows)


@pytest.mark.parametrize("window", [4, 10])
def test_random_texts_of_few_words(spark, window):
    dice = random.Random(window)
    vocabulary = ["a", "B", "c", "dé", "漢字", "E", "f1", "x" * 90]

    def text(most):
        return "".join(dice.choice(vocabulary) + dice.choice([" ", ", ", "\n", "-"]) for _ in range(dice.randint(0, most)))

    items = [(k % 25, text(14)) for k in range(40)] + [(None, "q w e r t y"), (90, None), (91, " ,. "), (92, "lone")]
    items += [(93, "The answer of the many words that all of the items share in full here")] * 2
    items += [(k, "the answer of the many words that all of the items share in full here") for k in range(94, 130)]
    docs = [(k, text(60)) for k in range(150)] + [(1, ""), (2, None), (None, text(50)), (3, "LONE star. q,w,e,r,t,y!")]
    docs += [(k, f"so {k} the answer, of the many words that all of the ITEMS share in full here, {k}") for k in range(200)]
    docs += [(500, "pad " * 40_000 + items[0][1] + " pad" * 9), (501, "y" * 200_000 + " lone " + "y" * 200_000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS row", "'x' AS words", "2 AS item_id")
    item_frame = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS length", "2 AS hash")
    assert found_by(spark, frame.repartition(5), item_frame, window) == by_hand(docs, items, window)


def test_empty_tables(spark, odd, nothing):
    items = odd.selectExpr("doc_id AS item_id", "text")
    assert contamination(nothing, items).documents.count() == 0
    clean = contamination(odd, items.limit(0))
    assert clean.documents.count() == odd.count() and clean.item_sets.count() == 0
    assert {row.n_hit for row in clean.documents.collect()} == {0}
    rows = [(row.doc_id, row.text) for row in odd.select("doc_id", "text").collect()]
    assert found_by(spark, odd, items, 10) == by_hand(rows, rows, 10)


def test_drop_contaminated(spark, odd):
    items = spark.createDataFrame([(1, "word word word")], "item_id int, text string")
    kept = drop_contaminated(odd, items)
    assert kept.columns == odd.columns
    assert kept.count() == odd.count() - 1
    assert drop_contaminated(odd, items, most=1.0).count() == odd.count()


def test_a_full_filter_passes_more_but_loses_nothing(spark):
    keys = np.random.default_rng(3).integers(-(2**63), 2**63 - 1, 20_000)
    frame = spark.createDataFrame([(int(k),) for k in keys], "k long").repartition(4)
    others = np.random.default_rng(4).integers(0, 2**63 - 1, 100_000).astype(np.uint64)
    for most, share in ((1 << 20, 0.002), (4096, 1.0)):
        held = KeyFilter.of(frame, "k", most)
        assert held.words.nbytes <= most
        assert len(held.found(keys.astype(np.uint64))) == len(keys)
        assert len(held.found(others)) <= share * len(others)
    assert len(KeyFilter.of(frame.limit(0), "k").found(others)) == 0


def test_query_on_a_larger_table(spark):
    sf_dir, name = "/root/testdata/sf0.01", "op11_decontamination"
    found = QUERIES[name](spark, sf_dir).toPandas()
    assert found.contaminated.any()
    assert compare(found, connect(sf_dir).execute(ORACLES[name]).fetchdf()) is None
