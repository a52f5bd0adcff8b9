from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from terrane.llm.fill_in_middle import cut_texts, fill_in_middle, restore, unit_counts

UNITS = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def by_hand(doc_id, text, seed=42, rate=50, spm=80):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in range(0, 32, 8))
    units = UNITS.findall(text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if h4 % 100 < spm:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}", text
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}", text


EXTRA = [
    "<", "<P", "S> <S", "a <M> b", "\x00 \x0b\x0c\x1c \x85  x", "tail  ", "  head", "\n\n", "é ü\t漢字 😀 end\r\n",
    "a" * 70_000 + " b", " " * 70_000,
]


def test_forms_pieces_and_restoring(spark, odd):
    texts = [(k, text) for k in range(100, 140) for text in EXTRA]
    docs = odd.unionByName(spark.createDataFrame(texts, "doc_id long, text string"), allowMissingColumns=True)
    docs = docs.selectExpr("*", "'x' AS form", "'y' AS output", "1 AS n", "2 AS h1", "'z' AS restored")
    for seed, rate, spm in ((42, 50, 80), (7, 100, 30), (1, 0, 0)):
        found = restore(fill_in_middle(docs, seed=seed, rate=rate, spm=spm)).collect()
        rows = [(row.doc_id, row.text) for row in docs.select("doc_id", "text").collect()]
        assert Counter(map(tuple, found)) == Counter(by_hand(*row, seed, rate, spm) for row in rows)


def test_empty_table(nothing):
    assert restore(fill_in_middle(nothing)).count() == 0


def test_restore_keeps_other_columns(spark):
    rows = [(1, "a", "spm", "<S>c<P>a <M>b"), (2, "b", "plain", "<S>"), (3, None, None, None)]
    frame = spark.createDataFrame(rows, "k int, other string, form string, output string")
    assert [row.restored for row in restore(frame).orderBy("k").collect()] == ["a bc", "<S>", ""]
    assert restore(frame).columns == ["k", "other", "form", "output", "restored"]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab é漢😀 \t\n\x0b\x1c <>PSM\x00", min_size=1, max_size=40), st.data())
def test_cuts_are_those_of_the_expression(text, data):
    import numpy as np
    import pyarrow as pa

    units = UNITS.findall(text)
    column = pa.array([text.encode()], pa.large_binary())
    assert unit_counts(column).tolist() == [len(units)]
    a = data.draw(st.integers(0, len(units)))
    b = data.draw(st.integers(a, len(units)))
    pieces = cut_texts(column, np.array([a]), np.array([b]))
    assert [p[0].as_py().decode() for p in pieces] == ["".join(units[i:j]) for i, j in ((0, a), (a, b), (b, None))]


@pytest.mark.parametrize("name", ["op13_fill_in_middle"])
def test_query_on_a_larger_table(spark, name):
    from oracle import compare, connect

    from terrane.llm.queries import ORACLES, QUERIES

    sf_dir = "/root/testdata/sf0.01"
    assert compare(QUERIES[name](spark, sf_dir).toPandas(), connect(sf_dir).execute(ORACLES[name]).fetchdf()) is None
