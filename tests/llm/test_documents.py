from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.linalg import DenseVector

from terrane.llm import jaccard_join
from terrane.llm.jaccard_join import (
    _SHORT,
    Limits,
    _Shorts,
    folded,
    jaccard_components,
    keep_one,
    may_link,
    signature,
)
from terrane.llm.pii import FEATURES, KINDS, Training, _apart, fit_trees, personal_data, redact
from terrane.llm.quality import Bands, Judge, beyond, keep_quality, learn_bands, outside, quality
from terrane.llm.sharding import Block, minimax_cuts, shard
from terrane.llm.toxicity import BUCKETS, Learning, drop_toxic, fit_member, learn, score_toxicity

WORDS = r"[^\x20\x09-\x0D]+"


def words_of(text):
    return re.findall(WORDS, text or "")


# --- quality ----------------------------------------------------------------------------


def judged(text, bands=Bands()):
    text = text or ""
    words, raw = words_of(text), text.encode()
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    counts, inside = Counter(windows), set()
    for k, window in enumerate(windows):
        if counts[window] > 1:
            inside.update(range(k, k + 8))
    lines, seen, repeated = text.split("\n"), set(), 0
    for line in lines:
        if words_of(line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    ratio = lambda part: len(part) / len(zstandard.ZstdCompressor(level=3).compress(part))
    kept = bool(raw) and not failed and not outside(ratio(raw), len(raw), bands)
    chunks = [raw[k : k + bands.chunk_bytes] for k in range(0, len(raw), bands.chunk_bytes)]
    bad = [outside(ratio(c), len(c), bands) for c in chunks if len(c) >= bands.least_chunk]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated,
        len(inside), failed, kept and sum(bad) <= bands.bad_chunks * len(bad),
    )


def test_quality(documents, odd, nothing):
    both = documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    found = quality(both).drop("ratio", "bad_chunk_share").collect()
    assert Counter(map(tuple, found)) == Counter((r.doc_id, *judged(r.text)) for r in both.collect())
    kept = [r for r in documents.collect() if judged(r.text)[-1]]
    assert Counter(keep_quality(documents).collect()) == Counter(kept)
    assert keep_quality(odd).columns == odd.columns
    assert quality(nothing).count() == keep_quality(nothing).count() == 0


SIZES = (250, 600, 1_500, 3_000, 8_000, 30_000)


def junk_of(size, random):
    """Base64 in lines and in short words, and prose of which half says one thing over."""
    raw = base64.b64encode(random.bytes(size))[:size].decode()
    yield "\n".join(raw[k : k + 76] for k in range(0, size, 76))
    yield " ".join(raw[k : k + 7] for k in range(0, size, 8))
    yield prose(size // 2, random) + "on and on and on " * (size // 34)


def prose(size, random):
    letters = np.array(list("eeeetttaaoooiinnsshhrrddlucmwfgypbvk"))
    if not hasattr(prose, "words"):
        fixed = np.random.default_rng(5)
        prose.words = np.array(["".join(fixed.choice(letters, fixed.integers(2, 9))) for _ in range(3000)])
    rank = np.minimum(random.zipf(1.3, size // 3), 3000) - 1
    return " ".join(prose.words[rank])[:size]


def test_limits_from_clean_texts(spark):
    random = np.random.default_rng(3)
    clean = [prose(int(200 * 2 ** random.uniform(0, 7.5)), random) for _ in range(1500)]
    docs = spark.createDataFrame(list(enumerate(clean)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1) for k in range(1500)] + [(0, None), (None, 1)], "doc_id long, quality int")
    bands = learn_bands(docs, labels)
    judge = Judge(bands)
    for size in SIZES:
        assert not any(judge(text.encode())[-1] for text in junk_of(size, random)), size
    kept = [judge(text.encode())[-1] for k, text in enumerate(clean) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert np.mean(kept) > 0.97
    for size in (1_024, 2_000, 4_096):  # chunks are judged by limits of their own
        for text in list(junk_of(size, random))[:2]:
            assert beyond(judge.ratio(text.encode()), size, bands.chunk)
    mixed = prose(12_288, random) + next(junk_of(4_096, random))  # one chunk in four
    assert not judge(mixed.encode())[-1] and judge(mixed.encode())[-2] == 0.25
    assert learn_bands(docs, labels.limit(0)) == learn_bands(docs.limit(0), labels) == Bands()
    general = Judge(Bands())
    for size in SIZES[1:]:
        assert not any(general(text.encode())[-1] for text in list(junk_of(size, random))[:2]), size


def test_limits_from_every_clean_text(spark):
    """30,000 clean texts: those that a draw of 20,000 by hash left out teach as well, and so do
    chunks beyond the eighth of a text."""
    short = " ".join(f"{k * 7919 % 9973:x}" for k in range(25))
    docs = spark.range(30_000).selectExpr("id AS doc_id", "pmod(xxhash64(1, id), 1 << 30) AS drawn")
    left_out = f"drawn >= {int(0.9 * (1 << 30))}"  # 20,000 of 24,000 not held out
    longer = " ".join(f"{k * 7919 % 9973:x}" for k in range(300))
    docs = docs.selectExpr("doc_id", f"if({left_out}, '{longer}', '{short} ' || doc_id) AS text")
    labels = docs.selectExpr("doc_id", "1 AS quality")
    below = [band[0] for band in learn_bands(docs, labels).whole]
    assert len(longer) + 1 in below
    random = np.random.default_rng(4)
    chunks = [prose(8 * 4096, random)[: 8 * 4096].ljust(8 * 4096, "e") + "same old words " * 274 for _ in range(260)]
    docs = spark.createDataFrame(list(enumerate(chunks)), "doc_id long, text string")
    learnt = learn_bands(docs, docs.selectExpr("doc_id", "1 AS quality"))
    assert learnt.chunk[-1][2] > 20


# --- personal data ----------------------------------------------------------------------

PATTERNS = {  # as the contract states them
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CASES = [
    "a@b.c_d@e.f x@y", "😀 a@b.co", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4", "+1(((((((",
    "4111 1111 1111 1111 2 3 +1 (389) 555-5010 4111111111111111", "+12 345 678 901 ",
    "\x01a@b.co\x01", "4111-1111-1111-1111", "1" * 30, "a@b..c a.@.b", "\n+49 30 1234567\n",
    "a." * 3000 + "@b" + ".c" * 3000, "1-" * 3000 + "1", "+" + "1 " * 3000,
]


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text):
    found = []
    for number, kind in enumerate(KINDS):
        for match in re.finditer(PATTERNS[kind], text):
            digits = re.sub("[^0-9]", "", match[0])
            right = {
                "email": True,
                "ip": kind == "ip" and all(int(part) <= 255 for part in match[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if right:
                found.append((match.start(), number, match.end(), kind))
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found)]


def test_trees_from_every_candidate(spark):
    """24,000 candidates: the 4,000 that come last by hash teach the trees as well."""
    found = spark.range(24_000).selectExpr("id AS text_key", "'card' AS kind", "0L AS start", "true AS base")
    places = [r[0] for r in found.selectExpr("xxhash64(1, text_key, kind, start) AS place").orderBy("place").collect()]
    found = found.selectExpr("*", f"xxhash64(1, text_key, kind, start) >= {places[20_000]} AS valid")
    rows = found.selectExpr("*", *[f"double(valid) AS {name}" for name in FEATURES])
    model, _ = fit_trees(rows, Training(trees=1, depth=2))
    assert model.numFeatures == len(FEATURES)
    assert model.predict(DenseVector([1.0] * len(FEATURES))) == 1.0
    assert model.predict(DenseVector([0.0] * len(FEATURES))) == 0.0


def test_personal_data(spark, documents, odd, nothing):
    cases = spark.createDataFrame([(10_000 + k, text) for k, text in enumerate(CASES)], "doc_id long, text string")
    both = documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text")).unionByName(cases)
    texts = defaultdict(list)
    for row in both.collect():
        texts[row.doc_id].append(row.text or "")
    rows = personal_data(both).collect()
    assert len(rows) == both.count()
    expected = Counter()
    for key, of_key in texts.items():
        for text in of_key:
            spans = base_spans(text)
            counts = [sum(s.startswith(kind + ":") for s in spans) for kind in KINDS]
            expected[(key, *counts, hashlib.sha256(",".join(spans).encode()).hexdigest())] += 1
    assert Counter(tuple(r)[:6] for r in rows) == expected
    for row in rows:
        if len(texts[row.doc_id]) == 1:
            assert set(base_spans(texts[row.doc_id][0])) <= set(row.spans.split(","))
    assert personal_data(nothing).count() == 0


def test_added_spans_give_way_only_to_kept_ones(spark):
    """Walked from the left: a span that was dropped stands in no other's way."""
    dice, rows = random.Random(8), []
    for row in range(120):
        for _ in range(dice.randint(0, 12)):
            start = dice.randint(0, 40)
            rows.append((row, row, 0, dice.choice(KINDS), start, start + dice.randint(1, 9)))
    rows = list(dict.fromkeys(rows))
    frame = spark.createDataFrame(rows, "row_id long, doc_id long, text_key long, kind string, start long, end long")
    expected = Counter()
    for row in range(120):
        at = 0
        for _, kind, start, end in sorted(((r[4], -r[5]), r[3], r[4], r[5]) for r in rows if r[0] == row):
            if start >= at:
                expected[(row, kind, start, end)] += 1
                at = end
    found = _apart(frame, ["row_id", "doc_id", "text_key"]).select("row_id", "kind", "start", "end").collect()
    assert Counter(map(tuple, found)) == expected
    assert _apart(frame.limit(0), ["row_id", "doc_id", "text_key"]).count() == 0


def test_redact(odd, nothing):
    rows = redact(odd).collect()
    assert redact(odd).columns == odd.columns and len(rows) == odd.count()
    (mail,) = [row.text for row in rows if row.doc_id == 7]
    assert mail == "mail me at [EMAIL] or [PHONE]\x01 😀 é ▁ <s>"
    assert sum(row.text is None for row in rows) == 2
    assert redact(nothing).count() == 0


# --- near duplicates ----------------------------------------------------------------------


def brute_components(rows):
    sets = []
    for _, text in rows:
        words = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        runs = [tuple(words)] if 0 < len(words) < 5 else [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        sets.append(frozenset(runs))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    shared, index = Counter(), defaultdict(list)
    for k, own in enumerate(sets):
        for run in own:
            shared.update((other, k) for other in index[run])
            index[run].append(k)
    for (a, b), overlap in shared.items():
        if 100 * overlap >= 75 * (len(sets[a]) + len(sets[b]) - overlap):
            parent[find(b)] = find(a)
    least = {}
    for k, (key, _) in enumerate(rows):
        if key is not None:
            least[find(k)] = min(key, least.get(find(k), key))
    return Counter((key, len(sets[k]), least.get(find(k))) for k, (key, _) in enumerate(rows))


@pytest.mark.parametrize("limits", [Limits(), Limits(1000, 1, 3, 2)])
def test_jaccard_components(spark, documents, odd, limits):
    # A chain of near copies each of which differs a little from the one before.
    base = [f"w{k}" for k in range(60)]
    chain = []
    for k in range(40):
        base = base[1:] + [f"x{k}"] if k % 3 else base[:-1] + [f"y{k}"]
        chain.append((20_000 + k, " ".join(base)))
    more = spark.createDataFrame(chain, "doc_id long, text string")
    both = documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text")).unionByName(more)
    found = jaccard_components(both, limits).drop("class").collect()
    assert Counter(map(tuple, found)) == brute_components([tuple(r) for r in both.collect()])


def test_near_copies_about_the_threshold(spark):
    """Copies of which each has a few words of its own: most pairs are just under 0.75."""
    dice = random.Random(4)
    base, rows = [f"w{dice.randrange(900)}" for _ in range(200)], []
    for k in range(250):
        words = list(base)[: dice.randrange(170, 200)] if k % 5 == 0 else list(base)
        for _ in range(3 + k % 3):
            words[dice.randrange(len(words))] = f"z{dice.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = jaccard_components(frame).drop("class").collect()
    assert Counter(map(tuple, found)) == brute_components(rows)


def near_families(n):
    """Two families of near copies, longer ones and shorter ones, that follow leaders of their
    own; every member of one links to every member of the other."""
    base = [f"w{k}" for k in range(194)]
    rows = [(0, " ".join(base[:144]))]
    for k in range(n):
        for family, words in enumerate((base[:164], base)):
            words = list(words)
            words[20 + k % 100] = f"u{family}x{k}"
            rows.append((len(rows), " ".join(words)))
    return rows


def test_jaccard_rows_follow_the_sets(spark, monkeypatch):
    """Of two families that all link, what is staged grows with the sets, not with their pairs."""
    staged, made = jaccard_join.staged, []

    def counted(frame, name):
        frame = staged(frame, name)
        made.append((frame.count(), name))
        return frame

    monkeypatch.setattr(jaccard_join, "staged", counted)
    rows = near_families(120)  # 14,400 pairs between the families
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).drop("class").collect()
    assert Counter(map(tuple, found)) == brute_components(rows)
    lists = next(count for count, name in made if name == "shingle-lists")
    assert max(made) == (lists, "shingle-lists") and any(name == "met" for _, name in made)


@pytest.mark.parametrize("together", [1_500_000, 4_000])
def test_sets_meet_in_dense_lists(spark, monkeypatch, together):
    """Dense lists of sets that link and of sets that nearly do, whole and cut into cells."""
    monkeypatch.setattr(jaccard_join, "FEW", 0)
    monkeypatch.setattr(jaccard_join, "TOGETHER", together)
    dice = random.Random(5)
    rows = [(key, text) for key, text in near_families(40)]
    base = [f"v{dice.randrange(900)}" for _ in range(200)]
    for k in range(150):
        words = list(base)[: dice.randrange(140, 200)]
        for _ in range(2 + k % 4):
            words[dice.randrange(len(words))] = f"z{dice.randrange(10**6)}"
        rows.append((1000 + k, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for rounds in (0, 1):
        found = jaccard_components(frame, Limits(rounds=rounds)).drop("class").collect()
        assert Counter(map(tuple, found)) == brute_components(rows)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.integers(0, 400), st.integers(0, 400), st.integers(0, 10**6))
def test_signatures_rule_out_no_link(shared, one, two, seed):
    values = np.random.default_rng(seed).integers(0, 1 << 48, shared + one + two).astype(np.uint64)
    a, b = np.unique(values[: shared + one]), np.unique(np.delete(values, np.s_[shared : shared + one]))
    overlap = len(np.intersect1d(a, b))
    if 100 * overlap >= 75 * (len(a) + len(b) - overlap):
        assert may_link(signature(a), signature(b), len(a), len(b))
        words = [np.frombuffer(folded(signature(x), 64).ljust(64, b"\0"), "<i8") for x in (a, b)]
        rows = {name: np.array([w[k] for w in words]) for k, name in enumerate(_SHORT)}
        assert _Shorts({**rows, "size": np.array([len(a), len(b)])}).open(np.array([0]), np.array([1])).all()
    elif overlap < (len(a) + len(b)) / 5 and min(len(a), len(b)) >= max(100, 3 * max(len(a), len(b)) / 4):
        assert not may_link(signature(a), signature(b), len(a), len(b))


def test_keep_one(documents, odd, nothing):
    found = jaccard_components(documents).drop("class").toPandas()
    kept = sorted(row.doc_id for row in keep_one(documents).collect())
    assert kept == sorted(found.component_id.unique())
    rows = keep_one(odd).collect()
    assert keep_one(odd).columns == odd.columns
    assert sum(row.doc_id == 1 for row in rows) == 1
    assert sum(not words_of(row.text) for row in rows) == 4
    assert jaccard_components(nothing).count() == keep_one(nothing).count() == 0


# --- toxicity -------------------------------------------------------------------------------


def test_toxicity(spark, odd, nothing):
    clean = [f"plain{k % 50} words{k % 7} about{k % 11} nothing much{k % 13}" for k in range(600)]
    texts = [t + (" you vile" + "abcde"[k % 5] + " fool" if k % 6 == 0 else "") for k, t in enumerate(clean)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame(
        [(k, int(k % 6 == 0)) for k in range(600) if k // 6 % 2 == 0] + [(0, None), (None, 1)],
        "doc_id long, toxic int",
    )
    model = learn(docs, labels)
    rows = score_toxicity(docs, model).collect()
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) for row in rows)
    held = [row for row in rows if row.held_out]
    assert np.mean([row.predicted == (row.doc_id % 6 == 0) for row in held]) > 0.95
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(binary(string(doc_id))) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    again = score_toxicity(docs, learn(docs, flipped)).collect()
    assert Counter(rows) == Counter(again)  # held-out labels are not read
    scored = score_toxicity(odd, model).collect()
    assert len(scored) == odd.count() and all(0 <= row.score <= 1 for row in scored)
    assert drop_toxic(odd, model).columns == odd.columns
    assert score_toxicity(nothing, model).count() == 0
    none = score_toxicity(odd, learn(nothing, labels.limit(0))).collect()
    assert {row.score for row in none} == {0.0}


@pytest.mark.parametrize("confirmed, missed, share", [(900, 0.02, 1 / 30), (3000, 0.02, 0.02), (3000, 0.04, 0.04)])
def test_threshold_follows_missed(confirmed, missed, share):
    random = np.random.default_rng(0)

    def text(most):
        signs = random.integers(0, 200, random.integers(2, most)) if most else []
        return np.unique(np.concatenate([signs, random.integers(1000, 1400, 5)])).astype(np.int64)

    positive = [text(30) for _ in range(confirmed)]
    unlabelled = [text(0) for _ in range(2160)] + [text(30) for _ in range(240)]
    used, known, bias = fit_member(positive, unlabelled, 0.1, Learning(missed=missed), 1)
    weights = np.zeros(BUCKETS)
    weights[used] = known
    scores = np.array([weights[row].sum() + bias for row in positive])
    assert bias < 0 and abs((scores < -1e-9).mean() - share) < 0.005


# --- sharding --------------------------------------------------------------------------------


def brute_cuts(sizes, shards):
    def shards_for(capacity):
        used, left = 1, capacity
        for size in sizes:
            if size > left:
                used, left = used + 1, capacity
            left -= size
        return used

    capacity = max(sizes)
    while shards_for(capacity) > shards:
        capacity += 1
    ends, filled, total = [], 0, 0
    for size in sizes:
        if filled + size > capacity:
            ends.append(total)
            filled = 0
        filled, total = filled + size, total + size
    return [*ends, total]


def test_minimax_cuts():
    chosen = np.random.default_rng(5)
    for _ in range(150):
        sizes = chosen.choice([1, 2, 8, 30, 77], chosen.integers(1, 200)).tolist()
        ends, width = np.cumsum(sizes), int(chosen.choice([50, 500, 5000]))

        def blocks(values, key):
            found = defaultdict(list)
            for value in values.tolist():
                found[key(value)].append(value)
            return [Block(min(v), max(v), len(v) <= 2) for v in found.values()]

        def inside(doubt):
            out = []
            for b in doubt:
                step = -(-(b.last - b.first + 1) // 4)
                own = ends[(ends >= b.first) & (ends <= b.last)]
                out += blocks(own, lambda v: (v - b.first) // step)
            return out

        shards = int(chosen.integers(1, 12))
        assert minimax_cuts(blocks(ends, lambda v: v // width), shards, inside) == brute_cuts(sizes, shards)


def test_shard(documents, odd, nothing):
    both = documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    rows = shard(both, 5).collect()
    texts = [(r.doc_id, r.text) for r in both.collect()]
    expected = Counter((k, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for k, t in texts)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == expected
    groups = defaultdict(lambda: [None, 0])
    for key, text in texts:
        group = groups[text]
        group[0] = key if group[0] is None else min(group[0], key if key is not None else group[0])
        group[1] += len((text or "").encode()) + 8
    home = defaultdict(set)
    slots = defaultdict(list)
    for row in rows:
        home[row.text_crc32, row.size].add(row.shard)
        slots[row.shard].append(row.slot)
    assert all(len(found) == 1 for found in home.values())
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())
    assert shard(nothing, 5).count() == 0
