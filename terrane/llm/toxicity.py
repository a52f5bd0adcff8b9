"""Toxicity by non-negative positive-unlabelled learning on words and their stems."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.llm.common import batch_rows, documents_of, map_arrow, staged, text_bytes

BATCH_BYTES = 4 << 20
BUCKETS = 1 << 20
STEMS = (4, 5, 6)  # bytes of a word's beginning that count as features beside the word


@dataclass(frozen=True)
class Learning:
    """Each of `members` classifiers learns from its own sample: at most `positives`
    confirmed toxic texts and `unlabelled` others, those first by hash. Features are left out
    that fewer than `least_texts` of the sample have, or whose shares among the two kinds are
    less than `least_deviations` standard deviations apart."""

    members: int = 3
    positives: int = 2_000
    unlabelled: int = 6_000
    least_texts: int = 4
    least_deviations: float = 3.5
    epochs: int = 30
    batch: int = 500
    rate: float = 0.5
    sparsity: float = 1e-3
    missed: float = 0.02
    give_back: float = 1.0  # the step back when the unlabelled risk falls below zero
    seed: int = 1


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are not learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def word_features(word: bytes) -> tuple[int, ...]:
    """Buckets of a lower-cased word: itself without marks around it, and its stems."""
    core = word.strip(b".,;:!?\"'()[]%$&*#|<>")
    if not core:
        return ()
    names = [b"w" + core] + [b"s%d" % n + core[:n] for n in STEMS if len(core) > n]
    return tuple(xxhash.xxh3_64_intdigest(name) % BUCKETS for name in names)


class Features(dict):
    """Word features, remembered."""

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) > 200_000:
            self.clear()
        self[word] = found = word_features(word)
        return found

    def of(self, raw: bytes) -> set[int]:
        return set(chain.from_iterable(map(self.__getitem__, set(raw.lower().split()))))


# --- learning -----------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


class _Rows:
    """Sparse rows of ones: the columns of row k are `columns[starts[k]:starts[k + 1]]`."""

    def __init__(self, rows: list[np.ndarray]):
        self.starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
        self.columns = np.concatenate(rows) if rows else np.empty(0, np.int64)

    def take(self, chosen: np.ndarray) -> _Rows:
        return _Rows([self.columns[self.starts[k] : self.starts[k + 1]] for k in chosen])

    def scores(self, weights: np.ndarray, bias: float) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(weights[self.columns])])
        return sums[self.starts[1:]] - sums[self.starts[:-1]] + bias

    def gradient(self, slopes: np.ndarray, width: int) -> np.ndarray:
        each = np.repeat(slopes, np.diff(self.starts))
        return np.bincount(self.columns, each, width)


def fit_member(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, learning: Learning, seed: int
) -> tuple[np.ndarray, np.ndarray, float]:
    """Used buckets, their weights and the bias of one logistic classifier.

    The risk is prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)]): the
    unlabelled texts count as clean, less the share of toxic ones among them. Where a batch
    makes the second part negative, a step is made against it instead. Adagrad steps, and
    shrinkage that leaves weights without evidence at zero.
    """
    n_p, n_all = len(positive), len(positive) + len(unlabelled)
    in_p = np.bincount(np.concatenate(positive), minlength=BUCKETS)
    counts = in_p + np.bincount(np.concatenate(unlabelled), minlength=BUCKETS)
    share = counts / n_all
    spread = np.sqrt(share * (1 - share) * (1 / n_p + 1 / (n_all - n_p)))
    apart = np.abs(in_p / n_p - (counts - in_p) / (n_all - n_p)) >= learning.least_deviations * spread
    used = np.flatnonzero(apart & (counts >= learning.least_texts) & (spread > 0))
    place = np.full(BUCKETS, -1, np.int64)
    place[used] = np.arange(len(used))

    def compact(rows: list[np.ndarray]) -> _Rows:
        return _Rows([at[at >= 0] for at in (place[row] for row in rows)])

    p_rows, u_rows = compact(positive), compact(unlabelled)
    weights, bias = np.zeros(len(used)), np.log(prior / (1 - prior))
    squares, bias_squares = np.full(len(used), 1e-6), 1e-6
    random = np.random.default_rng(seed)
    rounds = max(1, -(-len(unlabelled) // learning.batch))
    p_size = max(1, min(len(positive), learning.batch // 2))
    for _ in range(learning.epochs):
        order = random.permutation(len(unlabelled))
        for k in range(rounds):
            u = u_rows.take(order[k * learning.batch : (k + 1) * learning.batch])
            p = p_rows.take(random.choice(len(positive), p_size, replace=False))
            p_prob, u_prob = _sigmoid(p.scores(weights, bias)), _sigmoid(u.scores(weights, bias))
            clean = np.mean(-np.log1p(-np.minimum(u_prob, 1 - 1e-12)))
            clean -= prior * np.mean(-np.log1p(-np.minimum(p_prob, 1 - 1e-12)))
            p_batch, u_batch = len(p_prob), len(u_prob)
            if clean >= 0:
                p_slope = prior * (p_prob - 1) / p_batch - prior * p_prob / p_batch
                u_slope = u_prob / u_batch
            else:
                p_slope = learning.give_back * prior * p_prob / p_batch
                u_slope = -learning.give_back * u_prob / u_batch
            slope = p.gradient(p_slope, len(used)) + u.gradient(u_slope, len(used))
            squares += slope**2
            step = learning.rate / np.sqrt(squares)
            weights -= step * slope
            weights = np.sign(weights) * np.maximum(np.abs(weights) - step * learning.sparsity, 0)
            bias_slope = p_slope.sum() + u_slope.sum()
            bias_squares += bias_slope**2
            bias -= learning.rate * bias_slope / np.sqrt(bias_squares)
    # Shrinkage draws scores to the prior. One half is moved down to where all but `missed` of
    # the confirmed texts reach it (of few texts more may miss it), unless a good deal more unlabelled ones would than the prior.
    low = np.quantile(p_rows.scores(weights, bias), max(learning.missed, n_p**-0.5))
    most = np.quantile(u_rows.scores(weights, bias), 1 - min(1.0, 1.1 * prior + 0.01))
    bias -= min(0.0, max(low, most))
    kept = weights != 0
    return used[kept], weights[kept], float(bias)


def _sample(docs: DataFrame, labels: DataFrame, learning: Learning) -> DataFrame:
    """(member, toxic, features): the texts each member learns from."""
    order = lambda salt: F.xxhash64(F.lit(learning.seed + salt), "doc_id")
    known = labels.select(F.col("doc_id").cast("long"), "toxic").filter(~held_out(F.col("doc_id")))
    toxic = known.filter("toxic = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    picked_toxic = toxic.orderBy(order(1)).limit(learning.members * learning.positives)
    # The unlabelled texts are drawn from all, confirmed ones too: the prior is theirs.
    others = docs.select("doc_id").filter("doc_id IS NOT NULL").filter(~held_out(F.col("doc_id")))
    drawn = others.distinct().orderBy(order(2)).limit(learning.members * learning.unlabelled)
    ids = picked_toxic.withColumn("toxic", F.lit(1)).unionByName(drawn.withColumn("toxic", F.lit(0)))
    ids = staged(ids, "toxicity-sample")  # bounded by the parameters, so it may be broadcast
    # Of several texts under one id the first in order is learnt from, on any layout.
    texts = docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batch_rows(batches, BATCH_BYTES):
            packed = [
                np.array(sorted(features.of(raw)), "<u4").tobytes() for raw in text_bytes(batch.column("text"))
            ]
            columns = [batch.column("doc_id"), batch.column("toxic"), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "toxic", "features"])

    found = map_arrow(texts.select("doc_id", "toxic", "text"), run, "doc_id long, toxic int, features binary")
    member = F.pmod(F.xxhash64(F.lit(learning.seed), "doc_id"), F.lit(learning.members)).cast("int")
    return found.withColumn("member", member)


def class_prior(docs: DataFrame, labels: DataFrame) -> float:
    """The toxic share among the labelled rows that may be learnt from, smoothed."""
    known = labels.filter("toxic IS NOT NULL").filter(~held_out(F.col("doc_id")))
    toxic, rows = known.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("toxic")).first()
    return min(0.5, (toxic + 1) / (rows + 2))


@dataclass(frozen=True)
class Toxicity:
    """The members' bias and weights by bucket; none without a confirmed toxic text."""

    biases: list[float]
    weights: dict[int, tuple[float, ...]]


def learn(docs: DataFrame, labels: DataFrame, learning: Learning = Learning()) -> Toxicity:
    """Fit the members, each in one task, on their samples.

    `labels` has doc_id and toxic (1 is confirmed; 0 and null texts are unlabelled ones);
    labels of held-out rows are not read. Only the weights come to the driver.
    """
    docs = documents_of(docs)
    prior = class_prior(docs, labels)
    sample = staged(_sample(docs, labels, learning), "toxicity-features")

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        lists = {
            toxic: [np.frombuffer(raw, "<u4").astype(np.int32) for raw in rows.features[rows.toxic == toxic]]
            for toxic in (0, 1)
        }
        member = int(rows.member.iloc[0])
        if not lists[1] or not lists[0]:
            return pd.DataFrame({"member": [], "bucket": [], "weight": []})
        buckets, weights, bias = fit_member(lists[1], lists[0], prior, learning, learning.seed + member)
        return pd.DataFrame(
            {"member": member, "bucket": [-1, *buckets.tolist()], "weight": [bias, *weights.tolist()]}
        )

    found = sample.groupBy("member").applyInPandas(fit, "member int, bucket long, weight double").collect()
    members = sorted({row.member for row in found})
    place = {member: k for k, member in enumerate(members)}
    table: dict[int, list[float]] = {}
    for row in found:
        table.setdefault(row.bucket, [0.0] * len(members))[place[row.member]] = row.weight
    biases = table.pop(-1, [])
    return Toxicity(biases, {bucket: tuple(row) for bucket, row in table.items()})


# --- scoring --------------------------------------------------------------------------------


class Scorer(dict):
    """Scores texts; remembers for each word which weighted buckets it touches."""

    def __init__(self, model: Toxicity):
        super().__init__()
        self.model = model

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) > 200_000:
            self.clear()
        weights = self.model.weights
        self[word] = found = tuple(b for b in word_features(word) if b in weights)
        return found

    def __call__(self, raw: bytes) -> float:
        if not self.model.biases:
            return 0.0
        touched = set(chain.from_iterable(map(self.__getitem__, set(raw.lower().split()))))
        sums = np.array(self.model.biases)
        if touched:
            sums = sums + np.array([self.model.weights[b] for b in sorted(touched)]).sum(axis=0)
        return float(_sigmoid(sums).mean())


def score_toxicity(docs: DataFrame, model: Toxicity) -> DataFrame:
    """doc_id, held_out, score, predicted of every text, row by row.

    Null and empty texts have the score of a text without features; without a model every
    score is 0. Nothing but the text is an input. Other columns are left out.
    """
    docs = documents_of(docs)
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(known.value)
        for batch in batch_rows(batches, BATCH_BYTES):
            scores = [scorer(raw) for raw in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = map_arrow(docs, run, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, model: Toxicity) -> DataFrame:
    """The rows whose text scores below one half, with all their columns."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(known.value)
        for batch in batch_rows(batches, BATCH_BYTES):
            clean = [scorer(raw) < 0.5 for raw in text_bytes(batch.column("text"))]
            yield pc.filter(batch, pa.array(clean, pa.bool_()))

    return map_arrow(docs, run, docs.schema)
