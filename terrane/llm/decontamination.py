"""Benchmark decontamination: the words of documents that repeat a window of a benchmark item.

A window is `window` consecutive words of an item; an item of fewer words is one window. It
occurs in a document where the same words stand side by side, so a prefix-filtered join for
containment 1 needs one necessary token of each window. Tokens are shingles of three words (of
as many as the window has, if fewer), ordered by rarity in the documents:

1. one pass over the documents counts the shingles that some window has; a window with a
   shingle that no document has can't occur and is dropped;
2. each other window is indexed under its rarest shingle alone;
3. a second pass emits the places of indexed shingles with the few words around them, which are
   all that a window can cover there. They join the index by shingle; a window has to fit
   between the first and the last word of the document (length and position), and its words
   have to equal the document's.

Windows of many items with equal words are one; windows of the same set of items are one class,
and documents with the same set of classes share one list of items.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm.common import (
    KeyFilter,
    batch_rows,
    documents_of,
    map_arrow,
    staged,
    text_bytes,
    window_hashes,
    word_hashes,
)

# Words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z became a-z: other bytes turn into blanks.
_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_SHINGLE = 3
_BATCH_BYTES = 4 << 20
_OTHER = b"-"  # stands for a word longer than any of an item; no word looks like it


@dataclass
class Contamination:
    """`documents`: doc_id, n_words, n_hit, spans (start, end in words; apart, in order) and
    item_set, null without a hit, one row per input row. `item_sets`: item_set, item_ids (as
    strings, distinct, sorted)."""

    documents: DataFrame
    item_sets: DataFrame


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_LETTERS).split()


def contamination(docs: DataFrame, items: DataFrame, *, window: int = 10) -> Contamination:
    """Hit words of each document (doc_id, text) and the items (item_id, text) they come from.

    Null and empty texts have no words: such documents have no hit, such items no window.
    Repeated rows are judged one by one, repeated item ids and texts count once. An item with a
    null id marks words but is in no list. Empty tables and extra columns do no harm; words may
    be of any length.
    """
    windows, members = _windows_of(items, window)
    index = _rarest(docs, windows)
    rows = staged(_places(docs, index, window), "decontamination-rows")
    hits = staged(_verified(rows, index), "decontamination-hits")

    order = Window.partitionBy("row").orderBy("start", "length")
    ahead = F.max(F.col("start") + F.col("length")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.when(F.col("start") <= ahead, 0).otherwise(1)
    islands = hits.select("*", apart.alias("apart")).withColumn(
        "island", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    spans = islands.groupBy("row", "island").agg(
        F.min("start").alias("start"),
        F.max(F.col("start") + F.col("length")).alias("end"),
        F.collect_set("class").alias("classes"),
    )
    by_row = spans.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("classes")))).alias("classes"),
        F.sum(F.col("end") - F.col("start")).alias("n_hit"),
    )
    by_row = staged(by_row.withColumn("item_set", _set_name("classes")), "decontamination-spans")

    sets = by_row.groupBy("item_set").agg(F.first("classes").alias("classes"))
    named = sets.select("item_set", F.explode("classes").alias("class")).join(members, "class")
    item_sets = named.groupBy("item_set").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    documents = rows.select("row", "doc_id", "n_words").join(by_row.drop("classes"), "row", "left")
    documents = documents.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), "spans", "item_set"
    )
    return Contamination(documents, item_sets)


def _set_name(classes: str):
    return F.sha2(F.array_join(F.col(classes).cast("array<string>"), ","), 256)


def _windows_of(items: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (id, class, words, length, shingles), and the items of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        for batch in batch_rows(batches, _BATCH_BYTES // 16):  # each word is in ten windows
            for item, raw in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                words = words_of(raw)
                length = min(window, len(words))
                if not length:
                    continue
                width = min(_SHINGLE, length)
                shingles = window_hashes(hashes.of(words), width).astype(np.int64)
                inside = length - width + 1
                for first in range(0, len(words) - length + 1, 4096):
                    starts = np.arange(first, min(first + 4096, len(words) - length + 1))
                    offsets = pa.array(np.arange(len(starts) + 1) * inside, pa.int32())
                    flat = pa.array(shingles[starts[:, None] + np.arange(inside)].reshape(-1))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([item] * len(starts), pa.string()),
                            pa.array([b" ".join(words[k : k + length]) for k in starts], pa.binary()).cast(pa.string()),
                            pa.array(np.full(len(starts), length), pa.int32()),
                            pa.ListArray.from_arrays(offsets, flat),
                        ],
                        names=["item_id", "words", "length", "shingles"],
                    )

    pieces = items.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    pieces = map_arrow(pieces, run, "item_id string, words string, length int, shingles array<long>")
    pieces = staged(pieces.distinct(), "decontamination-pieces")
    # Windows of the same items are known by two sums of hashes of the items, 128 bits.
    named = [F.sum(F.xxhash64(F.lit(k), "item_id").cast("decimal(38,0)")).alias(f"sum{k}") for k in (1, 2)]
    distinct = pieces.groupBy("words").agg(
        F.first("length").alias("length"), F.first("shingles").alias("shingles"), *named
    )
    distinct = distinct.withColumn("id", F.monotonically_increasing_id())
    distinct = staged(distinct, "decontamination-windows")
    classes = staged(distinct.groupBy("sum1", "sum2").agg(F.min("id").alias("class")), "decontamination-classes")
    windows = distinct.join(classes, ["sum1", "sum2"]).select("id", "class", "words", "length", "shingles")
    examples = distinct.join(classes.select(F.col("class").alias("id")), "id").select(F.col("id").alias("class"), "words")
    members = examples.join(pieces, "words").select("class", "item_id")
    return staged(windows, "decontamination-classed"), staged(members, "decontamination-members")


def _rarest(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(id, class, words, length, hash, offset): windows that may occur, by their rarest shingle."""
    wanted = staged(windows.select(F.explode("shingles").alias("hash")).distinct(), "decontamination-shingles")
    known = docs.sparkSession.sparkContext.broadcast(KeyFilter.of(wanted, "hash"))
    widths = _widths(windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batch_rows(batches, _BATCH_BYTES):
            text = _Batch(text_bytes(batch.column(1)))
            for width in widths:
                shingles, at = text.shingles(width, known.value)
                values, counts = np.unique(shingles[at], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values.astype(np.int64)), pa.array(counts)], names=["hash", "times"]
                )

    counted = map_arrow(documents_of(docs), run, "hash long, times long").groupBy("hash").agg(F.sum("times").alias("times"))
    counted = staged(counted, "decontamination-counts")
    each = windows.select("id", F.posexplode("shingles").alias("offset", "hash")).join(counted, "hash", "left")
    # A shingle that occurs nowhere sorts first, and its window goes.
    rarest = each.groupBy("id").agg(F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "hash", "offset")).alias("r"))
    chosen = rarest.filter("r.times > 0").select("id", "r.hash", "r.offset")
    return staged(windows.drop("shingles").join(chosen, "id"), "decontamination-index")


def _widths(windows: DataFrame) -> list[int]:
    """Widths of shingles that occur, at most three."""
    found = windows.select(F.least("length", F.lit(_SHINGLE)).alias("width")).distinct().collect()
    return sorted(row.width for row in found)


class _Batch:
    """The words of some texts in one run, with where each text starts."""

    def __init__(self, texts: list[bytes]):
        parts = [words_of(raw) for raw in texts]
        self.counts = np.fromiter(map(len, parts), np.int64, len(parts))
        self.starts = np.cumsum(self.counts) - self.counts
        self.words = list(chain.from_iterable(parts))
        self.hashes = word_hashes().of(self.words)
        self.owner = np.repeat(np.arange(len(parts)), self.counts)

    def shingles(self, width: int, known: KeyFilter) -> tuple[np.ndarray, np.ndarray]:
        """Shingles of a width, and the places of those that may be known and lie in one text."""
        values = window_hashes(self.hashes, width)
        at = known.found(values)
        return values, at[self.owner[at] == self.owner[at + width - 1]]


def _places(docs: DataFrame, index: DataFrame, window: int) -> DataFrame:
    """(row, doc_id, n_words, places): each place of an indexed shingle with the words around it."""
    known = docs.sparkSession.sparkContext.broadcast(KeyFilter.of(index.select("hash").distinct(), "hash"))
    widths = _widths(index)
    longest = index.agg(F.max(F.octet_length("words"))).first()[0] or 0
    kind = pa.struct([("at", pa.int32()), ("first", pa.int32()), ("hash", pa.int64()), ("around", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batch_rows(batches, _BATCH_BYTES):
            text = _Batch(text_bytes(batch.column(1)))
            found = [text.shingles(width, known.value) for width in widths]
            at = np.concatenate([places for _, places in found] or [np.empty(0, np.int64)])
            hashes = np.concatenate([values[places] for values, places in found] or [np.empty(0, np.uint64)])
            order = np.argsort(at, kind="stable")
            at, hashes = at[order], hashes[order]
            owner = text.owner[at]
            first = np.maximum(at - window + 1, text.starts[owner])
            last = np.minimum(at + window, text.starts[owner] + text.counts[owner])
            around = [
                b" ".join([w if len(w) <= longest else _OTHER for w in text.words[i:j]])
                for i, j in zip(first.tolist(), last.tolist())
            ]
            places = pa.StructArray.from_arrays(
                [
                    pa.array(at - text.starts[owner], pa.int32()),
                    pa.array(first - text.starts[owner], pa.int32()),
                    pa.array(hashes.astype(np.int64)),
                    pa.array(around, pa.binary()).cast(pa.string()),
                ],
                fields=list(kind),
            )
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(text.counts)))])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(text.counts),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), places),
                ],
                names=["doc_id", "n_words", "places"],
            )

    schema = "doc_id long, n_words long, places array<struct<at: int, first: int, hash: long, around: string>>"
    placed = map_arrow(documents_of(docs), run, schema)
    return placed.withColumn("row", F.monotonically_increasing_id())  # fixed once it is written


def _verified(rows: DataFrame, index: DataFrame) -> DataFrame:
    """(row, start, length, class) of windows whose words are in the document there."""
    places = rows.select("row", "n_words", F.explode("places").alias("place")).select("row", "n_words", "place.*")
    start = F.col("at") - F.col("offset")
    from_ = F.greatest(F.col("start") - F.col("first") + 1, F.lit(1))
    same = F.array_join(F.slice(F.split("around", " "), from_, F.col("length")), " ") == F.col("words")
    pairs = places.join(index, "hash").withColumn("start", start)
    fits = (F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words"))
    return pairs.filter(fits & same).select("row", "start", "length", "class")


def drop_contaminated(docs: DataFrame, items: DataFrame, *, window: int = 10, most: float = 0.0) -> DataFrame:
    """The documents of which at most a share `most` of the words is hit, with all their columns.

    Rows of one doc_id go together, as the worst of them; rows with a null doc_id likewise.
    """
    found = contamination(docs, items, window=window).documents
    bad = found.filter(F.col("n_hit") > F.lit(most) * F.col("n_words")).select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["_bad"]), "left_anti")
