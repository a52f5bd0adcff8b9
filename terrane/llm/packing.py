"""Best-fit-decreasing packing of documents into sequences of bounded length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm.byte_bpe import END_OF_DOCUMENT, byte_bpe
from terrane.llm.common import (
    batch_rows,
    documents_of,
    map_arrow,
    numbered,
    staged,
    texts_of,
)

SEQUENCE = 2048
BATCH_BYTES = 4 << 20
_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


class CapacityTree:
    """A segment tree over remaining capacities; a leaf counts the open bins that have it."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.counts = [0] * (2 * self.leaves)

    def add(self, capacity: int, bins: int) -> None:
        node = self.leaves + capacity
        while node:
            self.counts[node] += bins
            node >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least `least` that an open bin has."""
        node = self.leaves + least
        if self.counts[node]:
            return least
        while node > 1:  # up, until a right neighbour holds bins; then down its left edge
            if node % 2 == 0 and self.counts[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.counts[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


@dataclass(frozen=True)
class Lot:
    """Pieces `first` to `first + bins * each - 1` of one length: `each` of them go to each
    of `bins` consecutive sequences from `sequence` on, at `offset` and behind one another."""

    length: int
    first: int
    count: int
    each: int
    sequence: int
    offset: int


def best_fit_lots(lengths: dict[int, int], capacity: int) -> list[Lot]:
    """Best-fit decreasing over a histogram of lengths (length: number of pieces).

    Pieces of one length are alike, so what best fit does with them one by one - fill the
    tightest open bin while it holds one more, then the next, and open bins at last - is
    done for a whole lot of equal bins at a time. The result is that of the plain algorithm;
    work and memory depend on the number of lengths, at most `capacity`, not of pieces.
    """
    tree = CapacityTree(capacity)
    runs: dict[int, list[tuple[int, int]]] = {}  # capacity: runs (first bin, bins)
    lots, opened = [], 0

    def put(left: int, first: int, bins: int) -> None:
        if bins and left:
            runs.setdefault(left, []).append((first, bins))
            tree.add(left, bins)

    for length in sorted(lengths, reverse=True):
        done, count = 0, lengths[length]
        while done < count:
            left = tree.tightest(length)
            if left is None:
                left, first = capacity, opened
                bins = -(-(count - done) // (capacity // length))
                opened += bins
            else:
                first, bins = runs[left].pop()
                tree.add(left, -bins)
            each = left // length
            full = min(bins, (count - done) // each)
            if full:
                lots.append(Lot(length, done, full * each, each, first, capacity - left))
                put(left - each * length, first, full)
                done += full * each
            if full < bins and done < count:  # one bin takes what is left
                rest = count - done
                lots.append(Lot(length, done, rest, rest, first + full, capacity - left))
                put(left - rest * length, first + full, 1)
                full, done = full + 1, count
            put(left, first + full, bins - full)
    return lots


def pieces_of(docs: DataFrame, tokenizer_path: str, capacity: int = SEQUENCE) -> DataFrame:
    """Tokenize and cut: a row a piece, of at most `capacity` ids, the end id counted.

    A document of more ids is cut into pieces of exactly `capacity`, but for the first, which
    takes what does not fill one. Null texts are empty ones: a piece with the end id alone.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizer_path)
        end = np.array([END_OF_DOCUMENT], "<u4").tobytes()
        for batch in batch_rows(batches, BATCH_BYTES):
            rows = []
            keys = batch.column("doc_id").to_pylist()
            for key, ids in zip(keys, bpe.batch(texts_of(batch.column("text")))):
                ids += end
                n = len(ids) // 4
                at = n % capacity or min(n, capacity)
                bounds = [0, *range(at, n + 1, capacity)]
                for piece, (start, stop) in enumerate(zip(bounds, bounds[1:])):
                    digest = zlib.crc32(memoryview(ids)[4 * start : 4 * stop])
                    rows.append((key, piece, start, stop - start, digest))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            names = [field.split()[0] for field in _PIECE.split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names)

    return map_arrow(documents_of(docs), cut, _PIECE)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = SEQUENCE) -> DataFrame:
    """Pack all documents: a row a piece with its sequence_id and the offset inside it.

    The driver sees the histogram of lengths only, at most `capacity` numbers, and plans lots
    of equal pieces; pieces are numbered within their length in parallel and look their lot
    up. Sequences fill without gaps. Repeated rows and null doc_ids are pieces like others;
    an empty table gives an empty one.
    """
    spark = docs.sparkSession
    pieces = staged(pieces_of(docs, tokenizer_path, capacity), "pieces")
    counted = pieces.groupBy("length").count().collect()
    lots = best_fit_lots({row["length"]: row["count"] for row in counted}, capacity)
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked = numbered(
        pieces,
        ["length"],
        ["doc_id", "piece", "start", "ids_crc32"],
        "_rank",
        salt=F.struct("doc_id", "piece", "ids_crc32"),
        salts=salts,
    )
    return _placed(ranked, lots)


def _placed(ranked: DataFrame, lots: list[Lot]) -> DataFrame:
    """Look up each piece's lot by binary search; the plan rides along as a few arrays.

    Its size is bounded by the number of lengths and of distinct fillings, not by the data.
    """
    starts: dict[int, list[int]] = {}
    for at, lot in enumerate(lots):  # lots of a length follow each other by their first piece
        starts.setdefault(lot.length, []).append(at)
    table = np.array([(x.first, x.each, x.sequence, x.offset) for x in lots], np.int64).reshape(-1, 4)
    known = ranked.sparkSession.sparkContext.broadcast((starts, table))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, table = known.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            sequence, offset = np.empty_like(length), np.empty_like(length)
            for one in np.unique(length):
                mine = np.flatnonzero(length == one)
                rows = table[starts[int(one)]]
                lot = rows[np.searchsorted(rows[:, 0], rank[mine], "right") - 1]
                inside = rank[mine] - lot[:, 0]
                sequence[mine] = lot[:, 2] + inside // lot[:, 1]
                offset[mine] = lot[:, 3] + inside % lot[:, 1] * one
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(sequence), pa.array(offset)],
                [*names, "sequence_id", "offset"],
            )

    return map_arrow(ranked, place, f"{_PIECE}, sequence_id long, offset long")
