"""Sharding: a minimax contiguous partition of ordered groups that stay whole.

Groups (rows of equal text) are ordered by their smallest doc_id and put on a line by the
running sum of their sizes. The smallest capacity with which a greedy cut needs no more than
the wanted number of shards is found by binary search. The greedy cut asks only one thing of
the data: the last group end at or before a point. The driver knows the ends exactly where it
matters: it holds the ends of coarse blocks, searches with a pessimistic and an optimistic
reading of them, and looks into just those blocks where the readings differ, until both give
the same cuts. What it holds is bounded by the number of shards and of blocks.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm.common import map_arrow, staged

ROW_BYTES = 8  # each row counts so much besides its text
BLOCKS = 4096
FINER = 64


@dataclass(frozen=True)
class Block:
    """Group ends from `first` to `last`; `exact` if it has none in between."""

    first: int
    last: int
    exact: bool


class Ends:
    """The group ends as known so far: blocks in order, without overlap."""

    def __init__(self, blocks: list[Block]):
        self.blocks = sorted(blocks, key=lambda b: b.first)
        self.firsts = [b.first for b in self.blocks]
        self.total = self.blocks[-1].last if blocks else 0

    def reach(self, point: int, optimistic: bool) -> tuple[int, Block | None]:
        """The last end at or before a point, and the block that leaves it in doubt."""
        at = bisect_right(self.firsts, point) - 1
        if at < 0:
            return 0, None
        block = self.blocks[at]
        if point >= block.last:
            return block.last, None
        if block.exact:
            return block.first, None
        return (min(point, block.last - 1) if optimistic else block.first), block

    def cuts(self, capacity: int, shards: int, optimistic: bool) -> tuple[list[int], list[Block]]:
        """Greedy shard ends for a capacity, as many as needed, and the blocks in doubt."""
        ends, doubt, at = [], [], 0
        while at < self.total and len(ends) < shards:
            reached, block = self.reach(at + capacity, optimistic)
            if block:
                doubt.append(block)
            if reached <= at:
                break
            at = reached
            ends.append(at)
        return ends, doubt

    def feasible(self, capacity: int, shards: int, optimistic: bool) -> bool:
        ends, _ = self.cuts(capacity, shards, optimistic)
        return self.total == 0 or bool(ends) and ends[-1] == self.total

    def least(self, shards: int, optimistic: bool) -> int:
        """Binary search for the smallest feasible capacity."""
        low, high = -(-self.total // shards), self.total
        while low < high:
            middle = (low + high) // 2
            if self.feasible(middle, shards, optimistic):
                high = middle
            else:
                low = middle + 1
        return low


def minimax_cuts(blocks: list[Block], shards: int, look_inside) -> list[int]:
    """Ends of the shards of the best contiguous partition, the greedy ones.

    `look_inside(blocks)` returns each given block as finer ones.
    """
    while True:
        ends = Ends(blocks)
        capacity = ends.least(shards, optimistic=False)
        hopeful = ends.least(shards, optimistic=True)
        doubt: set[Block] = set()
        for one in {capacity, hopeful}:
            for optimistic in (False, True):
                doubt |= set(ends.cuts(one, shards, optimistic)[1])
        if capacity == hopeful and ends.cuts(capacity, shards, False)[0] == ends.cuts(capacity, shards, True)[0]:
            return ends.cuts(capacity, shards, False)[0]
        blocks = [b for b in blocks if b not in doubt] + look_inside(sorted(doubt, key=lambda b: b.first))


def _blocks(frame: DataFrame, *by: str) -> list[Block]:
    found = frame.groupBy(*by).agg(F.min("end"), F.max("end"), F.count_distinct("end")).collect()
    return [Block(row[-3], row[-2], row[-1] <= 2) for row in found]


def _ends(groups: DataFrame) -> DataFrame:
    """Groups in order with the running sums of bytes (`end`) and of rows (`rows_end`).

    Range-partitioned and summed up inside each partition; the partitions' totals, a row
    each, are summed up on the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, size, rows = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = size + np.cumsum(batch.column("bytes").to_numpy())
            counts = rows + np.cumsum(batch.column("rows").to_numpy())
            size, rows = int(sizes[-1]), int(counts[-1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("digest"),
                    batch.column("rows"),
                    pa.array(np.full(batch.num_rows, part, np.int32)),
                    pa.array(sizes),
                    pa.array(counts),
                ],
                ["digest", "rows", "part", "end", "rows_end"],
            )

    ordered = groups.repartitionByRange("first", "digest").sortWithinPartitions("first", "digest")
    schema = "digest binary, rows long, part int, end long, rows_end long"
    summed = staged(map_arrow(ordered, run, schema), "group-ends")
    totals = summed.groupBy("part").agg(F.max("end"), F.max("rows_end")).orderBy("part").collect()
    bases, size, rows = [], 0, 0
    for part, part_size, part_rows in totals:
        bases.append((part, size, rows))
        size, rows = size + part_size, rows + part_rows
    offsets = groups.sparkSession.createDataFrame(bases, "part int, base long, rows_base long")
    return summed.join(F.broadcast(offsets), "part").select(  # a row a partition
        "digest",
        "rows",
        (F.col("end") + F.col("base")).alias("end"),
        (F.col("rows_end") + F.col("rows_base")).alias("rows_end"),
    )


def shard(docs: DataFrame, shards: int) -> DataFrame:
    """Deal all documents to `shards` shards of nearly equal bytes, equal texts together.

    doc_id, size (UTF-8 bytes and 8), text_crc32, law (`bytes`), shard, slot (from 0 without
    gaps in its shard), grown_shard (null: another number of shards cuts anew). Null texts
    have no bytes and form one group, empty ones another. No contiguous partition in this
    order has a smaller largest shard. Repeated rows get a slot each. Of an empty table
    nothing comes.
    """
    spark = docs.sparkSession
    raw = F.encode(F.col("text"), "utf-8")
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col("doc_id").cast("long"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.coalesce(F.crc32(raw), F.crc32(F.lit(b""))).alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2(raw, 256)), F.lit(b"null")).alias("digest"),
    ).withColumn("cell", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    rows = staged(rows, "shard-rows")
    # A group's rows are counted, and later numbered, in cells, so none meets in one task.
    cells = rows.groupBy("digest", "cell").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), F.min("doc_id").alias("first")
    )
    cells = staged(cells, "shard-cells")
    groups = cells.groupBy("digest").agg(
        F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.min("first").alias("first")
    )
    ends = staged(_ends(groups), "shard-ends")
    total = ends.agg(F.max("end")).first()[0] or 0

    def look_inside(doubt: list[Block]) -> list[Block]:
        """Blocks cut into up to FINER parts of equal width, each with its true ends."""
        lows = np.array([b.first for b in doubt])
        lasts = np.array([b.last for b in doubt])
        widths = -(-(lasts - lows + 1) // FINER)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                end = batch.column("end").to_numpy()
                k = np.maximum(np.searchsorted(lows, end, "right") - 1, 0)
                inside = (end >= lows[k]) & (end <= lasts[k])
                k, end = k[inside], end[inside]
                n = (end - lows[k]) // widths[k]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, (k, n, end))), ["k", "n", "end"])

        near = ends.select("end").filter(F.col("end").between(int(lows[0]), int(lasts[-1])))
        return _blocks(map_arrow(near, place, "k long, n long, end long"), "k", "n")

    width = -(-(total + 1) // BLOCKS)
    coarse = _blocks(ends.withColumn("n", F.floor(F.col("end") / width)), "n")
    cuts = minimax_cuts(coarse, shards, look_inside)
    at = F.lit(0)
    for end in cuts[:-1]:
        at = at + F.when(F.col("end") > end, 1).otherwise(0)
    placed = ends.withColumn("shard", at.cast("int"))
    first = placed.groupBy("shard").agg(F.min(F.col("rows_end") - F.col("rows")).alias("shard_base"))
    placed = placed.join(F.broadcast(first), "shard").select(  # a row a shard
        "digest", "shard", (F.col("rows_end") - F.col("rows") - F.col("shard_base")).alias("base")
    )
    before = Window.partitionBy("digest").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    located = cells.select("digest", "cell", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("skip"))
    located = located.join(placed, "digest")
    inside = Window.partitionBy("digest", "cell").orderBy("doc_id")
    slot = F.col("base") + F.col("skip") + F.row_number().over(inside) - 1
    return rows.join(located, ["digest", "cell"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        slot.cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
