"""Exact Jaccard self-join of documents' 5-word shingle sets, by set-relation skipping.

Documents with equal sets form a class; classes are joined. Two classes whose similarity
reaches the threshold share a shingle in their prefixes, the first quarter of each set in one
global order that puts frequent shingles last. An inverted index of the prefixes is shuffled
by shingle and each list is walked in order of set size:

1. Every set meets one leader, the smallest set of its size range in a list, the one it meets
   most often, and with it the leader's other followers. Sets that link to the leader are of
   one component and need no answers of their own; the others are compared with all.
2. The lists are walked again, and now only pairs of different components that did not meet
   before matter. Lists are read in blocks; a block is skipped when the sizes and positions in
   it leave no room for the overlap that is needed. A list with more such pairs than sets names
   only the sets: these meet there, and a link is kept where it joins two components. At first
   each set goes to the one list where it has most partners, then these lists are walked
   anew, and at last sets meet in every list that is still dense. So rows follow the sets, not their
   pairs. Pairs of other lists meet at leaders again, chosen among the pairs.
3. A set linked to a leader is highly similar to it, so its overlap with another set follows
   from the leaders' overlap, up to the few elements by which it differs. Leaders' pairs are
   computed first; only pairs that these answers leave open are computed themselves.

No link between components is lost, so components are those of all links. Set elements are
48-bit hashes and classes 64-bit hashes of whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from terrane.llm.common import (
    KeyFilter,
    WordHashes,
    batch_rows,
    documents_of,
    map_arrow,
    mixed,
    run_starts,
    runs,
    staged,
    text_bytes,
    window_hashes,
    word_hashes,
)
from terrane.llm.components import connected

WORDS = 5
ELEMENT_BYTES = 6
GUESTS = 2_000
FEW = 64  # pairs that any list may name, however few sets it has
MATRIX = 4_096  # sets of a cell whose signatures are compared each with each
TOGETHER = 1_500_000  # elements of the sets that meet in one place
BATCH_BYTES = 4 << 20
BROADCAST_BYTES = 16 << 20


@dataclass(frozen=True)
class Limits:
    """The order of shingles: the `frequent` most frequent of those seen `least_count` times
    come last, the rest before them by hash. It decides the work, never the result. A list
    of more than `list_rows` is cut for its first walk; `block_rows` is the skipping unit.
    Open pairs, while there are any, meet at leaders for `rounds` rounds; before that, dense
    lists are walked anew as often."""

    frequent: int = 1 << 18
    least_count: int = 4
    list_rows: int = 20_000
    block_rows: int = 128
    rounds: int = 2


def shingles(raw: bytes, hashes: WordHashes) -> np.ndarray:
    """The set of a text: sorted distinct hashes of its runs of five words.

    Fewer words make one shingle, none an empty set. A-Z are lower-cased.
    """
    words = raw.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    found = window_hashes(hashes.of(words), min(WORDS, len(words)))
    if len(words) < WORDS:
        found = mixed(found + np.uint64(len(words)))
    found = np.sort(found >> np.uint64(64 - 8 * ELEMENT_BYTES))
    return found[run_starts(found)]


def class_of(elements: np.ndarray) -> int:
    """A signed 64-bit name of the set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(elements.tobytes())).astype(np.int64))


def needed(left, right):
    """The overlap two sets of these sizes need: 100 * overlap >= 75 * union."""
    return -(-3 * (left + right) // 7)


def prefix_length(size: int) -> int:
    return size - (3 * size + 3) // 4 + 1


def signature(elements: np.ndarray) -> bytes:
    """Parity bits of the set: each element flips the bit that its low end names, of 3 to 6 bits
    an element. Two signatures differ in no more bits than the sets have elements apart."""
    bits = 1 << max(6, (3 * len(elements) - 1).bit_length())
    places = (elements & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8)).tobytes()


def folded(raw: bytes, size: int) -> bytes:
    """A signature as one of `size` bytes, by laying halves over each other."""
    while len(raw) > size:
        half = len(raw) // 2
        one, two = int.from_bytes(raw[:half], "little"), int.from_bytes(raw[half:], "little")
        raw = (one ^ two).to_bytes(half, "little")
    return raw


def may_link(one: bytes, two: bytes, size_one: int, size_two: int) -> bool:
    """Whether the signatures leave it open that the sets link."""
    size = min(len(one), len(two))
    apart = (int.from_bytes(folded(one, size), "little") ^ int.from_bytes(folded(two, size), "little")).bit_count()
    return size_one + size_two - apart >= 2 * needed(size_one, size_two)


# --- the passes over the texts ---------------------------------------------------------


def _sets(docs: DataFrame, limits: Limits) -> DataFrame:
    """A row a document (doc_id, size, class), and rows (shingle, count) of frequent ones.

    A task counts each class it sees once, and gives its signature once; shingles it saw once
    or twice are left to the hash order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen, held = word_hashes(), set(), []
        shingle, count = np.empty(0, np.uint64), np.empty(0, np.int64)

        def merge():
            nonlocal shingle, count, held
            one, n = np.unique(np.concatenate(held), return_counts=True) if held else (shingle[:0], count[:0])
            both = np.concatenate([shingle, one[n > 1]])
            shingle, at = np.unique(both, return_inverse=True)
            count = np.bincount(at, np.concatenate([count, n[n > 1]]), len(shingle)).astype(np.int64)
            held = []

        for batch in batch_rows(batches, BATCH_BYTES):
            sizes, classes, signatures = [], [], []
            for raw in text_bytes(batch.column("text")):
                elements = shingles(raw, hashes)
                sizes.append(len(elements))
                classes.append(class_of(elements) if len(elements) else None)
                signatures.append(None)
                if len(elements) and classes[-1] not in seen:
                    seen.add(classes[-1])
                    held.append(elements)
                    signatures[-1] = signature(elements)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(classes, pa.int64()),
                    pa.array(signatures, pa.binary()),
                    pa.nulls(n, pa.int64()),
                    pa.nulls(n, pa.int64()),
                ],
                ["doc_id", "size", "class", "signature", "shingle", "count"],
            )
            if sum(map(len, held)) > 1_000_000:
                merge()
        merge()
        often = count > 2
        n = int(often.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64())] * 3
            + [pa.nulls(n, pa.binary()), pa.array(shingle[often].astype(np.int64)), pa.array(count[often])],
            ["doc_id", "size", "class", "signature", "shingle", "count"],
        )

    schema = "doc_id long, size long, class long, signature binary, shingle long, count long"
    return staged(map_arrow(docs, run, schema), "shingle-sets")


def _frequent(sets: DataFrame, limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, at most `limits.frequent`, and their counts."""
    counted = sets.filter("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("count").alias("n"))
    often = counted.filter(F.col("n") >= limits.least_count)
    rows = often.orderBy(F.desc("n"), "shingle").limit(limits.frequent).collect()
    shingle = np.array([row[0] for row in rows], np.int64).astype(np.uint64)
    order = np.argsort(shingle)
    return shingle[order], np.array([row[1] for row in rows], np.int64)[order]


class _Order:
    """The global order of shingles."""

    def __init__(self, frequent: tuple[np.ndarray, np.ndarray]):
        self.shingle, self.count = frequent
        self.maybe = np.zeros(1 << 22, bool)  # most shingles are told from frequent ones here
        self.maybe[self._low(self.shingle)] = True

    def _low(self, elements: np.ndarray) -> np.ndarray:
        return (elements & np.uint64(len(self.maybe) - 1)).astype(np.int64)

    def counts(self, elements: np.ndarray) -> np.ndarray:
        found = np.zeros(len(elements), np.int64)
        near = np.flatnonzero(self.maybe[self._low(elements)])
        if len(near):
            wanted = elements[near]
            at = np.minimum(np.searchsorted(self.shingle, wanted), len(self.shingle) - 1)
            found[near] = np.where(self.shingle[at] == wanted, self.count[at], 0)
        return found

    def prefix(self, elements: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first elements in order, and their counts if they are frequent."""
        counts = self.counts(elements)
        order = np.argsort(counts, kind="stable")[: prefix_length(len(elements))]
        return elements[order], counts[order]


_POSTING = "shingle long, cell int, class long, size int, position int"


def _postings(docs: DataFrame, frequent, limits: Limits) -> DataFrame:
    """The inverted index of prefixes. A task indexes each class once, so copies of one text
    make no more rows of a shingle than there are tasks."""
    known = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen, order = word_hashes(), set(), _Order(known.value)
        for batch in batch_rows(batches, BATCH_BYTES):
            rows = []
            for raw in text_bytes(batch.column("text")):
                elements = shingles(raw, hashes)
                if not len(elements) or (name := class_of(elements)) in seen:
                    continue
                seen.add(name)
                first, counts = order.prefix(elements)
                # A list that is walked whole is cell 0; one that is cut has cells from 1 on.
                cells = (counts // limits.list_rows).astype(np.uint64)
                scattered = mixed(np.full(len(first), name, np.int64).astype(np.uint64))
                cell = np.where(cells > 0, 1 + scattered % (cells + np.uint64(1)), 0)
                rows.append((first, cell, name, len(elements)))
            if not rows:
                continue
            lengths = [len(row[0]) for row in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([row[0] for row in rows]).astype(np.int64)),
                    pa.array(np.concatenate([row[1] for row in rows]).astype(np.int32)),
                    pa.array(np.repeat(np.array([row[2] for row in rows], np.int64), lengths)),
                    pa.array(np.repeat(np.array([row[3] for row in rows], np.int32), lengths)),
                    pa.array(np.concatenate([np.arange(n, dtype=np.int32) for n in lengths])),
                ],
                ["shingle", "cell", "class", "size", "position"],
            )

    return map_arrow(docs, run, _POSTING)


def _elements_of(docs: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """(class, elements) of the wanted classes, from the smallest doc_id each has.

    A filter of these doc_ids, of bounded size, leaves most other documents alone. The few it
    lets pass besides do no harm, nor does a class that comes twice (from repeated rows).
    """
    owners = sets.filter("class IS NOT NULL").join(classes, "class").groupBy("class").agg(
        F.min("doc_id").alias("doc_id")
    )
    bits = docs.sparkSession.sparkContext.broadcast(KeyFilter.of(owners, "doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = word_hashes(), set()
        for batch in batch_rows(batches, BATCH_BYTES):
            ids = batch.column("doc_id")
            wanted = ids.is_null().to_numpy(False)
            wanted[bits.value.found(ids.fill_null(0).to_numpy().astype(np.uint64))] = True
            names, packed = [], []
            for raw in text_bytes(batch.column("text").filter(pa.array(wanted))):
                elements = shingles(raw, hashes)
                if len(elements) and (name := class_of(elements)) not in seen:
                    names.append(name)
                    packed.append(elements.view(np.uint8).reshape(-1, 8)[:, :ELEMENT_BYTES].tobytes())
                    seen.add(name)
            if names:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array(packed, pa.binary())], ["class", "elements"]
                )

    return staged(map_arrow(docs, run, "class long, elements binary"), "shingle-elements")


def _only(elements: DataFrame, classes: DataFrame) -> DataFrame:
    """Elements of the given classes and few others: what need not travel to a join stays."""
    bits = elements.sparkSession.sparkContext.broadcast(KeyFilter.of(classes, "class"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.take(pa.array(bits.value.found(batch.column("class").to_numpy().astype(np.uint64))))

    return map_arrow(elements, run, "class long, elements binary")


def unpacked(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // ELEMENT_BYTES, 8), np.uint8)
    wide[:, :ELEMENT_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, ELEMENT_BYTES)
    return wide.view(np.uint64).ravel()


# --- walking the lists -------------------------------------------------------------------


def _columns(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    for batch in batches:
        yield {name: batch.column(name).to_numpy() for name in batch.schema.names}


def _has_partner(size: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Which sets of one short list, ordered by size, may reach the threshold with another."""
    x, y = size[:, None], size[None, :]
    open_ = np.minimum(rest[:, None], rest[None, :]) >= needed(x, y)
    np.fill_diagonal(open_, False)
    return open_.any(axis=1)


def _partners(rows: dict[str, np.ndarray], starts: np.ndarray, lengths: np.ndarray, limits: Limits) -> np.ndarray:
    """Postings that some other posting of their list leaves open; of long lists, all."""
    size = rows["size"].astype(np.int64)
    rest = size - rows["position"]
    keep = np.repeat(lengths > limits.block_rows, lengths) | (rows["cell"] > 0)
    first = starts[lengths == 2]
    both = np.minimum(rest[first], rest[first + 1]) >= needed(size[first], size[first + 1])
    keep[first] |= both
    keep[first + 1] |= both
    for k in np.flatnonzero((lengths > 2) & (lengths <= limits.block_rows)).tolist():
        start, end = int(starts[k]), int(starts[k] + lengths[k])
        keep[start:end] |= _has_partner(size[start:end], rest[start:end])
    return keep


def _lists(postings: DataFrame, limits: Limits) -> DataFrame:
    """Postings that their list leaves open, each with the leader of its place in the list.

    Sets alone in a list, or kept from every other by size and position, are left out of it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(_columns(batches), ["shingle", "cell"]):
            once = run_starts(rows["shingle"], rows["cell"], rows["class"])
            rows = {name: column[once] for name, column in rows.items()}
            starts = run_starts(rows["shingle"], rows["cell"])
            lengths = np.diff(np.append(starts, len(rows["class"])))
            keep = _partners(rows, starts, lengths, limits)
            rows = {name: column[keep] for name, column in rows.items()}
            if not keep.any():
                continue
            starts = run_starts(rows["shingle"], rows["cell"])
            lengths = np.diff(np.append(starts, len(rows["class"])))
            leader = rows["class"].copy()
            for start, length in zip(starts.tolist(), lengths.tolist()):
                sizes, at = rows["size"][start : start + length], 0
                while at < length:
                    end = int(np.searchsorted(sizes, sizes[at] * 4 // 3, "right"))
                    leader[start + at : start + end] = rows["class"][start + at]
                    at = max(end, at + 1)
            names = ["shingle", "class", "size", "position"]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(rows[n]) for n in names], pa.array(leader)], [*names, "leader"]
            )

    by = ["shingle", "cell"]
    ordered = postings.repartition(*by).sortWithinPartitions(*by, "size", "class")
    schema = "shingle long, class long, size int, position int, leader long"
    return staged(map_arrow(ordered, run, schema), "shingle-lists")


def _block_pairs(rows: dict[str, np.ndarray], block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indexes of the pairs of one list, ordered by size, that can still reach the threshold
    by their sizes, places and short signatures, and have not met at a leader.

    For a set and a block before it the most any of the block's sets could share with it is
    known from their largest rest behind the shingle; if that is less than the smallest set
    of the block needs, the block is skipped.
    """
    size = rows["size"].astype(np.int64)
    rest, part = size - rows["position"], rows["component"]
    name, leader, cell = rows["class"], rows["leader"], rows["cell"]
    n = len(size)
    begins = np.arange(0, n, block)
    most_rest = np.maximum.reduceat(rest, begins)
    least_size = size[begins]
    one_part = np.minimum.reduceat(part, begins) == np.maximum.reduceat(part, begins)
    shorts = _Shorts(rows)
    for at, begin in enumerate(begins.tolist()):
        y = np.arange(begin, min(begin + block, n))[None, :]
        near = int(np.searchsorted(size, -(-3 * size[begin] // 4))) // block
        for other in range(near, at + 1):
            low = int(begins[other])
            if one_part[at] and one_part[other] and part[begin] == part[low]:
                continue
            if min(most_rest[at], most_rest[other]) < needed(least_size[other], size[begin]):
                continue
            x = np.arange(low, min(low + block, n))[:, None]
            ok = (x < y) & (part[x] != part[y]) & (4 * size[x] >= 3 * size[y])
            ok &= np.minimum(rest[x], rest[y]) >= needed(size[x], size[y])
            ok &= (leader[x] != leader[y]) | (cell[x] != cell[y]) | (cell[x] < 0)
            ok &= ((leader[x] != name[y]) | (cell[x] < 0)) & ((leader[y] != name[x]) | (cell[y] < 0))
            if ok.any():
                i, j = np.nonzero(ok)
                i, j = i + low, j + begin
                near = shorts.open(i, j)
                if near.any():
                    yield i[near], j[near]


_WALKED = "a long, b long, place long, partners long"


def _walked(lists: DataFrame, shorts: DataFrame, limits: Limits) -> DataFrame:
    """What the lists leave open between different components: pairs (a, b), or, of a list with
    more of them than sets, the sets (a) with the list (place) and their number of partners in it.
    """

    def distinct(held: list[np.ndarray]) -> np.ndarray:
        pairs = np.concatenate(held)
        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
        return pairs[run_starts(pairs[:, 0], pairs[:, 1])]

    def batch_of(*columns: np.ndarray | None) -> pa.RecordBatch:
        n = len(columns[0])
        arrays = [pa.nulls(n, pa.int64()) if column is None else pa.array(column, pa.int64()) for column in columns]
        return pa.RecordBatch.from_arrays(arrays, ["a", "b", "place", "partners"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for rows in runs(_columns(batches), ["shingle"]):
            starts = run_starts(rows["shingle"]).tolist()
            for start, end in zip(starts, [*starts[1:], len(rows["class"])]):
                one = {name: column[start:end] for name, column in rows.items()}
                name, partners, here, few = one["class"], np.zeros(end - start, np.int64), [], True
                for x, y in _block_pairs(one, limits.block_rows):
                    np.add.at(partners, x, 1)
                    np.add.at(partners, y, 1)
                    few = few and sum(map(len, here)) + len(x) <= max(FEW, end - start)
                    if few:
                        a, b = name[x], name[y]
                        here.append(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1))
                if not few:
                    met = np.flatnonzero(partners)
                    yield batch_of(name[met], None, np.full(len(met), one["shingle"][0]), partners[met])
                    continue
                held += here
                count += sum(map(len, here))
                if count > 250_000:
                    pairs = distinct(held)
                    yield batch_of(pairs[:, 0], pairs[:, 1], None, None)
                    held, count = [], 0
        if held:
            pairs = distinct(held)
            yield batch_of(pairs[:, 0], pairs[:, 1], None, None)

    spread = lists.groupBy("shingle").agg(F.min("component").alias("one"), F.max("component").alias("two"))
    mixed_lists = lists.join(spread.filter("one <> two").select("shingle"), "shingle", "left_semi")
    signed = mixed_lists.join(_broadcast_if_small(shorts), "class")
    ordered = signed.repartition("shingle").sortWithinPartitions("shingle", "size", "class")
    return staged(map_arrow(ordered, run, _WALKED), "open-lists")


def _met(walked: DataFrame, parts: DataFrame, sizes: DataFrame, elements: DataFrame, everywhere: bool) -> DataFrame:
    """Links (a, b) that join different components, among the sets of dense lists.

    The sets meet in the list where each has most partners, or `everywhere` they are named. What
    is too large for one task is cut into cells, and every two of them meet.
    """
    named = walked.filter("place IS NOT NULL").select(F.col("a").alias("class"), "place", "partners")
    if not everywhere:
        most = F.max_by("place", F.struct("partners", "place")).alias("place")
        named = named.groupBy("class").agg(most)
    part = parts.select(F.col("node").alias("class"), F.col("component").alias("part"))
    named = named.select("class", "place").join(sizes, "class").join(part, "class", "left")
    named = staged(named.withColumn("part", F.coalesce("part", "class")), "places")
    load, whole = F.sum("size"), F.lit(1)
    cells = F.when(load <= TOGETHER, whole).otherwise(F.ceil(2 * load / TOGETHER)).cast("int").alias("cells")
    own = F.pmod(F.xxhash64("class"), F.col("cells")).cast("int")
    celled = named.join(named.groupBy("place").agg(cells), "place").withColumn("own", own)
    celled = celled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    celled = celled.filter("cells = 1 OR other <> own").select(
        "class", "place", "part", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two")
    )
    by = ["place", "one", "two"]
    together = _only(elements, named).join(_broadcast_if_small(staged(celled, "places")), "class")
    together = together.repartition(*by).sortWithinPartitions(*by, "class")

    def meet(names: list[int], parts: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
        once = [k for k, name in enumerate(names) if k == 0 or name != names[k - 1]]
        names, sets = [names[k] for k in once], [sets[k] for k in once]
        _, part = np.unique(np.array([parts[k] for k in once], np.int64), return_inverse=True)
        beside = np.flatnonzero(part != np.bincount(part).argmax())  # the largest is met by all others
        shared = _Shared(sets)
        links = []
        for k in beside.tolist():
            apart = part != part[k]
            if not apart.any():
                break
            linked = apart & (7 * shared.overlaps(k) >= 3 * (shared.sizes + shared.sizes[k]))
            for other in np.flatnonzero(linked).tolist():
                if part[other] != part[k]:
                    part[part == part[other]] = part[k]
                    links.append((names[k], names[other]))
        return links

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, names, parts, sets = None, [], [], []

        def links() -> Iterator[pa.RecordBatch]:
            found = meet(names, parts, sets) if len(names) > 1 else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

        for batch in batches:
            for *at, name, part, raw in zip(*[batch.column(c).to_pylist() for c in [*by, "class", "part", "elements"]]):
                if at != place:
                    yield from links()
                    place, names, parts, sets = at, [], [], []
                names.append(name)
                parts.append(part)
                sets.append(unpacked(raw))
        yield from links()

    return staged(map_arrow(together, run, "a long, b long"), "met")


# --- overlaps ------------------------------------------------------------------------------


def _overlaps(pairs: DataFrame, elements: DataFrame) -> DataFrame:
    """The exact overlap of each distinct pair (a, b): a, b, size_a, size_b, overlap.

    Sets of `a` travel to their `b`, whose own set comes first in its run. The guests of a
    host that has many are dealt over cells, and its set goes to each of them.
    """
    cells = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / GUESTS).cast("int").alias("cells"))
    guests = pairs.join(cells, "b").select(
        F.col("a").alias("class"),
        F.col("b").alias("host"),
        F.pmod(F.xxhash64("a"), F.col("cells")).cast("int").alias("cell"),
    )
    elements = _only(elements, guests.select("class").unionByName(pairs.select(F.col("b").alias("class"))))
    visits = elements.join(_broadcast_if_small(guests), "class").select(
        "host", "cell", F.lit(1).alias("guest"), "class", "elements"
    )
    hosts = elements.join(_broadcast_if_small(cells.withColumnRenamed("b", "class")), "class").select(
        F.col("class").alias("host"),
        F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"),
        F.lit(0).alias("guest"),
        "class",
        "elements",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, own = None, np.empty(0, np.uint64)
        for batch in batches:
            rows = []
            for name, guest, key, raw in zip(
                batch.column("host").to_pylist(),
                batch.column("guest").to_pylist(),
                batch.column("class").to_pylist(),
                batch.column("elements").to_pylist(),
            ):
                if not guest:
                    host, own = name, unpacked(raw)
                    continue
                if name != host:
                    raise RuntimeError("a set is missing")
                other = unpacked(raw)
                at = np.minimum(np.searchsorted(own, other), len(own) - 1)
                rows.append((key, host, len(other), len(own), int((own[at] == other).sum())))
            if rows:
                columns = [pa.array(column, pa.int64()) for column in zip(*rows)]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b", "size_a", "size_b", "overlap"])

    together = hosts.unionByName(visits).repartition("host", "cell")
    together = together.sortWithinPartitions("host", "cell", "guest")
    schema = "a long, b long, size_a long, size_b long, overlap long"
    return staged(map_arrow(together, run, schema).distinct(), "overlaps")


class _Shared:
    """An index of the elements of sets, to count what one of them shares with each."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets, self.sizes = sets, np.array([len(one) for one in sets])
        owners, flat = np.repeat(np.arange(len(sets)), self.sizes), np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        self.owners, flat = owners[order], flat[order]
        self.starts = run_starts(flat)
        self.ends = np.append(self.starts[1:], len(flat))
        self.known = flat[self.starts]

    def overlaps(self, k: int) -> np.ndarray:
        at = np.searchsorted(self.known, self.sets[k])
        spans = zip(self.starts[at].tolist(), self.ends[at].tolist())
        return np.bincount(np.concatenate([self.owners[a:b] for a, b in spans]), minlength=len(self.sets))


_STAR = "a long, b long, size_a long, size_b long, overlap long, led boolean"


def _follow(lists: DataFrame) -> DataFrame:
    """(class, leader, cell): each set's leader, and the part of its followers it meets."""
    met = lists.filter("class <> leader").groupBy("class", "leader").agg(
        F.count(F.lit(1)).alias("lists"), F.max("size").alias("size")
    )
    best = F.max_by(F.struct("leader", "size"), F.struct("lists", "leader")).alias("best")
    return _dealt(met.groupBy("class").agg(best).select("class", "best.*"))


def _broadcast_if_small(places: DataFrame) -> DataFrame:
    """Where sets travel to, broadcast if all of it is small; else both sides are shuffled."""
    return F.broadcast(places) if 40 * places.count() <= BROADCAST_BYTES else places


def _dealt(first: DataFrame) -> DataFrame:
    """Followers (class, leader, size) with the cell of their leader they belong to."""
    load = first.groupBy("leader").agg(F.ceil(F.sum("size") / TOGETHER).cast("int").alias("cells"))
    cell = F.pmod(F.xxhash64("class"), F.col("cells")).cast("int").alias("cell")
    return staged(first.join(load, "leader").select("class", "leader", cell), "leaders")


def _meet_densest(pairs: DataFrame, sizes: DataFrame, elements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round of leaders chosen among open pairs: links found, and pairs that stay open.

    Each set follows the one of its partners that has most partners itself.
    """
    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degrees = both.groupBy("a").agg(F.count(F.lit(1)).alias("degree"))
    ranked = both.join(degrees.withColumnRenamed("a", "b"), "b")
    best = ranked.groupBy("a").agg(F.max_by("b", F.struct("degree", "b")).alias("leader"))
    follow = _dealt(best.withColumnRenamed("a", "class").join(sizes, "class"))
    one = follow.select(F.col("class").alias("a"), F.col("leader").alias("leader_a"), F.col("cell").alias("cell_a"))
    two = follow.select(F.col("class").alias("b"), F.col("leader").alias("leader_b"), F.col("cell").alias("cell_b"))
    met = F.expr("(leader_a = leader_b AND cell_a = cell_b) OR leader_a = b OR leader_b = a")
    left = staged(pairs.join(one, "a").join(two, "b").filter(~met).select("a", "b"), "open-pairs")
    return _stars(follow, elements).filter(_LINKED).select("a", "b"), left


SHORT_WORDS = 8
_SHORT = [f"bits{k}" for k in range(SHORT_WORDS)]


def _short(signatures: DataFrame) -> DataFrame:
    """(class, bits0, ...): signatures of at most 64 bytes, the shorter ones followed by zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = 8 * SHORT_WORDS
            whole = b"".join(folded(raw, width).ljust(width, b"\0") for raw in batch.column("signature").to_pylist())
            words = np.frombuffer(whole, "<i8").reshape(-1, SHORT_WORDS)
            columns = [pa.array(np.ascontiguousarray(words[:, k])) for k in range(SHORT_WORDS)]
            yield pa.RecordBatch.from_arrays([batch.column("class"), *columns], ["class", *_SHORT])

    schema = ", ".join(["class long", *[f"{name} long" for name in _SHORT]])
    return staged(map_arrow(signatures.select("class", "signature"), run, schema), "short-signatures")


class _Shorts:
    """Short signatures of a list's sets, to rule pairs out."""

    def __init__(self, rows: dict[str, np.ndarray]):
        self.size = rows["size"].astype(np.int64)
        self.words = np.stack([rows[name] for name in _SHORT], axis=1).view(np.uint64)
        bits = np.ceil(np.log2(np.maximum(3 * self.size, 64))).astype(np.int64)
        self.width = np.minimum(SHORT_WORDS, 1 << (bits - 6))  # in words
        self.folded: dict[int, np.ndarray] = {}

    def open(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Which pairs of rows may link."""
        width, both = np.minimum(self.width[one], self.width[two]), self.size[one] + self.size[two]
        keep = np.zeros(len(one), bool)
        for w in np.unique(width).tolist():
            if w not in self.folded:
                parts = self.words.reshape(len(self.words), SHORT_WORDS // w, w)
                self.folded[w] = np.bitwise_xor.reduce(parts, axis=1)
            at = np.flatnonzero(width == w)
            apart = np.bitwise_count(self.folded[w][one[at]] ^ self.folded[w][two[at]]).sum(axis=1, dtype=np.int64)
            keep[at] = both[at] - apart >= 2 * needed(self.size[one[at]], self.size[two[at]])
        return keep


def _signatures(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, size, signature) of the wanted classes, once each."""
    given = sets.filter("signature IS NOT NULL").select("class", "size", "signature")
    wanted = staged(classes.select("class").distinct(), "wanted")
    return given.join(_broadcast_if_small(wanted), "class", "left_semi").dropDuplicates(["class"])


def _promising(follow: DataFrame, signatures: DataFrame) -> DataFrame:
    """The followers that may link to another of their cell, or to its leader, by signature.

    Pairs of a cell that signatures rule out are decided without their elements. A cell of
    more than `MATRIX` sets keeps all of them, and decides by elements.
    """
    guests = follow.select("class", F.col("leader").alias("host"), "cell", F.lit(1).alias("guest"))
    hosts = follow.select(F.col("leader").alias("class"), F.col("leader").alias("host"), "cell").distinct()
    places = guests.unionByName(hosts.withColumn("guest", F.lit(0)))
    by = ["host", "cell"]
    together = signatures.join(_broadcast_if_small(places), "class").repartition(*by).sortWithinPartitions(*by, "guest")

    def keep(rows: list[tuple]) -> list[tuple]:
        if len(rows) > MATRIX:
            return [row for row in rows if row[3]]
        width = min(len(row[5]) for row in rows)
        bits = np.frombuffer(b"".join(folded(row[5], width) for row in rows), np.uint64).reshape(len(rows), -1)
        size = np.array([row[4] for row in rows], np.int64)
        open_ = np.zeros(len(rows), bool)
        step = max(1, (1 << 21) // bits.size)
        for k in range(0, len(rows), step):
            apart = np.bitwise_count(bits[k : k + step, None, :] ^ bits[None, :, :]).sum(axis=2, dtype=np.int64)
            both = size[k : k + step, None] + size[None, :]
            near = both - apart >= 2 * needed(size[k : k + step, None], size[None, :])
            near[np.arange(len(near)), np.arange(k, k + len(near))] = False
            open_[k : k + step] = near.any(axis=1)
        return [row for row, good in zip(rows, open_.tolist()) if good and row[3]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["host", "cell", "class", "guest", "size", "signature"]
        place, rows, found = None, [], []
        for batch in batches:
            for row in zip(*[batch.column(name).to_pylist() for name in names]):
                if row[:2] != place:
                    found += keep(rows) if len(rows) > 1 else []
                    place, rows = row[:2], []
                rows.append(row)
            if found:
                yield batch_of(found)
                found = []
        found += keep(rows) if len(rows) > 1 else []
        if found:
            yield batch_of(found)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        host, cell, name, _, _, _ = zip(*rows)
        columns = [pa.array(name, pa.int64()), pa.array(host, pa.int64()), pa.array(cell, pa.int32())]
        return pa.RecordBatch.from_arrays(columns, ["class", "leader", "cell"])

    return staged(map_arrow(together, run, "class long, leader long, cell int"), "promising")


def _still_open(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The pairs (a, b) that signatures do not rule out."""
    one = signatures.select(F.col("class").alias("a"), F.col("size").alias("size_a"), F.col("signature").alias("sign_a"))
    two = signatures.select(F.col("class").alias("b"), F.col("size").alias("size_b"), F.col("signature").alias("sign_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("sign_a", "sign_b", "size_a", "size_b")]
            yield batch.select(["a", "b"]).filter(pa.array([may_link(*row) for row in zip(*columns)], pa.bool_()))

    both = pairs.join(one, "a").join(two, "b").select("a", "b", "sign_a", "sign_b", "size_a", "size_b")
    return staged(map_arrow(both, run, "a long, b long"), "open-pairs")


def _stars(follow: DataFrame, elements: DataFrame) -> DataFrame:
    """Overlaps of followers with their leader (`led`), and links among its followers.

    A leader's set comes first among the followers of each cell. Those that link to it are
    joined; every other follower is compared with all of the cell at once, through an index
    of the cell's elements, and a link that joins two parts is kept.
    """
    guests = follow.select("class", F.col("leader").alias("host"), "cell", F.lit(1).alias("guest"))
    hosts = follow.select(F.col("leader").alias("class"), F.col("leader").alias("host"), "cell").distinct()
    places = guests.unionByName(hosts.withColumn("guest", F.lit(0)))
    by = ["host", "cell"]
    together = _only(elements, places).join(_broadcast_if_small(places), "class").repartition(*by)
    together = together.sortWithinPartitions(*by, "guest", "class")

    def star(names: list[int], sets: list[np.ndarray]) -> list[tuple]:
        once = [k for k, name in enumerate(names) if k == 0 or name != names[k - 1]]
        names, sets = [names[k] for k in once], [sets[k] for k in once]
        index = _Shared(sets)
        sizes, overlaps = index.sizes, index.overlaps
        part = np.arange(len(sets))
        shared = overlaps(0)
        linked = 7 * shared >= 3 * (sizes + sizes[0])
        part[linked] = 0
        rows = [
            (names[k], names[0], int(sizes[k]), int(sizes[0]), int(shared[k]), True) for k in range(1, len(sets))
        ]
        for k in np.flatnonzero(~linked).tolist():
            shared = overlaps(k)
            for other in np.flatnonzero(7 * shared >= 3 * (sizes + sizes[k])).tolist():
                if part[other] != part[k]:
                    part[part == part[other]] = part[k]
                    rows.append((names[k], names[other], int(sizes[k]), int(sizes[other]), int(shared[other]), False))
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, names, sets, rows = None, [], [], []
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("host", "cell", "class", "elements")]
            for host, cell, name, raw in zip(*columns):
                if (host, cell) != place:
                    if names:
                        rows += star(names, sets)
                    place, names, sets = (host, cell), [], []
                names.append(name)
                sets.append(unpacked(raw))
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(fields, row)) for row in rows], kinds)
                rows = []
        if names:
            yield pa.RecordBatch.from_pylist([dict(zip(fields, row)) for row in star(names, sets)], kinds)

    fields = [field.split()[0] for field in _STAR.split(", ")]
    kinds = pa.schema([(name, pa.bool_() if name == "led" else pa.int64()) for name in fields])
    return staged(map_arrow(together, run, _STAR), "stars")


_LINKED = "100 * overlap >= 75 * (size_a + size_b - overlap)"


def _derived(open_pairs: DataFrame, led: DataFrame, elements: DataFrame) -> DataFrame:
    """Links among the open pairs: from their leaders' answers where these settle them."""
    led = led.select("class", "leader", "size", "in_leader", "leader_size")
    one = led.select(*[F.col(c).alias(f"{c}_a") for c in led.columns])
    two = led.select(*[F.col(c).alias(f"{c}_b") for c in led.columns])
    pairs = open_pairs.join(one, F.col("a") == F.col("class_a"), "left")
    pairs = pairs.join(two, F.col("b") == F.col("class_b"), "left")
    hubs = pairs.select(
        "a", "b", "size_a", "size_b",
        F.coalesce("leader_a", "a").alias("hub_a"),
        F.coalesce("leader_b", "b").alias("hub_b"),
        F.coalesce(F.col("size_a") - F.col("in_leader_a"), F.lit(0)).alias("beside_a"),
        F.coalesce(F.col("size_b") - F.col("in_leader_b"), F.lit(0)).alias("beside_b"),
        F.coalesce(F.col("leader_size_a") - F.col("in_leader_a"), F.lit(0)).alias("missing_a"),
        F.coalesce(F.col("leader_size_b") - F.col("in_leader_b"), F.lit(0)).alias("missing_b"),
    )
    hubs = hubs.withColumns(
        {"low": F.least("hub_a", "hub_b"), "high": F.greatest("hub_a", "hub_b")}
    )
    hubs = staged(hubs, "hub-pairs")
    asked = hubs.select(F.col("low").alias("a"), F.col("high").alias("b")).filter("a <> b").distinct()
    answers = _overlaps(asked, elements)
    told = hubs.join(
        answers.select(
            F.col("a").alias("low"), F.col("b").alias("high"),
            F.col("size_a").alias("low_size"), F.col("size_b").alias("high_size"),
            F.col("overlap").alias("hub_overlap"),
        ),
        ["low", "high"],
    ).withColumns(
        {
            "size_a": F.coalesce("size_a", F.when(F.col("hub_a") == F.col("low"), F.col("low_size")).otherwise(F.col("high_size"))),
            "size_b": F.coalesce("size_b", F.when(F.col("hub_b") == F.col("low"), F.col("low_size")).otherwise(F.col("high_size"))),
        }
    )
    least = F.col("hub_overlap") - F.col("missing_a") - F.col("missing_b")
    most = F.col("hub_overlap") + F.col("beside_a") + F.col("beside_b")
    enough = F.lit(3) * (F.col("size_a") + F.col("size_b"))
    told = staged(told.select("a", "b", (least * 7 >= enough).alias("linked"), (most * 7 < enough).alias("apart")), "derived")
    left = _overlaps(told.filter("NOT linked AND NOT apart").select("a", "b"), elements)
    return told.filter("linked").select("a", "b").unionByName(left.filter(_LINKED).select("a", "b"))


def _in_parts(lists: DataFrame, follow: DataFrame, parts: DataFrame) -> DataFrame:
    """Postings with the component of their set, its leader, and the leader's cell it met."""
    named = lists.select("shingle", "class", "size", "position")
    named = named.join(parts.withColumnsRenamed({"node": "class"}), "class", "left")
    return named.join(follow, "class", "left").select(
        "shingle", "class", "size", "position",
        F.coalesce("component", "class").alias("component"),
        F.coalesce("leader", F.lit(0)).alias("leader"),
        F.coalesce("cell", F.lit(-1)).alias("cell"),
    )


def _apart(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs (a, b) of different components."""
    one = parts.select(F.col("node").alias("a"), F.col("component").alias("part_a"))
    two = parts.select(F.col("node").alias("b"), F.col("component").alias("part_b"))
    apart = F.coalesce("part_a", "a") != F.coalesce("part_b", "b")
    return pairs.join(one, "a", "left").join(two, "b", "left").filter(apart).select("a", "b")


def _components(docs: DataFrame, sets: DataFrame, limits: Limits) -> DataFrame:
    """(class, component) for every class that has a link."""
    lists = _lists(_postings(docs, _frequent(sets, limits), limits), limits)
    follow = _follow(lists)
    signatures = staged(_signatures(sets, lists.select("class")), "signatures")
    promising = _promising(follow, signatures)
    meeting = promising.select("class").unionByName(promising.select(F.col("leader").alias("class")))
    elements = _elements_of(docs, meeting.distinct(), sets)
    answers = _stars(promising, elements)
    links = answers.filter(_LINKED).select("a", "b")
    parts = connected(links)
    led = answers.filter("led").filter(_LINKED).select(
        F.col("a").alias("class"), F.col("b").alias("leader"), F.col("size_a").alias("size"),
        F.col("overlap").alias("in_leader"), F.col("size_b").alias("leader_size"),
    )
    shorts = _short(signatures)
    walked = _walked(_in_parts(lists, follow, parts), shorts, limits)
    pairs = _still_open(walked.filter("b IS NOT NULL").select("a", "b").distinct(), signatures)
    asked = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class")))
    asked = asked.unionByName(walked.filter("place IS NOT NULL").select(F.col("a").alias("class"))).distinct()
    asked = staged(asked.join(meeting, "class", "left_anti"), "asked")
    if asked.take(1):
        elements = elements.unionByName(_elements_of(docs, asked, sets))
    sizes = staged(lists.groupBy("class").agg(F.max("size").alias("size")), "sizes")
    for k in range(limits.rounds + 1):
        if not walked.filter("place IS NOT NULL").take(1):
            break
        links = links.unionByName(_met(walked, parts, sizes, elements, k == limits.rounds))
        parts = connected(links)
        if k < limits.rounds:  # only the dense lists are walked anew
            dense = walked.filter("place IS NOT NULL").select(F.col("place").alias("shingle")).distinct()
            again = staged(lists.join(_broadcast_if_small(staged(dense, "dense")), "shingle", "left_semi"), "again")
            walked = _walked(_in_parts(again, follow, parts), shorts, limits)
            new = _still_open(walked.filter("b IS NOT NULL").select("a", "b").distinct(), signatures)
            pairs = staged(_apart(pairs.unionByName(new).distinct(), parts), "open-pairs")
    for _ in range(limits.rounds):
        if not pairs.take(1):
            break
        found, pairs = _meet_densest(pairs, sizes, elements)
        links = links.unionByName(found)
    parts = connected(links)
    pairs = _apart(pairs, parts)
    links = links.unionByName(_derived(staged(pairs, "open-pairs"), led, elements))
    return connected(links).withColumnRenamed("node", "class")


def _located(docs: DataFrame, limits: Limits) -> DataFrame:
    """A row a document: doc_id, size, class, component (a class's name, or null), component_id."""
    docs = documents_of(docs)
    sets = _sets(docs, limits)
    members = sets.filter("shingle IS NULL").select("doc_id", "size", "class")
    parts = _components(docs, sets, limits)
    classes = members.filter("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("first"))
    named = classes.join(parts, "class", "left").withColumn("component", F.coalesce("component", "class"))
    named = staged(named, "classes")
    firsts = named.groupBy("component").agg(F.min("first").alias("component_id"))
    ids = named.join(firsts, "component").select("class", "component", "component_id")
    linked = members.filter("class IS NOT NULL").join(ids, "class")
    alone = members.filter("class IS NULL").withColumns(
        {"component": F.lit(None).cast("long"), "component_id": F.col("doc_id")}
    )
    return linked.unionByName(alone)


def jaccard_components(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """A row a document: doc_id, n_shingles, class, component_id.

    component_id is the smallest doc_id among the documents that links reach, the document's
    own included. Null and empty texts, and texts of white space, have an empty set, no class
    and no links. Repeated rows are of one class; a component whose doc_ids are all null has
    the id null. Other columns are left out.
    """
    columns = ["doc_id", F.col("size").alias("n_shingles"), "class", "component_id"]
    return _located(docs, limits).select(*columns)


def _with_class(docs: DataFrame, column: str) -> DataFrame:
    """The rows with their class in a further column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        for batch in batch_rows(batches, BATCH_BYTES):
            found = (shingles(raw, hashes) for raw in text_bytes(batch.column("text")))
            names = [class_of(one) if len(one) else None for one in found]
            yield batch.append_column(column, pa.array(names, pa.int64()))

    return map_arrow(docs, run, StructType([*docs.schema.fields, StructField(column, LongType())]))


def keep_one(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row of each group of linked documents, with all its columns: one of the smallest
    doc_id, null ids last. Documents without words are groups of their own.

    The choice is made among ids and classes; texts move once, to meet it. Where the chosen
    id stands on several rows of the chosen class, one of them stays.
    """
    groups = _located(docs, limits).filter("component IS NOT NULL").groupBy("component")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("class"))).alias("first")
    heads = staged(groups.agg(first).select(F.col("first.doc_id").alias("__id"), F.col("first.class").alias("__head")), "heads")
    named = _with_class(docs, "__class")
    same = (F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))) & (F.col("__class") == F.col("__head"))
    one = named.filter("__class IS NOT NULL").join(heads, same).dropDuplicates(["__id", "__head"])
    alone = named.filter("__class IS NULL")
    return one.select(docs.columns).unionByName(alone.select(docs.columns))
