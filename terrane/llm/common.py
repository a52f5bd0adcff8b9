"""What the operators share: staged tables, gapless numbering, word hashing, columns."""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terrane.session import importable, scratch_path, settings

# White space of the word definition `[^\x20\x09-\x0D]+`; bytes.split() knows the same six.
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: its lineage ends here."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}):
        df.write.parquet(path)  # long texts make large batches
    return spark.read.schema(df.schema).parquet(path)


def documents_of(docs: DataFrame) -> DataFrame:
    """Only what the operators read, under names that cannot clash: doc_id and text."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def map_arrow(df: DataFrame, function, schema: str | StructType) -> DataFrame:
    importable(df.sparkSession)
    return df.mapInArrow(function, schema)


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Python strings, with the empty string for null."""
    return [text if text is not None else "" for text in column.to_pylist()]


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes, with the empty string for null."""
    return [raw if raw is not None else b"" for raw in column.cast(pa.binary()).to_pylist()]


class WordHashes(dict):
    """64-bit hashes of words, remembered; forgets everything once `most` are held.

    Words over `longest` bytes are hashed anew each time, so what is held is bounded in bytes
    too, also where texts have no spaces.
    """

    def __init__(self, most: int = 300_000, longest: int = 64):
        super().__init__()
        self.most, self.longest = most, longest

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[word] = value
        return value

    def of(self, words: Sequence[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_kept: dict[tuple, object] = {}


def kept_by_worker(make: Callable, *arguments):
    """What a worker process remembers from task to task, for one operator at a time: what
    another one kept before is let go, so that memory stays bounded."""
    key = (make, *arguments)
    if key not in _kept:
        _kept.clear()
        gc.collect()
        _kept[key] = make(*arguments)
    return _kept[key]


@contextmanager
def no_cycles() -> Iterator[None]:
    """No search for cycles meanwhile, where many small objects are made that form none."""
    before = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if before:
            gc.enable()


def word_hashes() -> WordHashes:
    return kept_by_worker(WordHashes)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finalizer of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of `width` word hashes, a polynomial in them; order counts."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n]
    for shift in range(1, width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[shift : shift + n]
    return mixed(out)


class KeyFilter:
    """A Bloom filter of a frame's 64-bit keys: 32 bits a key and three probes, which pass one
    other key in 1,500. It never takes more than `most` bytes; past 8 keys a byte of it passes
    more, up to all, which costs work behind it but no result."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @classmethod
    def of(cls, frame: DataFrame, column: str, most: int = 16 << 20) -> KeyFilter:
        keys = frame.select(F.col(column).cast("long").alias("key")).filter("key IS NOT NULL")
        bits = min(8 * most, 1 << max(12, (32 * keys.count()).bit_length()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = cls(np.zeros(bits // 64, np.uint64))
            for batch in batches:
                key = batch.column(0).to_numpy().astype(np.uint64)
                for _ in range(3):
                    key, word, bit = part.probe(key)
                    np.bitwise_or.at(part.words, word, np.uint64(1) << bit)
            used = np.flatnonzero(part.words)
            columns = [pa.array(used, pa.int64()), pa.array(part.words[used].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["word", "bits"])

        parts = map_arrow(keys, run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
        whole, words = parts.toArrow(), np.zeros(bits // 64, np.uint64)
        words[whole["word"].to_numpy()] = whole["bits"].to_numpy().astype(np.uint64)
        return cls(words)

    def probe(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = mixed(keys)
        place = keys & np.uint64(64 * len(self.words) - 1)
        return keys, (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)

    def found(self, keys: np.ndarray) -> np.ndarray:
        """Where the keys are, perhaps, that the filter was made of."""
        at = np.arange(len(keys))
        for _ in range(3):
            keys, word, bit = self.probe(keys)
            held = (self.words[word] >> bit) & np.uint64(1) > 0
            at, keys = at[held], keys[held]
        return at


def batch_rows(batches: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The same batches, cut so that none holds much more than `most_bytes`."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = max(1, int(batch.num_rows * most_bytes / max(1, batch.nbytes)))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def runs(
    chunks: Iterator[dict[str, np.ndarray]], by: Sequence[str]
) -> Iterator[dict[str, np.ndarray]]:
    """Columns that come sorted, cut anew so that rows equal in `by` are in one piece."""
    held: list[dict[str, np.ndarray]] = []

    def flush() -> dict[str, np.ndarray]:
        whole = {name: np.concatenate([part[name] for part in held]) for name in held[0]}
        held.clear()
        return whole

    for chunk in chunks:
        rows = len(chunk[by[0]])
        if not rows:
            continue
        if held and any(held[-1][name][-1] != chunk[name][0] for name in by):
            yield flush()
        ends = run_starts(*[chunk[name] for name in by])
        last = int(ends[-1])
        if last:
            held.append({name: column[:last] for name, column in chunk.items()})
            yield flush()
        held.append({name: column[last:] for name, column in chunk.items()})
    if held:
        yield flush()


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """Where the values of sorted columns change; the first row counts."""
    change = np.zeros(len(columns[0]), bool)
    change[:1] = True
    for column in columns:
        change[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(change)


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    name: str,
    *,
    salt: Column,
    salts: int,
) -> DataFrame:
    """Number the rows of each key from 0 without gaps, in a column `name`.

    A key's rows are dealt over `salts` cells by `salt`; each cell is numbered by itself and
    starts where the cells before it end, so a key with a third of all rows is spread over
    as many tasks. Within a cell rows follow `order`; among cells the order is free. Keys
    must not be null. The frame is used twice and should be a staged one.
    """
    cell = F.pmod(F.xxhash64(salt), F.lit(salts)).cast("int")
    celled = df.withColumn("_cell", cell)
    sizes = celled.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sizes.withColumn("_base", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    inside = Window.partitionBy(*keys, "_cell").orderBy(*order)
    joined = celled.join(starts.drop("_rows"), [*keys, "_cell"])
    rank = F.col("_base") + F.row_number().over(inside) - 1
    return joined.withColumn(name, rank.cast("long")).drop("_cell", "_base")
