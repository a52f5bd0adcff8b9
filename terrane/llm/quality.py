"""Quality rules: zstandard compression bands over whole documents and fixed chunks."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Row
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
from terrane.llm.toxicity import held_out
from terrane.operators.quantiles import exact_quantiles

SYMBOLS = re.compile(rb"[#*$%&|<>]")
BATCH_BYTES = 4 << 20
NO_CONTINUATION = bytes(range(0x80)) + bytes(range(0xC0, 0x100))  # bytes that begin a character

# (bytes below, least ratio, greatest ratio), for tables without enough labelled clean texts to
# learn limits from: a short text hardly compresses, a long one of ordinary prose at two to
# three times; repetition goes far above, and base64 or noise stays below 1.4.
WHOLE_BANDS = (
    (200, 0.0, 3.0),
    (500, 1.0, 3.5),
    (1_000, 1.25, 4.0),
    (2_000, 1.4, 5.0),
    (5_000, 1.4, 6.0),
    (20_000, 1.4, 7.0),
    (float("inf"), 1.4, 8.0),
)


@dataclass(frozen=True)
class Bands:
    """Limits of the verdict. A text is kept if its ratio lies within the band of its length
    and no more than `bad_chunks` of its chunks lie outside the band of theirs (those of
    `whole`, if there are none for chunks)."""

    whole: tuple = WHOLE_BANDS
    chunk: tuple | None = None
    chunk_bytes: int = 4096
    least_chunk: int = 1024  # a shorter last chunk is judged with the whole only
    bad_chunks: float = 0.1
    level: int = 3


@dataclass(frozen=True)
class Learning:
    """How limits follow from the ratios of clean texts. A length class is half an octave, or
    more until it holds `least` ratios; its limits are the quantiles `tail` and 1 - `tail`,
    moved out by `margin` of themselves. Of fewer than `enough` texts nothing is learnt."""

    least: int = 30
    enough: int = 200
    tail: float = 0.005
    margin: float = 0.02


COUNTS = """n_words long, word_chars long, n_symbols long, n_dup_lines long,
            n_repeat_words long, base_failed boolean, ratio double, bad_chunk_share double,
            kept boolean"""


def beyond(ratio: float, size: int, limits: tuple) -> bool:
    for below, least, most in limits:
        if size < below:
            return not least <= ratio <= most
    return False


def outside(ratio: float, size: int, bands: Bands) -> bool:
    return beyond(ratio, size, bands.whole)


class Judge:
    """Counts and verdict of one text at a time."""

    def __init__(self, bands: Bands):
        self.bands = bands
        self.hashes = word_hashes()
        self.compress = zstandard.ZstdCompressor(level=bands.level).compress

    def ratio(self, raw: bytes) -> float:
        return len(raw) / len(self.compress(raw))

    def repeated_words(self, words: list[bytes]) -> int:
        """Words inside 8-word windows that the text holds at least twice."""
        windows = window_hashes(self.hashes.of(words), 8)
        if len(windows) < 2:
            return 0
        order = np.argsort(windows, kind="stable")
        same = windows[order][1:] == windows[order][:-1]
        twice = np.zeros(len(windows), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        edges = np.zeros(len(words) + 1, np.int64)
        starts = np.flatnonzero(twice)
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + 8, -1)
        return int((np.cumsum(edges) > 0).sum())

    def chunks(self, raw: bytes) -> Iterator[bytes]:
        for start in range(0, len(raw), self.bands.chunk_bytes):
            chunk = raw[start : start + self.bands.chunk_bytes]
            if len(chunk) >= self.bands.least_chunk:
                yield chunk

    def fails(self, words: list[bytes], repeated: int) -> bool:
        return len(words) < 20 or 100 * repeated > 30 * len(words)

    def __call__(self, raw: bytes) -> tuple:
        words = raw.split()
        joined = b"".join(words)
        chars = len(joined) - len(joined.translate(None, NO_CONTINUATION))
        symbols = len(SYMBOLS.findall(joined))
        lines = [line for line in raw.split(b"\n") if line.strip()]
        repeated = self.repeated_words(words)
        failed = self.fails(words, repeated)
        ratio = self.ratio(raw) if raw else 0.0
        bands, bad, judged = self.bands, 0, 0
        limits = bands.whole if bands.chunk is None else bands.chunk
        for chunk in self.chunks(raw):
            judged += 1
            bad += beyond(self.ratio(chunk), len(chunk), limits)
        share = bad / judged if judged else 0.0
        kept = bool(raw) and not failed and not outside(ratio, len(raw), bands)
        return (
            len(words),
            chars,
            symbols,
            len(lines) - len(set(lines)),
            repeated,
            failed,
            ratio,
            share,
            kept and share <= bands.bad_chunks,
        )


# --- limits from clean texts ----------------------------------------------------------------


def length_classes(octaves: Sequence[Row], least: int) -> list[list[Row]]:
    """Half octaves (octave, n, shortest, longest) in order of size, joined with the next ones
    until a class holds `least` ratios."""
    classes: list[list[Row]] = [[]]
    held, left = 0, sum(octave.n for octave in octaves)
    for octave in octaves:
        if classes[-1] and min(held, left) >= least:
            classes.append([])
            held = 0
        classes[-1].append(octave)
        held, left = held + octave.n, left - octave.n
    return classes


def limits_of(
    classes: Sequence[list[Row]], quantiles: Sequence[Row], learning: Learning, general: tuple
) -> tuple:
    """Limits by length class from the low and high quantiles of the classes' ratios.

    Outside the lengths seen, the `general` limits hold where they are wider.
    """
    shortest, longest = classes[0][0].shortest, classes[-1][-1].longest
    ends = [*[octaves[0].shortest for octaves in classes[1:]], longest + 1]
    found = [
        (below, q.low * (1 - learning.margin), q.high * (1 + learning.margin))
        for below, q in zip(ends, quantiles)
    ]
    shorter = [(min(b, shortest), min(low, found[0][1]), max(high, found[0][2])) for b, low, high in general]
    shorter = [band for k, band in enumerate(shorter) if not k or band[0] > shorter[k - 1][0]]
    longer = [(b, min(low, found[-1][1]), max(high, found[-1][2])) for b, low, high in general if b > longest + 1]
    return (*shorter, *found, *longer)


def clean_ratios(docs: DataFrame, labels: DataFrame, bands: Bands) -> DataFrame:
    """place (0: the whole text, then its chunks), bytes, ratio and half octave of size of every
    text labelled clean that passes the base rules. A written table.

    A bounded filter of the clean doc_ids spares other texts the compression; only sizes and
    ratios, never texts, are shuffled to be joined with the ids themselves.
    """
    clean = labels.filter("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long"))
    clean = clean.filter(~held_out(F.col("doc_id"))).distinct()
    wanted = KeyFilter.of(clean, "doc_id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(bands)
        for batch in batch_rows(batches, BATCH_BYTES):
            rows = []
            batch = batch.take(pa.array(wanted.found(batch.column("doc_id").to_numpy().astype(np.uint64))))
            for key, raw in zip(batch.column("doc_id").to_pylist(), text_bytes(batch.column("text"))):
                words = raw.split()
                if not judge.fails(words, judge.repeated_words(words)):
                    for place, part in enumerate(chain([raw], judge.chunks(raw))):
                        octave = int(np.floor(2 * np.log2(len(part))))
                        rows.append((key, place, len(part), judge.ratio(part), octave))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.int32()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "place", "bytes", "ratio", "octave"])

    texts = documents_of(docs).filter("doc_id IS NOT NULL")
    measured = map_arrow(texts, measure, "doc_id long, place int, bytes long, ratio double, octave int")
    one = measured.join(clean, "doc_id").groupBy("doc_id", "place")
    one = one.agg(F.min(F.struct("bytes", "ratio", "octave")).alias("one"))
    return staged(one.select("place", "one.*"), "quality-ratios")


def learn_bands(
    docs: DataFrame, labels: DataFrame, bands: Bands = Bands(), learning: Learning = Learning()
) -> Bands:
    """`bands` with limits for whole texts and for chunks from all texts labelled clean.

    `labels` has doc_id and quality (1 is clean); rows held out are not read. Texts that fail
    the base rules teach nothing. Every clean text and chunk counts: sizes are counted by half
    octave, ratios ranked where they lie, and only a row a class comes to the driver.
    """
    ratios = clean_ratios(docs, labels, bands).withColumn("chunk", F.col("place") > 0)
    sizes = ratios.groupBy("chunk", "octave").agg(
        F.count(F.lit(1)).alias("n"), F.min("bytes").alias("shortest"), F.max("bytes").alias("longest")
    )
    sizes = sorted(sizes.collect(), key=lambda row: row.octave)
    classes = {}
    for chunk in (False, True):
        octaves = [row for row in sizes if row.chunk == chunk]
        if sum(row.n for row in octaves) >= learning.enough:
            classes[chunk] = length_classes(octaves, learning.least)
    if False not in classes:
        return bands
    number = F.lit(None)
    for chunk, found in classes.items():
        starts = F.array(*[F.lit(octaves[0].octave) for octaves in found])
        passed = F.size(F.filter(starts, lambda start: start <= F.col("octave")))
        number = F.when(F.col("chunk") == chunk, passed).otherwise(number)
    numbered = ratios.withColumn("number", number).filter("number IS NOT NULL")
    tails = {"low": learning.tail, "high": 1 - learning.tail}
    quantiles = exact_quantiles(numbered, ["chunk", "number"], "ratio", tails)
    quantiles = sorted(quantiles.collect(), key=lambda row: row.number)
    learnt = {
        "chunk" if chunk else "whole": limits_of(
            found, [row for row in quantiles if row.chunk == chunk], learning, bands.whole
        )
        for chunk, found in classes.items()
    }
    return replace(bands, **learnt)


# --- verdicts -------------------------------------------------------------------------------


def _judged(batch: pa.RecordBatch, judge: Judge) -> list[tuple]:
    return [judge(raw) for raw in text_bytes(batch.column("text"))]


def quality(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """doc_id with the counts, the ratio and the verdict of every text, row by row.

    Null and empty texts count nothing, fail the base rules and are not kept. Repeated rows
    are judged each; other columns are left out. An empty table gives an empty one.
    """

    def judge_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(bands)
        for batch in batch_rows(batches, BATCH_BYTES):
            columns = list(zip(*_judged(batch, judge))) or [()] * 9
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            names = [part.split()[0] for part in COUNTS.split(",")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *arrays], ["doc_id", *names]
            )

    return map_arrow(documents_of(docs), judge_batches, f"doc_id long, {COUNTS}")


def keep_quality(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The rows whose text is kept, with all their columns; needs a column `text`."""

    def keep_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(bands)
        for batch in batch_rows(batches, BATCH_BYTES):
            kept = [row[-1] for row in _judged(batch, judge)]
            yield pc.filter(batch, pa.array(kept, pa.bool_()))

    return map_arrow(docs, keep_batches, docs.schema)
