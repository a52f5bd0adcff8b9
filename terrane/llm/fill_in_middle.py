"""Fill-in-middle: documents rearranged so that a model learns to fill a gap.

A document is cut into units (a run of white space with the word behind it; white space at the
end is a unit of its own), two cuts drawn from the document's id part prefix, middle and
suffix, and markers name the parts in the order prefix-suffix-middle (`psm`) or
suffix-prefix-middle (`spm`). The rest of the documents stay `plain`.

All work on texts is Arrow kernels on whole batches: units become list arrays, these are
flattened with the indices of their documents, ordinals decide each unit's role, each role is
filtered and its lists are built anew, and the pieces are joined with the markers. Rows never
meet, so there is no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.llm.common import batch_rows, documents_of, map_arrow

# The markers before prefix, suffix and middle, and the forms.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

_MARKERS = "<[PSM]>"
# A unit ends where white space follows a word. On bytes; no byte of a longer code point is
# white space.
_END = r"([^\x20\x09-\x0D])([\x20\x09-\x0D])"
_CUT = b"\xff"  # no byte of UTF-8
_BATCH_BYTES = 16 << 20
_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def fill_in_middle(docs: DataFrame, *, seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (code points) and output per row.

    `rate` percent of the documents are rearranged, `spm` percent of these suffix first; both
    follow the sha256 of `<seed>:<doc_id>`, so rows of one doc_id share their draws and a
    retried task makes the same ones. Null and empty texts, and texts that hold a marker, stay
    plain: output is the text (empty for null), prefix_chars and middle_chars are null. A null
    doc_id counts as an empty one. Other columns are left behind. An empty table gives no rows.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = [
        F.conv(F.substring("_digest", 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)
    ]
    drawn = documents_of(docs).withColumn("_digest", digest).select("doc_id", "text", *draws)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batch_rows(batches, _BATCH_BYTES):
            yield rearranged(batch, rate, spm)

    return map_arrow(drawn, work, _SCHEMA)


def restore(transformed: DataFrame) -> DataFrame:
    """Add `restored`: the text before the rearrangement, from output and form alone.

    Markers have no part in common, so none can arise where a piece meets one: the first
    three are the markers that were put in. A null output gives an empty text.
    """
    schema = T.StructType([*transformed.schema.fields, T.StructField("restored", T.StringType())])
    names = schema.names

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batch_rows(batches, _BATCH_BYTES):
            output = _bytes(batch.column(names.index("output")))
            text = restored(output, batch.column(names.index("form")))
            yield pa.RecordBatch.from_arrays([*batch.columns, text.cast(pa.string())], names=names)

    return map_arrow(transformed, work, schema)


def _bytes(column: pa.Array) -> pa.Array:
    return column.fill_null("").cast(pa.large_binary())


def _joined(*pieces) -> pa.Array:
    parts = [pa.scalar(piece, pa.large_binary()) if isinstance(piece, bytes) else piece for piece in pieces]
    return pc.binary_join_element_wise(*parts, pa.scalar(b"", pa.large_binary()))


def unit_counts(texts: pa.Array) -> np.ndarray:
    """Units of each text: one more than the places where one ends before white space."""
    ends = pc.count_substring_regex(texts, _END).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.where(_lengths(texts) > 0, ends + 1, 0)


def _lengths(texts: pa.Array) -> np.ndarray:
    return pc.binary_length(texts).to_numpy(zero_copy_only=False)


def cut_texts(texts: pa.Array, first: np.ndarray, second: np.ndarray) -> list[pa.Array]:
    """Prefix, middle and suffix of texts that are not empty: units before `first`, before
    `second`, and the rest."""
    units = pc.split_pattern(pc.replace_substring_regex(texts, _END, b"\\1" + _CUT + b"\\2"), _CUT)
    counts = pc.list_value_length(units).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(units)
    parents = pc.list_parent_indices(units).to_numpy(zero_copy_only=False)
    ordinals = np.arange(len(flat)) - (np.cumsum(counts) - counts)[parents]
    roles = (ordinals >= first[parents]).astype(np.int8) + (ordinals >= second[parents])
    pieces = []
    for role, sizes in enumerate((first, second - first, counts - second)):
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        chosen = flat.filter(pa.array(roles == role))
        lists = pa.ListArray.from_arrays(offsets, chosen)
        pieces.append(pc.binary_join(lists, pa.scalar(b"", flat.type)))
    return pieces


def rearranged(batch: pa.RecordBatch, rate: int, spm: int) -> pa.RecordBatch:
    doc_id, texts = batch.column(0), _bytes(batch.column(1))
    h1, h2, h3, h4 = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(2, 6))
    n = unit_counts(texts)
    marked = pc.match_substring_regex(texts, _MARKERS).to_numpy(zero_copy_only=False)
    moved = (n > 0) & ~marked & (h3 % 100 < rate)
    suffix_first = h4 % 100 < spm
    one, two = h1 % (n + 1), h2 % (n + 1)
    rows = np.flatnonzero(moved)
    first, second = np.minimum(one, two)[rows], np.maximum(one, two)[rows]
    prefix, middle, suffix = cut_texts(texts.take(pa.array(rows)), first, second)
    output = pc.if_else(
        pa.array(suffix_first[rows]),
        _joined(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle),
        _joined(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle),
    )
    place = np.full(len(n), -1)
    place[rows] = np.arange(len(rows))
    back = pa.array(place, mask=~moved)  # null where the text stays plain
    form = np.where(moved, np.where(suffix_first, SPM, PSM), PLAIN)
    columns = [
        doc_id,
        pa.array(n, pa.int64()),
        pa.array(form.tolist(), pa.string()),
        _characters(prefix).take(back),
        _characters(middle).take(back),
        pc.coalesce(output.take(back), texts).cast(pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def _characters(texts: pa.Array) -> pa.Array:
    return pc.utf8_length(texts.cast(pa.large_string())).cast(pa.int64())


def restored(output: pa.Array, form: pa.Array) -> pa.Array:
    plain = pc.equal(form, PLAIN).fill_null(True).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(~plain)
    moved = output.take(pa.array(rows))
    pieces = pc.split_pattern_regex(moved, _MARKERS, max_splits=3)
    first, second, third = (pc.list_element(pieces, k) for k in (1, 2, 3))
    suffix_first = pc.equal(form.take(pa.array(rows)), SPM)
    text = pc.if_else(suffix_first, _joined(second, third, first), _joined(first, third, second))
    place = np.full(len(plain), -1)
    place[rows] = np.arange(len(rows))
    return pc.coalesce(text.take(pa.array(place, mask=plain)), output)
