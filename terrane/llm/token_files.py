"""Token ids as flat binary files with 64-bit document offsets, read by memory map.

A part of the output is three files of little-endian unsigned integers, without headers:

    <part>.ids       the ids of its documents one after another, 16 or 32 bits each
    <part>.offsets   64 bits each: where a document begins in the part, and the part's end
    <part>.docs      64 bits each: the documents' doc_id (two's complement)

The manifest, a small Parquet table, names the parts in order with their numbers of
documents and ids; the prefix sums of these numbers are the parts' bases in the corpus.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.llm.byte_bpe import END_OF_DOCUMENT, byte_bpe
from terrane.llm.common import batch_rows, documents_of, map_arrow, staged, texts_of
from terrane.session import scratch_path

BATCH_BYTES = 4 << 20
_MANIFEST = "part int, name string, null_ids long, documents long, ids long, bits int"


@dataclass(frozen=True)
class TokenFiles:
    """Where the parts lie, and the staged manifest with the parts' bases."""

    folder: str
    manifest: DataFrame


def file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    """The store of a folder; a bare path is a local, or locally mounted, one."""
    return pafs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def _plain(folder: str) -> str:
    """file:/x as file:///x, which is the form Arrow reads."""
    rest = folder.removeprefix("file:")
    return folder if rest == folder else "file:///" + rest.lstrip("/")


def write_token_files(
    docs: DataFrame, tokenizer_path: str, folder: str, *, id_bits: int = 16
) -> TokenFiles:
    """Encode every text, with one end id after it, and write the files in doc_id order.

    Documents are range-partitioned by doc_id and each task writes its range as one part, so
    parts in order are the corpus in order. A task writes under a name of its own and
    reports it; only names in the manifest count, so a repeated or lost attempt leaves
    nothing that is read. Null texts are empty ones (the end id alone), null doc_ids come
    first, repeated rows are written each; ties follow a hash of the text. Ids are 16-bit unless
    `id_bits` is 32; one that does not fit is an error.
    """
    folder = _plain(folder)
    kind = {16: "<u2", 32: "<u4"}[id_bits]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(folder)
        store.create_dir(base, recursive=True)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        bpe = byte_bpe(tokenizer_path)
        ids = documents = nulls = 0
        path = f"{base}/{name}"
        with (
            store.open_output_stream(f"{path}.ids") as ids_file,
            store.open_output_stream(f"{path}.offsets") as offsets_file,
            store.open_output_stream(f"{path}.docs") as docs_file,
        ):
            offsets_file.write(np.array([0], "<u8").tobytes())
            for batch in batch_rows(batches, BATCH_BYTES):
                encoded = bpe.batch(texts_of(batch.column("text")))
                lengths = np.array([len(one) // 4 + 1 for one in encoded], np.int64)
                end = np.array([END_OF_DOCUMENT], "<u4").tobytes()
                flat = np.frombuffer(end.join([*encoded, b""]), "<u4")
                if id_bits == 16 and len(flat) and flat.max() > 0xFFFF:
                    raise ValueError("an id does not fit 16 bits; pass id_bits=32")
                ids_file.write(flat.astype(kind).tobytes())
                offsets_file.write((ids + np.cumsum(lengths)).astype("<u8").tobytes())
                keys = batch.column("doc_id")
                nulls += keys.null_count
                docs_file.write(keys.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                ids += len(flat)
                documents += len(encoded)
        if documents:
            row = [[part], [name], [nulls], [documents], [ids], [id_bits]]
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            names = [field.split()[0] for field in _MANIFEST.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names)

    order = ["doc_id", F.xxhash64("text")]  # the hash splits the rows of a hot doc_id
    ordered = documents_of(docs).repartitionByRange(*order).sortWithinPartitions(*order, "text")
    manifest = staged(map_arrow(ordered, write, _MANIFEST), "token-manifest")
    return TokenFiles(folder, with_bases(manifest))


def with_bases(manifest: DataFrame) -> DataFrame:
    """The manifest with each part's first document and id: sums over the parts before it.

    One row a part, so one task can add them up.
    """
    rows = manifest.orderBy("part").collect()
    based, documents, ids = [], 0, 0
    for row in rows:
        based.append((*row, documents, ids))
        documents, ids = documents + row["documents"], ids + row["ids"]
    schema = f"{_MANIFEST}, first_document long, first_id long"
    return manifest.sparkSession.createDataFrame(based, schema)


def read_token_files(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """A row a document from the files: doc_id, start among all ids, n_tokens, ids_crc32.

    A local or mounted folder is memory-mapped; other stores are read a range at a time.
    """
    folder = files.folder

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(folder)
        local = isinstance(store, pafs.LocalFileSystem)
        for batch in batches:
            for row in batch.to_pylist():
                kind, path = f"<u{row['bits'] // 8}", f"{base}/{row['name']}"
                opened = pa.memory_map if local else store.open_input_file
                with opened(f"{path}.offsets") as file:
                    offsets = np.frombuffer(file.read(), "<u8").astype(np.int64)
                with opened(f"{path}.docs") as file:
                    keys = np.frombuffer(file.read(), "<i8")
                with opened(f"{path}.ids") as file:
                    yield from _digests(file, kind, offsets, keys, row)

    parts = files.manifest.repartition(
        max(1, min(files.manifest.count(), spark.sparkContext.defaultParallelism * 4)), "part"
    )
    return map_arrow(parts, read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _digests(file, kind: str, offsets: np.ndarray, keys: np.ndarray, row: dict):
    width = np.dtype(kind).itemsize
    step = 4096
    for first in range(0, len(keys), step):
        last = min(first + step, len(keys))
        file.seek(int(offsets[first]) * width)
        size = int(offsets[last] - offsets[first]) * width
        flat = np.frombuffer(file.read(size), kind).astype("<u4")
        here = offsets[first : last + 1] - offsets[first]
        crcs = [zlib.crc32(flat[a:b]) for a, b in zip(here[:-1], here[1:])]
        numbers = np.arange(first, last)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys[first:last], pa.int64(), mask=numbers < row["null_ids"]),
                pa.array(row["first_id"] + offsets[first:last], pa.int64()),
                pa.array(np.diff(offsets[first : last + 1]), pa.int64()),
                pa.array(crcs, pa.int64()),
            ],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def token_files(docs: DataFrame, tokenizer_path: str, folder: str | None = None) -> DataFrame:
    """Write the files, in a fresh scratch folder unless one is named, and read them back."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    return read_token_files(spark, write_token_files(docs, tokenizer_path, folder))
