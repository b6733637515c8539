"""What the operators share: the cluster's shared folder, staged tables, text batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Separators between words: blank and the five control characters from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SEPARATORS = " \t\n\x0b\x0c\r"

#: Allocator settings of the Python workers. Workers of one stage are still there when the next begins; with
#: these they give large freed blocks back at once instead of keeping them.
LEAN_WORKERS = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "2",
    "MALLOC_MMAP_THRESHOLD_": "262144",
    "MALLOC_TRIM_THRESHOLD_": "262144",
}


def lean_workers(spark: SparkSession) -> None:
    """Have the workers of later stages give freed memory back; a session's own settings stay."""
    environment = spark.sparkContext.environment
    for name, value in LEAN_WORKERS.items():
        environment.setdefault(name, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a scratch one only where that is unset, as in tests."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="corpus-shared-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read. The files stay until the folder is cleared.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(id_col: str, text_col: str) -> Column:
    """A text that names a row by id and text hash; it sorts as ids from 0 do, null ids come last.

    Other ids (texts, negative numbers) stay whole behind a tilde, so that no two ids read alike.
    """
    text = F.col(id_col).cast("string")
    plain = text.rlike(r"^(0|[1-9][0-9]{0,18})\z")
    number = F.when(plain, F.lpad(text, 20, "0")).otherwise(F.concat(F.lit("~"), text))
    return F.concat(F.coalesce(number, F.lit("\x7f")), F.lit(":"), F.xxhash64(text_col).cast("string"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)


def make_folder(path: str) -> None:
    fs, name = filesystem(path)
    fs.create_dir(name, recursive=True)


@contextmanager
def written_shared(path: str) -> Iterator[BinaryIO]:
    """Write a file of the shared folder under a name of this attempt's own and move it to ``path`` at
    the end, so that a repeated or doubled task leaves one whole file."""
    fs, name = filesystem(path)
    attempt = f"{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(attempt, compression=None) as out:
        yield out
    fs.move(attempt, name)


def open_shared(path: str) -> BinaryIO:
    fs, name = filesystem(path)
    return fs.open_input_file(name)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column in one array, and each row's bounds; null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    if data is None:
        return np.empty(0, np.uint8), bounds - bounds[0]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches into pieces of about ``limit`` text bytes; a longer text stays whole, alone."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        start = 0
        while start < len(lengths):
            base = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, base + limit, side="right")), start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def spread(values: np.ndarray) -> np.ndarray:
    """Mix 64-bit integers so that all their bits depend on all bits given (a bijection)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int, base: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash every word of a batch of texts.

    A word is a maximal run, inside one text, of bytes for which ``is_word[byte]`` holds. Returns the
    words' 64-bit hashes and, for each text, the index of its first word (one entry more than texts).
    """
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = is_word[data]
    opens = np.zeros(len(data) + 1, bool)
    opens[1:] = ~inside[:-1]
    opens[bounds] = True
    starts = np.flatnonzero(inside & opens)
    first = np.searchsorted(starts, bounds)
    if not len(starts):
        return np.empty(0, np.uint64), first
    # Sums of bytes times powers of an odd base; those of a word are taken from running totals and
    # brought to the same power by the base's inverse.
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)
    value = np.where(inside[:-1], data.astype(np.uint64) + np.uint64(1), np.uint64(0))
    sums = np.add.reduceat(value * powers(len(data), base), starts)
    sums *= powers(len(data), inverse)[starts]
    lengths = np.add.reduceat(inside[:-1].astype(np.uint64), starts)
    return spread(sums + lengths * np.uint64(0xD6E8FEB86659FD93)), first
