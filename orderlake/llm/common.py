"""Helpers shared by the operators: stored frames, Arrow maps, document order."""

from __future__ import annotations

import ctypes
import itertools
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.session import new_scratch_dir

# Rows and bytes that one Arrow batch hands to a Python worker at most.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches, so that a batch of very long texts fits a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """The frame written to the shared scratch folder and read back: lineage ends there."""
    spark = df.sparkSession
    path = new_scratch_dir(spark, label)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def column(batch: pa.RecordBatch, name: str) -> list:
    """A column of a batch as Python values."""
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Texts of a batch; a null text counts as an empty one."""
    return [t or "" for t in column(batch, name)]


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows holding about ``most`` units each, one row at least."""
    lo = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


def offsets_of(lengths) -> np.ndarray:
    """Start of each of consecutive runs, and the end of the last."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of an id as text, modulo n; null ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(n))


MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A full-avalanche mix of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """64-bit hashes of words, remembered in a bounded dictionary."""

    def __init__(self, most: int = 400_000):
        self.most, self.known = most, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        import xxhash

        known = self.known
        if len(known) > self.most:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of k words, in order; none if there are fewer words."""
    n = len(hashes) - k + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for i in range(1, k):
        out = mix64(out) + hashes[i : i + n]
    return mix64(out)


def id_ranges(df: DataFrame, id_col: str, per_partition: int = 8) -> list[int]:
    """Ascending ids of the frame that cut it into ranges of about equal row counts.

    There are ``per_partition`` ranges for each shuffle partition, so the list is as
    long as the job's setting says, however many rows there are. Range j holds the ids
    from bound j to the next; ids below the first bound and null ids fall into range 0.
    """
    spark = df.sparkSession
    n = per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = df.agg(
        F.percentile_approx(F.col(id_col).cast("long"), [i / n for i in range(1, n)], 20 * n)
    ).first()[0]
    return sorted(set(bounds or []))


def ranges_of(ids: list, bounds: np.ndarray) -> np.ndarray:
    """The range of each id; null ids are in range 0."""
    known = np.array([np.iinfo(np.int64).min if i is None else i for i in ids], np.int64)
    return np.searchsorted(bounds, known, side="right").astype(np.int64)


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, Iterator[pa.RecordBatch]]]:
    """Consecutive rows of equal key of a sorted partition, as slices of its batches."""

    def cut() -> Iterator[tuple[object, pa.RecordBatch]]:
        for batch in batches:
            keys = column(batch, key)
            lo = 0
            for value, group in itertools.groupby(keys):
                n = sum(1 for _ in group)
                yield value, batch.slice(lo, n)
                lo += n

    for value, parts in itertools.groupby(cut(), key=lambda x: x[0]):
        yield value, (part for _, part in parts)


BatchMap = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def tidied(work: BatchMap) -> BatchMap:
    """The map, which at its end gives the memory it has freed back to the system. Spark keeps
    workers for later tasks, and idle ones count against their executor with all they hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        if sys.platform == "linux":
            # Of glibc; others have no such call.
            getattr(ctypes.CDLL(None), "malloc_trim", int)(0)

    return run
