"""Best-fit packing of tokenized documents by exact-complement hashing.

Lengths are at most the capacity, so a table of counts by length says all that the plan
needs, however many pieces there are. The plan fills a sequence with the longest lengths
left and closes it with one, two or three lengths that are exactly its gap, found by
single, pair and triple sums of the lengths still available; a gap without such a
combination takes its best fit. A pattern is repeated while its lengths last, so each
pattern uses up a length and the plan has at most as many patterns as lengths.

Pieces then find their places without meeting: a piece's rank among those of its length
comes from its rank inside its input split and the counts of the splits before, and the
plan maps (length, rank) to a sequence and an offset.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.common import column, prepare, slices, stored, texts_of, tidied
from orderlake.llm.tokens import encoder, vocabulary

CAPACITY, END_ID = 4096, 1
# Characters that a worker encodes at a time.
TEXT_CHUNK = 4_000_000


def tokenized_pieces(
    docs: DataFrame,
    vocabulary_path: str | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """(doc_id, piece, start, length, ids): each document's ids and the end id, cut into
    pieces of at most ``capacity``. ids: little-endian unsigned 32-bit.

    A null or empty text is the end id alone. Repeated rows are documents of their own;
    null ids stay null. Other columns of ``docs`` are not read.
    """
    prepare(docs.sparkSession)
    path = vocabulary_path or vocabulary("word_bpe_49k.json")
    end = np.array([end_id], "<u4").tobytes()

    @tidied
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, spaced=False)
        for batch in batches:
            ids, texts = column(batch, "id"), texts_of(batch)
            for lo, hi in slices([len(t) for t in texts], TEXT_CHUNK):
                rows: list[tuple] = []
                for i, raw in zip(ids[lo:hi], encode(texts[lo:hi])):
                    raw += end
                    for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                        part = raw[at : at + 4 * capacity]
                        rows.append((i, piece, at // 4, len(part) // 4, part))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cols[0], pa.int64()),
                        pa.array(cols[1], pa.int32()),
                        pa.array(cols[2], pa.int64()),
                        pa.array(cols[3], pa.int64()),
                        pa.array(cols[4], pa.binary()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids"],
                )

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids binary")


class Sums:
    """Which single, pair and triple sums the lengths still available make."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.here = counts > 0
        self.pairs: np.ndarray | None = None

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n
        if not self.counts[length]:
            self.here[length] = False
            self.pairs = None

    def longest_to(self, gap: int, used: dict[int, int]) -> int:
        """The longest length of at most ``gap`` of which more than ``used`` are left; 0 if none."""
        at = np.flatnonzero(self.here[: gap + 1])
        for length in at[::-1]:
            if self.counts[length] > used.get(int(length), 0):
                return int(length)
        return 0

    def enough(self, lengths: tuple[int, ...], used: dict[int, int]) -> bool:
        return all(
            self.counts[x] >= used.get(x, 0) + lengths.count(x) for x in set(lengths)
        )

    def pair(self, gap: int, used: dict[int, int]) -> tuple[int, ...]:
        low = np.flatnonzero(self.here[1 : gap // 2 + 1]) + 1
        for x in low[self.here[gap - low]]:
            found = (gap - int(x), int(x))
            if self.enough(found, used):
                return found
        return ()

    def exact(self, gap: int, used: dict[int, int]) -> tuple[int, ...]:
        """One, two or three available lengths whose sum is the gap, or nothing."""
        if self.here[gap] and self.enough((gap,), used):
            return (gap,)
        found = self.pair(gap, used)
        if found:
            return found
        if self.pairs is None:
            size = 2 * len(self.here)
            spectrum = np.fft.rfft(self.here.astype(float), size)
            self.pairs = np.fft.irfft(spectrum * spectrum, size)[: len(self.here)] > 0.5
        first = np.flatnonzero(self.here[: gap - 1])
        for x in first[self.pairs[gap - first]][::-1]:
            one = (int(x),)
            if self.enough(one, used):
                rest = self.pair(gap - int(x), {**used, int(x): used.get(int(x), 0) + 1})
                if rest:
                    return one + rest
        return ()


def plan(counts: np.ndarray) -> list[tuple[int, tuple[int, ...]]]:
    """(repetitions, lengths) of each pattern for ``counts[length]`` pieces of each length."""
    sums = Sums(counts.astype(np.int64).copy())
    capacity = len(counts) - 1
    patterns = []
    while True:
        longest = sums.longest_to(capacity, {})
        if not longest:
            return patterns
        used: dict[int, int] = {longest: 1}
        lengths, gap = [longest], capacity - longest
        while gap:
            fill = sums.exact(gap, used) or (sums.longest_to(gap, used),)
            if not fill[0]:
                break
            for x in fill:
                used[x] = used.get(x, 0) + 1
            lengths += fill
            gap -= sum(fill)
        times = min(int(sums.counts[x]) // n for x, n in used.items())
        for x, n in used.items():
            sums.take(x, n * times)
        patterns.append((times, tuple(lengths)))


def places(patterns: list[tuple[int, tuple[int, ...]]]) -> dict[str, np.ndarray]:
    """Runs of ranks of a length that have the same slot of the same pattern."""
    rows, sequence, taken = [], 0, {}
    for times, lengths in patterns:
        at = 0
        for length in lengths:
            lo = taken.get(length, 0)
            rows.append((length, lo, sequence, at))
            taken[length] = lo + times
            at += length
        sequence += times
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 4).T
    return dict(zip(("length", "rank", "sequence", "offset"), cols))


def with_fields(schema: T.StructType, **added: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructField(n, t) for n, t in added.items())])


def pack(pieces: DataFrame, *, length_col: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``pieces`` with ``sequence_id`` and ``offset`` (both long).

    Sequences hold at most ``capacity`` units and have no gaps from offset 0. All columns
    stay, but for those with the name of a new one, which it replaces. Lengths must be
    between 1 and ``capacity``; rows of null length get null places. An empty frame stays
    empty. Equal rows are pieces of their own.
    """
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset")
    prepare(spark)
    schema = with_fields(pieces.schema, _split=T.IntegerType(), _at=T.LongType())
    at_length = pieces.schema.names.index(length_col)

    @tidied
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        split = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            lengths = np.array([x or 0 for x in batch.column(at_length).to_pylist()], np.int64)
            if len(lengths) and (lengths.min() < 0 or lengths.max() > capacity):
                raise ValueError("a piece is longer than a sequence")
            order = np.argsort(lengths, kind="stable")
            ordered = lengths[order]
            first = np.searchsorted(ordered, ordered)
            at = np.empty(len(lengths), np.int64)
            at[order] = np.arange(len(lengths)) - first + seen[ordered]
            seen += np.bincount(lengths, minlength=capacity + 1)
            splits = pa.array(np.full(len(lengths), split, np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, splits, pa.array(at)], [*batch.schema.names, "_split", "_at"]
            )

    numbered = stored(pieces.mapInArrow(number, schema), "pieces")
    # At most one row for each split and length.
    per_split = numbered.groupBy(F.col(length_col).alias("_length"), "_split").agg(
        F.count(F.lit(1)).alias("_n")
    )
    before = per_split.withColumn(
        "_before",
        F.coalesce(
            F.sum("_n").over(
                Window.partitionBy("_length").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ),
    ).select(F.col("_length"), F.col("_split").alias("_of_split"), "_before")
    # As many rows as there are lengths, which the capacity bounds.
    totals = per_split.groupBy("_length").agg(F.sum("_n").alias("n")).where("_length >= 1").collect()
    counts = np.zeros(capacity + 1, np.int64)
    for row in totals:
        counts[row["_length"]] = row["n"]
    slots = places(plan(counts))

    ranked = numbered.join(
        before,
        (F.col(length_col) == F.col("_length")) & (F.col("_split") == F.col("_of_split")),
        "left",
    ).withColumn("_rank", F.col("_at") + F.col("_before"))
    out_schema = with_fields(pieces.schema, sequence_id=T.LongType(), offset=T.LongType())
    columns, width = [F.col(f"`{c}`") for c in pieces.columns], len(pieces.columns)

    @tidied
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stride = int(counts.max()) + 1
        keys = slots["length"] * stride + slots["rank"]
        for batch in batches:
            lengths = np.array([x or 0 for x in batch.column(at_length).to_pylist()], np.int64)
            ranks = np.array([x or 0 for x in column(batch, "_rank")], np.int64)
            known = lengths > 0
            run = np.searchsorted(keys, lengths * stride + ranks, side="right") - 1
            run = np.where(known, run, 0)
            empty = np.zeros(len(lengths), np.int64)
            sequence = slots["sequence"][run] + ranks - slots["rank"][run] if len(keys) else empty
            offset = slots["offset"][run] if len(keys) else empty
            kept = [batch.column(i) for i in range(width)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence, mask=~known), pa.array(offset, mask=~known)],
                out_schema.names,
            )

    return ranked.select(*columns, "_rank").mapInArrow(place, out_schema)


def packed_documents(docs: DataFrame, **options) -> DataFrame:
    """Pieces of all documents with their ids' checksum and their places, without the ids."""
    pieces = tokenized_pieces(docs, **options)
    return pack(
        pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    )
