"""Token ids of documents as canonical length-limited Huffman blocks.

Code lengths come from the counts of all ids and are at most ``MAX_BITS``, so a block is
decoded with one table of 2^MAX_BITS entries. The table of lengths is the whole code.

A block holds whole documents in ascending id order and is decoded without any other
block. Its payload is, little-endian: magic ``HUF1``, the number of ids (u32), the number
of ids between two checkpoints (u32), the bits of each stretch between checkpoints (u16
each), then the bits, padded to a byte. The stretches' sums are the bit offsets of the
checkpoints, where decoding can start; all stretches of a block are decoded side by side.
The container is a Parquet table, which any store that Spark reaches can hold:
(shard, block, shard_start, doc_ids, doc_tokens, payload), with the code beside it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlake.llm.common import column, id_ranges, offsets_of, prepare, ranges_of, runs, slices, stored, texts_of
from orderlake.llm.tokens import encoder, vocabulary
from orderlake.session import new_scratch_dir

END_ID, VOCABULARY_SIZE = 2, 50_257
MAX_BITS = 16
BLOCK_IDS, STRETCH = 1 << 18, 128
TEXT_CHUNK = 4_000_000
MAGIC = b"HUF1"


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` by package-merge; 0 where the count is 0."""
    lengths = np.zeros(len(counts), np.uint8)
    symbols = np.flatnonzero(counts)
    if len(symbols) > 1 << max_bits:
        raise ValueError("more ids than codes of that length")
    if len(symbols) < 2:
        lengths[symbols] = 1
        return lengths
    symbols = symbols[np.argsort(counts[symbols], kind="stable")]
    weights = counts[symbols].astype(np.int64)
    n, merged, is_leaf = len(symbols), weights, []
    for _ in range(max_bits):
        is_leaf.append(np.ones(n, bool) if not is_leaf else leaf)
        half = len(merged) // 2
        packages = merged[0 : 2 * half : 2] + merged[1 : 2 * half : 2]
        order = np.argsort(np.concatenate([weights, packages]), kind="stable")
        leaf = order < n
        merged = np.concatenate([weights, packages])[order]
    # Walk back: of the last level 2n-2 items are taken, of each level before it two for
    # each package taken. The leaves taken of a level are its cheapest ones.
    take = 2 * n - 2
    out = np.zeros(n, np.int64)
    for level in reversed(is_leaf):
        chosen = int(level[:take].sum())
        out[:chosen] += 1
        take = 2 * (take - chosen)
    lengths[symbols] = out
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes ordered by (length, id)."""
    codes = np.zeros(len(lengths), np.uint32)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    bits = lengths[order].astype(np.int64)
    if len(order):
        top = int(bits[-1])
        ends = np.cumsum(np.int64(1) << (top - bits))
        starts = np.concatenate([[0], ends[:-1]])
        codes[order] = starts >> (top - bits)
    return codes


def encode_block(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> bytes:
    """The payload of a block of ids."""
    bits = lengths[ids].astype(np.int64)
    ends = np.cumsum(bits)
    total = int(ends[-1]) if len(ids) else 0
    at = ends - bits
    shift = np.uint64(64) - (at % 32).astype(np.uint64) - bits.astype(np.uint64)
    value = codes[ids].astype(np.uint64) << shift
    word = at // 32
    out = np.zeros(total // 32 + 2, np.uint64)
    if len(ids):
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        # Codes of a word do not overlap, so their sum is their union.
        out[word[first]] += np.add.reduceat(value >> np.uint64(32), first)
        out[word[first] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
    stream = out.astype(">u4").tobytes()[: (total + 7) // 8]
    marks = np.concatenate([at[::STRETCH], [total]])
    head = MAGIC + np.array([len(ids), STRETCH], "<u4").tobytes()
    return head + np.diff(marks).astype("<u2").tobytes() + stream


def decoding_table(lengths: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Id and code length for every window of ``max_bits`` bits."""
    codes = canonical_codes(lengths)
    symbols = np.flatnonzero(lengths)
    ids, used = np.zeros(1 << max_bits, np.uint32), np.zeros(1 << max_bits, np.uint8)
    order = symbols[np.lexsort((symbols, lengths[symbols]))]
    repeat = np.int64(1) << (max_bits - lengths[order].astype(np.int64))
    n = int(repeat.sum())
    ids[:n], used[:n] = np.repeat(order, repeat), np.repeat(lengths[order], repeat)
    if len(order):
        assert int(codes[order[0]]) == 0
    return ids, used


def decode_block(payload: bytes, table: tuple[np.ndarray, np.ndarray], max_bits: int = MAX_BITS) -> np.ndarray:
    """The ids of a payload; every stretch starts at its own checkpoint."""
    if payload[:4] != MAGIC:
        raise ValueError("not a block of ids")
    n, step = (int(x) for x in np.frombuffer(payload, "<u4", 2, 4))
    lanes = -(-n // step)
    sizes = np.frombuffer(payload, "<u2", lanes, 12).astype(np.int64)
    raw = np.frombuffer(payload, np.uint8, offset=12 + 2 * lanes)
    raw = np.concatenate([raw, np.zeros(4, np.uint8)]).astype(np.uint32)
    windows = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    at = offsets_of(sizes)[:-1].copy()
    ids, used = table
    out = np.zeros((step, lanes), np.uint32)
    mask = np.uint32((1 << max_bits) - 1)
    last = len(windows) - 1
    for i in range(step):
        here = np.minimum(at >> 3, last)
        look = (windows[here] >> (24 - max_bits - (at & 7)).astype(np.uint32)) & mask
        out[i] = ids[look]
        at += used[look]
    return out.T.reshape(-1)[:n]


def document_ids(
    docs: DataFrame,
    vocabulary_path: str | None,
    bounds: list[int],
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
) -> DataFrame:
    """(range, doc_id, ids): ids of whole texts and the end id, little-endian unsigned 16-bit."""
    path = vocabulary_path or vocabulary("byte_bpe_50k.json")
    end = np.array([end_id], "<u2").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path, spaced=True)
        limits = np.array(bounds, np.int64)
        for batch in batches:
            ids, texts = column(batch, "id"), texts_of(batch)
            of = ranges_of(ids, limits)
            for lo, hi in slices([len(t) for t in texts], TEXT_CHUNK):
                raw = [
                    np.frombuffer(x, "<u4").astype("<u2").tobytes() + end
                    for x in tokens(texts[lo:hi])
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(of[lo:hi]), pa.array(ids[lo:hi], pa.int64()), pa.array(raw, pa.binary())],
                    ["range", "doc_id", "ids"],
                )

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(encode, "range long, doc_id long, ids binary")


def id_counts(encoded: DataFrame) -> np.ndarray:
    """How often each id occurs in all documents' ``ids``; 2^16 numbers, whatever the input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << 16, np.int64)
        for batch in batches:
            counts += np.bincount(
                np.frombuffer(b"".join(column(batch, "ids")), "<u2"), minlength=1 << 16
            )
        ids = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(counts[ids])], ["id", "n"])

    found = encoded.select("ids").mapInArrow(count, "id long, n long")
    counts = np.zeros(1 << 16, np.int64)
    for row in found.groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row["id"]] = row["n"]
    return counts


def write_documents(docs: DataFrame, path: str, vocabulary_path: str | None = None, **options) -> None:
    """Write all documents' ids to ``path``: the code and the blocks, in ascending doc_id
    order from shard to shard and block to block.

    A null or empty text is the end id alone. Null ids come first; rows of equal id are
    all written, ordered by their ids. Texts are encoded once, into the shared scratch
    folder, from which ids are counted and written. Writing is one Spark job with Spark's
    own commit, so a lost executor costs its tasks and leaves no half-written block. No
    documents: no blocks.
    """
    spark = docs.sparkSession
    prepare(spark)
    bounds = id_ranges(docs, options.get("id_col", "doc_id"))
    encoded = stored(document_ids(docs, vocabulary_path, bounds, **options), "ids", "zstd")
    lengths = code_lengths(id_counts(encoded))
    spark.createDataFrame([(MAX_BITS, bytearray(lengths.tobytes()))], "max_bits int, lengths binary").coalesce(
        1
    ).write.parquet(f"{path}/code")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = canonical_codes(lengths)
        for shard, parts in runs(batches, "range"):
            block = start = size = 0
            doc_ids: list = []
            held: list[np.ndarray] = []
            for part in parts:
                for i, raw in zip(column(part, "doc_id"), column(part, "ids")):
                    n = len(raw) // 2
                    if size and size + n > BLOCK_IDS:
                        yield block_row(shard, block, start, doc_ids, held, lengths, codes)
                        block, start, size, doc_ids, held = block + 1, start + size, 0, [], []
                    doc_ids.append(i)
                    held.append(np.frombuffer(raw, "<u2"))
                    size += n
            yield block_row(shard, block, start, doc_ids, held, lengths, codes)

    ordered = encoded.repartition(partitions, "range").sortWithinPartitions("range", "doc_id", "ids")
    ordered.mapInArrow(write, BLOCKS).write.parquet(f"{path}/blocks")


BLOCKS = (
    "shard long, block long, shard_start long, doc_ids array<long>, doc_tokens array<long>, payload binary"
)


def block_row(shard, block, start, doc_ids, held, lengths, codes) -> pa.RecordBatch:
    """A block as a row; ``shard_start``: ids of the shard before this block."""
    longs = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([shard], pa.int64()),
            pa.array([block], pa.int64()),
            pa.array([start], pa.int64()),
            pa.array([doc_ids], longs),
            pa.array([[len(x) for x in held]], longs),
            pa.array([encode_block(np.concatenate(held), lengths, codes)], pa.binary()),
        ],
        ["shard", "block", "shard_start", "doc_ids", "doc_tokens", "payload"],
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document of the files at ``path``; ids little-endian
    unsigned 32-bit, start: the ids of all documents before it."""
    prepare(spark)
    row = spark.read.parquet(f"{path}/code").first()
    lengths, max_bits = np.frombuffer(bytes(row["lengths"]), np.uint8), row["max_bits"]
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    totals = blocks.select("shard", F.expr("aggregate(doc_tokens, 0L, (a, b) -> a + b)").alias("n"))
    # As many rows as shards, which the job's partitions bound.
    shards = totals.groupBy("shard").agg(F.sum("n").alias("n")).withColumn(
        "base", F.sum("n").over(Window.orderBy("shard")) - F.col("n")
    )
    based = blocks.join(F.broadcast(shards.select("shard", "base")), "shard")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decoding_table(lengths, max_bits)
        for batch in batches:
            for base, start, docs, sizes, payload in zip(
                *(column(batch, c) for c in ("base", "shard_start", "doc_ids", "doc_tokens", "payload"))
            ):
                at = offsets_of(sizes)
                raw = pa.py_buffer(decode_block(payload, table, max_bits).astype("<u4").tobytes())
                texts = pa.Array.from_buffers(
                    pa.binary(), len(docs), [None, pa.py_buffer((4 * at).astype(np.int32)), raw]
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(at[:-1] + base + start), texts],
                    ["doc_id", "start", "ids"],
                )

    return based.select("base", "shard_start", "doc_ids", "doc_tokens", "payload").mapInArrow(
        decode, "doc_id long, start long, ids binary"
    )


def round_trip(docs: DataFrame, label: str = "huffman", **options) -> DataFrame:
    """Write all documents' ids to the shared scratch folder and read them back."""
    path = new_scratch_dir(docs.sparkSession, label)
    write_documents(docs, path, **options)
    return read_documents(docs.sparkSession, path)
