"""Improbable-feature digests of documents.

Every window of 64 bytes has an entropy; how often each entropy occurs in all documents says
how improbable a window is. In each run of 64 neighbouring windows the rarest one (leftmost
of equals) gets a point; windows with enough points are the text's features. Their hashes
go into chained Bloom filters of 2048 bits, a new one after every 128 features, in the order
of the text. Two digests are compared filter by filter: the bits in common, normalised so
that what chance would share counts 0 and all bits of the smaller filter count 1.

Entropies of all windows come from 63 shifted comparisons of the whole byte array: the count
of a byte in the window that it leaves or enters is all that changes from window to window.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import column, id_ranges, mix64, offsets_of, prepare, ranges_of, runs, slices, texts_of

WINDOW = 64
FILTER_BITS, FILTER_FEATURES, BITS_PER_FEATURE = 2048, 128, 5
# Points that make a window a feature.
POINTS = 16
BINS = 1001
# Bytes whose features are found together.
CHUNK = 1 << 20
SHORTEST = 2 * WINDOW
SCALE = 1 << 20

_count = np.arange(WINDOW + 2, dtype=float)
# c * log2(c) as an integer, and what it grows by from c to c + 1.
WEIGHT = np.round(SCALE * _count * np.log2(np.maximum(_count, 1))).astype(np.int64)
STEP = np.diff(WEIGHT)


def entropies(data: np.ndarray) -> np.ndarray:
    """Entropy bin (0 to 1000) of every window of WINDOW bytes of the array."""
    n = len(data) - WINDOW + 1
    # For every byte: how often it occurs again in the 63 bytes after it, and before it.
    after, before = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for lo in range(0, len(data), 1 << 15):
        hi = min(len(data), lo + (1 << 15))
        own = data[lo:hi]
        for d in range(1, WINDOW):
            end = min(hi, len(data) - d)
            if end <= lo:
                break
            same = own[: end - lo] == data[lo + d : end + d]
            after[lo:end] += same
            before[lo + d : end + d] += same
    first = int(WEIGHT[np.bincount(data[:WINDOW], minlength=256)].sum())
    total = np.empty(n, np.int64)
    total[0] = first
    # A byte leaves the window that it opens, the next one enters behind 63 others.
    total[1:] = first + np.cumsum(STEP[before[WINDOW:]] - STEP[after[: n - 1]])
    top = SCALE * WINDOW * 6
    return ((top - total) * 1000 // top).astype(np.int64)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts one after the other, each filled with zero bytes to SHORTEST, and their offsets."""
    filled = [t if len(t) >= SHORTEST else t + bytes(SHORTEST - len(t)) for t in texts]
    return np.frombuffer(b"".join(filled), np.uint8), offsets_of([len(t) for t in filled])


def entropy_counts(docs: DataFrame, *, text_col: str = "text") -> np.ndarray:
    """How many windows of all texts have each entropy bin; BINS numbers, whatever the input."""
    prepare(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BINS, np.int64)
        for batch in batches:
            texts = [t.encode("utf-8", "surrogatepass") for t in texts_of(batch) if t]
            for lo, hi in slices([len(t) for t in texts], CHUNK):
                data, at = joined(texts[lo:hi])
                inside = np.ones(len(data) - WINDOW + 1, bool)
                for end in at[1:-1]:
                    inside[end - WINDOW + 1 : end] = False
                counts += np.bincount(entropies(data)[inside], minlength=BINS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS)), pa.array(counts)], ["bin", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "bin long, n long")
    out = np.zeros(BINS, np.int64)
    for row in rows.groupBy("bin").agg(F.sum("n").alias("n")).collect():
        out[row["bin"]] = row["n"]
    return out


def ranks_of(counts: np.ndarray) -> np.ndarray:
    """Rank of each entropy bin, the rarest first. Windows of very low entropy say nothing
    of a text, so they rank last."""
    ranks = np.empty(BINS, np.int64)
    order = np.lexsort((np.arange(BINS), counts, np.arange(BINS) < 100))
    ranks[order] = np.arange(BINS)
    return ranks


HASH_FACTORS = np.random.default_rng(7).integers(0, 1 << 63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def digests(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """The Bloom filters of each text: (filters, FILTER_BITS / 8) bytes; none for an empty text."""
    data, at = joined(texts)
    key = ranks[entropies(data)] << np.int64(40)
    key += np.arange(len(key))
    # A window that crosses into the next text never wins there.
    for end in at[1:-1]:
        key[end - WINDOW + 1 : end] = np.iinfo(np.int64).max
    span = 1
    low = key
    while span < WINDOW:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    out = []
    mask = np.int64((1 << 40) - 1)
    for i, text in enumerate(texts):
        if not text:
            out.append(np.zeros((0, FILTER_BITS // 8), np.uint8))
            continue
        a, b = int(at[i]), int(at[i + 1])
        winners = low[a : b - 2 * WINDOW + 2] & mask
        points = np.bincount(winners - a)
        need = min(POINTS, max(1, len(winners) // 8))
        features = np.flatnonzero(points >= need) + a
        if not len(features):
            features = np.array([int(points.argmax()) + a])
        hashed = np.zeros(len(features), np.uint64)
        for j in range(WINDOW):
            hashed = (hashed ^ data[features + j]) * HASH_FACTORS[j]
        hashed = mix64(hashed)
        group = np.arange(len(features)) // FILTER_FEATURES
        bits = np.zeros((int(group[-1]) + 1, FILTER_BITS), np.uint8)
        for j in range(BITS_PER_FEATURE):
            bits[group, ((hashed >> np.uint64(11 * j)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = 1
        out.append(np.packbits(bits, axis=1))
    return out


def similarity(x: np.ndarray, y: np.ndarray) -> float:
    """Likeness of two digests, 0 to 1: for each filter of the shorter one its best match,
    weighted by its bits. Two empty digests are alike, an empty one is like no other."""
    if len(x) != len(y) and len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 1.0 if not len(y) else 0.0
    if len(x) == len(y):
        return min(one_way(x, y), one_way(y, x))
    return one_way(x, y)


def one_way(x: np.ndarray, y: np.ndarray) -> float:
    n_x = np.bitwise_count(x).sum(axis=1, dtype=np.int64)
    n_y = np.bitwise_count(y).sum(axis=1, dtype=np.int64)
    best = np.zeros(len(x))
    # Rows at a time, so that long digests need little memory.
    step = max(1, (1 << 22) // (y.shape[0] * y.shape[1]))
    for lo in range(0, len(x), step):
        both = np.bitwise_count(x[lo : lo + step, None, :] & y[None, :, :]).sum(axis=2, dtype=np.int64)
        chance = n_x[lo : lo + step, None] * n_y[None, :] / FILTER_BITS
        most = np.minimum(n_x[lo : lo + step, None], n_y[None, :])
        score = np.where(most > chance, (both - chance) / np.maximum(most - chance, 1e-9), both >= most)
        best[lo : lo + step] = np.clip(score, 0, 1).max(axis=1)
    return float((best * n_x).sum() / n_x.sum())


def to_text(filters: np.ndarray) -> str:
    """Filters as base64 strings joined by ``:``; equal digests have equal strings."""
    return ":".join(base64.b64encode(f.tobytes()).decode() for f in filters)


def from_text(fingerprint: str) -> np.ndarray:
    parts = [np.frombuffer(base64.b64decode(p), np.uint8) for p in fingerprint.split(":") if p]
    return np.array(parts, np.uint8).reshape(-1, FILTER_BITS // 8)


def fingerprints(docs: DataFrame, ranks: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of each row; a null or empty text has an empty fingerprint."""
    prepare(docs.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode("utf-8", "surrogatepass") for t in texts_of(batch)]
            out = [
                to_text(f) for lo, hi in slices([len(t) for t in texts], CHUNK) for f in digests(texts[lo:hi], ranks)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column(batch, "id"), pa.int64()), pa.array(out, pa.string())], ["doc_id", "fingerprint"]
            )

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(sign, "doc_id long, fingerprint string")


def edited_text(text: str, following: str) -> str:
    """The last quarter of the text replaced by as much of the beginning of the following one."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compared_in_order(docs: DataFrame, ranks: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against its edited text and against the next document by id.

    The ids are cut into ranges; a range's first document is sent to the range before it as
    well, so neighbours meet in one task and texts are shuffled once. Null ids come first,
    rows of equal id are ordered by text, null texts count as empty, a single document is
    its own next one.
    """
    spark = docs.sparkSession
    prepare(spark)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    bounds = id_ranges(source, "id")
    first = source.orderBy(F.col("id").asc_nulls_first()).select("id").limit(1).collect()
    if not first:
        return spark.createDataFrame([], COMPARED)
    smallest = first[0]["id"]
    # A bound that is itself the smallest id would open an empty range before it.
    bounds = [b for b in bounds if smallest is None or b > smallest]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limits, heads = np.array(bounds, np.int64), set(bounds)
        for batch in batches:
            ids = column(batch, "id")
            of = ranges_of(ids, limits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(of), pa.array(np.zeros(len(ids), np.int32)), *batch.columns], ["range", "follower", "id", "text"]
            )
            again = [i for i, x in enumerate(ids) if x in heads or x == smallest]
            if again:
                before = [int(of[i]) - 1 if ids[i] != smallest else len(limits) for i in again]
                part = batch.take(pa.array(again))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(before, pa.int64()), pa.array([1] * len(again), pa.int32()), *part.columns],
                    ["range", "follower", "id", "text"],
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows))
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            names = [c.split()[0] for c in COMPARED.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

        def answer(held: list[tuple[int | None, str]], following: str) -> pa.RecordBatch:
            texts = [t for _, t in held]
            edited = [edited_text(t, n) for t, n in zip(texts, [*texts[1:], following])]
            raw = [t.encode("utf-8", "surrogatepass") for t in [*texts, following, *edited]]
            found = []
            for lo, hi in slices([len(t) for t in raw], CHUNK):
                found += digests(raw[lo:hi], ranks)
            n = len(held)
            rows = []
            for i, (doc, text) in enumerate(held):
                own, after, other = found[i], found[i + 1], found[n + 1 + i]
                sha = hashlib.sha256(raw[n + 1 + i]).hexdigest()
                rows.append(
                    (doc, len(text), sha, to_text(own), to_text(other), similarity(own, other), similarity(own, after))
                )
            return out(rows)

        for _, parts in runs(batches, "range"):
            held: list[tuple[int | None, str]] = []
            size, done = 0, False
            for part in parts:
                for doc, text, follower in zip(column(part, "id"), texts_of(part), column(part, "follower")):
                    if done:
                        continue
                    if follower or size > CHUNK:
                        if held:
                            yield answer(held, text)
                        held, size, done = [], 0, bool(follower)
                        if done:
                            continue
                    held.append((doc, text))
                    size += len(text)

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = source.mapInArrow(deal, "range long, follower int, id long, text string")
    ordered = dealt.repartition(partitions, "range").sortWithinPartitions(
        "range", "follower", "id", F.coalesce("text", F.lit(""))
    )
    return ordered.mapInArrow(compare, COMPARED)
