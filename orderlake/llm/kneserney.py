"""Interpolated modified Kneser-Ney model of any order in sorted hash arrays.

Counting is a Spark job: tasks count words and word pairs of many documents at a time, deal
their sorted counts to shards by hash, and a task merges a shard into two flat files, sorted
64-bit hashes and their counts. Workers map these files into memory and look up a batch in
hash order, so a file is walked from front to back and its pages are shared by all workers
of a machine. Word ids are places in the sorted hashes of words; a pair's hash is an
invertible mix of its two ids, so pairs never collide. It has no more bits than two ids need,
and blocks on their way to a shard hold compressed differences of sorted hashes.

    p(w | v) = max(c(vw) - D(c(vw)), 0) / c(v) + gamma(v) p(w)
    p(w)     = max(b(w) - D'(b(w)), 0) / B + gamma' / (V + 1)

b(w): in how many different pairs w is second, B: their sum, V: the distinct tokens. The
discounts D for counts of 1, 2 and 3 or more come from the counts of counts; unknown words
share the last term.

Orders above two repeat this on n-grams. An n-gram's key is the place of its first n - 1 words
among the (n-1)-grams and the id of its last word, unmixed: the n-grams of one context lie side
by side, so sums over a context are read off them and need no array of their own. Only contexts
with many n-grams have theirs summed up beforehand: each batch asks for those.
The highest order uses counts c; each lower one uses a(g), in how many different (n+1)-grams
g is the end, or its count if it starts with the start mark, which nothing precedes:

    p(w | h) = max(a(hw) - D(a(hw)), 0) / a(h .) + gamma(h) p(w | h without its first word)

Every text starts from a start mark and ends with an end token.

The folder must be a file system that workers mount, since files are mapped where they lie.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import (
    MIX_A,
    MIX_B,
    WordHashes,
    column,
    crc_mod,
    mix64,  # noqa: F401  # what unmix64 undoes
    offsets_of,
    prepare,
    runs,
    slices,
    stored,
    texts_of,
    words_of,
)
from orderlake.session import new_scratch_dir

# Ids of the start mark, the end token and a word that training has not seen.
START, END, UNKNOWN, FIRST_WORD = 0, 1, np.uint64((1 << 32) - 1), 2
# Tokens that a task counts before it deals out.
BUFFER = 4_000_000
# Characters whose tokens are looked up together.
CHUNK = 4_000_000
HELD_OUT = 10
# N-grams of a context above which its sums are kept, and the count from which a byte is too few.
HEAVY, MANY = 32, 255
# Spark's setting that removes a query's shuffle files when the query ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_INVERSE_A = np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
_INVERSE_B = np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))


def unmix64(x: np.ndarray) -> np.ndarray:
    """The integers whose ``mix64`` is x."""
    x = x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))
    x = x * _INVERSE_B
    x = x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))
    x = x * _INVERSE_A
    return x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))


def packed(values: np.ndarray) -> bytes:
    """Ascending integers as their number and the compressed byte planes of their differences."""
    steps = np.diff(values.astype("<u8"), prepend=np.uint64(0))
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def packed_counts(counts: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(counts.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(counts).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(block: bytes, width: int = 8) -> np.ndarray:
    n = int.from_bytes(block[:8], "little")
    planes = np.frombuffer(pa.decompress(block[8:], n * width, "zstd"), np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel()


def unpacked_values(block: bytes) -> np.ndarray:
    return np.cumsum(unpacked(block), dtype=np.uint64)


def unpacked_counts(block: bytes) -> np.ndarray:
    return unpacked(block, 4)


def shard_of(hashes: np.ndarray, shards: int, contexts: int = 1 << 32) -> np.ndarray:
    """The shard of each hash; ascending hashes have ascending shards. Keys that begin with a
    context's place are dealt by it, out of so many ``contexts``."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) // np.uint64(contexts)).astype(np.int64)


def counted(hashes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes and their total counts."""
    if counts is None:
        hashes = np.sort(hashes)
    else:
        order = np.argsort(hashes, kind="stable")
        hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, int)
    if counts is None:
        return hashes[first], np.diff(np.append(first, len(hashes)))
    return hashes[first], np.add.reduceat(counts, first) if len(first) else counts


def dealt(
    hashes: np.ndarray, counts: np.ndarray, shards: int, contexts: int = 1 << 32
) -> Iterator[pa.RecordBatch]:
    """A row (shard, hashes, counts) for each shard that has some of the sorted hashes."""
    ends = np.searchsorted(shard_of(hashes, shards, contexts), np.arange(shards + 1))
    rows = [
        (s, packed(hashes[a:b]), packed_counts(counts[a:b]))
        for s, (a, b) in enumerate(zip(ends[:-1], ends[1:]))
        if b > a
    ]
    for lo in range(0, len(rows), 64):
        cols = list(zip(*rows[lo : lo + 64]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())],
            ["shard", "hashes", "counts"],
        )


def local_folder(folder: str) -> str:
    path = folder.removeprefix("file://") if folder.startswith("file://") else folder.removeprefix("file:")
    if "://" in path:
        raise ValueError(f"{folder} cannot be mapped into memory: name a mounted folder")
    return path


def write_array(folder: str, values: np.ndarray) -> str:
    """Write an array under a name of its own; a file is whole before its name is told."""
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{uuid.uuid4().hex}"
    with open(path, "wb") as file:
        values.tofile(file)
    return path


def write_counts(folder: str, counts: np.ndarray) -> str:
    """Write counts as bytes, and the places and values of those that a byte can't hold."""
    path = write_array(folder, np.minimum(counts, MANY).astype(np.uint8))
    many = np.flatnonzero(counts >= MANY)
    np.column_stack([many, counts[many]]).astype("<u8").tofile(f"{path}.many")
    return path


class Counts:
    """Counts that ``write_counts`` wrote, mapped into memory."""

    def __init__(self, path: str):
        self.few = np.memmap(path, np.uint8, "r")
        self.places, self.many = np.fromfile(f"{path}.many", "<u8").reshape(-1, 2).astype(np.int64).T

    def __getitem__(self, places: np.ndarray) -> np.ndarray:
        out = self.few[places].astype(np.int64)
        more = np.flatnonzero(out == MANY)
        out[more] = self.many[np.searchsorted(self.places, places[more])]
        return out

    def all(self) -> np.ndarray:
        out = np.array(self.few, np.int64)
        out[self.places] = self.many
        return out


class SortedCounts:
    """Counts by hash in shards of sorted arrays, mapped into memory. ``bits``: of a word id in
    the hashes of pairs."""

    def __init__(self, shards: int, rows: list[tuple[int, int, str, str]], contexts: int = 1 << 32, bits: int = 32):
        self.shards, self.contexts, self.bits = shards, contexts, bits
        self.sizes = np.zeros(shards, np.int64)
        self.paths: dict[int, tuple[str, str]] = {}
        for shard, n, hashes, counts in rows:
            self.sizes[shard] = n
            self.paths[shard] = hashes, counts
        self.starts = offsets_of(self.sizes)
        self.maps: dict[int, tuple[np.ndarray, Counts]] = {}

    def __getstate__(self):
        return {**self.__dict__, "maps": {}}

    def opened(self, shard: int) -> tuple[np.ndarray, Counts]:
        if shard not in self.maps:
            a, b = self.paths[shard]
            self.maps[shard] = np.memmap(a, "<u8", "r"), Counts(b)
        return self.maps[shard]

    def key_at(self, places: np.ndarray) -> np.ndarray:
        """The hash at each place."""
        order = np.argsort(places)
        ordered, out = places[order], np.zeros(len(places), np.uint64)
        ends = np.searchsorted(ordered, self.starts)
        for shard in np.flatnonzero(np.diff(ends)).tolist():
            a, b = ends[shard], ends[shard + 1]
            out[order[a:b]] = self.opened(shard)[0][ordered[a:b] - self.starts[shard]]
        return out

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place or -1, count) of each hash."""
        order = np.argsort(hashes)
        ordered = hashes[order]
        place, count = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        ends = np.searchsorted(shard_of(ordered, self.shards, self.contexts), np.arange(self.shards + 1))
        for shard in np.flatnonzero((np.diff(ends) > 0) & (self.sizes > 0)).tolist():
            a, b = ends[shard], ends[shard + 1]
            keys, counts = self.opened(shard)
            at = np.minimum(np.searchsorted(keys, ordered[a:b]), len(keys) - 1)
            hit = keys[at] == ordered[a:b]
            place[order[a:b]] = np.where(hit, at + self.starts[shard], -1)
            count[order[a:b]] = np.where(hit, counts[at], 0)
        return place, count


def merged(
    blocks: DataFrame, folder: str, shards: int, contexts: int = 1 << 32, bits: int = 32
) -> tuple[SortedCounts, np.ndarray]:
    """Merge dealt blocks into shard files; the arrays and the counts of counts 1 to 4.

    A pair that is very frequent was counted in each task before, so it is one entry of a
    block; shards are cut by hash and equally large.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, parts in runs(batches, "shard"):
            hashes, counts = [], []
            for part in parts:
                hashes += map(unpacked_values, column(part, "hashes"))
                counts += map(unpacked_counts, column(part, "counts"))
            keys, totals = counted(np.concatenate(hashes), np.concatenate(counts).astype(np.int64))
            if len(totals) and totals.max() >= 1 << 32:
                raise ValueError("a count exceeds 32 bits")
            few = np.bincount(np.minimum(totals, 5), minlength=6)[1:5]
            values = [shard, len(keys), write_array(folder, keys), write_counts(folder, totals), few.tolist()]
            kinds = [pa.int32(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(values, kinds)], ["shard", "n", "hashes", "counts", "few"]
            )

    spark = blocks.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    told = stored(
        blocks.repartition(partitions, "shard").sortWithinPartitions("shard").mapInArrow(
            merge, "shard int, n long, hashes string, counts string, few array<long>"
        ),
        "shards",
    ).collect()
    few = np.sum([r["few"] for r in told], axis=0) if told else np.zeros(4, np.int64)
    rows = [(r["shard"], r["n"], r["hashes"], r["counts"]) for r in told]
    return SortedCounts(shards, rows, contexts, bits), np.asarray(few)


def discounts(few: np.ndarray) -> np.ndarray:
    """D(0) = 0, D(1), D(2), D(3+) from the counts of counts 1 to 4."""
    n1, n2, n3, n4 = (float(x) for x in few)
    if not n1 or not n2:
        return np.array([0.0, 0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *(min(max(x, 0.05), i + 0.95) for i, x in enumerate(d))])


class RangeArrays:
    """Numbers by id, in ranges of ids that are files mapped into memory."""

    def __init__(self, size: int, ranges: int, rows: list[tuple[int, str]], width: int = 4):
        self.size, self.ranges, self.paths, self.width = size, ranges, dict(rows), width
        self.step = -(-size // ranges) if size else 1
        self.maps: dict[int, np.ndarray] = {}

    def __getstate__(self):
        return {**self.__dict__, "maps": {}}

    def get(self, ids: np.ndarray) -> np.ndarray:
        """The row of each id, (n1, n2, n3, firsts) of a word; zeros for ids that have none."""
        out = np.zeros((len(ids), self.width), np.int64)
        of = ids // self.step
        order = np.argsort(of, kind="stable")
        ends = np.searchsorted(of[order], np.arange(self.ranges + 1))
        for r in np.flatnonzero(np.diff(ends)).tolist():
            if r in self.paths:
                if r not in self.maps:
                    self.maps[r] = np.memmap(self.paths[r], "<u4", "r").reshape(-1, self.width)
                at = order[ends[r] : ends[r + 1]]
                out[at] = self.maps[r][ids[at] - r * self.step]
        return out


@dataclass
class Step:
    """The n-grams of one order of a model above two.

    ``before`` has in how many longer n-grams each is the end, None for the highest order.
    ``contexts`` has for each word as a context how many words follow with a count of 1, 2 and
    3 or more, and the sum of their counts. It is None above order 2, where the n-grams of one
    context lie side by side and are summed up when they are asked for, or before if they are
    many: ``heavy`` has a file of (context, sums) for each shard.
    """

    grams: SortedCounts
    before: RangeArrays | None
    contexts: RangeArrays | None
    discounts: np.ndarray
    heavy: dict[int, str] = field(default_factory=dict)

    def follow(self, contexts: np.ndarray) -> np.ndarray:
        """The row of ``contexts`` for each of ascending distinct contexts."""
        if self.contexts is not None:
            return self.contexts.get(contexts)
        grams, out = self.grams, np.zeros((len(contexts), 4), np.int64)
        keys = contexts.astype(np.uint64) << np.uint64(32)
        ends = np.searchsorted(shard_of(keys, grams.shards, grams.contexts), np.arange(grams.shards + 1))
        for shard in np.flatnonzero((np.diff(ends) > 0) & (grams.sizes > 0)).tolist():
            own, counts = grams.opened(shard)
            asked = keys[ends[shard] : ends[shard + 1]]
            first = np.searchsorted(own, asked)
            lengths = np.searchsorted(own, asked + np.uint64(1 << 32)) - first
            many = np.flatnonzero(lengths > HEAVY)
            if len(many):
                known = np.fromfile(self.heavy[shard], "<u8").reshape(-1, 5)
                at = np.searchsorted(known[:, 0], contexts[ends[shard] + many].astype(np.uint64))
                out[ends[shard] + many] = known[at, 1:]
            few = np.flatnonzero((lengths > 0) & (lengths <= HEAVY))
            if len(few):
                out[ends[shard] + few] = self.sums(shard, first[few], lengths[few])
        return out

    def adjusted(self, places: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return adjusted(self.before, places, counts)

    def sums(self, shard: int, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """How many n-grams of each run of a shard have a count of 1, 2 and 3 or more, and
        the sum of their counts."""
        counts, out = self.grams.opened(shard)[1], np.zeros((len(first), 4), np.int64)
        for lo, hi in slices(lengths.tolist(), BUFFER):
            at = offsets_of(lengths[lo:hi])
            places = np.repeat(first[lo:hi] - at[:-1], lengths[lo:hi]) + np.arange(at[-1])
            n = self.adjusted(self.grams.starts[shard] + places, counts[places])
            for i, x in enumerate((n == 1, n == 2, n > 2, n)):
                out[lo:hi, i] = np.add.reduceat(x, at[:-1], dtype=np.int64)
        return out

    def heavy_sums(self, spark, folder: str) -> dict[int, str]:
        """A file of the sums of each shard's contexts with more than ``HEAVY`` n-grams."""

        def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for shard in column(batch, "shard"):
                    contexts = np.array(self.grams.opened(shard)[0]) >> np.uint64(32)
                    first = np.flatnonzero(np.diff(contexts, prepend=contexts[0] + np.uint64(1)))
                    lengths = np.diff(np.append(first, len(contexts)))
                    first, lengths = first[lengths > HEAVY], lengths[lengths > HEAVY]
                    sums = self.sums(shard, first, lengths).astype("<u8")
                    path = write_array(folder, np.column_stack([contexts[first], sums]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard], pa.int32()), pa.array([path], pa.string())], ["shard", "path"]
                    )

        if not self.grams.paths:
            return {}
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        names = spark.createDataFrame([(s,) for s in self.grams.paths], "shard int").repartition(partitions)
        told = stored(names.mapInArrow(write, "shard int, path string"), "heavy").collect()
        return {r["shard"]: r["path"] for r in told}


@dataclass
class Model:
    """A trained model; pickled into tasks as file names and a few numbers."""

    words: SortedCounts
    pairs: SortedCounts
    contexts: RangeArrays
    documents: int
    tokens: int
    pair_discounts: np.ndarray
    word_discounts: np.ndarray
    # Distinct pairs, and words that are second in 1, 2 and more pairs.
    distinct_pairs: int
    seconds: np.ndarray
    # Orders 2 to the highest, for a model of more than two.
    steps: list[Step] = field(default_factory=list)

    @property
    def distinct(self) -> int:
        return int(self.words.sizes.sum()) + (self.documents > 0)

    def ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id, training count) of each word hash."""
        place, count = self.words.find(hashes)
        return np.where(place < 0, int(UNKNOWN), place + FIRST_WORD).astype(np.uint64), count


def pair_keys(first: np.ndarray, second: np.ndarray, bits: int = 32) -> np.ndarray:
    """An invertible mix of two ids of so many bits, in the upper bits of the key."""
    half, unused = np.uint64(bits), np.uint64(64 - 2 * bits)
    mask = np.uint64((1 << 2 * bits) - 1)
    x = (first << half) | second
    for factor in (MIX_A, MIX_B):
        x = ((x ^ (x >> half)) * factor) & mask
    return (x ^ (x >> half)) << unused


def pairs_of(keys: np.ndarray, bits: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """The two ids of each key."""
    half, unused = np.uint64(bits), np.uint64(64 - 2 * bits)
    mask = np.uint64((1 << 2 * bits) - 1)
    x = keys >> unused
    for factor in (_INVERSE_B, _INVERSE_A):
        x = ((x ^ (x >> half)) * factor) & mask
    x = x ^ (x >> half)
    return x >> half, x & np.uint64((1 << bits) - 1)


def gram_keys(order: int, context: np.ndarray, last: np.ndarray, bits: int = 32) -> np.ndarray:
    """The keys of n-grams. Pairs are mixed; longer ones sort by their context's place."""
    return pair_keys(context, last, bits) if order == 2 else (context << np.uint64(32)) | last


def sequences(hashes: list[np.ndarray], find) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(contexts, tokens, counts, offsets) of texts one after the other, each with its end;
    the end's count is set to -1."""
    sizes = [len(h) for h in hashes]
    flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    distinct, back = np.unique(flat, return_inverse=True)
    ids, counts = find(distinct)
    at = offsets_of([n + 1 for n in sizes])
    tokens, token_counts = np.full(at[-1], END, np.uint64), np.full(at[-1], -1, np.int64)
    inner = np.ones(at[-1], bool)
    inner[at[1:] - 1] = False
    tokens[inner], token_counts[inner] = ids[back], counts[back]
    contexts = np.empty(at[-1], np.uint64)
    contexts[1:] = tokens[:-1]
    contexts[at[:-1]] = START
    return contexts, tokens, token_counts, at


def walked(
    grams: list[SortedCounts], contexts: np.ndarray, tokens: np.ndarray, at: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each order from 2 and each token (the n-gram before it, place, count) of the n-gram
    that ends there; -1 for what a text or training does not have. After the last order, the
    n-grams before each token alone."""
    prefix = np.where(contexts == UNKNOWN, -1, contexts.astype(np.int64))
    for order, known in enumerate(grams, 2):
        place, count = np.full(len(tokens), -1, np.int64), np.zeros(len(tokens), np.int64)
        ask = np.flatnonzero((prefix >= 0) & (tokens != UNKNOWN))
        place[ask], count[ask] = known.find(
            gram_keys(order, prefix[ask].astype(np.uint64), tokens[ask], known.bits)
        )
        yield prefix, place, count
        prefix = np.roll(place, 1)
        prefix[at[:-1]] = -1
    yield prefix, np.zeros(0, np.int64), np.zeros(0, np.int64)


def ends_of(grams: list[SortedCounts], keys: np.ndarray, bits: int) -> np.ndarray:
    """The n-gram without its first word, for hashes of the order after those of ``grams``."""
    if not grams:
        return pairs_of(keys, bits)[1].astype(np.int64)
    last = keys & UNKNOWN
    shorter = ends_of(grams[:-1], grams[-1].key_at((keys >> np.uint64(32)).astype(np.int64)), bits)
    return grams[-1].find(gram_keys(len(grams) + 1, shorter.astype(np.uint64), last, bits))[0]


def adjusted(before: RangeArrays | None, places: np.ndarray, counts: np.ndarray) -> np.ndarray:
    if before is None:
        return counts
    n = before.get(places)[:, 0]
    return np.where(n > 0, n, counts)


def summed(spark, grams: SortedCounts, emit, folder: str, size: int, width: int) -> RangeArrays:
    """Sums of what ``emit`` gives for each shard: (entries id x width + column, amounts)."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    arrays = RangeArrays(size, partitions, [], width)
    if not grams.paths:
        return arrays
    step = arrays.step

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entry, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for shard in column(batch, "shard"):
                new, amounts = emit(shard)
                entry, n = counted(np.concatenate([entry, new]), np.concatenate([n, amounts]))
        if len(n) and n.max() >= 1 << 32:
            raise ValueError("a count exceeds 32 bits")
        ends = np.searchsorted(entry // np.uint64(width * step), np.arange(partitions + 1))
        for r in np.flatnonzero(np.diff(ends)).tolist():
            x, y = ends[r], ends[r + 1]
            values = [r, packed(entry[x:y]), packed_counts(n[x:y])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(values, (pa.int32(), pa.binary(), pa.binary()))],
                ["shard", "hashes", "counts"],
            )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, parts in runs(batches, "shard"):
            table = np.zeros(width * (min(size, (r + 1) * step) - r * step), np.int64)
            for part in parts:
                for x, n in zip(column(part, "hashes"), column(part, "counts")):
                    table[unpacked_values(x).astype(np.int64) - width * r * step] += unpacked_counts(n)
            if table.max() >= 1 << 32:
                raise ValueError("a count exceeds 32 bits")
            path = write_array(folder, table.astype("<u4"))
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([path], pa.string())], ["range", "path"])

    names = spark.createDataFrame([(s,) for s in grams.paths], "shard int")
    told = stored(
        names.repartition(partitions).mapInArrow(split, "shard int, hashes binary, counts binary")
        .repartition(partitions, "shard").sortWithinPartitions("shard")
        .mapInArrow(write, "range int, path string"),
        "sums",
    ).collect()
    arrays.paths = {r["range"]: r["path"] for r in told}
    return arrays


def longer_grams(
    texts: DataFrame, words: SortedCounts, grams: list[SortedCounts], folder: str, shards: int
) -> tuple[SortedCounts, np.ndarray]:
    """Counts of the n-grams of the order after those of ``grams``, and their counts of counts."""
    contexts_known = max(1, int(grams[-1].sizes.sum()))
    if contexts_known >= 1 << 32:
        raise ValueError("more than 2^32 n-grams of an order")

    def find(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place, count = words.find(x)
        return (place + FIRST_WORD).astype(np.uint64), count

    def keys(held: list[np.ndarray]) -> np.ndarray:
        contexts, tokens, _, at = sequences(held, find)
        *_, (prefix, _, _) = walked(grams, contexts, tokens, at)
        own = np.flatnonzero(prefix >= 0)
        return gram_keys(len(grams) + 2, prefix[own].astype(np.uint64), tokens[own])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size, seen = WordHashes(), [], 0, []
        for batch in batches:
            for text in texts_of(batch):
                held.append(hashes(words_of(text)))
                size += len(held[-1]) + 1
                if size >= BUFFER // 8:
                    seen.append(keys(held))
                    held, size = [], 0
                    if sum(map(len, seen)) >= BUFFER:
                        yield from dealt(*counted(np.concatenate(seen)), shards, contexts_known)
                        seen = []
        if held:
            seen.append(keys(held))
        if seen:
            yield from dealt(*counted(np.concatenate(seen)), shards, contexts_known)

    blocks = texts.mapInArrow(count, "shard int, hashes binary, counts binary")
    return merged(blocks, folder, shards, contexts_known)


def steps_of(texts: DataFrame, words: SortedCounts, pairs: SortedCounts, folder: str, shards: int, order: int) -> list[Step]:
    """The orders from 2 to ``order``."""
    spark, grams, few, out = texts.sparkSession, [pairs], [None], []
    while len(grams) < order - 1:
        longest, counts = longer_grams(texts, words, grams, f"{folder}/grams{len(grams) + 2}", shards)
        grams.append(longest)
        few.append(counts)
    size = int(words.sizes.sum()) + FIRST_WORD
    for k, own in enumerate(grams):
        before = None
        if k + 1 < len(grams):
            shorter, longer = grams[: k + 1], grams[k + 1]

            def count_before(shard: int, shorter=shorter, longer=longer) -> tuple[np.ndarray, np.ndarray]:
                return counted(
                    ends_of(shorter, np.array(longer.opened(shard)[0]), shorter[0].bits).astype(np.uint64)
                )

            before = summed(spark, longer, count_before, f"{folder}/before{k + 2}", int(own.sizes.sum()), 1)

        def follow(shard: int, own=own, before=before, size=size, pairs=not k) -> tuple[np.ndarray, np.ndarray]:
            keys, counts = own.opened(shard)
            n = adjusted(before, own.starts[shard] + np.arange(len(keys)), counts.all())
            # The counts of counts 1 to 4 go to a row after those of all contexts.
            few = np.uint64(4 * size) + n[n < 5].astype(np.uint64) - np.uint64(1)
            if not pairs:
                return counted(few)
            first = pairs_of(np.array(keys), own.bits)[0] * np.uint64(4)
            entries = [first + np.minimum(n, 3).astype(np.uint64) - np.uint64(1), first + np.uint64(3), few]
            amounts = [np.ones(len(n), np.int64), n, np.ones(len(few), np.int64)]
            return counted(np.concatenate(entries), np.concatenate(amounts))

        if k and before is None:
            out.append(Step(own, None, None, discounts(few[k])))
        else:
            # Above pairs only the counts of counts are summed up here.
            contexts = size if not k else 0
            sums = summed(spark, own, partial(follow, size=contexts), f"{folder}/follow{k + 2}", contexts + 1, 4)
            out.append(Step(own, before, None if k else sums, discounts(sums.get(np.array([contexts]))[0])))
        if k:
            out[-1].heavy = out[-1].heavy_sums(spark, f"{folder}/heavy{k + 2}")
    return out


def train(docs: DataFrame, folder: str | None = None, *, text_col: str = "text", order: int = 2) -> Model:
    """A model of all rows of ``docs``. Null texts count as empty: an end token alone."""
    if order < 2:
        raise ValueError("the order is 2 or more")
    spark = docs.sparkSession
    prepare(spark)
    # A pass leaves files behind and nothing reads its shuffle again: drop that at its end.
    kept = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        return _train(docs, folder, text_col, order)
    finally:
        spark.conf.unset(CLEAN_UP) if kept is None else spark.conf.set(CLEAN_UP, kept)


def _train(docs: DataFrame, folder: str | None, text_col: str, order: int) -> Model:
    spark = docs.sparkSession
    folder = local_folder(folder or new_scratch_dir(spark, "bigrams"))
    # More shards than partitions even out what a task merges.
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = 2 * partitions
    texts = docs.select(F.col(text_col).alias("text"))
    block = "shard int, hashes binary, counts binary"

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size = WordHashes(), [], 0
        for batch in batches:
            for text in texts_of(batch):
                held.append(hashes(words_of(text)))
                size += len(held[-1])
                if size >= BUFFER:
                    yield from dealt(*counted(np.concatenate(held)), shards)
                    held, size = [], 0
        if size:
            yield from dealt(*counted(np.concatenate(held)), shards)

    documents = docs.count()
    words, _ = merged(texts.mapInArrow(count_words, block), f"{folder}/words", shards)
    total = int(words.sizes.sum()) + FIRST_WORD
    bits = (total - 1).bit_length()
    if bits > 32:
        raise ValueError("more than 2^32 words")

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size, seen = WordHashes(), [], 0, []

        def find(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            place, count = words.find(x)
            return (place + FIRST_WORD).astype(np.uint64), count

        for batch in batches:
            for text in texts_of(batch):
                held.append(hashes(words_of(text)))
                size += len(held[-1]) + 1
                if size >= BUFFER // 8:
                    contexts, tokens, _, _ = sequences(held, find)
                    seen.append(pair_keys(contexts, tokens, bits))
                    held, size = [], 0
                    if sum(map(len, seen)) >= BUFFER:
                        yield from dealt(*counted(np.concatenate(seen)), shards)
                        seen = []
        if held:
            contexts, tokens, _, _ = sequences(held, find)
            seen.append(pair_keys(contexts, tokens, bits))
        if seen:
            yield from dealt(*counted(np.concatenate(seen)), shards)

    pairs, few = merged(texts.mapInArrow(count_pairs, block), f"{folder}/pairs", shards, bits=bits)
    contexts, seconds, second_few = context_arrays(docs, pairs, f"{folder}/contexts", total, partitions)
    return Model(
        words, pairs, contexts, documents, words_total(docs, words) + documents, discounts(few),
        discounts(second_few), int(pairs.sizes.sum()), seconds,
        steps_of(texts, words, pairs, folder, shards, order) if order > 2 else [],
    )


def words_total(docs: DataFrame, words: SortedCounts) -> int:
    """All word tokens, summed over the shards' counts."""
    spark = docs.sparkSession
    paths = [(p[1],) for p in words.paths.values()]
    if not paths:
        return 0

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [int(Counts(p).all().sum()) for p in column(batch, "path")]
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], ["n"])

    return spark.createDataFrame(paths, "path string").mapInArrow(add, "n long").agg(F.sum("n")).first()[0]


def context_arrays(
    docs: DataFrame, pairs: SortedCounts, folder: str, size: int, ranges: int
) -> tuple[RangeArrays, np.ndarray, np.ndarray]:
    """For each id: with how many seconds it has count 1, 2 and 3 or more, and of how many
    pairs it is the second; how many ids are second in 1, 2 and more pairs; and in 1 to 4."""
    spark = docs.sparkSession
    arrays = RangeArrays(size, ranges, [])
    if not pairs.paths:
        return arrays, np.zeros(3, np.int64), np.zeros(4, np.int64)
    step = arrays.step
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = spark.createDataFrame([(s, *p) for s, p in pairs.paths.items()], "shard int, hashes string, counts string")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task's shards are summed before they are dealt out: a row for each range.
        entry, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for a, b in zip(column(batch, "hashes"), column(batch, "counts")):
                counts = np.minimum(Counts(b).few, 3).astype(np.uint64)
                first, second = pairs_of(np.fromfile(a, "<u8"), pairs.bits)
                first = first * np.uint64(4) + counts - np.uint64(1)
                new, times = counted(np.concatenate([first, second * np.uint64(4) + np.uint64(3)]))
                entry, n = counted(np.concatenate([entry, new]), np.concatenate([n, times]))
        ends = np.searchsorted(entry // np.uint64(4 * step), np.arange(ranges + 1))
        for r in np.flatnonzero(np.diff(ends)).tolist():
            x, y = ends[r], ends[r + 1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r], pa.int32()),
                    pa.array([packed(entry[x:y])], pa.binary()),
                    pa.array([packed_counts(n[x:y])], pa.binary()),
                ],
                ["shard", "hashes", "counts"],
            )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, parts in runs(batches, "shard"):
            table = np.zeros(4 * (min(size, (r + 1) * step) - r * step), np.int64)
            for part in parts:
                for x, n in zip(column(part, "hashes"), column(part, "counts")):
                    table[unpacked_values(x).astype(np.int64) - 4 * r * step] += unpacked_counts(n)
            seconds = np.bincount(np.minimum(table[3::4], 5), minlength=6)[1:].tolist()
            path = write_array(folder, table.astype("<u4"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r], pa.int32()), pa.array([path], pa.string()), pa.array([seconds], pa.list_(pa.int64()))],
                ["range", "path", "seconds"],
            )

    told = stored(
        names.repartition(partitions).mapInArrow(split, "shard int, hashes binary, counts binary")
        .repartition(partitions, "shard").sortWithinPartitions("shard")
        .mapInArrow(write, "range int, path string, seconds array<long>"),
        "contexts",
    ).collect()
    arrays.paths = {r["range"]: r["path"] for r in told}
    seconds = np.sum([r["seconds"] for r in told], axis=0)
    return arrays, np.array([seconds[0], seconds[1], seconds[2:].sum()]), seconds[:4]


def log_probabilities(model: Model, contexts: np.ndarray, tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """log10 p(token | context); ``counts`` are the tokens' training counts."""
    classes = model.distinct + 1
    if not model.documents:
        return np.full(len(tokens), -np.log10(classes))
    unknown = tokens == UNKNOWN
    # Distinct words first: a batch repeats its frequent ones.
    ids, back = np.unique(np.concatenate([contexts, tokens]), return_inverse=True)
    rows = np.zeros((len(ids), 4), np.int64)
    known = ids != UNKNOWN
    rows[known] = model.contexts.get(ids[known].astype(np.int64))
    of_context, of_token = rows[back[: len(contexts)]], rows[back[len(contexts) :]]
    d, e = model.pair_discounts, model.word_discounts
    b = of_token[:, 3]
    rest = (e[1:] * model.seconds).sum() / model.distinct_pairs
    lower = np.maximum(b - e[np.minimum(b, 3)], 0) / model.distinct_pairs + rest / classes
    total = of_context[:, :3].sum(axis=1)
    # A context's count: how often it is the first of a pair.
    context_counts = np.where(contexts == START, model.documents, np.roll(counts, 1)).astype(float)
    seen = (total > 0) & (context_counts > 0)
    gamma = np.where(seen, of_context[:, :3] @ d[1:] / np.maximum(context_counts, 1), 1.0)
    n = np.zeros(len(tokens), np.int64)
    ask = np.flatnonzero(seen & ~unknown)
    if len(ask):
        n[ask] = model.pairs.find(pair_keys(contexts[ask], tokens[ask], model.pairs.bits))[1]
    higher = np.where(n > 0, (n - d[np.minimum(n, 3)]) / np.maximum(context_counts, 1), 0.0)
    return np.log10(higher + gamma * lower)


def order_log_probabilities(
    model: Model, contexts: np.ndarray, tokens: np.ndarray, at: np.ndarray
) -> np.ndarray:
    """log10 p(token | as many words before it as the model's order takes)."""
    classes = model.distinct + 1
    if not model.documents:
        return np.full(len(tokens), -np.log10(classes))
    e = model.word_discounts
    ids, back = np.unique(tokens, return_inverse=True)
    known = ids != UNKNOWN
    firsts = np.zeros(len(ids), np.int64)
    firsts[known] = model.contexts.get(ids[known].astype(np.int64))[:, 3]
    b = firsts[back]
    rest = (e[1:] * model.seconds).sum() / model.distinct_pairs
    p = np.maximum(b - e[np.minimum(b, 3)], 0) / model.distinct_pairs + rest / classes
    for step, (prefix, place, count) in zip(model.steps, walked([s.grams for s in model.steps], contexts, tokens, at)):
        has = np.flatnonzero(prefix >= 0)
        ids, back = np.unique(prefix[has], return_inverse=True)
        follow = step.follow(ids)[back]
        has, follow = has[follow[:, 3] > 0], follow[follow[:, 3] > 0]
        n, d = np.zeros(len(has), np.int64), step.discounts
        found = np.flatnonzero(place[has] >= 0)
        n[found] = step.adjusted(place[has[found]], count[has[found]])
        p[has] = (n - d[np.minimum(n, 3)] + follow[:, :3] @ d[1:] * p[has]) / follow[:, 3]
    return np.log10(p)


SCORED = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scored(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of each row: tokens with
    the end, those that training has seen, the log10 probability under single counts (0.1
    added to each) and under the model, whatever its order. Perplexity is
    10^(-score / n_tokens).

    A null or empty text is an end token alone. Null ids stay null, repeated rows are scored
    one by one. A model of no documents gives every token the same probability.
    """
    prepare(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        floor = model.tokens + 0.1 * (model.distinct + 1)
        for batch in batches:
            ids, texts = column(batch, "id"), texts_of(batch)
            for lo, hi in slices([len(t) for t in texts], CHUNK):
                contexts, tokens, counts, at = sequences([hashes(words_of(t)) for t in texts[lo:hi]], model.ids)
                counts[counts < 0] = model.documents
                base = np.add.reduceat(np.log10((counts + 0.1) / floor), at[:-1])
                if model.steps:
                    each = order_log_probabilities(model, contexts, tokens, at)
                else:
                    each = log_probabilities(model, contexts, tokens, counts)
                value = np.add.reduceat(each, at[:-1])
                known = np.add.reduceat((counts > 0).astype(np.int64), at[:-1])
                total = np.full(hi - lo, model.tokens, np.int64)
                values = [np.diff(at), known, total, base, value]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo:hi], pa.int64()), *map(pa.array, values)],
                    [c.split()[0] for c in SCORED.split(", ")],
                )

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(score, SCORED)


def held_out(id_col: str = "doc_id"):
    """Whether a row is left out of training."""
    return crc_mod(F.col(id_col), HELD_OUT) == 0
