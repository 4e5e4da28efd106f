"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are put into classes by their number of shingles, each class twice as large as the
one before. For the class of up to s shingles a document is seen as windows of two
neighbouring blocks of s shingles, so every run of s shingles lies in a window and a
window's size is at most about four times its items' size: an item of which 0.8 is in the
window has a Jaccard similarity of at least about 0.19 with it. Item and window share each
of ``HASHES`` minima with that probability; one shared minimum makes a candidate, so an
item at the threshold is missed with probability (1 - 0.19)^64, about 1e-6. Candidates are
verified by the exact share of the item's shingles that the whole document has.

These bounds hold for items of more than half the smallest class. Items of at most that many
shingles are looked up exactly: of an item's s shingles, of which a match has n at least, any
s - n + 1 include one that the document has. An item of fewer words than a shingle is one
shingle of its own length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import (
    WordHashes,
    column,
    offsets_of,
    prepare,
    shingle_hashes,
    slices,
    stored,
    texts_of,
    tidied,
    words_of,
)
from orderlake.llm.wacz import file_system

WORDS, THRESHOLD, HASHES = 5, 0.8, 64
# Shingles of the items that a pass over the documents searches for, about.
BLOCK_SHINGLES = 2_000_000
SMALLEST = 16
# Items of at most so many shingles are looked up exactly.
EXACT = SMALLEST // 2
# Characters of documents that are searched together.
CHUNK = 500_000


def multipliers(n: int) -> np.ndarray:
    """Odd 64-bit multipliers, always the same."""
    return np.random.default_rng(20240229).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Blocks:
    """Minima of each hash over blocks of many documents' shingles.

    ``minima`` is (hashes, blocks); a block never holds shingles of two documents, which
    have ``counts`` blocks each.
    """

    def __init__(self, minima: np.ndarray, counts: np.ndarray):
        self.minima, self.counts = minima, counts

    @classmethod
    def of(cls, shingles: list[np.ndarray], factors: np.ndarray) -> Blocks:
        """Blocks of SMALLEST shingles."""
        sizes = np.array([len(s) for s in shingles])
        flat, counts = np.concatenate(shingles), -(-sizes // SMALLEST)
        first = np.repeat(offsets_of(sizes)[:-1], counts)
        starts = first + SMALLEST * run_places(counts)
        out = np.empty((len(factors), len(starts)), np.uint64)
        # Pieces that stay in the processor's cache.
        for lo in range(0, len(starts), 1024):
            hi = min(lo + 1024, len(starts))
            base, end = starts[lo], starts[hi] if hi < len(starts) else len(flat)
            part, at = flat[base:end], starts[lo:hi] - base
            for i, factor in enumerate(factors):
                np.minimum.reduceat(part * factor, at, out=out[i, lo:hi])
        return cls(out, counts)

    def halved(self) -> Blocks:
        """Blocks of twice the size."""
        counts = -(-self.counts // 2)
        starts = np.repeat(offsets_of(self.counts)[:-1], counts) + 2 * run_places(counts)
        return Blocks(np.minimum.reduceat(self.minima, starts, axis=1), counts)

    def windows(self) -> np.ndarray:
        """Minima over each block and the one after it in its document."""
        after = np.arange(1, self.minima.shape[1] + 1)
        after[np.cumsum(self.counts) - 1] -= 1
        return np.minimum(self.minima, self.minima[:, after])


def run_places(counts: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... within each of consecutive runs."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


# An item's id, its distinct shingles and how many words each has.
Item = tuple[int, np.ndarray, int]
ITEM_COLUMNS = ["item_id", "length", "n", "shingles"]


def places(hashes: np.ndarray, bits: np.uint64) -> np.ndarray:
    """The place of each hash in a small table of bits."""
    return ((hashes >> np.uint64(20)) & bits).astype(np.int64)


def table_bits(n: int) -> np.uint64:
    return np.uint64((1 << max(10, min(22, (16 * n).bit_length()))) - 1)


class Exact:
    """Items by some of their shingles, which all have one length in words."""

    def __init__(self, entries: list[tuple[int, int]]):
        keys = np.array([k for k, _ in entries], np.uint64)
        order = np.argsort(keys, kind="stable")
        self.members = np.array([i for _, i in entries])[order]
        self.keys, first = np.unique(keys[order], return_index=True)
        self.starts = np.append(first, len(keys))
        self.bits = table_bits(len(keys))
        self.some = np.zeros(int(self.bits) + 1, bool)
        self.some[places(self.keys, self.bits)] = True

    def candidates(self, shingles: list[np.ndarray]) -> set[tuple[int, int]]:
        """(document, item) places that share a shingle."""
        flat = np.concatenate(shingles)
        at = np.flatnonzero(self.some[places(flat, self.bits)])
        key = np.minimum(np.searchsorted(self.keys, flat[at]), len(self.keys) - 1)
        hit = self.keys[key] == flat[at]
        document = np.searchsorted(offsets_of([len(s) for s in shingles]), at[hit], side="right") - 1
        out: set[tuple[int, int]] = set()
        for d, k in np.unique(np.stack([document, key[hit]]), axis=1).T.tolist():
            out.update((d, i) for i in self.members[self.starts[k] : self.starts[k + 1]].tolist())
        return out


class Items:
    """A block of benchmark items: minima by size class, and shingles of short ones."""

    def __init__(self, items: list[Item], factors: np.ndarray, words: int, threshold: float):
        self.items, self.factors, self.words = items, factors, words
        self.classes: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        by_class: dict[int, list[int]] = {}
        by_length: dict[int, list[tuple[int, int]]] = {}
        for i, (_, shingles, length) in enumerate(items):
            if len(shingles) <= EXACT:
                wanted = max(1, math.ceil(threshold * len(shingles)))
                some = shingles[: max(0, len(shingles) - wanted + 1)].tolist()
                by_length.setdefault(length, []).extend((s, i) for s in some)
                continue
            size = SMALLEST
            while size < len(shingles):
                size *= 2
            by_class.setdefault(size, []).append(i)
        self.exact = {length: Exact(entries) for length, entries in by_length.items() if entries}
        for size, members in by_class.items():
            found = []
            bits = table_bits(len(members))
            for factor in factors:
                minima = np.array([(items[i][1] * factor).min() for i in members], np.uint64)
                order = np.argsort(minima, kind="stable")
                some = np.zeros(int(bits) + 1, bool)
                some[places(minima, bits)] = True
                found.append((minima[order], np.array(members)[order], some))
            self.classes[size] = found

    def candidates(self, documents: list[np.ndarray]) -> set[tuple[int, int]]:
        """(document, item) places that may match, for the word hashes of documents."""
        out: set[tuple[int, int]] = set()
        for length, exact in self.exact.items():
            out |= exact.candidates([shingle_hashes(h, length) for h in documents])
        if self.classes:
            long = [d for d, h in enumerate(documents) if len(h) >= self.words]
            shingles = [shingle_hashes(documents[d], self.words) for d in long]
            out.update((long[d], i) for d, i in self.alike(shingles))
        return out

    def alike(self, shingles: list[np.ndarray]) -> set[tuple[int, int]]:
        """(document, item) places that share a minimum; no document may be empty."""
        out: set[tuple[int, int]] = set()
        if not shingles:
            return out
        blocks, size = Blocks.of(shingles, self.factors), SMALLEST
        for wanted in sorted(self.classes):
            while size < wanted:
                blocks, size = blocks.halved(), 2 * size
            windows = blocks.windows()
            document = np.repeat(np.arange(len(shingles)), blocks.counts)
            for row, (known, members, some) in zip(windows, self.classes[wanted]):
                # A small table of bits leaves few windows to look up.
                at = np.flatnonzero(some[places(row, np.uint64(len(some) - 1))])
                lo, hi = (np.searchsorted(known, row[at], side) for side in ("left", "right"))
                for w, a, b in zip(at[hi > lo], lo[hi > lo], hi[hi > lo]):
                    out.update((int(document[w]), int(i)) for i in members[a:b])
        return out


def item_blocks(items: DataFrame, id_col: str, text_col: str, words: int) -> list[str]:
    """Files of the benchmark items with their distinct shingles, about BLOCK_SHINGLES in
    each. Items are hashed in tasks and written to the shared scratch folder; the driver
    sees a number and the files' names."""
    spark = items.sparkSession

    @tidied
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            rows = []
            for item, text in zip(column(batch, "item_id"), texts_of(batch)):
                own = hashes(words_of(text))
                if len(own):
                    length = min(words, len(own))
                    shingles = np.unique(shingle_hashes(own, length))
                    rows.append((item, length, len(shingles), shingles.tobytes()))
            cols = list(zip(*rows)) or [()] * 4
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ITEM_COLUMNS)

    source = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    known = source.where("item_id is not null and text is not null")
    one = stored(known.mapInArrow(hashed, "item_id long, length int, n long, shingles binary"), "items")
    total = one.agg(F.sum("n")).first()[0]
    if not total:
        return []
    # Rows are dealt in turn, so repeated items do not meet in one block.
    return sorted(stored(one.repartition(math.ceil(total / BLOCK_SHINGLES)), "item-blocks").inputFiles())


def read_block(path: str) -> list[Item]:
    """The items of a file."""
    import pyarrow.parquet as pq

    files, place = file_system(path)
    with files.open_input_file(place) as file:
        table = pq.read_table(file, columns=["item_id", "length", "shingles"])
    return [
        (item, np.frombuffer(raw, np.uint64), length)
        for item, length, raw in zip(*(table[c].to_pylist() for c in ("item_id", "length", "shingles")))
    ]


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    words: int = WORDS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, item_id, matched, item_shingles, containment): a row for each document and
    item of which the document has at least ``threshold`` of the distinct shingles. An item
    of fewer than ``words`` words is a single shingle: its words one after the other.

    The items are the stated query set: workers read them from files of about
    ``BLOCK_SHINGLES`` shingles, each a pass over the documents, which are not shuffled.
    Words are split at white space, A-Z lower-cased. Documents or items that are null or
    have no words match nothing; so do items without an id. Repeated documents and items are
    searched row by row. No items or documents: an empty frame.
    """
    spark = docs.sparkSession
    prepare(spark)
    factors = multipliers(HASHES)
    schema = "doc_id long, item_id long, matched long, item_shingles long, containment double"
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = spark.createDataFrame([], schema)
    for path in item_blocks(items, item_id_col, item_text_col, words):

        @tidied
        def search(batches: Iterator[pa.RecordBatch], path=path) -> Iterator[pa.RecordBatch]:
            index, hashes = Items(read_block(path), factors, words, threshold), WordHashes()
            for batch in batches:
                rows = []
                ids, texts = column(batch, "id"), texts_of(batch)
                for lo, hi in slices([len(t) for t in texts], CHUNK):
                    hashed = [hashes(words_of(t)) for t in texts[lo:hi]]
                    own, of = {}, -1
                    for d, i in sorted(index.candidates(hashed)):
                        item, wanted, length = index.items[i]
                        if d != of:
                            own, of = {}, d
                        if length not in own:
                            own[length] = np.unique(shingle_hashes(hashed[d], length))
                        at = np.minimum(np.searchsorted(own[length], wanted), len(own[length]) - 1)
                        n = int((own[length][at] == wanted).sum())
                        if n >= threshold * len(wanted):
                            rows.append((ids[lo + d], item, n, len(wanted), n / len(wanted)))
                cols = list(zip(*rows)) or [()] * 5
                kinds = [pa.int64()] * 4 + [pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds)],
                    ["doc_id", "item_id", "matched", "item_shingles", "containment"],
                )

        out = out.union(source.mapInArrow(search, schema))
    return out


def decontaminated(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents that contain no item; all columns stay. Rows of one id go together, so
    a row of null id is kept only if no row of null id contains an item."""
    found = contained_items(docs, items, id_col=id_col, **options)
    hits = found.select(F.col("doc_id").alias("_leaky")).distinct()
    return docs.join(hits, docs[id_col].cast("long").eqNullSafe(hits["_leaky"]), "left_anti")
