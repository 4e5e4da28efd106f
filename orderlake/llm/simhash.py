"""Near-duplicates by SimHash fingerprints and Golay-code fuzzy hashing.

Bit b of a fingerprint is set when over half of the text's word shingles have it set in their
64-bit hash. Fingerprints that differ in at most two bits are linked, exactly:

1. Equal fingerprints are one class; only classes go on, so copies never meet one another.
2. A fingerprint is cut into segments of 22, 21 and 21 bits. Two differing bits leave one
   segment whole, and at most two of them fall into the segment after it.
3. The perfect binary Golay code of 23 bits puts every word within three bits of exactly one
   codeword. The keys of a segment are the codewords that the words within one bit of it are
   decoded to: six at most. Segments two bits apart have a word within one bit of both, so
   they share a key. A bucket is (which segment is whole, its bits, a key of the next one):
   about 16 rows a class.
4. Members of a bucket are compared bit by bit and give the links of a spanning forest.
5. Fingerprints of a bucket with more than ``MOST`` members are not compared. Each names the
   65 words within one bit of it; those that name the same word are at most two bits apart,
   and two that are so far apart name a common word. A word is named by 65 fingerprints at
   most, so this is linear however many fingerprints crowd together, and as exact.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import column, prepare, stored, texts_of, words_of
from orderlake.llm.neardup import components

BITS, SEED = 64, 42
DISTANCE = 2
# First bit and width of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
# Members up to which a bucket is compared pair by pair in one task.
MOST = 128
# Shingles whose hashes are unpacked to bits at a time.
UNPACKED = 8192

# ---- fixed values: the code's generator, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 ----
GENERATOR, CODE_BITS, CHECK_BITS = 0xC75, 23, 11
# ---------------------------------------------------------------------------------------


def remainder(word: int) -> int:
    """The word as a polynomial, modulo the generator."""
    for bit in range(CODE_BITS - 1, CHECK_BITS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK_BITS)
    return word


def code_tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainders by byte place and value, and the error of up to three bits by remainder."""
    bits = [remainder(1 << i) for i in range(24)]
    by_byte = np.zeros((3, 256), np.int64)
    for place, value, bit in itertools.product(range(3), range(256), range(8)):
        if value >> bit & 1:
            by_byte[place, value] ^= bits[8 * place + bit]
    errors = np.zeros(1 << CHECK_BITS, np.int64)
    for weight in range(1, 4):
        for places in itertools.combinations(range(CODE_BITS), weight):
            found = 0
            for i in places:
                found ^= bits[i]
            errors[found] = sum(1 << i for i in places)
    return by_byte, errors


class Golay:
    """Decoding of arrays of words of up to 23 bits."""

    def __init__(self) -> None:
        self.by_byte, self.errors = code_tables()

    def decode(self, words: np.ndarray) -> np.ndarray:
        """The 12-bit index of the codeword nearest to each word."""
        one, two, three = self.by_byte
        left = one[words & 255] ^ two[words >> 8 & 255] ^ three[words >> 16]
        return (words ^ self.errors[left]) >> CHECK_BITS

    def keys(self, words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, indices): each row's distinct codeword indices within one bit of its word."""
        flips = np.concatenate([[0], 1 << np.arange(width)])
        near = np.sort(self.decode(words[:, None] ^ flips[None, :]), axis=1)
        first = np.ones(near.shape, bool)
        first[:, 1:] = near[:, 1:] != near[:, :-1]
        rows, at = np.nonzero(first)
        return rows, near[rows, at]


def fingerprint_of(text: str, words: int = 3) -> int:
    """The fingerprint of a text, unsigned; zero for a text without words."""
    import xxhash

    parts = words_of(text)
    if not parts:
        return 0
    k = min(words, len(parts))
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(parts) - k + 1
    counts = np.zeros(BITS, np.int64)
    for lo in range(0, n, UNPACKED):
        hi = min(n, lo + UNPACKED)
        cuts = zip(starts[lo:hi].tolist(), ends[lo + k - 1 : hi + k - 1].tolist())
        hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in cuts), "<u8", hi - lo)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, *, words: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint) of each row; the fingerprint as a signed 64-bit integer."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.array([fingerprint_of(t, words) for t in texts_of(batch)], np.uint64)
            ids = pa.array(column(batch, "id"), pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(own.view(np.int64))], ["doc_id", "fingerprint"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(sign, "doc_id long, fingerprint long")


def bucket_keys(classes: DataFrame) -> DataFrame:
    """(key, fp): the buckets of each distinct fingerprint."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Golay()
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            unsigned = own.view(np.uint64)
            parts = [
                (unsigned >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64)
                for at, width in SEGMENTS
            ]
            for i, whole in enumerate(parts):
                after = (i + 1) % len(parts)
                rows, index = code.keys(parts[after], SEGMENTS[after][1])
                keys = i << 34 | whole[rows] << 12 | index
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(own[rows])], ["key", "fp"])

    return classes.select("fp").mapInArrow(keyed, "key long, fp long")


def forest(members: np.ndarray) -> list[tuple[int, int]]:
    """Links between fingerprints at most two bits apart that join them into components."""
    members = np.sort(members)
    unsigned = members.view(np.uint64)
    label = np.arange(len(members))
    out = []
    for i in range(1, len(members)):
        near = np.flatnonzero(np.bitwise_count(unsigned[:i] ^ unsigned[i]) <= DISTANCE)
        for j in near:
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                out.append((int(members[j]), int(members[i])))
    return out


def bucket_links(members: DataFrame) -> DataFrame:
    """(a, b): forests of buckets, given as lists of at most ``MOST`` fingerprints."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [link for fps in column(batch, "fps") for link in forest(np.array(fps, np.int64))]
            cols = list(zip(*found)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b"])

    return members.select("fps").mapInArrow(compare, "a long, b long")


def crowded_links(fps: DataFrame) -> DataFrame:
    """(a, b): fingerprints that name a common word within one bit, and the smallest that does."""
    within_one = "explode(concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))) AS word"
    named = fps.selectExpr("fp", within_one).groupBy("word").agg(F.collect_list("fp").alias("fps"))
    return named.where(F.size("fps") > 1).select(
        F.array_min("fps").alias("a"), F.explode("fps").alias("b")
    )


def links(classes: DataFrame) -> DataFrame:
    """(a, b): links that join all distinct fingerprints at most two bits apart, stored."""
    keys = stored(bucket_keys(classes), "buckets")
    sizes = stored(
        keys.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        .where("n > 1"),
        "bucket-sizes",
    )
    pairs = sizes.where(f"n = 2 and bit_count(a ^ b) <= {DISTANCE}").select("a", "b")
    members = keys.join(sizes.where("n > 2").select("key", "n"), "key")
    few = members.where(f"n <= {MOST}").groupBy("key").agg(F.collect_list("fp").alias("fps"))
    crowd = members.where(f"n > {MOST}").select("fp").distinct()
    return stored(
        pairs.union(bucket_links(few)).union(crowded_links(crowd)).where("a <> b").distinct(), "fp-links"
    )


def near_duplicates(
    docs: DataFrame, *, words: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row of ``docs``.

    ``fingerprint`` is 16 lowercase hex digits; component_id is the smallest id reachable over
    links of at most two differing bits. Null and empty texts have fingerprint zero and are
    linked like others. Rows of one id are one document: their fingerprints are linked. Rows
    without an id take no part in that; they get the component of their fingerprint, null if
    no row in it has an id.
    """
    prepare(docs.sparkSession)
    signed = stored(fingerprints(docs, words=words, id_col=id_col, text_col=text_col), "fingerprints")
    classes = stored(
        signed.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("first")), "fp-classes"
    )
    of_ids = (
        signed.where("doc_id is not null").groupBy("doc_id")
        .agg(F.min("fingerprint").alias("a"), F.max("fingerprint").alias("z")).where("a <> z")
    )
    same_id = signed.join(of_ids, "doc_id").select("a", F.col("fingerprint").alias("b")).where("a <> b")
    joined = components(links(classes).union(same_id))
    named = joined.withColumnRenamed("node", "fp").join(classes, "fp")
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = classes.join(named.join(smallest, "component").select("fp", "component_id"), "fp", "left").select(
        "fp", F.coalesce("component_id", "first").alias("component_id")
    )
    return signed.join(named, signed["fingerprint"] == named["fp"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
