"""Near-duplicates by SetSketch registers, joint likelihood and exact verification.

A document is the set of its distinct word shingles. Register i of its sketch is
floor(1 - log_b x_i), cut off to a byte, where x_i is the smallest of exponential variables
that the shingles draw from hash i: truncated minima on an exponential scale, which merge by
maximum and are equal in two sets with about their Jaccard similarity.

1. Equal sets become one class; only classes go on, so copies never meet one another.
2. Runs of ``ROWS`` registers are band keys. A bucket links its members to its smallest
   document only. At a similarity of 0.8 all of the ``BANDS`` bands miss with probability
   (1 - 0.8^5)^40, about 1e-7.
3. A candidate whose joint likelihood is highest far below the threshold is dropped.
4. The rest is verified on full sets, and components are formed.
5. Members of a bucket that are in different components by then may still be linked with
   each other. They meet in tiles of bounded size, a pair only in the first band that it
   shares. A tile compares sketches, verifies likely pairs on the full sets it holds, and
   skips pairs whose components it has joined already: it gives at most one link less than
   it has components, so many similar but unlinked members make no rows. No candidate that
   shares a band goes untested, however large its bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

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
from orderlake.llm.decontam import multipliers

BANDS, ROWS = 40, 5
REGISTERS = BANDS * ROWS
# Base of the registers' scale, and the rate's logarithm in steps of it: sets of one shingle
# to some millions fit a byte.
BASE, SHIFT = 1.12, 26
# A pair is dropped unverified only if its most likely similarity is this far below.
# Estimates have a standard deviation of at most 0.03 there.
MARGIN = 0.12
# Members of a tile's side, and shingles of them together, on average.
TILE, TILE_SHINGLES = 512, 1 << 21
CACHED = 1 << 16


def document_set(text: str, hashes: WordHashes, words: int) -> np.ndarray:
    """Sorted distinct shingles; with fewer words the whole sequence is the only one."""
    known = hashes(words_of(text))
    if not len(known):
        return np.zeros(0, np.uint64)
    return np.unique(shingle_hashes(known, min(words, len(known))))


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """The sketches of non-empty sets: (sets, REGISTERS) bytes."""
    flat, at = np.concatenate(sets), offsets_of([len(s) for s in sets])
    minima = np.full((REGISTERS, len(sets)), np.iinfo(np.uint64).max, np.uint64)
    factors = multipliers(REGISTERS)
    for lo in range(0, len(flat), CACHED):
        part = flat[lo : lo + CACHED]
        first = int(np.searchsorted(at, lo, side="right")) - 1
        last = int(np.searchsorted(at, lo + len(part)))
        starts = np.maximum(at[first:last] - lo, 0)
        for i, factor in enumerate(factors):
            row = minima[i, first:last]
            np.minimum(row, np.minimum.reduceat(part * factor, starts), out=row)
    x = -np.log1p(-np.clip(minima / 2.0**64, 2.0**-64, 1 - 2.0**-53))
    return np.clip(np.floor(1 + SHIFT - np.log(x) / np.log(BASE)), 0, 255).astype(np.uint8).T


def likely_similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The similarity of each pair of sketches with the highest joint likelihood of its
    numbers of larger, smaller and equal registers, given the sets' sizes."""
    more = (a > b).sum(axis=1)[:, None]
    less = (a < b).sum(axis=1)[:, None]
    same = a.shape[1] - more - less
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    grid = np.linspace(0, 1, 101)[None, :] * np.minimum(u / v, v / u)

    def p(x: np.ndarray) -> np.ndarray:
        return np.clip(-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE), 1e-12, 1)

    # P(a's register is larger) and P(smaller) at similarity j.
    larger, smaller = p(u - v * grid), p(v - u * grid)
    equal = np.clip(1 - larger - smaller, 1e-12, 1)
    value = more * np.log(larger) + less * np.log(smaller) + same * np.log(equal)
    return np.take_along_axis(grid, value.argmax(axis=1)[:, None], axis=1)[:, 0]


def signatures(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_shingles, set_key, registers); key and registers of an empty set are null."""

    @tidied
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        hashes = WordHashes()
        for batch in batches:
            ids, texts = column(batch, "id"), texts_of(batch)
            for lo, hi in slices([len(t) for t in texts], 2_000_000):
                sets = [document_set(t, hashes, words) for t in texts[lo:hi]]
                full = [s for s in sets if len(s)]
                sketches = iter(registers(full)) if full else iter(())
                keys = [xxhash.xxh3_128_digest(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[lo:hi], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array([next(sketches).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "set_key", "registers"],
                )

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(sign, "doc_id long, n_shingles long, set_key binary, registers binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over edges (a, b), for nodes with one.

    Labels pass to neighbours and then to the label's own label, until none changes: as
    many rounds as the logarithm of the longest path. Joins and minima only, so a node with
    very many links is split and pre-aggregated like any key.
    """
    links = stored(
        edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .union(edges.select("b", "a"))
        .where("node <> other")
        .distinct(),
        "links",
    )
    labels = stored(
        links.groupBy("node").agg(F.min("other").alias("other"))
        .select("node", F.least("node", "other").alias("component"), F.lit(True).alias("changed")),
        "labels",
    )
    while True:
        told = (
            links.join(labels.select(F.col("node").alias("other"), "component"), "other")
            .groupBy("node").agg(F.min("component").alias("told"))
        )
        nearer = labels.join(told, "node").select(
            "node", F.col("component").alias("was"), F.least("component", "told").alias("next")
        )
        up = labels.select(F.col("node").alias("next"), F.col("component").alias("up"))
        labels = stored(
            nearer.join(up, "next", "left").select(
                "node",
                F.least("next", F.coalesce("up", "next")).alias("component"),
                (F.least("next", F.coalesce("up", "next")) < F.col("was")).alias("changed"),
            ),
            "labels",
        )
        if labels.where("changed").isEmpty():
            return labels.select("node", "component")


def likely_pairs(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs whose similarity is likely near the threshold or above."""
    floor = percent / 100 - MARGIN

    @tidied
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (sketch_rows(column(batch, c)) for c in ("registers_a", "registers_b"))
            n_a, n_b = (np.array(column(batch, c), float) for c in ("n_a", "n_b"))
            keep = likely_similarity(a, b, n_a, n_b) >= floor
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    side = lambda x: classes.select(
        F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("registers").alias(f"registers_{x}")
    )
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.select("a", "b", "n_a", "n_b", "registers_a", "registers_b").mapInArrow(keep, "a long, b long")


def sketch_rows(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint8).reshape(-1, REGISTERS)


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union of two non-empty sorted sets."""
    few, many = (x, y) if len(x) <= len(y) else (y, x)
    if 100 * len(few) < percent * len(many):
        return False
    at = np.minimum(np.searchsorted(many, few), len(many) - 1)
    both = int(np.count_nonzero(many[at] == few))
    return 100 * both >= percent * (len(x) + len(y) - both)


def sets_of(
    nodes: DataFrame, classes: DataFrame, docs: DataFrame, words: int, id_col: str, text_col: str
) -> DataFrame:
    """(node, members) of distinct nodes, stored: only their texts are read into sets."""
    named = nodes.join(classes.select("node", "first", "set_key"), "node").select(
        "node", "first", F.col("set_key").alias("wanted")
    )
    source = docs.select(F.col(id_col).cast("long").alias("first"), F.col(text_col).alias("text"))

    @tidied
    def collect_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        hashes = WordHashes()
        for batch in batches:
            out = []
            for node, wanted, text in zip(column(batch, "node"), column(batch, "wanted"), texts_of(batch)):
                own = document_set(text, hashes, words)
                if xxhash.xxh3_128_digest(own) == wanted:
                    out.append((node, own.tobytes()))
            cols = list(zip(*out)) or [(), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary())], ["node", "members"]
            )

    sets = source.join(named, "first").mapInArrow(collect_sets, "node long, members binary")
    # Repeated rows of a document give its set again.
    return stored(sets.dropDuplicates(["node"]), "sets")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union on full sets, stored."""

    @tidied
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                for x, y in zip(column(batch, "members_a"), column(batch, "members_b"))
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda x: sets.select(F.col("node").alias(x), F.col("members").alias(f"members_{x}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "members_a", "members_b")
    return stored(joined.mapInArrow(compare, "a long, b long"), "verified")


def open_members(members: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component, stored: (key, band, node,
    component, main, tiles, other_tiles), with the bucket's largest component and the
    numbers of tiles of all its members and of those outside it.

    A bucket's centre is left out: it has been tested with all of its members already.
    """
    named = (
        members.where("n > 2")
        .join(labels.select("node", F.col("component").alias("_c")), "node", "left")
        .join(classes.select("node", "n_shingles"), "node")
        .select("key", "band", "node", "center", "n_shingles", F.coalesce("_c", "node").alias("component"))
    )
    parts = named.groupBy("key", "component").agg(
        F.count(F.lit(1)).alias("n_part"), F.sum("n_shingles").alias("s_part")
    )
    tiles = lambda n, s: F.greatest(F.ceil(n / TILE), F.ceil(s / TILE_SHINGLES)).cast("int")
    main = (
        parts.groupBy("key")
        .agg(
            F.max(F.struct("n_part", "component", "s_part")).alias("main"),
            F.sum("n_part").alias("n"),
            F.sum("s_part").alias("s"),
        )
        .where("n > main.n_part")
        .select(
            "key",
            F.col("main.component").alias("main"),
            tiles(F.col("n"), F.col("s")).alias("tiles"),
            tiles(F.col("n") - F.col("main.n_part"), F.col("s") - F.col("main.s_part")).alias("other_tiles"),
        )
    )
    return stored(
        named.join(main, "key").where("node <> center").drop("center", "n_shingles"), "open"
    )


def remaining_links(opened: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): components that a link between members of one bucket joins, stored.

    Members outside a bucket's largest component are held in tiles, which all members are
    compared with; tasks share the tiles.
    """
    full = opened.join(classes.select("node", "n_shingles", "registers"), "node").join(sets, "node")
    tile = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    rows = ["band", "node", "component", "main", "n_shingles", "registers", "members"]
    left = full.where("component <> main").select(
        "key", tile("other_tiles").alias("i"), every("tiles").alias("j"), F.lit(0).alias("side"), *rows
    )
    right = full.select(
        "key", every("other_tiles").alias("i"), tile("tiles").alias("j"), F.lit(1).alias("side"), *rows
    )
    floor = percent / 100 - MARGIN

    @tidied
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile_now, tile = None, Tile(floor, percent)
        for batch in batches:
            found: list[tuple[int, int]] = []
            at = zip(*(column(batch, c) for c in ("key", "i", "j")))
            values = zip(*(column(batch, c) for c in ("side", *rows)))
            for place, (side, *row) in zip(at, values):
                if place != tile_now:
                    tile_now, tile = place, Tile(floor, percent)
                if side == 0:
                    tile.held.append(row)
                else:
                    found += tile.links(*row)
            cols = list(zip(*found)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b"])

    spark = opened.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tiles = left.unionByName(right).repartition(partitions, "key", "i", "j")
    return stored(tiles.sortWithinPartitions("key", "i", "j", "side").mapInArrow(compare, "a long, b long"), "joined")


class Tile:
    """Members of a bucket that other members of it are compared with."""

    def __init__(self, floor: float, percent: int):
        self.floor, self.percent = floor, percent
        self.held: list[list] = []
        self.table: tuple | None = None
        self.joined: dict[int, int] = {}

    def root(self, component: int) -> int:
        while component in self.joined:
            component = self.joined[component]
        return component

    def links(
        self, band: int, node: int, component: int, main: int, n: int, raw: bytes, members: bytes
    ) -> list[tuple[int, int]]:
        """Pairs of components that links of a member with the held ones join newly."""
        if not self.held:
            return []
        if self.table is None:
            _, ids, own, _, sizes, raws, sets = zip(*self.held)
            sketches = sketch_rows(list(raws))
            self.table = np.array(ids), np.array(own), np.array(sizes, float), sketches, band_values(sketches)
            self.sets = [np.frombuffer(x, np.uint64) for x in sets]
        ids, components, sizes, sketches, bands = self.table
        one = np.frombuffer(raw, np.uint8)[None, :]
        same = bands[:, : band + 1] == band_values(one)[:, : band + 1]
        # A pair is dealt with in the first band it shares; of two held ones, once.
        near = np.flatnonzero(same[:, band] & ~same[:, :band].any(axis=1) & (components != component))
        if component != main:
            near = near[ids[near] < node]
        found: list[tuple[int, int]] = []
        root = self.root(component)
        roots = {int(c): self.root(int(c)) for c in set(components[near].tolist())}
        near = near[[roots[int(c)] != root for c in components[near]]] if len(near) else near
        if not len(near):
            return found
        like = likely_similarity(
            sketches[near], np.broadcast_to(one, (len(near), REGISTERS)), sizes[near], np.full(len(near), float(n))
        )
        own_set = np.frombuffer(members, np.uint64)
        for k in np.argsort(-like, kind="stable"):
            if like[k] < self.floor:
                break
            other = int(components[near[k]])
            root, far = self.root(component), self.root(other)
            if root != far and linked(self.sets[near[k]], own_set, self.percent):
                self.joined[max(root, far)] = min(root, far)
                found.append((component, other))
        return found


def band_values(sketches: np.ndarray) -> np.ndarray:
    """Each band's registers as one number: (sets, BANDS)."""
    out = np.zeros((len(sketches), BANDS), np.uint64)
    for row in sketches.reshape(len(sketches), BANDS, ROWS).transpose(2, 0, 1):
        out = (out << np.uint64(8)) | row
    return out


def near_duplicates(
    docs: DataFrame,
    *,
    words: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of ``docs``.

    Documents are linked when 100 * intersection >= percent * union of their sets;
    component_id is the smallest id reachable. Null and empty texts have no set, are linked
    with nothing and kept. Rows of one id are one document: their sets are linked. Rows with a
    null id take no part in links; they get the component of equal sets, if any, and are kept
    if there is none.
    """
    prepare(docs.sparkSession)
    signed = stored(signatures(docs, words, id_col, text_col), "signatures")
    classes = stored(
        signed.where("set_key is not null and doc_id is not null")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("first"), F.max("n_shingles").alias("n_shingles"), F.max("registers").alias("registers"))
        # Written once, so the numbers stay: rows of one id may have several sets.
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    keys = F.expr(
        f"posexplode(transform(sequence(0, {BANDS - 1}), i -> xxhash64(i, substring(registers, i * {ROWS} + 1, {ROWS}))))"
    )
    bands = classes.select(keys.alias("band", "key"), "node")
    buckets = bands.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("center")).where("n > 1")
    members = stored(bands.join(buckets, "key"), "members")

    exact = (classes, docs, words, id_col, text_col)
    starred = members.where("node <> center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    likely = stored(likely_pairs(starred, classes, percent), "candidates")
    named = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    labels = components(verified(likely, sets_of(named, *exact), percent))
    opened = open_members(members, classes, labels)
    sets = sets_of(opened.select("node").distinct(), *exact)
    by_component = classes.join(labels, "node", "left").select(
        "set_key", "first", F.coalesce("component", "node").alias("_component")
    )
    same_id = id_links(signed, by_component)
    joined = components(remaining_links(opened, classes, sets, percent).union(same_id))
    found = by_component.join(joined.withColumnRenamed("node", "_component"), "_component", "left").select(
        "set_key", "first", F.coalesce("component", "_component").alias("_component")
    )
    smallest = found.groupBy("_component").agg(F.min("first").alias("_smallest"))
    component = found.join(smallest, "_component").select("set_key", "_smallest")
    return signed.join(component, "set_key", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("_smallest", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("_smallest", "doc_id"), F.col("_smallest").isNull()).alias("kept"),
    )


def id_links(signed: DataFrame, by_component: DataFrame) -> DataFrame:
    """(a, b): components of the different sets that rows of one id have."""
    own = signed.where("doc_id is not null and set_key is not null")
    several = (
        own.groupBy("doc_id").agg(F.min("set_key").alias("_low"), F.max("set_key").alias("_high")).where("_low <> _high")
    )
    keys = own.join(several, "doc_id").select("_low", "set_key").distinct()
    of = by_component.select("set_key", "_component")
    return (
        keys.join(of.withColumnsRenamed({"set_key": "_low", "_component": "a"}), "_low")
        .join(of.withColumnRenamed("_component", "b"), "set_key")
        .select("a", "b").where("a <> b").distinct()
    )


def deduplicated(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that stay: one row of each component, all columns.

    Of rows of one kept id the least in the order of all columns stays. Rows without an id stay
    if no row with an id has their set, one of each set; so do all without words.
    """
    groups = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    gone = (
        groups.where("not kept and doc_id is not null").select(F.col("doc_id").alias("_gone")).distinct()
    )
    named = docs.where(F.col(id_col).isNotNull()).join(gone, docs[id_col].cast("long") == gone["_gone"], "left_anti")
    kept = named
    # Few ids repeat, if any. Only then are other rows told from theirs.
    repeated = stored(
        docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id"))
        .agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_id"),
        "repeated",
    )
    if not repeated.isEmpty():
        same = named[id_col] == repeated["_id"]
        rest = [c for c in docs.columns if c != id_col]
        once = (
            named.join(repeated, same, "left_semi").groupBy(id_col).agg(F.min(F.struct(*rest)).alias("_row"))
            .select(*[F.col(c) if c == id_col else F.col("_row")[c].alias(c) for c in docs.columns])
        )
        kept = named.join(repeated, same, "left_anti").union(once)
    without = docs.where(F.col(id_col).isNull())
    if not without.isEmpty():
        kept = kept.union(unnamed(docs, id_col, text_col, options.get("words", 5)))
    return kept


def unnamed(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """Rows without an id that stay: one of each set that no row with an id has, and those
    without a set."""
    without = docs.where(F.col(id_col).isNull())

    @tidied
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        hashes = WordHashes()
        for batch in batches:
            sets = [document_set(t, hashes, words) for t in texts_of(batch, text_col)]
            keys = pa.array([xxhash.xxh3_128_digest(s) if len(s) else None for s in sets], pa.binary())
            yield batch.append_column("_set_key", keys)

    schema = T.StructType([*without.schema.fields, T.StructField("_set_key", T.BinaryType())])
    rows = stored(without.mapInArrow(keyed, schema), "unnamed")
    own = signatures(docs.where(F.col(id_col).isNotNull()), words, id_col, text_col)
    known = own.where("set_key is not null").select(F.col("set_key").alias("_set_key")).distinct()
    new = rows.where("_set_key is not null").join(known, "_set_key", "left_anti")
    columns = docs.columns
    once = new.groupBy("_set_key").agg(F.min(F.struct(*columns)).alias("_row")).select("_row.*")
    return rows.where("_set_key is null").select(*columns).union(once)
