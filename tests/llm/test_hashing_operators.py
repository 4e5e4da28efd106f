"""SimHash, spelling variants and Merkle manifests against brute force, and on untidy rows."""

import hashlib
import itertools
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from compare import compare
from pyspark.sql import functions as F

from orderlake.llm import merkle, queries, simhash, spelling

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "key string, word string, fp long, place long, digest string"
)
LONG = " ".join(f"word{i % 977} colour{'' if i % 3 else 's'} tail{i}" for i in range(40_000))


@pytest.fixture(scope="module")
def rows(spark, sf):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select(
        "doc_id", "text", "lang", "source", "n_chars").collect()]


UNTIDY = [
    (1, "one two three four five six seven", "a"),
    (1, "one two three four five six seven", "a"),
    (2, None, "a"),
    (3, "", None),
    (4, LONG, "b"),
    (5, LONG + "\nmore", "b"),
    (None, "a text without an id", "b"),
    (None, None, None),
    (6, "ONE two three four five six seven", ""),
    (7, "   \n\t ", "é"),
    (8, "x", "é"),
    (9, "LETTER letter letters lettre Letter lettér letter, letter letters", "c"),
    (1, "a second text of the first id", "c"),
    (-5, "é ü 日本語", "日"),
]


@pytest.fixture(scope="module")
def untidy(spark):
    rows = [(i, t, None, s, 7, "k", "w", 1, 2, "d") for i, t, s in UNTIDY]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- 11 SimHash ------------------------------------------------------------------
def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    """Fingerprint -> component number, by comparing all pairs."""
    prints = sorted(set(prints))
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= 2:
            parent[root(a)] = root(b)
    return {p: root(p) for p in prints}


def check_simhash(got, docs):
    prints = [(i, slow_fingerprint(t)) for i, t in docs]
    component = slow_components(p for _, p in prints)
    smallest = {}
    for i, p in prints:
        smallest[component[p]] = min(i, smallest.get(component[p], i))
    want = Counter((i, f"{p:016x}", smallest[component[p]]) for i, p in prints)
    assert Counter(map(tuple, got)) == want


def test_simhash_query(spark, sf, rows):
    got = queries.op11_simhash(spark, sf)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    check_simhash(got.collect(), [(r[0], r[1]) for r in rows])


def test_golay_keys_meet_within_two_bits():
    code = simhash.Golay()
    words = np.arange(1 << 23)
    nearest = code.decode(words)
    # A perfect code: 4096 spheres of equal size that hold all words.
    assert set(np.bincount(nearest, minlength=4096)) == {2048}
    rng = np.random.default_rng(5)
    some = rng.integers(0, 1 << 21, 300)
    rows, keys = code.keys(some, 21)
    found = defaultdict(set)
    for r, k in zip(rows, keys):
        found[r].add(int(k))
    assert max(map(len, found.values())) <= 6
    for r, word in enumerate(some):
        for bits in itertools.chain.from_iterable(itertools.combinations(range(21), n) for n in (1, 2)):
            other = np.array([word ^ sum(1 << b for b in bits)])
            assert found[r] & set(code.keys(other, 21)[1].tolist())


@pytest.mark.parametrize("most", [3, 128])
def test_links_of_planted_fingerprints(spark, monkeypatch, most):
    monkeypatch.setattr(simhash, "MOST", most)
    rng = np.random.default_rng(most)
    prints = set(rng.integers(0, 1 << 63, 60).tolist())
    for base in list(prints)[:20]:
        for n in (1, 2, 3, 4):
            bits = rng.choice(64, n, replace=False)
            prints.add(base ^ sum(1 << int(b) for b in bits))
    crowd = next(iter(prints))
    # Many fingerprints in one bucket, chained and apart.
    for bits in itertools.combinations(range(45, 56), 2):
        prints.add(crowd ^ (1 << bits[0]) ^ (1 << bits[1]))
    for bits in itertools.combinations(range(56, 64), 4):
        prints.add(crowd ^ sum(1 << b for b in bits))
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    unsigned = lambda v: v & (1 << 64) - 1
    assert all((unsigned(e.a) ^ unsigned(e.b)).bit_count() <= 2 for e in edges)
    want = slow_components(prints)
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for e in edges:
        parent[root(unsigned(e.a))] = root(unsigned(e.b))
    groups = lambda label: {frozenset(p for p in prints if label(p) == c) for c in {label(p) for p in prints}}
    assert groups(root) == groups(want.get)


def test_simhash_of_untidy_rows(untidy, nothing):
    assert simhash.near_duplicates(nothing).count() == 0
    got = simhash.near_duplicates(untidy).collect()
    assert len(got) == len(UNTIDY)
    want = Counter((i, f"{slow_fingerprint(text):016x}") for i, text, _ in UNTIDY)
    assert Counter((r.doc_id, r.fingerprint) for r in got) == want
    by_text = defaultdict(set)
    for r in got:
        by_text[r.fingerprint].add(r.component_id)
    # Texts without words are alike, also the one without an id; so are both cases of a text.
    assert by_text["0" * 16] == {2}
    assert {r.component_id for r in got if r.doc_id in (1, 6)} == {1}
    assert [r.component_id for r in got if r.doc_id is None and r.fingerprint != "0" * 16] == [None]


# ---- 12 spelling variants ----------------------------------------------------------
def slow_words(docs, slips):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if slips and h % slips == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def slow_variants(counts):
    def edits(w):
        letters = {c for x in counts for c in x}
        for i in range(len(w)):
            yield w[:i] + w[i + 1 :]
            for c in letters:
                yield w[:i] + c + w[i + 1 :]
        for i in range(len(w) + 1):
            for c in letters:
                yield w[:i] + c + w[i:]

    near = {w: {x for x in edits(w) if x in counts and x != w} for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 5 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return Counter(out)


VARIANT_COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def test_spelling_query(spark, sf, rows):
    got = queries.op12_spelling(spark, sf)
    assert got.columns == VARIANT_COLUMNS
    want = slow_variants(slow_words([(r[0], r[1]) for r in rows], 199))
    assert Counter(map(tuple, got.collect())) == want
    assert any(k[1] for k in want)


def test_neighbours_by_pairs_of_nodes(spark):
    rng = np.random.default_rng(3)
    # Runs of equal letters, ties and chains of forms.
    words = {"".join(rng.choice(list("abé"), rng.integers(6, 9))) for _ in range(400)}
    words |= {"aaaaaa", "aaaaaaa", "aaaaaab", "baaaaaa", "aabbaa", "aabaa" + "a"}
    counts = {w: int(5 ** rng.integers(1, 5) + rng.integers(0, 2)) for w in sorted(words)}
    frame = spark.createDataFrame([(w, n) for w, n in counts.items()], "word string, n long")
    ordered = frame.orderBy(F.col("n").desc(), "word").select(F.monotonically_increasing_id().alias("word_id"), "word", "n")
    got = spelling.forms(ordered.cache())
    assert Counter(tuple(r[c] for c in VARIANT_COLUMNS) for r in got.collect()) == slow_variants(counts)


def test_spelling_of_untidy_rows(spark, untidy, nothing):
    assert spelling.spelling_variants(nothing).count() == 0
    got = spelling.spelling_variants(untidy).collect()
    assert Counter(map(tuple, got)) == slow_variants(slow_words([(i, t) for i, t, _ in UNTIDY], None))
    assert ("colour", None) not in {(r.word, r.n) for r in got} and any(r.word == "colours" for r in got)
    slipped = spelling.spelling_variants(untidy, slips=3)
    assert Counter(map(tuple, slipped.collect())) == slow_variants(slow_words([(i, t) for i, t, _ in UNTIDY], 3))


# ---- 13 Merkle manifest --------------------------------------------------------------
def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def slow_leaf(row, text):
    values = (row[0], row[3], row[2], row[4], text)
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def slow_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def slow_proof(levels, i):
    for level in levels[:-1]:
        run = level[i - i % 3 : i - i % 3 + 3]
        yield run[: i % 3], run[i % 3 + 1 :]
        i //= 3


def slow_manifest(rows, tampered):
    """Rows (doc_id, text, lang, source, n_chars) -> the result's rows."""
    groups = defaultdict(list)
    for r in rows:
        text = r[1].replace("\n", "") if r[1] and tampered(r[0]) else r[1]
        groups[r[3]].append((r[0], slow_leaf(r, r[1]), slow_leaf(r, text)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for members in groups.values():
        members.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1]))
    trees = {s: slow_tree([m[1] for m in groups[s]]) for s in names}
    whole = slow_tree([trees[s][-1][0] for s in names])
    out = []
    for at, s in enumerate(names):
        for i, (doc, leaf, claimed) in enumerate(groups[s]):
            steps = [*slow_proof(trees[s], i), *slow_proof(whole, at)]
            root = claimed
            for left, right in steps:
                root = H(*left, root, *right)
            proof = H(*(d for left, right in steps for d in left + right))
            out.append((doc, leaf, trees[s][-1][0], whole[-1][0], proof, root, root == whole[-1][0]))
    return Counter(out)


def even(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 2 == 0


def test_merkle_query(spark, sf, rows, duckdb_con):
    got = queries.op13_merkle(spark, sf)
    want = slow_manifest(rows, even)
    assert Counter(map(tuple, got.collect())) == want
    assert {k[-1] for k in want} == {True, False}
    assert compare(got, duckdb_con, queries.statements()["op13_merkle"]) is None


@pytest.mark.parametrize("every", [1, 2, 4])
def test_checkpoints_of_any_distance(spark, every):
    # Groups of 1, 3 ** k and one more; as many groups as make a run of one.
    sizes = {None: 1, "": 3, "a": 4, "b": 81, "c": 82, "ü": 200, "Z": 2}
    rows = [(i, f"text\n{i}", "en", s, 6) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stripped = F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    got = merkle.checked(merkle.build(docs.repartition(5), found={"text": stripped}, every=every)).collect()
    assert Counter(map(tuple, got)) == slow_manifest(rows, lambda i: i % 2 == 0)


def test_proofs_lead_to_the_root(spark, sf):
    manifest = merkle.build(spark.read.parquet(f"{sf}/documents.parquet"))
    proofs = merkle.proofs(manifest).collect()
    assert {merkle.folded(p.leaf, p.path) for p in proofs} == {manifest.root}
    assert merkle.folded(proofs[0].leaf[::-1], proofs[0].path) != manifest.root


def test_merkle_of_untidy_rows(untidy, nothing):
    empty = merkle.build(nothing)
    assert empty.root is None and merkle.checked(empty).count() == 0 and merkle.proofs(empty).count() == 0
    rows = [(i, t, None, s, 7) for i, t, s in UNTIDY]
    got = merkle.checked(merkle.build(untidy)).collect()
    assert Counter(map(tuple, got)) == slow_manifest(rows, lambda i: False)
    assert all(r.verified for r in got)


def test_long_texts_take_little_time():
    text = "word " * 2_000_000
    began = time.perf_counter()
    assert simhash.fingerprint_of(text) == slow_fingerprint("word word word")
    assert time.perf_counter() - began < 20
