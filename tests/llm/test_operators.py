"""Each operator against brute force, and on untidy rows."""

import binascii
import hashlib
import math
import os
import random
import re
import subprocess
import sys
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import compare
from pyspark import cloudpickle
from pyspark.sql import functions as F

import __spark_entry__ as contract
from orderlake.llm import (
    decontam,
    fingerprint,
    huffman,
    kneserney,
    neardup,
    packing,
    pii,
    queries,
    tokens,
    toxicity,
    urlfilter,
    wacz,
)

SCHEMA = "doc_id long, text string, lang string, id long, range string, node string, _gone long, length long"
LONG = " ".join(f"word{i % 977} tail{i}" for i in range(40_000))


@pytest.fixture(scope="module")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").cache()


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}


@pytest.fixture(scope="module")
def untidy(spark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing column names."""
    rows = [
        (1, "one two three four five six seven"),
        (1, "one two three four five six seven"),
        (2, None),
        (3, ""),
        (4, LONG),
        (5, LONG + " more"),
        (None, "a text without an id"),
        (None, None),
        (6, "ONE two three four five six seven"),
        (7, "   \n\t "),
        (8, "x"),
        (9, "mail me at a.b@c.org or +49 (30) 123-456789 or 10.0.0.1"),
        (-5, "é ü 日本語"),
    ]
    return spark.createDataFrame([(i, t, None, 7, "r", "n", 1, 2) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def crc(text, n):
    return binascii.crc32(str(text).encode()) % n


# ---- 1 fingerprints ------------------------------------------------------------
def slow_entropies(data):
    out = []
    for i in range(len(data) - 63):
        counts = Counter(data[i : i + 64])
        total = sum(int(fingerprint.WEIGHT[c]) for c in counts.values())
        top = fingerprint.SCALE * 64 * 6
        out.append((top - total) * 1000 // top)
    return out


def test_entropies():
    rng = np.random.default_rng(1)
    for data in (bytes(200), b"abcdefgh" * 30, rng.integers(0, 256, 500, dtype=np.uint8).tobytes(), LONG.encode()[:40_000]):
        assert fingerprint.entropies(np.frombuffer(data, np.uint8)).tolist() == slow_entropies(data)


def test_digests_do_not_depend_on_neighbours():
    ranks = fingerprint.ranks_of(np.arange(fingerprint.BINS))
    parts = [LONG.encode()[:5000], b"short", b"", LONG.encode()[300:900], b"y" * 400]
    together = fingerprint.digests(parts, ranks)
    for part, digest in zip(parts, together):
        assert np.array_equal(fingerprint.digests([part], ranks)[0], digest)
        assert np.array_equal(fingerprint.from_text(fingerprint.to_text(digest)), digest)
    assert fingerprint.similarity(together[0], together[0]) == 1.0
    assert fingerprint.similarity(together[2], together[2]) == 1.0
    assert fingerprint.similarity(together[2], together[0]) == 0.0


def test_fingerprint_query(spark, sf, texts):
    rows = {r.doc_id: r for r in queries.op1_fingerprints(spark, sf).collect()}
    ids = sorted(texts)
    assert sorted(rows) == ids
    by_text = {}
    for i, doc in enumerate(ids):
        text, after = texts[doc], texts[ids[(i + 1) % len(ids)]]
        n = len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        assert rows[doc].n_chars == len(text)
        assert rows[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, rows[doc].fingerprint) == rows[doc].fingerprint
        following = rows[ids[(i + 1) % len(ids)]].fingerprint
        expected = fingerprint.similarity(
            fingerprint.from_text(rows[doc].fingerprint), fingerprint.from_text(following)
        )
        assert rows[doc].near_next == pytest.approx(expected)
    assert np.mean([r.near_edited for r in rows.values()]) > 0.6
    assert np.mean([r.near_next for r in rows.values()]) < 0.1


def test_fingerprints_of_untidy_rows(untidy, nothing):
    ranks = fingerprint.ranks_of(fingerprint.entropy_counts(untidy))
    rows = fingerprint.compared_in_order(untidy, ranks).collect()
    assert len(rows) == untidy.count()
    assert {r.fingerprint for r in rows if r.doc_id in (2, 3)} == {""}
    assert len({r.fingerprint for r in rows if r.doc_id == 1}) == 1
    # The last by id (9) is followed by the first: the null ids come first, an empty text first.
    last = next(r for r in rows if r.doc_id == 9)
    text = "mail me at a.b@c.org or +49 (30) 123-456789 or 10.0.0.1"
    assert last.edited_sha256 == hashlib.sha256(text[: len(text) - len(text) // 4].encode()).hexdigest()
    assert fingerprint.compared_in_order(nothing, ranks).count() == 0
    one = fingerprint.compared_in_order(untidy.where("doc_id = 8"), ranks).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(8, 1.0)]


# ---- 2 packing -----------------------------------------------------------------
def whole_encoder(name):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokens.vocabulary(name))
    found.encode_special_tokens = True
    return lambda text: found.encode(text, add_special_tokens=False).ids


def test_word_by_word_ids_are_the_librarys(texts):
    odd = [
        "", "a", " a", "a ", "  a b", "a\nb", "a\n\nb c.", "x'll don't 's", "It's o'clock.\nThe ½ end", "é áb é.",
        "<|endoftext|> a<|endoftext|>", "tab\tb c d  e", "日本語。 テスト", "12 3.4, 5!?", "a\x1cb c", "İstanbul. ǅ",
        "a\r\nb.\r\nc", "İ. x", "\u0958. x", "\n\n\nA, b.\n\nC!\n", "\n", "a\n\n", "\nA\n\n\n", "a\xa0 b", "dogs'. it's,",
        "a.\n b", "..,, ..", "é.\nÉ", "a.b, c!\nD", "a ́b", "x  ", " ", ". a", ", ,", "a .b", "a  b",
    ]
    for name, spaced in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        encode, whole = tokens.Encoder(tokens.vocabulary(name), spaced, most=5000), whole_encoder(name)
        everything = odd + list(texts.values())
        for _ in range(2):
            for lo in range(0, len(everything), 40):
                part = everything[lo : lo + 40]
                assert [np.frombuffer(x, "<u4").tolist() for x in encode(part)] == [whole(t) for t in part]


def test_ids_of_random_texts_are_the_librarys():
    draw = random.Random(5)
    parts = list("  \n\taBxés'.,-1½_#\r") + ["İ", "\u0301", "日", "\u0958", "\x1c", "foo", "Bar,", "12.", "it's", "\n\n"]
    everything = ["".join(draw.choices(parts, k=draw.randrange(14))) for _ in range(4000)]
    for name, spaced in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        encode, whole = tokens.Encoder(tokens.vocabulary(name), spaced, most=200_000), whole_encoder(name)
        for lo in range(0, len(everything), 200):
            part = everything[lo : lo + 200]
            assert [np.frombuffer(x, "<u4").tolist() for x in encode(part)] == [whole(t) for t in part]


def check_packing(rows, expected):
    """rows: (doc_id, piece, start, length, crc, sequence, offset)."""
    pieces = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert pieces == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return sequences


def expected_pieces(texts):
    whole, out = whole_encoder("word_bpe_49k.json"), Counter()
    for doc, text in texts:
        ids = np.array([*whole(text or ""), packing.END_ID], "<u4")
        for piece, at in enumerate(range(0, len(ids), packing.CAPACITY)):
            part = ids[at : at + packing.CAPACITY]
            out[doc, piece, at, len(part), binascii.crc32(part.tobytes())] += 1
    return out


def test_packing_query(spark, sf, texts):
    sequences = check_packing(queries.op2_packing(spark, sf).collect(), expected_pieces(texts.items()))
    total = sum(n for parts in sequences.values() for _, n in parts)
    assert len(sequences) <= math.ceil(total / packing.CAPACITY) + 1


def test_packing_of_untidy_rows(untidy, nothing):
    rows = packing.packed_documents(untidy).collect()
    check_packing(rows, expected_pieces([(r.doc_id, r.text) for r in untidy.collect()]))
    assert packing.packed_documents(nothing).count() == 0
    held = packing.pack(untidy.withColumn("length", F.when(F.col("doc_id") > 3, F.lit(4096))))
    assert set(untidy.columns) <= set(held.columns)
    assert all((r.length is None) == (r.sequence_id is None) for r in held.collect())
    again = packing.pack(held.select("doc_id", "length", "Offset", F.lit("x").alias("sequence_id")))
    assert sorted(again.columns) == ["doc_id", "length", "offset", "sequence_id"]
    assert {r.offset for r in again.collect()} == {None, 0}


def test_plan_uses_exact_complements():
    counts = np.zeros(101, np.int64)
    counts[[60, 40, 30, 30, 55, 20, 25]] += 1
    counts[30] = 2
    patterns = packing.plan(counts)
    assert sum(t for t, _ in patterns) == 3
    rng = np.random.default_rng(3)
    for _ in range(30):
        counts = np.bincount(rng.integers(1, 101, 200), minlength=101)
        used = np.zeros(101, np.int64)
        for times, lengths in packing.plan(counts):
            assert sum(lengths) <= 100
            np.add.at(used, list(lengths), times)
        assert (used == counts).all()


# ---- 3 decontamination ---------------------------------------------------------
def shingles(text, k):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")) if w]
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute_contained(docs, items):
    items = [(i, shingles(t, 5)) for i, t in items if i is not None and shingles(t, 5)]
    return Counter(
        (d, i, len(own & wanted), len(wanted))
        for d, t in docs
        for own in [shingles(t, 5)]
        for i, wanted in items
        if len(own & wanted) >= 0.8 * len(wanted)
    )


def test_decontamination_query(spark, sf, texts):
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    rows = queries.op3_decontamination(spark, sf).collect()
    assert Counter((r.doc_id, r.item_id, r.matched, r.item_shingles) for r in rows) == brute_contained(texts.items(), items)
    assert rows


def test_short_items_in_long_documents(spark, untidy, nothing, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_SHINGLES", 8)
    words = LONG.split()
    rows = [
        (1, " ".join(words[50_001:50_040])), (2, " ".join(words[7:700])), (3, "one two three four five six seven"),
        (4, "two words"), (5, None), (None, "one two three four five six seven"), (6, ""), (3, "ONE two three four five"),
        (7, " ".join([*words[900:960], "not", "there", "at", "all"])),
    ]
    items = spark.createDataFrame(rows, "item_id long, text string")
    found = decontam.contained_items(untidy, items).collect()
    docs = [(r.doc_id, r.text) for r in untidy.collect()]
    assert Counter((r.doc_id, r.item_id, r.matched, r.item_shingles) for r in found) == brute_contained(docs, rows)
    kept = decontam.decontaminated(untidy, items)
    assert kept.columns == untidy.columns
    hit = {r.doc_id for r in found}
    assert Counter(r.doc_id for r in kept.collect()) == Counter(d for d, _ in docs if d not in hit)
    assert decontam.decontaminated(untidy, items.limit(0)).count() == len(docs)
    assert decontam.contained_items(nothing, items).count() == 0


# ---- 4 toxicity ----------------------------------------------------------------
def slow_segments(scores):
    """Maximal segments by their definition: the best one, then both sides of it."""
    best = max(
        ((sum(scores[a:b]), a - b, -a, a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)),
        default=None,
    )
    if not best or best[0] <= 0:
        return []
    a, b = best[3], best[4]
    right = [(x + b, y + b) for x, y in slow_segments(scores[b:])]
    return slow_segments(scores[:a]) + [(a, b)] + right


def test_maximal_segments():
    rng = np.random.default_rng(5)
    for _ in range(300):
        scores = rng.normal(-0.2, 1, rng.integers(0, 12))
        assert [(a, b) for a, b, _ in toxicity.maximal_segments(scores)] == slow_segments(scores.tolist())


def test_toxicity_is_accurate_on_held_out_rows(spark):
    d = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    rows = [r for r in queries.op4_toxicity(spark, d).collect() if r.held_out and r.doc_id in labels]
    assert all(crc(r.doc_id, 5) == 0 and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    right = sum(r.predicted == labels[r.doc_id] for r in rows)
    found = sum(r.predicted for r in rows if labels[r.doc_id])
    assert right / len(rows) > 0.97
    assert found / sum(labels[r.doc_id] for r in rows) > 0.85


def test_toxicity_of_untidy_rows(spark, untidy, nothing):
    labels = spark.createDataFrame([(4, 1), (None, 0), (5, None)], "doc_id long, toxic int")
    blank = toxicity.train(untidy, labels)
    assert {r.score for r in toxicity.scored(untidy, blank).collect()} == {0.0}
    model = toxicity.Model({"seven": 4.0}, 1.0, 0.05, (-2.0, 1.0, 1.0))
    rows = toxicity.scored(untidy, model).collect()
    assert len(rows) == untidy.count()
    assert {len(r.passages) for r in rows if r.doc_id in (1, 6)} == {1}
    assert toxicity.scored(nothing, model).count() == 0
    kept = toxicity.accepted(untidy, model)
    assert kept.columns == untidy.columns
    assert 1 not in {r.doc_id for r in kept.collect()} and kept.count() == len(rows) - 3
    assert toxicity.train(nothing, labels).fit is None


def test_every_short_item_is_found(spark):
    rng = np.random.default_rng(7)
    document = [f"w{x}" for x in rng.integers(0, 5000, 6000)]
    docs = spark.createDataFrame([(1, " ".join(document)), (2, "alone here"), (3, " ".join(document[:3000]))], "doc_id long, text string")
    items = []
    for i in range(2400):
        n = 5 + i % 8
        lo = int(rng.integers(0, len(document) - n))
        passage = document[lo : lo + n]
        if n >= 9 and i % 16 > 7:
            passage = [*passage[:-1], "changed"]
        items.append((i, " ".join(passage)))
    found = decontam.contained_items(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter((r.doc_id, r.item_id, r.matched, r.item_shingles) for r in found) == brute_contained(texts, items)
    assert {r.item_id for r in found if r.doc_id == 1} >= {i for i, t in items if "changed" not in t}


def test_items_of_fewer_words_than_a_shingle(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d e f g"), (2, "alone Here"), (3, "c"), (4, ""), (5, None), (6, "c x d")], "doc_id long, text string"
    )
    items = spark.createDataFrame(
        [(1, "C"), (2, "c d"), (3, "d  e f"), (4, "b c d e"), (5, "alone here"), (6, "e d"), (7, " "), (8, "c"), (None, "c")],
        "item_id long, text string",
    )
    found = [tuple(r) for r in decontam.contained_items(docs, items).collect()]
    hits = [(1, 1), (1, 8), (3, 1), (3, 8), (6, 1), (6, 8), (1, 2), (1, 3), (1, 4), (2, 5)]
    assert sorted(found) == sorted((d, i, 1, 1, 1.0) for d, i in hits)


# ---- 5 language model ----------------------------------------------------------
def slow_model(train):
    """A dictionary-based modified Kneser-Ney bigram model, written from its formulas."""
    pairs, words = Counter(), Counter()
    for tokens_ in train:
        words.update(tokens_)
        pairs.update(zip(["<s>", *tokens_], tokens_))
    seconds = Counter(w for _, w in pairs)

    def cut(counts):
        few = Counter(counts.values())
        return kneserney.discounts(np.array([few[i] for i in (1, 2, 3, 4)]))

    d, e = cut(pairs), cut(seconds)
    classes, total = len(words) + 1, len(pairs)
    by_context = defaultdict(list)
    for (v, _), n in pairs.items():
        by_context[v].append(n)
    rest = sum(e[min(n, 3)] for n in seconds.values()) / total

    def p(v, w):
        b = seconds[w]
        low = max(b - e[min(b, 3)], 0) / total + rest / classes
        if v not in by_context:
            return low
        ns = by_context[v]
        n = pairs[v, w]
        high = (n - d[min(n, 3)]) / sum(ns) if n else 0
        return high + sum(d[min(x, 3)] for x in ns) / sum(ns) * low

    return p, words


def tokens_of(text):
    return [*kneserney.words_of(text or ""), "</s>"]


def test_language_model_query(spark, sf, texts, documents):
    rows = {r.doc_id: r for r in queries.op5_kneser_ney(spark, sf).collect()}
    train = [tokens_of(t) for d, t in texts.items() if crc(d, 10)]
    p, words = slow_model(train)
    n, v = sum(words.values()), len(words)
    gain = 0
    for doc, text in texts.items():
        own, row = tokens_of(text), rows[doc]
        assert row.held_out == (crc(doc, 10) == 0)
        assert (row.n_tokens, row.train_tokens) == (len(own), n)
        assert row.n_known == sum(words[w] > 0 for w in own)
        base = sum(math.log10((words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        assert row.base_score == pytest.approx(base)
        gain += (row.score - row.base_score) * row.held_out
    assert gain > 0
    # Order 2, by the formulas of its own.
    pairs = {r.doc_id: r for r in kneserney.scored(documents, kneserney.train(documents.where(~kneserney.held_out()))).collect()}
    for doc, text in texts.items():
        own = tokens_of(text)
        assert pairs[doc].score == pytest.approx(sum(math.log10(p(a, b)) for a, b in zip(["<s>", *own], own)))
    # Two words of context foretell held-out texts better than one.
    assert sum(rows[d].score - pairs[d].score for d in texts if rows[d].held_out) > 0
    model = kneserney.train(documents)
    everything = [*model.words.sizes]
    assert sum(everything) + 1 == len({w for t in texts.values() for w in tokens_of(t)})


def test_model_probabilities_add_up(untidy):
    p, words = slow_model([tokens_of(r.text) for r in untidy.where("doc_id <> 4 and doc_id <> 5").collect()])
    for v in [*words, "<s>", "never"]:
        if v != "</s>":
            assert sum(p(v, w) for w in [*words, "unknown"]) == pytest.approx(1)


def test_language_model_of_untidy_rows(untidy, nothing):
    model = kneserney.train(untidy)
    rows = kneserney.scored(untidy, model).collect()
    assert len(rows) == untidy.count()
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3, 7)} == {1}
    blank = kneserney.train(nothing)
    assert {(r.n_known, r.train_tokens) for r in kneserney.scored(untidy, blank).collect()} == {(0, 0)}
    assert kneserney.scored(nothing, model).count() == 0


def slow_order(train, order):
    """p(word | history) of any order: counts on top, numbers of words before an n-gram below."""
    grams = [Counter() for _ in range(order + 1)]
    for own in train:
        line = ["<s>", *own]
        for k in range(1, order + 1):
            grams[k].update(tuple(line[i : i + k]) for i in range(len(line) - k + 1))
    used = {order: grams[order]}
    for k in range(1, order):
        before = Counter(g[1:] for g in grams[k + 1])
        used[k] = Counter({g: before[g] or n for g, n in grams[k].items() if k > 1 or g != ("<s>",)})
    cuts, follow = {}, {}
    for k, counts in used.items():
        few = Counter(counts.values())
        cuts[k] = kneserney.discounts(np.array([few[i] for i in (1, 2, 3, 4)]))
        follow[k] = defaultdict(list)
        for g, n in counts.items():
            follow[k][g[:-1]].append(n)
    rests = {
        k: {h: (sum(ns), sum(cuts[k][min(n, 3)] for n in ns)) for h, ns in by_history.items()}
        for k, by_history in follow.items()
    }
    classes = len({w for own in train for w in own}) + 1

    def p(history, w):
        k = min(len(history), order - 1) + 1
        history = tuple(history[len(history) - k + 1 :])
        low = p(history[1:], w) if k > 1 else 1 / classes
        if history not in rests[k]:
            return low
        total, rest = rests[k][history]
        n = used[k][(*history, w)]
        return (max(n - cuts[k][min(n, 3)], 0) + rest * low) / total

    return p


@pytest.mark.parametrize("order", [3, 4])
def test_models_of_higher_order(spark, texts, order):
    some = sorted(texts.items())[:150]
    train, asked = some[:120], [*some[100:], (-1, ""), (-2, None), (-3, "never seen before words"), (-4, "the")]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    model = kneserney.train(frame([*train, (0, ""), (0, None)]), order=order)
    p = slow_order([tokens_of(t) for t in [*dict(train).values(), "", ""]], order)
    rows = {r.doc_id: r for r in kneserney.scored(frame(asked), model).collect()}
    for doc, text in asked:
        line = ["<s>", *tokens_of(text)]
        want = sum(math.log10(p(line[max(0, i - order + 1) : i], line[i])) for i in range(1, len(line)))
        assert rows[doc].score == pytest.approx(want), doc


def test_models_of_higher_order_add_up():
    train = [[*t.split(), "</s>"] for t in ("a b a b c", "a b c", "b a a c", "", "c a b")]
    for order in (2, 3, 4):
        p = slow_order(train, order)
        for history in (["<s>"], ["<s>", "a"], ["a", "b"], ["b", "a", "b"], ["c", "c"], ["x"], ["<s>", "a", "b"]):
            assert sum(p(history, w) for w in ["a", "b", "c", "</s>", "unknown"]) == pytest.approx(1)


def test_language_model_query_takes_two_words_of_context(spark, sf, texts):
    rows = {r.doc_id: r for r in queries.op5_kneser_ney(spark, sf).collect()}
    p = slow_order([tokens_of(t) for d, t in texts.items() if crc(d, 10)], 3)
    for doc, text in texts.items():
        line = ["<s>", *tokens_of(text)]
        want = sum(math.log10(p(line[max(0, i - 2) : i], line[i])) for i in range(1, len(line)))
        assert rows[doc].score == pytest.approx(want)


def test_higher_order_of_untidy_rows(untidy, nothing):
    model = kneserney.train(untidy, order=3)
    assert kneserney.scored(untidy, model).count() == untidy.count()
    blank = kneserney.train(nothing, order=3)
    assert all(math.isfinite(r.score) for r in kneserney.scored(untidy, blank).collect())


def test_mix_is_undone():
    x = np.random.default_rng(0).integers(0, 1 << 63, 1000, dtype=np.uint64)
    assert (kneserney.unmix64(kneserney.mix64(x)) == x).all()


@pytest.mark.parametrize("bits", [1, 2, 7, 21, 32])
def test_pairs_are_read_off_their_keys(bits):
    rng = np.random.default_rng(bits)
    first, second = (rng.integers(0, 1 << bits, 1000, dtype=np.uint64) for _ in range(2))
    keys = kneserney.pair_keys(first, second, bits)
    assert [x.tolist() for x in kneserney.pairs_of(keys, bits)] == [first.tolist(), second.tolist()]
    assert len(set(keys.tolist())) == len(set(zip(first.tolist(), second.tolist())))


def test_blocks_hold_few_bytes_for_each_pair():
    rng = np.random.default_rng(5)
    first, second = (np.minimum(rng.zipf(1.2, 10**6), 1 << 20).astype(np.uint64) for _ in range(2))
    keys, counts = kneserney.counted(kneserney.pair_keys(first, second, 21))
    blocks = list(kneserney.dealt(keys, counts, 20))
    assert sum(b.nbytes for b in blocks) < 6 * len(keys)
    back = [
        np.concatenate([unpack(x) for b in blocks for x in b[name].to_pylist()])
        for name, unpack in (("hashes", kneserney.unpacked_values), ("counts", kneserney.unpacked_counts))
    ]
    assert (back[0] == keys).all() and (back[1] == counts).all()


def test_frequent_contexts_are_summed_up_once(spark, tmp_path):
    # "a b" goes before 300 words, one of them 400 times: more than a byte holds.
    lines = [f"a b w{i} c" for i in range(300)] + ["a b w0 d"] * 399
    train = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    model = kneserney.train(train, f"file:{tmp_path}", order=3)
    step = model.steps[-1]
    grams = int(step.grams.sizes.sum())
    assert sum(f.stat().st_size for f in (tmp_path / "grams3").iterdir()) <= 9 * grams + 16 * 8
    asked = []
    read = step.sums
    step.sums = lambda shard, first, lengths: asked.append(int(lengths.sum())) or read(shard, first, lengths)
    found = step.follow(np.arange(int(step.grams.contexts)))
    # Contexts: n-grams with a count of 1, 2, 3 or more, and all counts.
    assert [299, 0, 1, 699] in found.tolist()
    assert found[:, :3].sum() == grams
    assert sum(asked) == grams - 300
    p = slow_order([tokens_of(t) for t in lines], 3)
    for row in kneserney.scored(train.where("doc_id in (0, 1, 300)"), model).collect():
        line = ["<s>", *tokens_of(lines[row.doc_id])]
        assert row.score == pytest.approx(sum(math.log10(p(line[max(0, i - 2) : i], line[i])) for i in range(1, len(line))))


# ---- Workers -------------------------------------------------------------------
WORKER = """
import re, sys
import numpy as np, pyarrow as pa
from pyspark import cloudpickle

def held():
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()).group(1)) / 1024

def batches():
    rng = np.random.default_rng(1)
    for _ in range(4):
        texts = [" ".join(map(str, rng.integers(0, 10**6, 500).tolist())) for _ in range(1000)]
        batch = pa.RecordBatch.from_arrays([pa.array(range(1000), pa.int64()), pa.array(texts)], ["id", "text"])
        # As Spark hands them over.
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as stream:
            stream.write_batch(batch)
        yield pa.ipc.open_stream(sink.getvalue()).read_next_batch()

work = cloudpickle.load(open(sys.argv[1], "rb"))
began = held()
for batch in work(batches()):
    pass
del batch
print(held() - began)
"""


class Captured:
    """In place of a frame: keeps the function that is mapped over it."""

    def __init__(self, docs):
        self.schema, self.sparkSession = docs.schema, docs.sparkSession

    def select(self, *_):
        return self

    def mapInArrow(self, work, _):
        self.work = work


@pytest.mark.parametrize("stage", ["signatures", "accepted"])
def test_idle_workers_hold_little_memory(spark, documents, tmp_path, stage):
    captured = Captured(documents.select("doc_id", "text"))
    if stage == "signatures":
        neardup.signatures(captured, 5, "doc_id", "text")
    else:
        toxicity.accepted(captured, toxicity.Model({"bad": 1.0}))
    (tmp_path / "work").write_bytes(cloudpickle.dumps(captured.work))
    done = subprocess.run(
        [sys.executable, "-c", WORKER, str(tmp_path / "work")],
        capture_output=True, text=True, check=True, env={**os.environ, "PYTHONPATH": os.pathsep.join(sys.path)},
    )
    assert float(done.stdout) < 40


# ---- 6 near-duplicates ---------------------------------------------------------
def brute_components(docs, k, percent=80):
    sets = {}
    for doc, text in docs:
        words = [w.decode() for w in kneserney.words_of(text or "")]
        size = min(k, len(words))
        sets[doc] = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    p, q = sorted((root(a), root(b)))
                    parent[q] = p
    return {d: (len(sets[d]), root(d)) for d in ids}


def test_near_duplicate_query(spark, sf, texts):
    rows = queries.op6_near_duplicates(spark, sf).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_components(texts.items(), 2)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_chains_within_a_bucket(spark, monkeypatch):
    """Links that no bucket's centre has: the tiles must find them."""
    monkeypatch.setattr(neardup, "TILE", 4)
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(70):
        words = list(base)
        for at in rng.choice(120, rng.integers(1, 16), replace=False):
            words[at] = f"x{rng.integers(1000)}"
        docs.append((i, " ".join(words)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(frame, words=2).collect()}
    assert found == brute_components(docs, 2)


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 200), (200, 150), (7, 7)]
    found = {r.node: r.component for r in neardup.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{i: 1 for i in range(1, 41)}, 100: 100, 150: 100, 200: 100}


def test_near_duplicates_of_untidy_rows(untidy, nothing):
    rows = neardup.near_duplicates(untidy, words=2).collect()
    assert len(rows) == untidy.count()
    by_id = defaultdict(set)
    for r in rows:
        by_id[r.doc_id].add((r.component_id, r.kept))
    assert by_id[1] == {(1, True)} and by_id[6] == {(1, False)} and by_id[5] == {(4, False)}
    assert by_id[2] == {(2, True)} and by_id[7] == {(7, True)}
    assert by_id[None] == {(None, True)}
    kept = neardup.deduplicated(untidy)
    assert kept.columns == untidy.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 7, 8, 9, -5, None}
    assert neardup.near_duplicates(nothing).count() == 0


def test_sets_of_one_id_are_linked(spark):
    a, b = [f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    near = lambda words, n: " ".join([*words[:-1], f"x{n}"])
    rows = [(1, " ".join(a)), (2, " ".join(b)), (2, near(a, 1)), (3, near(b, 2)), (4, near(a, 3)), (5, "one two three"), (5, "one two three"), (None, "one two three"), (None, "lone words here"), (None, "lone words here"), (None, None), (6, "six")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.component_id) for r in neardup.near_duplicates(frame, words=2).collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 5), (6, 6), (None, 5), (None, None)}
    left = Counter(map(tuple, neardup.deduplicated(frame, words=2).collect()))
    assert left == Counter([(1, " ".join(a)), (5, "one two three"), (6, "six"), (None, "lone words here"), (None, None)])


# ---- 7 URL filters -------------------------------------------------------------
def test_url_filter_query(spark, sf, duckdb_con):
    assert compare(queries.op7_url_filters(spark, sf), duckdb_con, queries.statements()["op7_url_filters"]) is None


def test_entries_count_only_while_valid(spark):
    changes = spark.createDataFrame(
        [
            ("bad", "block", "domain:evil.org", "add", 10),
            ("bad", "block", "domain:evil.org", "add", 10),
            ("bad", "block", "domain:evil.org", "remove", 20),
            ("bad", "block", "domain:evil.org", "remove", 20),
            ("bad", "block", "domain:evil.org", "add", 30),
            ("ok", "allow", "domain:good.evil.org", "add", 0),
            ("ok", "allow", "domain:good.evil.org", "remove", 0),
            ("page", "block", "url:http://x.com/a", "add", 5),
            ("page", "block", None, "add", 5),
            ("page", "block", "domain:x.com", "gone", 5),
            ("late", "block", "domain:evil.org", "remove", 1),
        ],
        "list_name string, policy string, key string, action string, at int",
    )
    rows = [
        ("http://a.evil.org/x", t, want) for t, want in ((9, 0), (10, 1), (19, 1), (20, 0), (30, 1), (99, 1))
    ] + [
        ("http://good.evil.org:80/", 15, 0), ("http://x.com/a#b", 5, 1), ("http://x.com/b", 9, 0),
        ("https://u:p@EVIL.org./", 12, 1), (None, 10, 0), ("http://a.evil.org/x", None, 0), ("not a url", 10, 0), ("", 10, 0),
        ("http://a.evil.org/x", 10, 1),
    ]
    captures = spark.createDataFrame(rows, "url string, fetched_at int, _url int")
    out = urlfilter.judged(captures, changes).collect()
    assert len(out) == len(rows)
    assert all(r.blocked == bool(r._url) for r in out), [r for r in out if r.blocked != bool(r._url)]
    assert urlfilter.judged(captures.limit(0), changes).count() == 0
    assert {r.blocked for r in urlfilter.judged(captures, changes.limit(0)).collect()} == {False}


# ---- 8 web archives ------------------------------------------------------------
def check_archives(rows, pages):
    groups = defaultdict(list)
    for page, html in pages:
        groups[(html or "").encode()].append(page)
    want = Counter()
    for payload, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        for i in ids:
            again = top is not None and i != top
            want[i, len(payload), wacz.base32_sha1(payload), "revisit" if again else "response", top if again else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == want


def test_archive_query(spark, sf):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    check_archives(queries.op8_web_archives(spark, sf).collect(), pages)


def test_archives_of_untidy_pages(spark, monkeypatch):
    monkeypatch.setattr(wacz, "ARCHIVE_BYTES", 600)
    rows = [
        (1, "http://a/", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://a\r\nX: y", None), (4, "u", ""),
        (None, "n", "only"), (None, "n", "<p>x</p>"), (5, "é", "\r\n\r\nWARC/1.1\r\n\r\n"), (5, "é", "\r\n\r\nWARC/1.1\r\n\r\n"),
        (6, "z", "é" * 300_000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = wacz.round_trip(pages).collect()
    check_archives(out, [(i, h) for i, _, h in rows])
    assert {bytes(r.payload).decode() for r in out if r.payload is not None} == {h or "" for _, _, h in rows}
    assert wacz.round_trip(pages.limit(0)).count() == 0


def test_directories_with_zip64(tmp_path, monkeypatch):
    import zipfile

    import pyarrow.fs

    fs = pyarrow.fs.LocalFileSystem()
    for name, limit in (("plain", None), ("wide", 10)):
        if limit:
            monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
            monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
        archive = wacz.Archive(fs, f"{tmp_path}/{name}")
        records = [wacz.warc_record(i, "http://x/", bytes([65 + i]) * 50, "D", None, False) for i in range(9)]
        for i, record in enumerate(records):
            archive.add(record, i)
        archive.close()
        raw = (tmp_path / name).read_bytes()
        assert (b"PK\x06\x07" in raw) == bool(limit)
        with fs.open_input_file(f"{tmp_path}/{name}") as file:
            found = wacz.members(file, file.size())
            at, size = wacz.stored_member(file, found, wacz.DATA)
            with zipfile.ZipFile(tmp_path / name) as z:
                assert z.read(wacz.DATA) == raw[at : at + size]
                assert z.testzip() is None


# ---- 9 Huffman -----------------------------------------------------------------
def best_limited_lengths(counts, limit):
    """The cheapest prefix code of bounded length by trying all length multisets."""
    counts = sorted(counts, reverse=True)

    def go(i, room, least):
        if i == len(counts):
            return 0
        options = []
        for bits in range(least, limit + 1):
            if 2.0**-bits * (len(counts) - i) <= room + 1e-12 or 2.0**-bits <= room:
                rest = go(i + 1, room - 2.0**-bits, bits)
                if room - 2.0**-bits >= -1e-12 and rest is not None:
                    options.append(counts[i] * bits + rest)
        return min(options) if options else None

    return go(0, 1.0, 1)


def test_code_lengths_are_optimal_and_limited():
    rng = np.random.default_rng(2)
    for _ in range(40):
        n, limit = int(rng.integers(2, 8)), int(rng.integers(3, 6))
        counts = (rng.pareto(0.5, n) * 10).astype(np.int64) + 1
        lengths = huffman.code_lengths(counts, limit)
        assert lengths.max() <= limit and sum(2.0 ** -lengths.astype(float)) <= 1
        assert (lengths * counts).sum() == best_limited_lengths(counts.tolist(), limit)


def test_blocks_decode_from_their_checkpoints():
    rng = np.random.default_rng(4)
    ids = np.minimum(50_256, rng.pareto(0.4, 70_000)).astype("<u2")
    lengths = huffman.code_lengths(np.bincount(ids, minlength=1 << 16))
    codes, table = huffman.canonical_codes(lengths), huffman.decoding_table(lengths)
    for n in (0, 1, 127, 128, 129, 70_000):
        payload = huffman.encode_block(ids[:n], lengths, codes)
        assert (huffman.decode_block(payload, table) == ids[:n]).all()


def check_ids(rows, docs):
    whole, start = whole_encoder("byte_bpe_50k.json"), 0
    rows = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [d for d, _ in docs]
    for row, (_, text) in zip(rows, docs):
        ids = np.array([*whole(text or ""), huffman.END_ID], "<u4")
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == binascii.crc32(ids.tobytes())
        start += len(ids)


def test_huffman_query(spark, sf, texts):
    check_ids(queries.op9_huffman_ids(spark, sf).collect(), sorted(texts.items()))


def test_huffman_of_untidy_rows(untidy, nothing, monkeypatch):
    monkeypatch.setattr(huffman, "BLOCK_IDS", 100)
    read = huffman.round_trip(untidy).select("doc_id", "start", F.expr("octet_length(ids) div 4 n_tokens"), F.crc32("ids").alias("ids_crc32"))
    docs = [(r.doc_id, r.text) for r in untidy.collect()]
    known = lambda x: (x[0] is not None, x[0] or 0, (x[1] or "") != "")
    check_ids(read.collect(), sorted(docs, key=known))
    assert huffman.round_trip(nothing).count() == 0


# ---- 10 personal data ----------------------------------------------------------
def plain_matches(text):
    patterns = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    )
    out = []
    for k, (kind, pattern) in enumerate(patterns):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def test_personal_data_query(spark, sf, texts):
    rows = {r.doc_id: r for r in queries.op10_personal_data(spark, sf).collect()}
    assert sorted(rows) == sorted(texts)
    for doc, text in texts.items():
        want = plain_matches(text)
        assert rows[doc].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        spans = [s for s in rows[doc].spans.split(",") if s]
        assert set(want) <= set(spans)
        kinds = Counter(s.split(":")[0] for s in spans)
        assert [rows[doc][f"n_{k}"] for k in pii.KINDS] == [kinds[k] for k in pii.KINDS]


def test_plain_search_is_the_patterns():
    rng = np.random.default_rng(6)
    for _ in range(20_000):
        text = "".join(rng.choice(list("a@.1 +-(2é.@b0")) for _ in range(rng.integers(0, 40)))
        found = [f"{k}:{a}:{b}" for k, a, b in sorted(pii.identifiers(text), key=lambda s: (s[1], pii.KINDS.index(s[0])))]
        assert found == plain_matches(text), text


@pytest.mark.parametrize(
    "text,kind,hidden",
    [
        ("mail john (at) example (dot) com now", "email", "john (at) example (dot) com"),
        ("mail j.doe [at] mail.example.com", "email", "j.doe [at] mail.example.com"),
        ("write jane at example dot com please", "email", "jane at example dot com"),
        ("call plus four nine one two three four five six seven eight nine", "phone", "plus four nine one two three four five six seven eight nine"),
        ("Jоhn@exаmple.com", "email", "Jоhn@exаmple.com"),
        ("４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"),
        ("ip one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
        ("jo​hn@ex​ample.com", "email", "jo​hn@ex​ample.com"),
    ],
)
def test_disguises(text, kind, hidden):
    assert (kind, hidden) in [(k, text[a:b]) for k, a, b, _ in pii.spans_of(text)]


@pytest.mark.parametrize("text", ["the at the of", "at home dot", "one of two at least", "dot dot dot at at", "Привет мир"])
def test_clean_texts_stay_clean(text):
    assert pii.spans_of(text) == []


@pytest.mark.parametrize("gap", ["-", ",", ", ", "\t", "\n", "\r\n", "\u00a0"])
def test_disguises_with_any_separator(gap):
    phone = "plus four nine one seven zero one two three four five six".replace(" ", gap)
    card = "four one one one one one one one one one one one one one one one".replace(" ", gap)
    ip = "one nine two dot one six eight dot one dot two".replace(" ", gap)
    for text, kind in ((phone, "phone"), (card, "card"), (ip, "ip")):
        whole = f"call {text}."
        assert pii.spans_of(whole) == [(kind, 5, 5 + len(text), False)]
        assert pii.spans_of(text) == [(kind, 0, len(text), False)]
        assert pii.redacted_text(whole) == f"call [{kind.upper()}]."


@pytest.mark.parametrize(
    "hidden", ["jane at example dot\ncom", "jane\tat\texample\tdot\tcom", "jane\n@\nexample.com", "jane@\nexample (dot) com"]
)
def test_signs_between_any_white_space(hidden):
    assert pii.spans_of(f"ask {hidden}") == [("email", 4, 4 + len(hidden), False)]


def test_a_text_without_a_sign_is_not_changed_by_any_transducer():
    """The check before rewriting is implied by each of the patterns that rewrite."""
    rng = np.random.default_rng(5)
    parts = ["dot", "AT", "@", "point", "(", "]", "[", ")", ".", "one", "Two", "drei", "x", "com", "más", " ", "\n", "\t", ",", "-"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts, rng.integers(3, 14)))
        if pii.disguised(text) is None:
            out = pii.Rewritten(text)
            out.replace(pii.spelled_digits(out.text))
            for sign, to in ((pii.AT_SIGN, "@"), (pii.DOT_SIGN, ".")):
                out.replace([(*m.span(), to) for m in sign.finditer(out.text)])
            assert not out.new.any() and out.text == text


@pytest.mark.parametrize("run", [" " * 10**6, "\t\n" * 500_000, "[ " * 500_000, " [" * 500_000, " at " * 250_000, "@ " * 500_000, "one " * 250_000, "dot" + " " * 10**6])
def test_long_runs_take_linear_time(run):
    text = f"jane [at] shop.com, {run}x (dot) y{run}"
    began = time.perf_counter()
    assert ("email", 0, len("jane [at] shop.com")) in [s[:3] for s in pii.spans_of(text)]
    assert time.perf_counter() - began < 15


def test_personal_data_of_untidy_rows(untidy, nothing):
    rows = pii.personal_data(untidy).collect()
    assert len(rows) == untidy.count()
    assert sum(len(r.spans) for r in rows if r.doc_id != 9) == 0
    out = pii.redacted(untidy, length_col="length")
    assert out.columns == untidy.columns
    nine = next(r for r in out.collect() if r.doc_id == 9)
    assert nine.text == "mail me at [EMAIL] or [PHONE] or [IP]" and nine.length == len(nine.text)
    assert pii.personal_data(nothing).count() == 0 and pii.redacted(nothing).count() == 0


# ---- pipeline ------------------------------------------------------------------
def test_pipeline(spark, sf, texts):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    calm = {d: t for d, t in texts.items() if toxicity.probability(toxicity.features(t, model), model) < 0.5}
    groups = brute_components(calm.items(), 5)
    first = {d: t for d, t in calm.items() if groups[d][1] == d}
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    leaky = {d for d, *_ in brute_contained(first.items(), items)}
    clean = [(d, pii.redacted_text(t)) for d, t in first.items() if d not in leaky]
    assert 0 < len(clean) < len(first) < len(calm)
    check_packing(corpus_pipeline.run(spark, sf).collect(), expected_pieces(clean))
    assert corpus_pipeline.ORACLE_SQL is None
    assert [f(spark, docs, sf).columns for _, f in corpus_pipeline.STAGES[:4]] == [docs.columns] * 4


def test_every_operator_is_registered():
    names = set(contract.queries())
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11))
