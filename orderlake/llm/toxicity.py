"""Toxic passages by maximum-scoring segments of token log-odds.

A token's score is the log-odds that toxic and not clean texts hold it, under an informative
Dirichlet prior (its share of all texts), less a drift. A token without a significant score
of its own has that of its longest beginning that has one, so inflected and compound forms
count. All maximal-scoring segments of a text come from one linear scan. The score of a
text's best segment follows an extreme-value law in clean texts, P(M > x) = 1 - exp(-K n
exp(-lambda x)); K and lambda are fitted to the best segments of clean texts. The best
segment's surprise, -ln P, and the number of significant segments give a probability by a
logistic fit on labelled texts that the token scores have not seen.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import column, crc_mod, prepare, texts_of, tidied

WORD = re.compile(r"\w+")
# Labelled texts that the model is fitted on at most: those with the smallest hashes of ids.
MOST_LABELLED = 20_000
# Weight of the prior in texts, least z-score of a token that counts, loss for each token.
PRIOR, SIGNIFICANT, DRIFT = 100.0, 3.0, 0.1
BEGINNINGS = (8, 7, 6, 5, 4)
REMEMBERED = 400_000


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    decay: float = 1.0
    scale: float = 1.0
    fit: tuple[float, float, float] | None = None
    known: dict[str, float] = field(default_factory=dict)

    def __getstate__(self):
        return {**self.__dict__, "known": {}}

    def scores(self, tokens: list[str]) -> list[float]:
        """The log-odds of each token; 0 for one that is not significant."""
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for token in set(tokens).difference(known):
            known[token] = next((self.weights[p] for p in pieces(token) if p in self.weights), 0.0)
        return list(map(known.__getitem__, tokens))


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def pieces(word: str) -> list[str]:
    """A word and its beginnings, the longest first; ``~`` marks a beginning."""
    return [word, *(word[:n] + "~" for n in BEGINNINGS if len(word) > n)]


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score) of a sequence, left to right.

    Linear: a list of candidate segments, each joined to the nearest earlier one from which
    it can be reached at a gain.
    """
    if not len(scores):
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    up = scores > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], up, [False]]).astype(np.int8)))
    found: list[tuple[int, int, float, float, int]] = []
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        start, left, right = a, total[a], total[b]
        j = len(found) - 1
        while True:
            # The last candidate whose left sum is below this one's.
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= right:
                found.append((start, b, left, right, j))
                break
            start, left = found[j][0], found[j][2]
            del found[j:]
            j = len(found) - 1
    return [(a, b, float(r - x)) for a, b, x, r, _ in found]


def segments(text: str, model: Model) -> tuple[int, list[tuple[int, int, float]]]:
    """Number of tokens, and the maximal segments in tokens."""
    tokens = words(text)
    if not tokens or not model.weights:
        return len(tokens), []
    scores = np.array(model.scores(tokens))
    return len(tokens), maximal_segments(scores - DRIFT) if scores.max() > DRIFT else []


def evidence(n: int, scores: list[float], model: Model) -> tuple[float, float, list[float]]:
    """-ln P of the best segment in clean texts of n tokens, ln(1 + significant segments),
    and each segment's excess over what such texts are expected to hold."""
    if not scores:
        return 0.0, 0.0, []
    excess = [model.decay * s - float(np.log(max(model.scale * n, 1e-9))) for s in scores]
    chance = -np.expm1(-np.exp(-np.clip(max(excess), -30, 30)))
    return float(-np.log(max(chance, 1e-13))), float(np.log1p(sum(e > 0 for e in excess))), excess


def features(text: str, model: Model) -> tuple[float, float]:
    n, found = segments(text, model)
    return evidence(n, [s for _, _, s in found], model)[:2]


def extreme_value_fit(lengths: np.ndarray, best: np.ndarray) -> tuple[float, float]:
    """(lambda, K) of the most likely law for clean texts' best segments; a best segment of
    0 says only that there was none."""
    some = best > 0
    if not some.any():
        return 1.0, 1.0 / max(lengths.sum(), 1)
    found = []
    for decay in np.geomspace(0.02, 5, 200):
        scale = some.sum() / (lengths * np.exp(-decay * best)).sum()
        value = some.sum() * np.log(scale * decay) - decay * best[some].sum() - some.sum()
        found.append((value, decay, scale))
    _, decay, scale = max(found)
    return float(decay), float(scale)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    """Weights of a logistic regression with intercept, by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w.tolist())


def probability(x: tuple[float, float], model: Model) -> float:
    if model.fit is None:
        return 0.0
    z = model.fit[0] + model.fit[1] * x[0] + model.fit[2] * x[1]
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def labelled_texts(docs: DataFrame, labels: DataFrame, most: int, id_col: str, text_col: str) -> DataFrame:
    """(label, half, text) of at most ``most`` labelled documents outside the held-out fifth.

    Rows with a null id or label are left out. An id labelled more than once has its
    highest label.
    """
    known = (
        labels.select(F.col(id_col).cast("long").alias("_id"), F.col("toxic").cast("int").alias("_label"))
        .dropna()
        .where(crc_mod(F.col("_id"), 5) != 0)
        .groupBy("_id")
        .agg(F.max("_label").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(most)
    )
    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text"))
    # At most ``most`` pairs of numbers.
    return source.join(F.broadcast(known), "_id").select(
        F.col("_label").alias("label"), F.shiftrightunsigned(F.xxhash64("_id"), 5).bitwiseAND(F.lit(1)).cast("int").alias("half"), "text"
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    most: int = MOST_LABELLED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model:
    """A model from a bounded sample of labelled rows; without both labels it scores 0."""
    prepare(docs.sparkSession)
    sample = labelled_texts(docs, labels, most, id_col, text_col)

    texts = dict(sample.where("half = 0").groupBy((F.col("label") > 0).alias("toxic")).count().collect())
    n1, n0 = texts.get(True, 0), texts.get(False, 0)
    if not n1 or not n0:
        return Model()

    @tidied
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for label, half, text in zip(column(batch, "label"), column(batch, "half"), texts_of(batch)):
                if half == 0:
                    counts[int(label > 0)].update({p for w in set(words(text)) for p in pieces(w)})
        for label, seen in enumerate(counts):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(seen), pa.string()),
                    pa.array(np.full(len(seen), label, np.int32)),
                    pa.array(list(seen.values()), pa.int64()),
                ],
                ["piece", "label", "n"],
            )

    of = lambda label: F.sum(F.when(F.col("label") == label, F.col("n")).otherwise(0))
    prior = PRIOR * (F.col("toxic") + F.col("clean")) / (n1 + n0)
    y1, y0 = F.col("toxic") + prior, F.col("clean") + prior
    ratio = F.log(y1 / (n1 + PRIOR - y1 + 0.5)) - F.log(y0 / (n0 + PRIOR - y0 + 0.5))
    # The significant pieces of a bounded sample.
    rows = (
        sample.mapInArrow(count, "piece string, label int, n long")
        .groupBy("piece").agg(of(1).alias("toxic"), of(0).alias("clean"))
        .select("piece", ratio.alias("ratio"), (ratio / F.sqrt(1 / y1 + 1 / y0)).alias("z"))
        .where(F.abs("z") >= SIGNIFICANT)
        .select("piece", "ratio")
        .collect()
    )
    model = Model({r["piece"]: r["ratio"] for r in rows})

    @tidied
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for label, half, text in zip(column(batch, "label"), column(batch, "half"), texts_of(batch)):
                if half == 1:
                    n, found = segments(text, model)
                    rows.append((label, n, [s for _, _, s in found]))
            cols = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.list_(pa.float64()))],
                ["label", "n", "scores"],
            )

    seen = sample.mapInArrow(measure, "label int, n long, scores array<double>").collect()
    calm = [(r["n"], max(r["scores"], default=0.0)) for r in seen if r["label"] == 0 and r["n"]]
    if not calm:
        return model
    model.decay, model.scale = extreme_value_fit(*np.array(calm, float).T)
    table = np.array([(*evidence(r["n"], r["scores"], model)[:2], r["label"] > 0) for r in seen], float)
    if 0 < table[:, 2].sum() < len(table):
        model.fit = logistic(table[:, :2], table[:, 2])
    return model


def scored(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, passages) of each row; passages: (start, end, score) in tokens of the
    segments that exceed what clean texts of that length hold.

    A null text counts as an empty one, which is scored like a text without a segment; null
    ids stay null and repeated rows are scored one by one.
    """
    prepare(docs.sparkSession)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    @tidied
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, passages = [], []
            for text in texts_of(batch):
                n, found = segments(text, model)
                *x, excess = evidence(n, [s for _, _, s in found], model)
                scores.append(probability(x, model))
                passages.append(
                    [{"start": a, "end": b, "score": e} for (a, b, _), e in zip(found, excess) if e > 0]
                )
            ids = pa.array(column(batch, "id"), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(scores, pa.float64()), pa.array(passages, kind)], ["doc_id", "score", "passages"]
            )

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(
        score, "doc_id long, score double, passages array<struct<start:int,end:int,score:double>>"
    )


def accepted(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows whose text scores below the threshold; all columns stay."""
    prepare(docs.sparkSession)
    at = docs.schema.names.index(text_col)

    @tidied
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (t or "" for t in batch.column(at).to_pylist())
            calm = [probability(features(t, model), model) < threshold for t in texts]
            yield batch.filter(pa.array(calm, pa.bool_()))
        model.known.clear()

    return docs.mapInArrow(keep, docs.schema)
