"""Toxicity by maximum-scoring segments over token log-odds.

Learning (training labels only):
1. a bounded sample of TRAIN_DOCS labelled documents, in the order of a digest of their ids; near copies among them
   (the same bottom hash over their word trigrams) count once, so one text copied a thousand times teaches one document;
2. document frequencies of words and word prefixes in either class, and their log-odds with a Dirichlet prior whose
   mean is the feature's frequency in both classes together; features with a small effect or a small z-score go;
3. the background of clean documents gives the extreme-value parameters: lambda solves E[exp(lambda * s)] = 1 over
   the token scores, K follows from the mean largest segment of clean documents of n tokens;
4. a logistic curve from a document's segments to a probability. Training documents are scored with their own counts
   taken out, so the curve is fitted to honest scores.

Scoring: each token has the log-odds of its most specific known feature (the word, else its longest known prefix) less
a small drift, so clean text runs downhill. A linear-time scan finds every maximal segment; the significant ones
(lambda * S > ln(K n)) are the toxic passages, and their normalised scores give the document's score.

Defined cases: null text counts as empty, and empty texts score as documents without segments; labels that are null
don't teach; with no positive or no negative training document every score is 0; repeated rows are scored each; extra
columns are ignored; a doc_id that has several labels teaches with each.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from uuid import uuid4
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baitline.llm.common import OnBatches, checkpointed, kept, short_batches, text_or_empty
from baitline.llm.tokens import Words

TRAIN_DOCS = 12_000
PRIOR = 0.05  # mass of the Dirichlet prior, in training documents as a share of all of them
LEAST_EFFECT, LEAST_Z = 2.5, 2.2
DRIFT = 0.1
PREFIXES = (4, 5, 6)
THRESHOLD = 0.7
_WORDS = re.compile(r"[^\W\d_]+").findall


def words_of(text: str) -> list[str]:
    return _WORDS(text.lower())


def features_of(words: list[str]) -> set[str]:
    """Words, and prefixes marked by a star."""
    distinct = set(words)
    return distinct | {w[:n] + "*" for w in distinct for n in PREFIXES if len(w) > n}


def log_odds(toxic: float, clean: float, n_toxic: float, n_clean: float) -> tuple[float, float]:
    """(log-odds, z-score) of a feature that toxic of n_toxic and clean of n_clean documents hold."""
    both = (toxic + clean) / (n_toxic + n_clean)
    mass = PRIOR * (n_toxic + n_clean)
    prior = mass * both
    if prior <= 0:
        return 0.0, 0.0
    odds = lambda y, n: math.log((y + prior) / (n + mass - y - prior))
    delta = odds(toxic, n_toxic) - odds(clean, n_clean) if both < 1 else 0.0
    return delta, delta / math.sqrt(1 / (toxic + prior) + 1 / (clean + prior))


def weight(toxic: float, clean: float, n_toxic: float, n_clean: float) -> float | None:
    """A feature's token score, None where the evidence is too thin."""
    if n_toxic < 1 or n_clean < 1:
        return None
    delta, z = log_odds(toxic, clean, n_toxic, n_clean)
    return delta if abs(delta) >= LEAST_EFFECT and abs(z) >= LEAST_Z else None


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), disjoint, in order: one pass, each score looked at once.

    The stack holds candidate segments with the running totals before and after them; a new positive score is merged
    leftward as long as that raises its total above all between.
    """
    total = np.concatenate(([0.0], np.cumsum(scores)))
    stack: list[list] = []  # [start, end, before, after, index of the nearest earlier candidate with a smaller before]
    for i in np.flatnonzero(scores > 0).tolist():
        new = [i, i + 1, total[i], total[i + 1], -1]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= new[2]:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= new[3]:
                new[4] = j
                stack.append(new)
                break
            new[0], new[2] = stack[j][0], stack[j][2]
            del stack[j:]
    return [(s, e, float(b - a)) for s, e, a, b, _ in stack]


@dataclass
class Model:
    """Feature counts and the fitted constants; small, as the training sample is bounded."""

    n_toxic: float = 0
    n_clean: float = 0
    counts: dict[str, tuple[float, float]] = field(default_factory=dict)
    lam: float = 1.0
    log_k: float = 0.0
    curve: tuple[float, ...] | None = None

    def feature(self, word: str, own: int | None = None) -> float:
        """The score of a word; own: the label of the document it stands in, whose count is taken out."""
        for name in (word, *(word[:n] + "*" for n in reversed(PREFIXES) if len(word) > n)):
            if (seen := self.counts.get(name)) is not None:
                toxic, clean = seen
                if own is not None:
                    toxic, clean = (toxic - 1, clean) if own else (toxic, clean - 1)
                found = weight(toxic, clean, self.n_toxic - (own == 1), self.n_clean - (own == 0))
                if found is not None:
                    return found - DRIFT
        return -DRIFT

    def segments(self, scores: np.ndarray) -> list[tuple[int, int, float]]:
        """Maximal segments with normalised scores lambda * S - ln(K n); above 0: significant."""
        base = self.log_k + math.log(max(len(scores), 1))
        return [(s, e, self.lam * x - base) for s, e, x in maximal_segments(scores)]

    def evidence(self, scores: np.ndarray) -> tuple[float, float, float]:
        """(largest normalised score, sum of the significant ones, raw sum of positive segments), on log scales."""
        found = [x for *_, x in self.segments(scores)] if len(scores) else []
        raw = sum(x for *_, x in maximal_segments(scores)) if len(scores) else 0.0
        return max(-10.0, min(30.0, max(found, default=-10.0))), math.log1p(sum(x for x in found if x > 0)), math.log1p(raw)

    def probability(self, scores: np.ndarray) -> float:
        if self.curve is None:
            return 0.0
        x = self.curve[0] + sum(a * b for a, b in zip(self.curve[1:], self.evidence(scores)))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sketch, found = [], []
        for text in batch.column(0).to_pylist():
            words = words_of(text)
            sketch.append(min((crc32(" ".join(w).encode()) for w in zip(words, words[1:], words[2:])), default=crc32(" ".join(words).encode())))
            found.append(words)
        yield pa.RecordBatch.from_arrays([pa.array(sketch, pa.int64()), batch.column(1), pa.array(found, pa.list_(pa.string())), batch.column(2)], names=["sketch", "toxic", "words", "doc_id"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, list[int]] = {}
        for words, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for name in features_of(words):
                counts.setdefault(name, [0, 0])[0 if toxic else 1] += 1
        yield pa.RecordBatch.from_arrays([pa.array([*counts], pa.string()), pa.array([a for a, _ in counts.values()], pa.int64()), pa.array([b for _, b in counts.values()], pa.int64())], names=["feature", "t", "c"])


def _honest(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Per training document: label, tokens, largest raw segment, evidence, and a histogram of its token scores."""
    for batch in batches:
        rows = []
        for words, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            cache = Words({}, lambda w, own=int(toxic): model.feature(w, own))
            scores = np.array([cache[w] for w in words])
            best = max((x for *_, x in maximal_segments(scores)), default=0.0) if len(words) else 0.0
            mgf = [float(np.exp(lam * scores).mean()) if len(words) else 1.0 for lam in LAMBDAS]
            rows.append((int(toxic), len(words), best, *model.evidence(scores), mgf))
        label, n, best, a, b, c, mgf = zip(*rows) if rows else ([],) * 7
        yield pa.RecordBatch.from_arrays(
            [pa.array(label, pa.int32()), pa.array(n, pa.int64()), *(pa.array(x, pa.float64()) for x in (best, a, b, c)), pa.array(mgf, pa.list_(pa.float64()))],
            names=["toxic", "n", "best", "a", "b", "c", "mgf"],
        )


#: Candidate values of lambda, at which the moment generating function of clean token scores is summed up.
LAMBDAS = [0.25 * i for i in range(1, 17)]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 200) -> np.ndarray:
    """Weights (intercept first) by Newton's method with a ridge and bounded steps, so separable data stay finite."""
    x = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-3] + [ridge] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_docs: int = TRAIN_DOCS) -> Model:
    """Learns from labels(id_col, label_col) of documents whose crc32(id) mod 3 is not 1, at most train_docs of them."""
    short_batches(docs.sparkSession)
    key = F.col(id_col).cast("string")
    chosen = (
        labels.where(F.col(label_col).isNotNull() & key.isNotNull() & (F.crc32(key.cast("binary")) % 3 != 1))
        .select(F.col(id_col).cast("long").alias("doc_id"), (F.col(label_col) > 0).cast("int").alias("toxic"))
        .orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id", "toxic")
        .limit(train_docs)
    )
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic", "doc_id")
    read = rows.mapInArrow(_training, "sketch long, toxic int, words array<string>, doc_id long")
    train = checkpointed(read.groupBy("sketch", "toxic").agg(F.min_by("words", "doc_id").alias("words")).select("words", "toxic"))
    sizes = dict(train.groupBy("toxic").count().collect())
    model = Model(float(sizes.get(1, 0)), float(sizes.get(0, 0)))
    if not model.n_toxic or not model.n_clean:
        return model
    counted = train.mapInArrow(_features, "feature string, t long, c long").groupBy("feature").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    t, c = F.col("t"), F.col("c")
    mass = PRIOR * (model.n_toxic + model.n_clean)
    prior = F.lit(PRIOR) * (t + c)
    odds = lambda y, n: F.log((y + prior) / (F.lit(n + mass) - y - prior))
    delta = odds(t, model.n_toxic) - odds(c, model.n_clean)
    strong = counted.where((t + c < model.n_toxic + model.n_clean) & (F.abs(delta) >= LEAST_EFFECT) & (F.abs(delta) / F.sqrt(1 / (t + prior) + 1 / (c + prior)) >= LEAST_Z))
    model.counts = {r.feature: (float(r.t), float(r.c)) for r in strong.toLocalIterator()}
    honest = lambda: train.mapInArrow(OnBatches(_honest, model), "toxic int, n long, best double, a double, b double, c double, mgf array<double>").toPandas()
    found = honest()
    clean = found[(found.toxic == 0) & (found.n > 0)]
    if len(clean):
        mean = np.average(np.array(clean.mgf.tolist()), axis=0, weights=clean.n)
        above = np.flatnonzero(mean >= 1)
        model.lam = LAMBDAS[above[0]] if len(above) else LAMBDAS[-1]
        model.lam = min(model.lam, 1.0)  # log-odds have lambda 1 in theory; thin data must not exceed it
        # Gumbel: E[lambda * max - ln n] = ln K + 0.5772
        model.log_k = float((model.lam * clean.best - np.log(clean.n)).clip(-6, 6).mean()) - 0.5772
    found = honest()
    model.curve = tuple(map(float, logistic(found[["a", "b", "c"]].to_numpy(), found.toxic.to_numpy(float))))
    return model


def _score(batches: Iterator[pa.RecordBatch], key: str, given: Broadcast, passages: bool) -> Iterator[pa.RecordBatch]:
    model, cache = kept(key, lambda: (given.value, Words({}, given.value.feature)))
    look = cache.__getitem__
    for batch in batches:
        out, spans = [], []
        for text in batch.column(1).to_pylist():
            scores = np.fromiter(map(look, words_of(text)), np.float64)
            out.append(model.probability(scores))
            if passages:
                spans.append([{"start": s, "end": e, "score": x} for s, e, x in model.segments(scores) if x > 0])
        columns = [batch.column(0), pa.array(out, pa.float64())]
        if passages:
            columns.append(pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))))
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "passages"][: len(columns)])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", passages: bool = False) -> DataFrame:
    """doc_id, score and, if asked for, the significant passages (word offsets) of every row of docs."""
    spark = docs.sparkSession
    short_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    schema = "doc_id long, score double" + ", passages array<struct<start:int,end:int,score:double>>" * passages
    return rows.mapInArrow(OnBatches(_score, uuid4().hex, spark.sparkContext.broadcast(model), passages), schema)


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score, predicted, passages for every row of docs."""
    scored = score(docs, fit(docs, labels, **options), passages=True)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "passages")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs without the rows that are predicted toxic; same columns. The score goes by a row's text alone.

    Null and empty texts stay, as do repeated rows of a clean text; without a toxic or without a clean label to learn
    from all rows stay; an empty table stays empty; other columns, whatever their names, are carried along.
    """
    model = fit(docs, labels, id_col, text_col, **options)
    given = docs.sparkSession.sparkContext.broadcast(model)
    at = [c.lower() for c in docs.columns].index(text_col.lower())
    return docs.mapInArrow(OnBatches(_mark, uuid4().hex, given, at), docs.schema)


def _mark(batches: Iterator[pa.RecordBatch], key: str, given: Broadcast, at: int) -> Iterator[pa.RecordBatch]:
    model, cache = kept(key, lambda: (given.value, Words({}, given.value.feature)))
    look = cache.__getitem__
    for batch in batches:
        stay = [model.probability(np.fromiter(map(look, words_of(t or "")), np.float64)) < THRESHOLD for t in batch.column(at).to_pylist()]
        yield batch.filter(pa.array(stay, pa.bool_()))
