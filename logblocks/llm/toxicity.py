"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

1. Counts: for every labelled training document the set of hashed character n-grams; per bucket the
   number of toxic and of clean documents that have it. Tasks add up dense arrays, Spark sums them.
2. Ratio: r = log((toxic + 1) / (N_toxic + 2)) - log((clean + 1) / (N_clean + 2)). The ``FEATURES`` buckets
   whose counts differ most between the classes (likelihood ratio) become features.
3. Fit: logistic regression on r * presence over about ``FIT_ROWS`` training documents (those
   with the smallest id hashes; the bound is a parameter, kept by the hash threshold). Features of that
   sample are all that the driver gets.
4. Map: scores of texts that a fit has not seen are less extreme than those of its own rows. The sample is cut into ``CROSS`` parts; each is
   scored by a fit on the others, with ratios from counts without that part. A two-parameter logistic map from these scores to the
   labels, halfway between the sample's class shares and equal shares, is folded into the weights and the intercept.
5. Score: one pass over all whole texts, no shuffle: the sum of weight * r of the n-grams present.

A null text counts as empty and gets the bare intercept. Documents with several label rows count as toxic
if one row says so; null labels are left out. With only one class (or none) among the labels, every score is
that class's share, 0.5 without any. Repeated rows get equal scores. Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logblocks.llm.common import fold, whole
from logblocks.operators.staging import broadcast_if_small
from logblocks.shipping import ship

GRAMS = (4, 5, 6)
BITS = 20
FEATURES = 8_192
FIT_ROWS = 20_000
CHUNK = 1 << 20  # feature marks that a step of the fit works on at a time
HASHES = 1 << 30
THRESHOLD = 0.7
PENALTY = 10.0
CROSS = 3
BALANCE = 0.5  # 0: the sample's own class shares, 1: equal shares
STEP = np.uint64(0x9E3779B97F4A7C15)


def buckets(text: str | None) -> np.ndarray:
    """The hash buckets of a text's character n-grams, each once."""
    flat = f" {' '.join((text or '').lower().split())} "
    codes = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    found = []
    with np.errstate(over="ignore"):
        h = codes
        for n in range(2, max(GRAMS) + 1):
            h = (h[:-1] * STEP + codes[n - 1 :]) if len(codes) >= n else codes[:0]
            if n in GRAMS:
                mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * n)
                found.append((mixed >> np.uint64(64 - BITS)).astype(np.int32))
    seen = np.zeros(1 << BITS, bool) if len(flat) > 100_000 else None
    if seen is not None:  # a very long text: a bit per bucket instead of a sort
        for part in found:
            seen[part] = True
        return np.flatnonzero(seen).astype(np.int32)
    return np.unique(np.concatenate(found))


def _count(batches):
    counts = np.zeros((2, 1 << BITS), np.int64)
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            counts[toxic, buckets(text)] += 1
    at = np.flatnonzero(counts.any(axis=0))
    for a in range(0, len(at), 1 << 16):
        part = at[a : a + (1 << 16)]
        yield pa.RecordBatch.from_pydict({"bucket": part.astype(np.int32), "clean": counts[0, part], "toxic": counts[1, part]})


class Model:
    """Weights by bucket: ``weight[b]`` is the fitted weight times the bucket's ratio."""

    def __init__(self, at: np.ndarray, weight: np.ndarray, intercept: float):
        self.at, self.weight, self.intercept = at, weight, intercept
        self._dense = None

    def __getstate__(self):
        return {"at": self.at, "weight": self.weight, "intercept": self.intercept, "_dense": None}

    def score(self, text: str | None) -> float:
        if self._dense is None:
            self._dense = np.zeros(1 << BITS)
            self._dense[self.at] = self.weight
        z = self.intercept + self._dense[buckets(text)].sum()
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def _chunks(rows: list[np.ndarray]):
    """Runs of rows with about ``CHUNK`` marks together: (first row, last row, marks, start of each row)."""
    ends = np.cumsum([len(r) for r in rows])
    a = 0
    while a < len(rows):
        seen = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, seen + CHUNK, "right")))
        sizes = np.array([len(r) for r in rows[a:b]])
        yield a, b, np.concatenate(rows[a:b]), sizes
        a = b


def _row_sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sum over each row's run of ``values``; rows may be empty."""
    out, some = np.zeros(len(sizes)), sizes > 0
    if some.any():
        out[some] = np.add.reduceat(values, (np.cumsum(sizes) - sizes)[some])
    return out


def fit_logistic(rows: list[np.ndarray], ratio: np.ndarray, label: np.ndarray, l2: float = PENALTY, rounds: int = 300):
    """Weights and intercept of a logistic regression on ratio * presence, by accelerated gradient steps.

    Only the marks of the features present are held whole; all that a step derives from them is a chunk long.
    """
    n = len(rows)
    parts = list(_chunks(rows))
    # Diagonal majorizer: the Hessian of the mean loss is at most that of sum |x_ij| * |x_i|, feature by feature,
    # so a few very long documents slow down their own features only.
    size = np.abs(ratio)
    pulled, length = np.zeros(len(ratio)), np.ones(n)
    for a, b, cols, sizes in parts:
        length[a:b] += _row_sums(size[cols], sizes)
        pulled += np.bincount(cols, np.repeat(length[a:b], sizes), len(ratio))
    curve = 0.25 * size * pulled / max(n, 1) + l2 / max(n, 1)
    curve_b = 0.25 * length.sum() / max(n, 1) + 1e-9
    w, bias = np.zeros(len(ratio)), 0.0
    w_old, bias_old = w, bias
    for k in range(rounds):
        pull = k / (k + 3)
        v, c = w + pull * (w - w_old), bias + pull * (bias - bias_old)
        weight, slope, gaps = v * ratio, np.zeros(len(ratio)), 0.0
        for a, b, cols, sizes in parts:
            z = c + _row_sums(weight[cols], sizes)
            gap = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - label[a:b]
            slope += np.bincount(cols, np.repeat(gap, sizes), len(ratio))
            gaps += gap.sum()
        w_old, bias_old = w, bias
        w = v - (slope * ratio / n + l2 / n * v) / curve
        bias = c - gaps / n / curve_b
    return w, bias


def log_ratio(clean, toxic, all_clean: int, all_toxic: int):
    return np.log((toxic + 1) / (all_toxic + 2)) - np.log((clean + 1) / (all_clean + 2))


def unseen_scores(rows: list[np.ndarray], label: np.ndarray, clean: np.ndarray, toxic: np.ndarray, sizes: tuple[int, int], parts: int = CROSS):
    """Linear scores of the sample's rows, each from a fit without its part; ``clean`` and ``toxic`` count all training rows."""
    found, part = np.zeros(len(rows)), np.arange(len(rows)) % parts
    for k in range(parts):
        out, kept = np.flatnonzero(part == k), np.flatnonzero(part != k)
        if not len(out) or not len(kept):
            continue
        counts, totals = [clean.copy(), toxic.copy()], list(sizes)
        for i in out:
            counts[int(label[i])][rows[i]] -= 1
            totals[int(label[i])] -= 1
        ratio = log_ratio(*counts, *totals)
        weight, bias = fit_logistic([rows[i] for i in kept], ratio, label[kept])
        weight = weight * ratio
        found[out] = [bias + weight[rows[i]].sum() for i in out]
    return found


def fit_map(score: np.ndarray, label: np.ndarray, balance: float = BALANCE) -> tuple[float, float]:
    """Slope and offset of the logistic map from scores to labels; the identity if a class is missing or the map would turn scores round."""
    ones, zeros = label.sum(), (1 - label).sum()
    if not ones or not zeros:
        return 1.0, 0.0
    target = np.where(label == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))  # never quite 0 or 1
    x, at = np.stack([score, np.ones(len(score))], axis=1), np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -500, 500)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - target))
        at = at - step
        if np.abs(step).max() < 1e-9:
            break
    slope, offset = at
    return (float(slope), float(offset + balance * np.log(zeros / ones))) if slope > 0 and np.isfinite(at).all() else (1.0, 0.0)


def train(rows: DataFrame, features: int = FEATURES, fit_rows: int = FIT_ROWS) -> Model:
    """A model from ``(doc_id, text, toxic)`` rows."""
    ship(rows.sparkSession)
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not clean or not toxic:
        share = (toxic + 0.5) / (clean + toxic + 1)
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(share / (1 - share))))
    counted = rows.select("text", "toxic").mapInArrow(_count, "bucket int, clean long, toxic long")
    counted = counted.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    part = lambda seen, n: F.when(seen > 0, seen * F.log(seen / ((F.col("toxic") + F.col("clean")) * (n / (toxic + clean))))).otherwise(0.0)
    gain = part(F.col("toxic"), toxic) + part(F.col("clean"), clean)
    top = counted.select("bucket", "clean", "toxic", gain.alias("gain")).orderBy(F.desc("gain"), "bucket").limit(features)
    top = top.toPandas().sort_values("bucket")
    at, seen = top["bucket"].to_numpy(), (top["clean"].to_numpy(), top["toxic"].to_numpy())
    ratio = log_ratio(*seen, clean, toxic)
    place = np.full(1 << BITS, -1, np.int32)
    place[at] = np.arange(len(at))
    kind = np.dtype("<u2" if len(at) <= 1 << 16 else "<i4")

    def featurise(batches):
        for batch in batches:
            found = [place[buckets(t)] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"toxic": batch.column("toxic"), "cols": [f[f >= 0].astype(kind).tobytes() for f in found]})

    share = min(1.0, fit_rows / (clean + toxic))
    sample = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(HASHES)) < int(share * HASHES))
    fitted = sample.select("text", "toxic").mapInArrow(featurise, "toxic int, cols binary").toArrow()
    label = fitted.column("toxic").to_numpy().astype(float)
    cols = [np.frombuffer(c.as_buffer(), kind) for c in fitted.column("cols")]
    w, b = fit_logistic(cols, ratio, label)
    slope, offset = fit_map(unseen_scores(cols, label, *seen, (clean, toxic)), label)
    return Model(at, slope * w * ratio, slope * b + offset)


def scorer(model: Model):
    """A Pandas UDF: text to the probability of label 1."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return score


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; fold ``held`` of the ids teaches nothing."""
    held_out = fold(F.col("doc_id"), folds) == held
    marks = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    rows = docs.where(~held_out).select("doc_id", "text").join(broadcast_if_small(marks), "doc_id")
    score = scorer(train(rows))(whole(F.col("text")))
    return docs.select("doc_id", held_out.alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
