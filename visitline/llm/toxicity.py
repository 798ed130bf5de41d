"""Toxicity scores by a factorization machine over hashed terms.

A text's features are its distinct words and their first four to six letters, hashed.
The machine scores ``w0 + sum w_i + sum_{i<j} <v_i, v_j>`` over the text's features, so it
learns pairs (an insult together with the mention of a group) that no sum of single
weights can tell from the two alone.

Training: a seeded draw of at most ``SAMPLE`` labels that are not held out, then of as many rows with these ids
(about ``PER_ID`` of one id at most, equal rows once), goes to one task. It keeps the features whose rate differs between the
labels and, among the ``PAIR_FEATURES`` most frequent, those of which a pair's rate differs from what its members' rates
say, even where each alone tells nothing; then it fits the machine with AdaGrad. The model (about 1 MB at
most, ``MAX_FEATURES``) goes to all tasks. Every whole text is then scored in one narrow pass.

Edge cases: null and empty texts have no feature and score the model's bias; a null label or
a label other than 0 and 1 is no label; without labels of both kinds the score is the label
rate, or 0; a null doc_id is never held out and has no label; a document with several labels
counts with each; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitline.llm.common import as_rows, hash_limit, is_empty, only, stored

#: Labels, and then rows, that the machine is fitted on, at most; rows of one id, at most about.
SAMPLE, PER_ID = 12_000, 16
BITS, FACTORS, MAX_FEATURES = 20, 8, 16_384
#: Pairs are looked for among so many features, the most frequent; standard deviations from which a feature, or a pair, is kept.
PAIR_FEATURES, PAIRLESS, PAIRED = 4096, 4, 7
EPOCHS, RATE, DECAY, SEED = 40, 0.1, 1e-4, 7
THRESHOLD = 0.7
_WORD = re.compile(r"[^\W\d_]+")
_CACHE = 500_000


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def word_features(word: str) -> list[int]:
    keys = ["w" + word, *("p" + word[:n] for n in (4, 5, 6) if len(word) > n)]
    return [xxhash.xxh3_64_intdigest(k) & ((1 << BITS) - 1) for k in keys]


def text_features(text: str | None, known: dict[str, list[int]]) -> np.ndarray:
    """Distinct hashed features of a whole text; ``known`` caches words."""
    got: set[int] = set()
    for w in set(_WORD.findall((text or "").lower())):
        ids = known.get(w)
        if ids is None:
            if len(known) >= _CACHE:
                known.clear()
            ids = known[w] = word_features(w)
        got.update(ids)
    return np.fromiter(got, np.uint32, len(got))


def pair_signal(rows: np.ndarray, ids: np.ndarray, y: np.ndarray, often: np.ndarray) -> np.ndarray:
    """For each of the features ``often``, how far the labels of some pair that it is in are from what its members say alone.

    In standard deviations: the positive rate of the rows that hold both, against the sum of both rates less the base rate.
    """
    slot = np.full(1 << BITS, -1, np.int64)
    slot[often] = np.arange(len(often))
    on = slot[ids] >= 0
    rows, cols = rows[on], slot[ids[on]]
    m, rate = len(often), float(y.mean())
    both, positive = np.zeros((m, m), np.float32), np.zeros((m, m), np.float32)
    for at in range(0, len(y), 1024):
        i, j = np.searchsorted(rows, [at, at + 1024])
        x = np.zeros((min(1024, len(y) - at), m), np.float32)
        x[rows[i:j] - at, cols[i:j]] = 1
        both += x.T @ x
        hit = x[y[at : at + 1024] > 0]
        positive += hit.T @ hit
    alone = np.diagonal(positive) / np.maximum(np.diagonal(both), 1)
    out = np.zeros(m)
    for i in range(m):
        n = both[i]
        gap = np.abs(positive[i] - n * np.clip(alone[i] + alone - rate, 0, 1)) / np.sqrt(np.maximum(n, 1) * rate * (1 - rate))
        gap[(n < 3) | (n == both[i, i]) | (n == np.diagonal(both))] = 0  # always together: not a pair
        out[i] = gap.max(initial=0)
    return out


def fit(features: list[np.ndarray], labels: np.ndarray) -> dict:
    """The machine: kept feature ids, bias, weights and factors."""
    y = np.asarray(labels, float)
    n, n1 = len(y), float(y.sum())
    rate = n1 / n if n else 0.0
    model = {"ids": np.zeros(0, np.uint32), "w0": 0.0, "w": np.zeros(0, np.float32), "v": np.zeros((0, FACTORS), np.float32), "rate": rate}
    if not 0 < rate < 1:
        return model | {"w0": None}
    rows = np.repeat(np.arange(n), [len(f) for f in features])
    ids = np.concatenate(features).astype(np.int64)
    all_ = np.bincount(ids, minlength=1 << BITS).astype(float)
    pos = np.bincount(ids, weights=y[rows], minlength=1 << BITS)
    # Screening: features in at least 3 rows whose positive rate is far from the base rate, or that have it only together.
    z = np.abs(pos - all_ * rate) / np.sqrt(np.maximum(all_, 1) * rate * (1 - rate))
    often = np.argsort(-all_, kind="stable")[:PAIR_FEATURES]
    often = np.sort(often[all_[often] >= 3])
    z[often] = np.maximum(z[often], pair_signal(rows, ids, y, often) * PAIRLESS / PAIRED)
    keep = np.flatnonzero((all_ >= 3) & (z >= PAIRLESS))
    keep = np.sort(keep[np.argsort(-z[keep], kind="stable")[:MAX_FEATURES]])
    slot = np.full(1 << BITS, -1, np.int64)
    slot[keep] = np.arange(len(keep))
    on = slot[ids] >= 0
    rows, cols = rows[on], slot[ids[on]]
    starts = np.searchsorted(rows, np.arange(n + 1))
    rng = np.random.default_rng(SEED)
    m = len(keep)
    w0, w = float(np.log(rate / (1 - rate))), np.zeros(m)
    v = rng.normal(0, 0.05, (m, FACTORS))
    g0, gw, gv = 1e-8, np.full(m, 1e-8), np.full((m, FACTORS), 1e-8)
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for at in range(0, n, 256):
            batch = order[at : at + 256]
            sizes = starts[batch + 1] - starts[batch]
            local = np.repeat(np.arange(len(batch)), sizes)
            take = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts[batch], sizes)
            c = cols[take]
            vc = v[c]
            s = np.zeros((len(batch), FACTORS))
            sq = np.zeros((len(batch), FACTORS))
            lin = np.bincount(local, weights=w[c], minlength=len(batch))
            for f in range(FACTORS):
                s[:, f] = np.bincount(local, weights=vc[:, f], minlength=len(batch))
                sq[:, f] = np.bincount(local, weights=vc[:, f] ** 2, minlength=len(batch))
            z_ = w0 + lin + 0.5 * (s * s - sq).sum(1)
            err = (1 / (1 + np.exp(-np.clip(z_, -30, 30))) - y[batch]) / len(batch)
            e0 = err.sum()
            ew = np.bincount(c, weights=err[local], minlength=m) + DECAY * w / len(batch)
            g0 += e0 * e0
            gw += ew * ew
            w0 -= RATE * e0 / np.sqrt(g0)
            inner = err[local][:, None] * (s[local] - vc)
            for f in range(FACTORS):
                ev = np.bincount(c, weights=inner[:, f], minlength=m) + DECAY * v[:, f] / len(batch)
                gv[:, f] += ev * ev
                v[:, f] -= RATE * ev / np.sqrt(gv[:, f])
            w -= RATE * ew / np.sqrt(gw)
    return model | {"ids": keep.astype(np.uint32), "w0": w0, "w": w.astype(np.float32), "v": v.astype(np.float32)}


class Scorer:
    """Scores texts with a fitted machine; one per task."""

    def __init__(self, model: dict):
        self.model = model
        self.slot = np.full(1 << BITS, -1, np.int32)
        self.slot[model["ids"]] = np.arange(len(model["ids"]))
        self.known: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str | None) -> float:
        m = self.model
        if m["w0"] is None:
            return float(m["rate"])
        on: set[int] = set()
        for w in set(_WORD.findall((text or "").lower())):
            ids = self.known.get(w)
            if ids is None:
                if len(self.known) >= _CACHE:
                    self.known.clear()
                ids = self.known[w] = tuple(int(self.slot[i]) for i in word_features(w) if self.slot[i] >= 0)
            on.update(ids)
        z = m["w0"]
        if on:
            c = np.fromiter(on, np.int64, len(on))
            c.sort()
            v = m["v"][c].astype(float)
            s = v.sum(0)
            z += float(m["w"][c].astype(float).sum()) + 0.5 * float((s * s - (v * v).sum(0)).sum())
        return float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> bytes:
    """Fit on a seeded draw of the labelled rows that are not held out; the pickled model."""
    marks = only(labels, "doc_id", "toxic").where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marks = marks.select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    n = marks.count()
    # About four times as many by their hash, then the exact number.
    key = F.xxhash64("doc_id", "toxic", F.lit(SEED))
    marks = stored(marks.where(key <= hash_limit(4 * sample, n)).orderBy(key, "doc_id", "toxic").limit(sample))
    if n and is_empty(marks):
        raise RuntimeError(f"none of {n} labels was drawn")
    docs = only(docs, "doc_id", "text")
    # At most SAMPLE rows of three numbers are broadcast, so no text is shuffled to find the labelled ones.
    rows = docs.select("doc_id").join(F.broadcast(marks.select("doc_id").distinct()), "doc_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    hashed = F.xxhash64("text", F.lit(SEED))
    texts = docs.join(F.broadcast(marks.join(rows, "doc_id")), "doc_id").withColumn("h", hashed)
    texts = texts.where(F.pmod("h", F.lit(1 << 53)) * F.col("rows") < F.lit(float(PER_ID << 53))).select("doc_id", "text", "toxic", "h")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, list[int]] = {}
        for b in batches:
            ids = [np.sort(text_features(t, known)).tobytes() for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "toxic": b["toxic"], "h": b["h"], "ids": ids})

    def fit_all(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "toxic", "ids"], kind="stable")
        model = fit([np.frombuffer(x, np.uint32) for x in rows["ids"]], rows["toxic"].to_numpy())
        return pd.DataFrame({"model": [pickle.dumps(model)]})

    found = texts.mapInPandas(features, "doc_id bigint, toxic int, h bigint, ids binary")
    found = found.groupBy("doc_id", "toxic", "h").agg(F.first("ids").alias("ids"))
    found = found.orderBy(F.xxhash64("doc_id", "toxic", "h", F.lit(SEED)), "doc_id", "toxic", "h").limit(sample)
    got = found.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(fit_all, "model binary").collect()
    return bytes(got[0]["model"]) if got else pickle.dumps(fit([], np.zeros(0)))


def with_scores(docs: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """``docs`` and the ``score`` of every whole ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MAX_FEATURES

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(pickle.loads(shared.value))
        for texts in batches:
            yield pd.Series([scorer(t) for t in texts], dtype="float64")

    return docs.withColumn("score", score(text))


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The registered result: one row per document."""
    docs = only(docs, "doc_id", "text")
    scored = with_scores(docs, train(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below the threshold, with their columns."""
    scored = with_scores(as_rows(docs), train(docs, labels), "row.text")
    return scored.where(F.col("score") < THRESHOLD).select("row.*")
