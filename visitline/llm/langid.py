"""Language identification by a byte convolutional network.

A text's UTF-8 bytes are cut into windows of ``WINDOW`` bytes (the last one padded).
The network embeds the bytes, convolves them with filters of several widths, takes each
filter's maximum over the window and gives the languages' probabilities by softmax. It is
trained in numpy (Adam) in one task on a seeded draw of at most ``SAMPLE`` texts
with a language (rows equal in id and text once), ``PER_TEXT`` windows spread over each. A whole text's prediction is the
mean log-probability of all its windows, weighted by their bytes.

Edge cases: a null text or one without a letter is ``und`` with score 0; a null language is
no label; without any label every text is ``und``; with one language only it is always
predicted; a null doc_id is never held out; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitline.llm.common import as_rows, hash_limit, only

#: Texts that the network is trained on, at most, and windows of each.
SAMPLE, PER_TEXT = 8_000, 4
WINDOW, WIDTHS, FILTERS, EMBED = 256, (2, 3, 4), 16, 8
EPOCHS, BATCH, RATE, SEED = 6, 64, 0.01, 11
#: Pipeline: a document stays if a language is found with at least this score (near-even probabilities are rejected).
KEEP = 0.3
UND = "und"
_LETTER = re.compile(r"[^\W\d_]")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def windows(text: str) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a text's bytes and how many bytes each holds."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    n = max(1, -(-len(raw) // WINDOW))
    out = np.zeros((n, WINDOW), np.uint8)
    out.reshape(-1)[: len(raw)] = raw
    sizes = np.full(n, WINDOW)
    sizes[-1] = len(raw) - WINDOW * (n - 1)
    return out, sizes


def _forward(p: dict, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    e = p["e"][x]
    pooled, where = [], []
    for w in WIDTHS:
        # (batch, positions, width * embedding)
        cols = sliding_window_view(e, w, axis=1).transpose(0, 1, 3, 2).reshape(len(x), WINDOW - w + 1, w * EMBED)
        h = cols @ p[f"k{w}"]
        at = h.argmax(1)
        pooled.append(np.take_along_axis(h, at[:, None, :], 1)[:, 0] + p[f"b{w}"])
        where.append(at)
    act = np.maximum(np.concatenate(pooled, 1), 0)
    z = act @ p["o"] + p["c"]
    z -= z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True)), [act], where


def fit(x: np.ndarray, y: np.ndarray, langs: list[str]) -> dict:
    rng = np.random.default_rng(SEED)
    f32 = np.float32
    p = {"e": rng.normal(0, 0.3, (256, EMBED)).astype(f32)}
    for w in WIDTHS:
        p[f"k{w}"] = rng.normal(0, (w * EMBED) ** -0.5, (w * EMBED, FILTERS)).astype(f32)
        p[f"b{w}"] = np.zeros(FILTERS, f32)
    p["o"] = rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(langs))).astype(f32)
    p["c"] = np.zeros(len(langs), f32)
    m1, m2 = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    t = 0
    for _ in range(EPOCHS if len(langs) > 1 else 0):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            take = order[at : at + BATCH]
            xb, yb = x[take], y[take]
            logp, (act,), where = _forward(p, xb)
            d = np.exp(logp)
            d[np.arange(len(xb)), yb] -= 1
            d /= len(xb)
            g = {"o": act.T @ d, "c": d.sum(0), "e": np.zeros_like(p["e"])}
            dact = (d @ p["o"].T) * (act > 0)
            for i, w in enumerate(WIDTHS):
                dh = dact[:, i * FILTERS : (i + 1) * FILTERS]
                # Only each filter's place of maximum passes a gradient on.
                span = where[i][:, :, None] + np.arange(w)
                seen = xb[np.arange(len(xb))[:, None, None], span]
                cols = p["e"][seen].reshape(len(xb), FILTERS, w * EMBED)
                g[f"k{w}"] = np.einsum("bf,bfc->cf", dh, cols)
                g[f"b{w}"] = dh.sum(0)
                de = (dh[:, :, None] * p[f"k{w}"].T[None]).reshape(-1, EMBED)
                np.add.at(g["e"], seen.reshape(-1), de)
            t += 1
            for k, a in g.items():
                m1[k] = 0.9 * m1[k] + 0.1 * a
                m2[k] = 0.999 * m2[k] + 0.001 * a * a
                p[k] = (p[k] - RATE * (m1[k] / (1 - 0.9**t)) / (np.sqrt(m2[k] / (1 - 0.999**t)) + 1e-8)).astype(f32)
    return p | {"langs": langs}


def predict(model: dict, texts: list[str | None], batch: int = 1024) -> tuple[list[str], np.ndarray]:
    """Languages and scores of whole texts, in batches of windows over text boundaries."""
    langs = model["langs"]
    known = [i for i, t in enumerate(texts) if langs and t and _LETTER.search(t)]
    total = np.zeros((len(texts), max(len(langs), 1)))
    weight = np.zeros(len(texts))
    pending: list[tuple[np.ndarray, np.ndarray, int]] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if not pending:
            return
        x = np.concatenate([p[0] for p in pending])
        sizes = np.concatenate([p[1] for p in pending])
        owner = np.repeat([p[2] for p in pending], [len(p[0]) for p in pending])
        for at in range(0, len(x), batch):
            logp = _forward(model, x[at : at + batch])[0]
            np.add.at(total, owner[at : at + batch], logp * sizes[at : at + batch, None])
        np.add.at(weight, owner, sizes)
        pending.clear()
        held = 0

    for i in known:
        x, sizes = windows(texts[i])
        pending.append((x, sizes, i))
        held += len(x)
        if held >= batch:
            flush()
    flush()
    out, scores = [UND] * len(texts), np.zeros(len(texts))
    for i in known:
        z = total[i] / weight[i]
        prob = np.exp(z - z.max())
        prob /= prob.sum()
        best = int(prob.argmax())
        out[i], scores[i] = langs[best], min(1.0, float(prob[best]))
    return out, scores


def train(docs: DataFrame, sample: int = SAMPLE) -> bytes:
    """Fit on a seeded sample of the labelled rows that are not held out; the pickled model."""
    rows = only(docs, "doc_id", "text", "lang").where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.char_length("text") > 0))
    n = rows.count()
    # About four times as many by their hash, then the exact number.
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text", F.lit(SEED))).where(F.col("key") <= hash_limit(4 * sample, n))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = []
            for t in b["text"]:
                x = windows(t)[0]
                got.append(x[np.unique(np.linspace(0, len(x) - 1, PER_TEXT).astype(int))].tobytes())
            yield pd.DataFrame({"key": b["key"], "lang": b["lang"], "x": got})

    def fit_all(got: pd.DataFrame) -> pd.DataFrame:
        got = got.sort_values(["lang", "x"], kind="stable")
        langs = sorted(set(got["lang"]))
        x = np.frombuffer(b"".join(got["x"]), np.uint8).reshape(-1, WINDOW)
        y = np.repeat([langs.index(v) for v in got["lang"]], [len(b) // WINDOW for b in got["x"]])
        return pd.DataFrame({"model": [pickle.dumps(fit(x, y, langs))]})

    drawn = rows.select("key", "lang", "text").mapInPandas(cut, "key bigint, lang string, x binary")
    drawn = drawn.groupBy("key", "lang").agg(F.first("x").alias("x")).orderBy("key", "lang").limit(sample)
    got = drawn.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(fit_all, "model binary").collect()
    if n and not got:
        raise RuntimeError(f"none of {n} texts was drawn")
    return bytes(got[0]["model"]) if got else pickle.dumps({"langs": []})


def with_language(docs: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """``docs`` and ``lid`` = struct(lang, score) of every whole ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand weights

    @F.pandas_udf("lang string, score double")
    def lid(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        net = pickle.loads(shared.value)
        for texts in batches:
            langs, scores = predict(net, list(texts))
            yield pd.DataFrame({"lang": langs, "score": scores})

    return docs.withColumn("lid", lid(text))


def predictions(docs: DataFrame) -> DataFrame:
    """The registered result: one row per document."""
    docs = only(docs, "doc_id", "text", "lang")
    found = with_language(docs.select("doc_id", "text"), train(docs))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("lid.lang").alias("lang_pred"), F.col("lid.score").alias("score")
    )


def keep_known(docs: DataFrame) -> DataFrame:
    """The documents whose language is recognised with a score of ``KEEP`` at least, with their columns."""
    found = with_language(as_rows(docs), train(docs), "row.text")
    return found.where((F.col("lid.lang") != UND) & (F.col("lid.score") >= KEEP)).select("row.*")
