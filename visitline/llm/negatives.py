"""Hard negatives by anchor spanning trees.

Index. Vectors are packed, within the tasks that read them, into blocks of at most ``BLOCK`` rows of the
smallest integer type that holds them. Anchors are packed likewise: each block holds up to ``ANCHORS`` of
them, of one label and near each other where the task's rows allow, and the spanning tree of least total
distance over them (root: the one nearest to their mean).

Scoring. Anchor blocks meet index blocks by an equi-join on the index task that made them. The tree is
walked from its root, which scores a whole block. An anchor's score with a candidate differs from its
parent's by at most the distance between the two anchors times the candidate's norm, so the parent's score
(or its own bounds) plus or minus that bounds it. Only candidates whose bounds overlap the anchor's window
are scored exactly; the others pass their bounds on to the anchor's children. The window is

- for positives, everything that can reach the ``POSITIVES`` best scores of the anchor's label so far;
- for negatives, between ``LOW`` percent of the smallest positive score and the largest one, raised to the
  worst of ``NEGATIVES`` found where each positive has so many.

What overlaps is rescored in exact integers, so the bounds only save work. Per anchor and task the best
rows leave a task; they are merged by (anchor block, place in it).

Edge cases: rows with a null id, label or vector, or a null or non-finite component take no part; missing
components of a shorter vector count as 0; equal anchor rows are one anchor, other rows of one id are
anchors each; every row of another id is a candidate, repeated rows each (a repeated positive has its
negatives twice, told apart by ``positive_rank``); ties go to the smaller id; an anchor without another row
of its label, or without a negative in the window, gives no row; a positive score below 0 has an empty
window; an empty table gives an empty result; other columns are ignored. Scores that could leave 55 bits raise
an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitline.llm.common import only, stored

SCALE, POSITIVES, NEGATIVES = 256, 5, 5
#: The window of negatives, in percent of the positive's score.
LOW, HIGH = 80, 100
BLOCK, ANCHORS, PIVOTS = 4096, 256, 16
_INDEX = "part int, ids binary, labels binary, kind string, width int, matrix binary"
_ANCHORS = "a_block long, a_ids binary, a_labels binary, a_kind string, a_width int, a_matrix binary, a_parent binary, a_edge binary"


def usable(vectors: DataFrame, label: Column | None = None, scale: int = SCALE) -> DataFrame:
    """``(vec_id, label, v)``: the rows that take part, components as ``floor(scale x)``."""
    rows = only(vectors, "vec_id", "embedding", "label")
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.col("label").isNotNull())
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    return rows.where(~F.exists("embedding", bad)).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        (F.col("label") if label is None else label).cast("long").alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"),
    )


def _matrix(vectors: list) -> np.ndarray:
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _packed(m: np.ndarray) -> tuple[str, bytes]:
    """The smallest integer type for a matrix, and its bytes."""
    lo, hi = int(m.min(initial=0)), int(m.max(initial=0))
    kind = next(k for k in ("<i2", "<i4", "<i8") if np.iinfo(k).min <= lo and hi <= np.iinfo(k).max)
    return kind, m.astype(kind).tobytes()


def _unpacked(kind: str, n: int, width: int, raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, kind).reshape(n, width).astype(np.int64)


def _index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    ids: list[int] = []
    labels: list[int] = []
    vectors: list = []

    def block() -> pd.DataFrame:
        m = _matrix(vectors)
        kind, raw = _packed(m)
        row = {"part": part, "ids": np.array(ids, np.int64).tobytes(), "labels": np.array(labels, np.int64).tobytes(), "kind": kind, "width": m.shape[1], "matrix": raw}
        for x in (ids, labels, vectors):
            x.clear()
        return pd.DataFrame([row])

    for b in batches:
        for i, y, v in zip(b["vec_id"], b["label"], b["v"], strict=True):
            ids.append(i)
            labels.append(y)
            vectors.append(v)
            if len(ids) == BLOCK:
                yield block()
    if ids:
        yield block()


def spanning_tree(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(order, parent, edge)`` of the rows' least spanning tree: parents come first; ``parent`` is a place in ``order``."""
    x = m.astype(float)
    n = len(x)
    order, parent, edge = [int(((x - x.mean(0)) ** 2).sum(1).argmin())], [0], [0.0]
    far = ((x - x[order[0]]) ** 2).sum(1)
    near, out = np.zeros(n, int), np.ones(n, bool)
    out[order[0]] = False
    while len(order) < n:
        j = int(np.where(out, far, np.inf).argmin())
        out[j] = False
        parent.append(int(near[j]))
        edge.append(float(np.sqrt(far[j])))
        order.append(j)
        d = ((x - x[j]) ** 2).sum(1)
        closer = d < far
        near[closer] = len(order) - 1
        far = np.minimum(far, d)
    return np.array(order), np.array(parent, np.int32), np.array(edge)


def _anchor_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext

    block = TaskContext.get().partitionId() << 32
    held: list[tuple] = []

    def blocks() -> Iterator[pd.DataFrame]:
        nonlocal block
        ids, labels = np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.int64)
        m = _matrix([h[2] for h in held])
        held.clear()
        pivots = m[:: max(1, len(m) // PIVOTS)].astype(float)
        near = ((pivots**2).sum(1) - 2 * m.astype(float) @ pivots.T).argmin(1)
        by = np.lexsort((ids, near, labels))
        for at in range(0, len(by), ANCHORS):
            take = by[at : at + ANCHORS]
            order, parent, edge = spanning_tree(m[take])
            take = take[order]
            kind, raw = _packed(m[take])
            yield pd.DataFrame(
                [
                    {
                        "a_block": block, "a_ids": ids[take].tobytes(), "a_labels": labels[take].tobytes(), "a_kind": kind, "a_width": m.shape[1],
                        "a_matrix": raw, "a_parent": parent.tobytes(), "a_edge": edge.tobytes(),
                    }
                ]
            )
            block += 1

    for b in batches:
        for row in zip(b["vec_id"], b["label"], b["v"], strict=True):
            held.append(row)
            if len(held) == ANCHORS * PIVOTS:
                yield from blocks()
    if held:
        yield from blocks()


class Anchors:
    """One block of anchors; ``scores`` walks its tree over a block of candidates."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray, parent: np.ndarray, edge: np.ndarray):
        self.ids, self.labels, self.matrix, self.parent, self.edge = ids, labels, matrix, parent, edge
        self.rescored = 0

    def scores(self, matrix: np.ndarray) -> Iterator:
        """A generator: for each anchor it yields its place, ``(low, high)`` bounds of all rows; sent the rows to score, it yields their scores."""
        width = max(matrix.shape[1], self.matrix.shape[1])
        c, a = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (matrix, self.matrix))
        largest = int(np.abs(a).max(initial=0)) * int(np.abs(c).max(initial=0)) * max(width, 1)
        if largest >= 1 << 55:
            raise ValueError("scores of these vectors don't fit 55 bits")
        if largest < 1 << 53:  # every partial sum is a whole number that a double holds exactly
            a, c = a.astype(float), c.astype(float)
        norm = np.sqrt((c.astype(float) ** 2).sum(1))
        lows, highs = [], []
        for t in range(len(a)):
            if t == 0:
                exact = c @ a[0]
                low, high = exact.astype(float), exact.astype(float)
                rows = yield t, low, high
                self.rescored += len(c)
                yield exact[rows].astype(np.int64)
            else:
                p = self.parent[t]
                # Widened by the rounding of the sums and of the distance.
                reach = self.edge[t] * norm * (1 + 1e-9) + 1 + 1e-9 * np.maximum(np.abs(lows[p]), np.abs(highs[p]))
                low, high = lows[p] - reach, highs[p] + reach
                rows = yield t, low, high
                self.rescored += len(rows)
                # Beyond half of the rows, the whole product is cheaper than their copy.
                exact = (c @ a[t])[rows] if 2 * len(rows) > len(c) else c[rows] @ a[t]
                low[rows] = high[rows] = exact
                yield exact.astype(np.int64)
            lows.append(low)
            highs.append(high)


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    best = np.lexsort((ids, -scores))[:k]
    return scores[best], ids[best]


class Positives:
    """The best rows of each anchor's own label."""

    def __init__(self, anchors: Anchors, k: int = POSITIVES):
        self.anchors, self.k = anchors, k
        none = np.zeros(0, np.int64)
        self.found = [(none, none) for _ in anchors.ids]

    def feed(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray) -> None:
        walk = self.anchors.scores(matrix)
        for t, low, high in walk:
            scores, got = self.found[t]
            mine = np.flatnonzero((labels == self.anchors.labels[t]) & (ids != self.anchors.ids[t]))
            bar = float(scores[-1]) if len(scores) == self.k else -np.inf
            if len(mine) > self.k:
                bar = max(bar, np.partition(low[mine], len(mine) - self.k)[len(mine) - self.k])
            rows = mine[high[mine] >= bar]
            exact = walk.send(rows)
            self.found[t] = _first(np.concatenate([scores, exact]), np.concatenate([got, ids[rows]]), self.k)

    def rows(self) -> pd.DataFrame:
        sizes = [len(s) for s, _ in self.found]
        return pd.DataFrame(
            {
                "spot": np.repeat(np.arange(len(sizes)), sizes),
                "anchor_id": np.repeat(self.anchors.ids, sizes),
                "vec_id": np.concatenate([i for _, i in self.found]),
                "score": np.concatenate([s for s, _ in self.found]),
            }
        )


class Negatives:
    """For each positive of each anchor, the best rows of other labels in its window."""

    def __init__(self, anchors: Anchors, spots: np.ndarray, slots: np.ndarray, scores: np.ndarray, k: int = NEGATIVES, low: int = LOW, high: int = HIGH):
        self.anchors, self.k, self.low, self.high = anchors, k, low, high
        none = np.zeros(0, np.int64)
        self.wanted: list[list[list]] = [[] for _ in anchors.ids]
        for spot, slot, score in zip(spots, slots, scores, strict=True):
            if low * int(score) <= high * int(score):
                self.wanted[spot].append([int(slot), int(score), none, none])

    def feed(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray) -> None:
        walk = self.anchors.scores(matrix)
        for t, low, high in walk:
            wanted = self.wanted[t]
            rows = np.zeros(0, np.int64)
            if wanted:
                # A full list's worst score is a floor: an equal one may still win by its id.
                floor = min(max(self.low * p / 100 - 1, float(s[-1]) if len(s) == self.k else -np.inf) for _, p, s, _ in wanted)
                top = max(self.high * p / 100 + 1 for _, p, _, _ in wanted)
                rows = np.flatnonzero((labels != self.anchors.labels[t]) & (high >= floor) & (low <= top))
            exact = walk.send(rows)
            for w in wanted:
                _, p, scores, got = w
                on = (100 * exact >= self.low * p) & (100 * exact <= self.high * p)
                if on.any():
                    w[2], w[3] = _first(np.concatenate([scores, exact[on]]), np.concatenate([got, ids[rows[on]]]), self.k)

    def rows(self) -> pd.DataFrame:
        got = [(t, slot, i, s) for t, wanted in enumerate(self.wanted) for slot, _, scores, ids in wanted for s, i in zip(scores, ids, strict=True)]
        return pd.DataFrame(got, columns=["spot", "slot", "vec_id", "score"]).astype("int64")


def _anchors_of(r) -> Anchors:
    ids = np.frombuffer(r.a_ids, np.int64)
    matrix = _unpacked(r.a_kind, len(ids), r.a_width, r.a_matrix)
    return Anchors(ids, np.frombuffer(r.a_labels, np.int64), matrix, np.frombuffer(r.a_parent, np.int32), np.frombuffer(r.a_edge, float))


def _mine(start):
    """A task's pairs of blocks: what ``start`` makes of an anchor block is fed the index blocks that come with it, one after the other."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, miner = None, None
        for b in batches:
            for r in b.itertuples(index=False):
                if r.a_block != block:
                    if miner is not None:
                        yield miner.rows().assign(block=block)
                    block, miner = r.a_block, start(r)
                ids = np.frombuffer(r.ids, np.int64)
                miner.feed(ids, np.frombuffer(r.labels, np.int64), _unpacked(r.kind, len(ids), r.width, r.matrix))
        if miner is not None:
            yield miner.rows().assign(block=block)

    return run


def _start_negatives(r) -> Negatives:
    numbers = lambda x: np.array(list(x), np.int64)
    return Negatives(_anchors_of(r), numbers(r.spots), numbers(r.slots), numbers(r.p_scores))


def _best(found: DataFrame, keys: list[str], name: str, k: int) -> DataFrame:
    """The first ``k`` rows of each of ``keys``: per task at most as many rows come in."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn(name, F.row_number().over(order)).where(F.col(name) <= k)


def hard_negatives(vectors: DataFrame, anchors: DataFrame) -> DataFrame:
    """``(anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score)`` for ``anchors`` among ``vectors`` (both as from ``usable``)."""
    index = stored(vectors.mapInPandas(_index, _INDEX))
    parts = index.agg(F.max("part")).first()[0]
    blocks = stored(anchors.distinct().mapInPandas(_anchor_blocks, _ANCHORS))
    # The anchors, a stated set in blocks, go once to each index task's blocks.
    to_parts = F.array().cast("array<int>") if parts is None else F.sequence(F.lit(0), F.lit(parts))

    def meet(a: DataFrame) -> DataFrame:
        return a.withColumn("part", F.explode(to_parts)).join(index, "part")

    tops = meet(blocks).mapInPandas(_mine(lambda r: Positives(_anchors_of(r))), "block long, spot int, anchor_id long, vec_id long, score long")
    positives = stored(_best(tops, ["block", "spot"], "slot", POSITIVES))
    listed = positives.groupBy(F.col("block").alias("a_block")).agg(F.collect_list(F.struct("spot", "slot", "score")).alias("p"))
    lists = listed.select("a_block", F.col("p.spot").alias("spots"), F.col("p.slot").alias("slots"), F.col("p.score").alias("p_scores"))
    near = meet(blocks.join(lists, "a_block")).mapInPandas(_mine(_start_negatives), "block long, spot int, slot int, vec_id long, score long")
    near = _best(near, ["block", "spot", "slot"], "rank", NEGATIVES)
    near = near.select("block", "spot", "slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return positives.join(near, ["block", "spot", "slot"]).select(
        "anchor_id",
        F.col("vec_id").alias("positive_id"),
        F.col("slot").alias("positive_rank"),
        "rank",
        "negative_id",
        F.col("score").alias("positive_score"),
        "negative_score",
    )


def negatives_report(vectors: DataFrame) -> DataFrame:
    """The registered result: rows whose id is divisible by 7 have the next label, those whose id is divisible by 100 are the anchors."""
    label = F.col("label").cast("long")
    rows = usable(vectors, F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives(rows, rows.where(F.col("vec_id") % 100 == 0))


NEGATIVES_SQL = """
with r as (
  select vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label::bigint end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), a as (
  select *, row_number() over () as aid from (select distinct * from r where vec_id % 100 = 0)
), s as (
  select a.aid, a.vec_id as anchor_id, a.label = r.label as same, r.vec_id,
    list_sum(list_transform(list_zip(a.v, r.v), lambda p: coalesce(p[1] * p[2], 0)))::bigint as score
  from a join r on r.vec_id <> a.vec_id
), p as (
  select aid, anchor_id, vec_id as positive_id, score as positive_score, row_number() over (partition by aid order by score desc, vec_id)::int as positive_rank
  from s where same qualify positive_rank <= 5
)
select p.anchor_id, p.positive_id, p.positive_rank, row_number() over (partition by p.aid, p.positive_rank order by n.score desc, n.vec_id)::int as rank,
  n.vec_id as negative_id, p.positive_score, n.score as negative_score
from p join s n on n.aid = p.aid and not n.same and 100 * n.score between 80 * p.positive_score and 100 * p.positive_score
qualify rank <= 5
"""
