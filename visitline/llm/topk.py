"""Exact top-k search by inner product over an impact-ordered index.

Index. Vectors are packed, within the tasks that read them, into blocks of at most
``BLOCK`` rows. For each dimension a block's rows are sorted by value and cut into
segments of equal quantised impact; a segment knows its smallest and largest value.

Search. Query blocks meet index blocks by an equi-join on the index task that made them.
For a query, a block's posting segments are processed score-at-a-time: by descending
``|query component| x |quantised impact|``. Each processed segment adds its smallest and
largest possible contribution to its rows' lower and upper bounds; what the other segments
can still add is bounded per dimension. Processing stops only when the bounds prove that all
but a few rows are below the k-th best lower bound. Every remaining possible member is then
rescored exactly in integers, and the k best of the blocks are merged.

Edge cases: null vectors, or vectors with a null or non-finite component, and rows with a null
id take no part, neither as query nor as candidate; missing components of a shorter vector count
as 0; a query's own row is every row with its id; repeated rows of another id are each a candidate;
a query id that occurs several times is searched once per distinct vector, and the results are
merged; ties go to the smaller id; fewer than k candidates give as many; an empty table gives an
empty result. Scores that could leave 63 bits raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitline.llm.common import only, stored

BLOCK, LEVELS, ROUNDS, SCALE = 4096, 16, 8, 1024
QUERY_BLOCK = 256
_BLOCK_SCHEMA = "part int, ids binary, matrix binary, width int"


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, v)``: the rows that take part, components as ``floor(1024 x)``."""
    rows = only(vectors, "vec_id", "embedding").where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    bad = lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    rows = rows.where(~F.exists("embedding", bad))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE)).alias("v"))


def _matrix(vectors) -> np.ndarray:
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _packed(size: int):
    """Rows of a task packed into blocks of at most ``size`` vectors."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        ids: list[int] = []
        vectors: list = []

        def block() -> pd.DataFrame:
            m = _matrix(vectors)
            row = {"part": [part], "ids": [np.array(ids, np.int64).tobytes()], "matrix": [m.tobytes()], "width": [m.shape[1]]}
            ids.clear()
            vectors.clear()
            return pd.DataFrame(row)

        for b in batches:
            for i, v in zip(b["vec_id"], b["v"], strict=True):
                ids.append(i)
                vectors.append(v)
                if len(ids) == size:
                    yield block()
        if ids:
            yield block()

    return pack


class Index:
    """A block's impact-ordered postings."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        self.ids, self.matrix = ids, matrix
        n, d = matrix.shape
        top = max(1, int(np.abs(matrix).max(initial=0)) + 1)
        step = max(1, -(-2 * top // LEVELS))
        order = np.argsort(matrix, axis=0, kind="stable").T  # dimension by dimension
        ranked = np.take_along_axis(matrix.T, order, 1)
        level = np.floor_divide(ranked, step)
        new = np.ones((d, n), bool)
        new[:, 1:] = level[:, 1:] != level[:, :-1]
        start = np.flatnonzero(new)
        end = np.append(start[1:], n * d)
        flat = ranked.reshape(-1)
        self.posting = order.reshape(-1)
        self.start, self.size, self.dim = start, end - start, start // max(n, 1)
        self.low, self.high = flat[start], flat[end - 1]
        self.impact = np.abs(level.reshape(-1)[start] * 2 + 1)  # middle of the level, in half steps

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the block's k best rows (ties to the smaller id) but those of id ``own``."""
        n, d = self.matrix.shape
        other = self.ids != own
        q = np.zeros(d, np.int64)
        q[: min(d, len(query))] = query[:d]
        if int(np.abs(q).max(initial=0)) * int(np.abs(self.matrix).max(initial=0)) * max(d, 1) >= 1 << 62:
            raise ValueError("scores of these vectors don't fit 63 bits")
        sq = q[self.dim]
        a, b = sq * self.low, sq * self.high
        low, high = np.minimum(a, b).astype(float), np.maximum(a, b).astype(float)
        order = np.argsort(-(np.abs(sq) * self.impact), kind="stable")
        order = order[sq[order] != 0]
        done = np.cumsum(self.size[order])
        cuts = np.searchsorted(done, np.linspace(0, done[-1] if len(done) else 0, ROUNDS + 1)[1:], "left") + 1
        lower, upper = np.zeros(n), np.zeros(n)
        few, at = max(4 * k, n // 32), 0
        members = np.flatnonzero(other)
        for cut in cuts:
            seg = order[at : int(cut)]
            at = max(at, int(cut))
            if len(seg):
                size = self.size[seg]
                place = np.arange(size.sum()) + np.repeat(self.start[seg] - (np.cumsum(size) - size), size)
                rows = self.posting[place]
                lower += np.bincount(rows, np.repeat(low[seg], size), n)
                upper += np.bincount(rows, np.repeat(high[seg], size), n)
            rest = order[at:]
            more, less = np.zeros(d), np.zeros(d)
            np.maximum.at(more, self.dim[rest], high[rest])
            np.minimum.at(less, self.dim[rest], low[rest])
            if len(members) > k:
                # The proof: rows whose upper bound is under the k-th largest lower bound can't be members.
                bar = np.partition(lower[members], len(members) - k)[len(members) - k] + less.sum()
                members = members[upper[members] + more.sum() >= bar]
            if len(members) <= few:
                break
        scores = self.matrix[members] @ q
        best = np.lexsort((self.ids[members], -scores))[:k]
        return self.ids[members][best], scores[best]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best rows of ``vectors`` for each row of ``queries`` (both as from ``usable``)."""
    index = stored(vectors.mapInPandas(_packed(BLOCK), _BLOCK_SCHEMA))
    parts = index.agg(F.max("part")).first()[0]
    blocks = queries.mapInPandas(_packed(QUERY_BLOCK), _BLOCK_SCHEMA).select(
        F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix"), F.col("width").alias("q_width")
    )
    # The stated query set, in blocks, goes once to each index task's blocks.
    blocks = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(-1 if parts is None else parts))) if parts is not None else F.lit(0))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, built = None, None
        for b in batches:
            for r in b.itertuples(index=False):
                ids = np.frombuffer(r.ids, np.int64)
                if last != (r.ids, r.matrix):
                    last, built = (r.ids, r.matrix), Index(ids, np.frombuffer(r.matrix, np.int64).reshape(len(ids), r.width))
                q_ids = np.frombuffer(r.q_ids, np.int64)
                q = np.frombuffer(r.q_matrix, np.int64).reshape(len(q_ids), r.q_width)
                found = [built.search(q[i], q_ids[i], k) for i in range(len(q_ids))]
                yield pd.DataFrame(
                    {
                        "query_id": np.repeat(q_ids, [len(f[0]) for f in found]),
                        "vec_id": np.concatenate([f[0] for f in found]),
                        "score": np.concatenate([f[1] for f in found]),
                    }
                )

    pairs = index.join(blocks, "part").mapInPandas(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search_report(vectors: DataFrame) -> DataFrame:
    """The registered result: the 10 best rows for every row whose id is divisible by 100."""
    rows = usable(vectors)
    return top_k(rows, rows.where(F.col("vec_id") % 100 == 0).distinct())


TOPK_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1] * p[2], 0)))::bigint as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from s qualify rank <= 10
"""
