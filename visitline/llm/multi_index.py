"""Near-duplicate vectors by an inverted multi-index.

Fit. Vectors are scaled to length 1 and cut in two halves. Each half has a codebook of its own (k-means, one
task) from a sample of at most ``SAMPLE`` distinct vectors and ``SAMPLE_NUMBERS`` components; a pair of centroids, one
of each half, is a cell of the product grid. The number of centroids grows with the number of vectors, up to ``MAX_CENTROIDS``.

Index. Every distinct vector of a label belongs to the cell of its nearest centroids: a *node*, which counts with its copies.

Search. For each half, a vector's centroids are ordered by how far it is from their regions (the distance to the
plane between the centroid and the vector's own). The multi-sequence traversal visits cells by the sum of the two
squared distances and stops at a sum where the target recall is reached: the ``TARGET`` quantile of that sum over sampled
vectors displaced to exactly the threshold's similarity, in random directions and towards other vectors, whichever needs
more. With a target of 1 it stops only where no cell beyond can hold a link (the sum exceeds the squared
distance of two linked vectors). A vector visits only cells after its own in the grid's numbering, and its own.

Verify. A cell's vectors and visitors are compared in pairs of blocks, each in its own task: cosines in double
precision. Only counts and links that span the linked nodes leave a task, never the pairs; links are joined to components.

Result, one row per distinct row (id, label, vector): ``n_links`` (the number of other such rows of its label at the threshold
or above), ``component_id`` (the smallest id of its component) and ``kept`` (whether it is that one's).

Edge cases: a null label, a null, zero or empty vector, or one with a null or non-finite component links with nothing and is its
own component; rows equal in id, label and vector are one vector, rows of one id that differ are vectors each; rows with
a null id are linked like others, but a null is a component's id only if it has no other; missing components of a
shorter vector count as 0; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitline.llm.common import components, only, stored

THRESHOLD, TARGET = 0.98, 0.999
#: Vectors that the codebooks are fitted on, at most, and their components in all, at most.
SAMPLE, SAMPLE_NUMBERS = 20_000, 8_000_000
#: Vectors per cell that the number of centroids aims at, and centroids per half, at most.
OCCUPANCY, MAX_CENTROIDS = 512, 1024
ROUNDS, SEED, BLOCK = 8, 13, 1024


def unit(vectors: list, width: int) -> np.ndarray:
    """Vectors of length 1 (scaled by their largest component first, so that no square overflows), padded to ``width``."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    out /= np.maximum(np.abs(out).max(1, keepdims=True, initial=0), np.finfo(float).tiny)
    return out / np.maximum(np.sqrt((out**2).sum(1, keepdims=True)), np.finfo(float).tiny)


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = x.shape[1] // 2
    return x[:, :cut], x[:, cut:]


def _squares(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ centers.T + (centers**2).sum(1), 0)


def k_means(x: np.ndarray, k: int, seed: int = SEED) -> np.ndarray:
    centers = x[np.sort(np.random.default_rng(seed).choice(len(x), k, replace=False))].copy()
    for _ in range(ROUNDS):
        near = np.concatenate([_squares(x[i : i + 4096], centers).argmin(1) for i in range(0, len(x), 4096)])
        n = np.bincount(near, minlength=k)
        total = np.zeros_like(centers)
        np.add.at(total, near, x)
        centers[n > 0] = total[n > 0] / n[n > 0, None]
    return centers


def region_costs(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest centroid, and its squared distance from the region of each centroid, at least."""
    d = _squares(x, centers)
    own = d.argmin(1)
    gap = np.sqrt(_squares(centers, centers))[own]
    cost = (d - d[np.arange(len(x)), own][:, None]) / np.maximum(2 * gap, 1e-12)
    cost[np.arange(len(x)), own] = 0
    return own, np.maximum(cost, 0) ** 2


class Grid:
    """The product grid of two codebooks, and where its traversal stops."""

    def __init__(self, sample: np.ndarray, centroids: int, threshold: float = THRESHOLD, target: float = TARGET):
        self.books = [k_means(h, centroids) for h in halves(sample)]
        self.width, self.centroids = sample.shape[1], centroids
        self.stop = 2 - 2 * threshold + 1e-9
        if target < 1:
            self.stop = min(self.stop, max(self._cost(sample, threshold, target, d) for d in self._directions(sample)) + 1e-12)

    @classmethod
    def load(cls, raw: bytes) -> Grid:
        grid = cls.__new__(cls)
        vars(grid).update(pickle.loads(raw))
        return grid

    def dump(self) -> bytes:
        return pickle.dumps(vars(self))

    @staticmethod
    def _directions(x: np.ndarray) -> Iterator[np.ndarray]:
        rng = np.random.default_rng(SEED)
        yield rng.normal(size=x.shape)
        yield x[rng.permutation(len(x))]

    def _cost(self, x: np.ndarray, threshold: float, target: float, direction: np.ndarray) -> float:
        side = direction - (direction * x).sum(1, keepdims=True) * x
        length = np.sqrt((side**2).sum(1, keepdims=True))
        moved = threshold * x + np.sqrt(1 - threshold**2) * side / np.maximum(length, 1e-12)
        total = np.zeros(len(x))
        for a, b, book in zip(halves(x), halves(moved), self.books, strict=True):
            for at in range(0, len(x), 4096):
                rows = slice(at, at + 4096)
                to = _squares(b[rows], book).argmin(1)
                total[rows] += region_costs(a[rows], book)[1][np.arange(len(to)), to]
        return float(np.quantile(total, target, method="higher"))

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Each row's own cell, and the cells after it that it visits, nearest first."""
        (own1, cost1), (own2, cost2) = (region_costs(h, book) for h, book in zip(halves(x), self.books, strict=True))
        home = own1.astype(np.int64) * self.centroids + own2
        by1, by2 = cost1.argsort(1, kind="stable"), cost2.argsort(1, kind="stable")
        first, second = np.take_along_axis(cost1, by1, 1), np.take_along_axis(cost2, by2, 1)
        rows, cells, sums = [], [], []
        # Both sequences in step: place i of the first goes with the beginning of the second that keeps the sum.
        for i in range(self.centroids):
            on = np.flatnonzero(first[:, i] <= self.stop)
            if not len(on):
                break
            for j in range(self.centroids):
                total = first[on, i] + second[on, j]
                fits = total <= self.stop
                on, total = on[fits], total[fits]
                if not len(on):
                    break
                rows.append(on)
                cells.append(by1[on, i].astype(np.int64) * self.centroids + by2[on, j])
                sums.append(total)
        row, cell, total = np.concatenate(rows), np.concatenate(cells), np.concatenate(sums)
        after = cell > home[row]
        row, cell, total = row[after], cell[after], total[after]
        order = np.lexsort((cell, total, row))
        return home, np.split(cell[order], np.searchsorted(row[order], np.arange(1, len(x))))


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, label, v)``, distinct; ``v`` is null for vectors that link with nothing."""
    rows = only(vectors, "vec_id", "embedding", "label")
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf"))
    fits = F.col("label").isNotNull() & F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0)
    return rows.select("vec_id", "label", F.when(fits, F.col("embedding")).alias("v")).distinct()


def fit(nodes: DataFrame, n: int, width: int, threshold: float, target: float) -> bytes:
    """The pickled grid, fitted in one task on a sample of ``(node, v)``."""
    size = max(1, min(SAMPLE, SAMPLE_NUMBERS // max(width, 1)))
    sample = nodes.select(F.xxhash64("label", "v", F.lit(SEED)).alias("key"), "v").orderBy("key", "v").limit(size)

    def fit_all(rows: pd.DataFrame) -> pd.DataFrame:
        x = unit(list(rows.sort_values("key", kind="stable")["v"]), width)
        k = int(min(MAX_CENTROIDS, max(1, round((n / OCCUPANCY) ** 0.5)), max(1, len(x) // 8)))
        return pd.DataFrame({"grid": [Grid(x, k, threshold, target).dump()]})

    return bytes(sample.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(fit_all, "grid binary").first()["grid"])


def _comparer(width: int, threshold: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        """One pair of blocks of a cell: each node's links, and links that span the linked nodes."""
        rows = rows.sort_values(["home", "side", "node"])
        node, copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
        home, side = rows["home"].to_numpy(bool), rows["side"].to_numpy()
        x = unit(list(rows["v"]), width)
        left, right = np.flatnonzero(home & (side != 1)), np.flatnonzero(~home | (side == 1))
        linked = np.zeros((len(node), len(node)), bool)
        linked[np.ix_(left, right)] = x[left] @ x[right].T >= threshold
        alone = np.flatnonzero(side[left] == 2)  # a block against itself
        own = left[alone]
        linked[np.ix_(own, own)] = x[own] @ x[own].T >= threshold
        linked |= linked.T
        np.fill_diagonal(linked, False)
        links = linked @ copies
        root = np.arange(len(node))
        while True:
            low = np.minimum(root, np.where(linked, root[None, :], len(node)).min(1, initial=len(node)))
            low = low[low]
            if (low == root).all():
                break
            root = low
        on = links > 0
        return pd.DataFrame({"node": node[on], "links": links[on], "root": node[root[on]]})

    return compare


def _links(nodes: DataFrame, threshold: float, target: float) -> tuple[DataFrame, DataFrame]:
    """``(node, links)`` and spanning links ``(a, b)`` of the stored nodes ``(node, label, v, copies)``."""
    n, width = nodes.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    shared = nodes.sparkSession.sparkContext.broadcast(fit(nodes, n, width, threshold, target))  # bounded by MAX_CENTROIDS times the width

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grid = Grid.load(shared.value)
        for b in batches:
            for at in range(0, len(b), 1024):  # bounds the distances to all centroids
                part = b.iloc[at : at + 1024]
                home, visits = grid.cells(unit(list(part["v"]), width))
                yield part.assign(cell=home, visits=visits)

    kind = nodes.schema["v"].dataType.simpleString()
    label = nodes.schema["label"].dataType.simpleString()
    placed = nodes.mapInPandas(assign, f"node long, label {label}, v {kind}, copies long, cell long, visits array<long>")
    placed = stored(placed)
    # Only cells that are somebody's own, and how many blocks they and their visitors make.
    homes = placed.groupBy("label", "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("long").alias("blocks"))
    visits = placed.select("node", "label", F.explode("visits").alias("cell"))
    guests = visits.groupBy("label", "cell").agg(F.count(F.lit(1)).alias("n"))
    few = (F.col("blocks") == 1) & (F.coalesce("n", F.lit(0)) <= BLOCK)  # they join the only block of the cell
    sizes = homes.join(guests, ["label", "cell"], "left").select(
        "label", "cell", "blocks", F.when(few, 0).otherwise(F.ceil(F.col("n") / F.lit(BLOCK))).cast("long").alias("guest_blocks")
    )
    sizes = stored(sizes.withColumn("guest_blocks", F.coalesce("guest_blocks", F.lit(0).cast("long"))))
    dealt = lambda blocks: F.pmod(F.xxhash64("node", F.lit(SEED)), blocks)
    to = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    members = placed.select("node", "label", "cell", "v", "copies").join(sizes, ["label", "cell"])
    members = members.withColumn("own", dealt(F.col("blocks"))).withColumn("with", F.explode(to(F.col("blocks") + F.col("guest_blocks"))))
    own, other = F.col("own"), F.col("with")
    members = members.select(
        "label", "cell", F.least(own, other).alias("i"), F.greatest(own, other).alias("j"), F.lit(True).alias("home"),
        F.when(own == other, 2).when(own < other, 0).otherwise(1).alias("side"), "node", "copies", "v",
    )
    # Only the cells that are met go with a vector.
    guest = placed.select("node", "label", "copies", "v", F.explode("visits").alias("cell")).join(sizes, ["label", "cell"])
    j = F.when(F.col("guest_blocks") == 0, 0).otherwise(F.col("blocks") + dealt(F.greatest("guest_blocks", F.lit(1))))
    guest = guest.withColumn("j", j.cast("long")).withColumn("i", F.explode(to(F.col("blocks"))))
    guest = guest.select("label", "cell", "i", "j", F.lit(False).alias("home"), F.lit(1).alias("side"), "node", "copies", "v")
    units = members.unionByName(guest).groupBy("label", "cell", "i", "j")
    found = stored(units.applyInPandas(_comparer(width, threshold), "node long, links long, root long"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    return links, found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, target: float = TARGET) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``: links of ``vectors`` (vec_id, embedding, label) at the threshold."""
    rows = stored(usable(vectors))
    inside = rows.where("v is not null")
    nodes = inside.groupBy("label", "v").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()))
    alone = rows.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if not nodes.take(1):
        return alone.withColumn("kept", F.lit(True))
    links, edges = _links(nodes.select("node", "label", "v", "copies"), threshold, target)
    classes = components(edges)
    told = nodes.join(links, "node", "left").join(classes, "node", "left")
    told = stored(
        told.select(
            "label", "v", "first", F.coalesce("component", "node").alias("component"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
        )
    )
    lowest = told.groupBy("component").agg(F.min("first").alias("component_id"))
    told = stored(told.join(lowest, "component").select("label", "v", "n_links", "component_id"))
    out = inside.join(told, ["label", "v"]).select("vec_id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


NEAR_SQL = """
with recursive v as (
  select distinct vec_id, label, list_transform(embedding, lambda x: x::double) as v from embeddings
), fit as (
  select row_number() over () as rid, *,
    label is not null and v is not null and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(v, lambda x: x <> 0)) > 0 as fits
  from v
), pair as (
  select a.rid as a, b.rid as b from fit a join fit b on a.label = b.label and a.rid <> b.rid and a.fits and b.fits
  where list_cosine_similarity(a.v, b.v) >= 0.98
), reach(a, b) as (
  select a, b from pair union select r.a, p.b from reach r join pair p on p.a = r.b
)
select f.vec_id, (select count(*) from pair p where p.a = f.rid) as n_links, least(f.vec_id, min(o.vec_id)) as component_id,
  f.vec_id is not distinct from least(f.vec_id, min(o.vec_id)) as kept
from fit f left join reach r on r.a = f.rid left join fit o on o.rid = r.b
group by f.rid, f.vec_id
"""
