"""Near-duplicate join: Jaccard similarity of word 5-grams, by MinHash banding.

1. Every whole text becomes its set of distinct word n-grams (64-bit hashes; a text of fewer than
   ``NGRAM`` words is one shorter n-gram). Texts with equal sets are one *node*: a 64-bit hash of the set.
   Its signature is cut into bands; band and row counts follow from the target recall (``bands_for``).
2. Band hashes are shuffled as (band hash, node). Only buckets with two different nodes go on.
3. Nodes that share two bands or more with a bucket's smallest node are grouped. A group's texts are
   compared in pairs of blocks, each in its own task, by their full n-gram sets: only counts and the
   spanning links leave the task, never the group's pairs.
4. A node that shares a band with a node of another group is compared with that group: with each member if
   they are few, else as a guest of the group's blocks.
5. Links are joined to classes (connected components).

Steps 3 and 4 together compare every pair of nodes that shares a band; the grouping only decides where.
Equal texts are never expanded into pairs: a node counts with its copies.

Result, one row per document: ``class_id`` (the smallest doc_id of its class) and ``n_links`` (the number of
other documents at similarity 0.8 or more).

Edge cases: a null text, or one without a word, has no n-gram: it is its own class, without links. Words
are lower-case runs of letters and digits. Repeated rows are copies of each other; rows with equal doc_id and
different texts get the links of their own text; rows with a null doc_id are linked like others, but a null is
never a class id unless its class has no other. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitline.llm.common import as_rows, components, only, stored

NGRAM, THRESHOLD, RECALL, MAX_HASHES = 5, 0.8, 0.9999, 128
BLOCK = 256
#: Candidates of groups up to this size are compared pair by pair, those of larger groups in blocks.
FEW = 16
SEED = 23
_WORD = re.compile(r"[^\W_]+")
_CACHE = 500_000
_M64 = np.uint64(0x9E3779B97F4A7C15)


def bands_for(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """``(bands, rows)``: the most rows (fewest chance candidates) whose bands find a pair at the threshold with the target recall."""
    best = (max_hashes, 1)
    for rows in range(1, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows > max_hashes:
            break
        best = (bands, rows)
    return best


BANDS, ROWS = bands_for()


def _constants(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 1 << 32, n, dtype=np.uint32), rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class Grams:
    """Sorted distinct n-gram hashes of whole texts; a word's hash is computed once per task."""

    def __init__(self, n: int = NGRAM):
        self.n, self.known = n, {}
        self.factors = [_mixed(np.array([i + 1], np.uint64) * _M64)[0] | np.uint64(1) for i in range(n)]

    def __call__(self, text: str | None) -> np.ndarray:
        words = _WORD.findall((text or "").lower())
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > _CACHE:
            known.clear()
        hashes = np.empty(len(words), np.uint64)
        for i, w in enumerate(words):
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh3_64_intdigest(w)
            hashes[i] = h
        k = min(self.n, len(words))
        m = len(words) - k + 1
        total = np.full(m, np.uint64(k))
        for i in range(k):
            total += _mixed(hashes[i : i + m] ^ self.factors[i]) * self.factors[i]
        return np.unique(_mixed(total))


def signature_bands(grams: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit hash per band of the set's MinHash signature."""
    xor, mul = _constants(bands * rows)
    low = (grams >> np.uint64(32)).astype(np.uint32)
    sig = np.full(bands * rows, np.uint32(0xFFFFFFFF))
    for at in range(0, len(low), 1024):
        np.minimum(sig, ((low[at : at + 1024, None] ^ xor) * mul).min(0), out=sig)
    out = np.arange(bands, dtype=np.uint64) * _M64
    for row in sig.reshape(bands, rows).T:
        out = _mixed((out ^ row.astype(np.uint64)) * _M64)
    return out.view(np.int64)


def node_of(grams: np.ndarray) -> int:
    return int(np.array([xxhash.xxh3_64_intdigest(grams.tobytes())], np.uint64).view(np.int64)[0])


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    grams = Grams()
    for b in batches:
        sets = [grams(t) for t in b["text"]]
        yield pd.DataFrame(
            {
                "doc_id": b["doc_id"].astype("Int64"),
                "text_hash": b["text_hash"],
                "node": pd.array([node_of(s) if len(s) else None for s in sets], "Int64"),
                "size": [len(s) for s in sets],
                "bands": [signature_bands(s) if len(s) else None for s in sets],
            }
        )


def _with_node(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    make = Grams()
    for b in batches:
        found = [(node_of(s), t) for t in b["text"] if len(s := make(t))]
        yield pd.DataFrame({"node": np.array([n for n, _ in found], np.int64), "text": np.array([t for _, t in found], object)})


def similar(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared >= threshold * (len(a) + len(b) - shared) - 1e-9


def _shared_counts(rows: list[np.ndarray], cols: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, by products over slices of the shared n-grams."""
    r_id, r_len = np.concatenate(rows), [len(x) for x in rows]
    c_id, c_len = np.concatenate(cols), [len(x) for x in cols]
    both = np.intersect1d(r_id, c_id)
    out = np.zeros((len(rows), len(cols)), np.float32)
    spots = []
    for ids, lens in ((r_id, r_len), (c_id, c_len)):
        owner = np.repeat(np.arange(len(lens)), lens)
        at = np.searchsorted(both, ids)
        at[at == len(both)] = 0
        on = both[at] == ids if len(both) else np.zeros(len(ids), bool)
        order = np.argsort(at[on], kind="stable")
        spots.append((owner[on][order], at[on][order]))
    for lo in range(0, len(both), 4096):
        parts = []
        for (owner, at), n in zip(spots, out.shape, strict=True):
            i, j = np.searchsorted(at, [lo, lo + 4096])
            dense = np.zeros((n, min(4096, len(both) - lo)), np.float32)
            dense[owner[i:j], at[i:j] - lo] = 1
            parts.append(dense)
        out += parts[0] @ parts[1].T
    return out


def _compare_blocks(rows: pd.DataFrame) -> pd.DataFrame:
    """One pair of blocks of a group: each node's links to documents of other nodes, and links that span the linked nodes."""
    rows = rows.drop_duplicates(["node", "side"])
    make = Grams()
    sets = {}
    for node, text in zip(rows["node"], rows["text"], strict=True):
        if node not in sets and node_of(found := make(text)) == node:
            sets[node] = found
    rows = rows[rows["node"].isin(sets)]
    copies = dict(zip(rows["node"], rows["copies"], strict=True))
    left = sorted(rows["node"][rows["side"] != 1])
    right = sorted(rows["node"][rows["side"] != 0])
    empty = pd.DataFrame({"node": pd.array([], "int64"), "links": pd.array([], "int64"), "root": pd.array([], "int64")})
    if not left or not right:
        return empty
    shared = _shared_counts([sets[n] for n in left], [sets[n] for n in right])
    ls, rs = np.array([len(sets[n]) for n in left]), np.array([len(sets[n]) for n in right])
    linked = shared >= THRESHOLD * (ls[:, None] + rs[None, :] - shared) - 1e-6
    linked &= np.array(left)[:, None] != np.array(right)[None, :]
    lc, rc = np.array([copies[n] for n in left]), np.array([copies[n] for n in right])
    same = left == right  # a block against itself: every pair is seen from both ends
    links = dict.fromkeys(sets, 0)
    for n, v in zip(left, linked @ rc, strict=True):
        links[n] += int(v)
    if not same:
        for n, v in zip(right, linked.T @ lc, strict=True):
            links[n] += int(v)
    root = {n: n for n in sets}

    def top(n: int) -> int:
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for i, n in enumerate(left):
        for j in np.flatnonzero(linked[i]):
            a, b = top(n), top(right[j])
            if a != b:
                root[max(a, b)] = min(a, b)
    nodes = [n for n in sets if links[n]]
    return pd.DataFrame({"node": nodes, "links": [links[n] for n in nodes], "root": [top(n) for n in nodes]}).astype("int64")


def _compare_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    make = Grams()
    for b in batches:
        on = []
        for a, c, ta, tc in zip(b["a"], b["b"], b["text_a"], b["text_b"], strict=True):
            x, y = make(ta), make(tc)
            on.append(node_of(x) == a and node_of(y) == c and similar(x, y))
        yield b.loc[on, ["a", "b", "copies_a", "copies_b"]]


def _linked(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows ``(doc_id, text_hash, node, ...)``, the nodes, and ``(node, first_doc, copies, component, links)`` of nodes that aren't alone."""
    docs = only(docs, "doc_id", "text")
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    signed = stored(docs.mapInPandas(_sign, "doc_id long, text_hash long, node long, size int, bands array<long>"))
    # A node's text is that of its row with the smallest id: found by id and text, as rows with equal ids may hold other texts.
    nodes = stored(
        signed.where("node is not null").groupBy("node").agg(
            F.min("doc_id").alias("first_doc"), F.coalesce(F.min_by("text_hash", "doc_id"), F.min("text_hash")).alias("text_hash"),
            F.count(F.lit(1)).alias("copies"), F.max("size").alias("size"),
        )
    )
    # Buckets with two different nodes, and their members once each.
    spread = signed.where("node is not null").select("node", F.explode("bands").alias("key"))
    buckets = spread.groupBy("key").agg(F.min("node").alias("center"), F.max("node").alias("other")).where("center < other").drop("other")
    members = stored(spread.join(buckets, "key").distinct())
    # Groups: nodes that share two bands or more with the same bucket's smallest node.
    strong = members.where("node <> center").groupBy("center", "node").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")
    groups = components(strong.select(F.col("center").alias("a"), F.col("node").alias("b")))
    groups = groups.select("node", F.col("component").alias("grp"))
    placed = stored(members.join(groups, "node", "left").select("key", "node", F.coalesce("grp", "node").alias("grp")))
    roster = stored(placed.select("node", "grp").distinct().join(nodes.drop("first_doc", "text_hash"), "node"))
    sizes = stored(
        roster.groupBy("grp").agg(
            F.count(F.lit(1)).alias("n"), F.min("size").alias("low"), F.max("size").alias("high"), F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("long").alias("blocks")
        )
    )
    # Candidates across groups: in a bucket of several groups, a node meets every group larger than its own (ties: by id)
    # as a whole. A pair of nodes is met once, and a large group is one row, not one for each member.
    several = placed.groupBy("key").agg(F.min("grp").alias("one"), F.max("grp").alias("two")).where("one < two").select("key")
    mixed = placed.join(several, "key")
    hosts = mixed.select("key", "grp").distinct().join(sizes, "grp").select("key", F.col("grp").alias("host"), F.col("n").alias("n_host"), "low", "high")
    own = mixed.join(roster.select("node", "copies", "size"), "node").join(sizes.select("grp", "n"), "grp")
    cross = own.join(hosts, "key").where(
        (F.struct("n_host", "host") > F.struct("n", "grp"))
        # Sets whose sizes differ by more than the threshold allows can't be similar.
        & (F.col("size") >= THRESHOLD * F.col("low") - 1e-9)
        & (F.col("high") >= THRESHOLD * F.col("size") - 1e-9)
    )
    cross = stored(cross.select("node", "copies", "size", "host", "n_host").distinct())
    pairs = cross.where(F.col("n_host") <= FEW).join(
        roster.select(F.col("grp").alias("host"), F.col("node").alias("b"), F.col("copies").alias("copies_b"), F.col("size").alias("size_b")), "host"
    )
    pairs = pairs.where(F.least("size", "size_b") >= THRESHOLD * F.greatest("size", "size_b") - 1e-9)
    pairs = stored(pairs.select(F.col("node").alias("a"), "b", F.col("copies").alias("copies_a"), "copies_b"))
    guests = cross.where(F.col("n_host") > FEW).select("node", F.col("host").alias("grp"))
    guest_sizes = guests.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("long").alias("guest_blocks"))
    # One text for each node that is compared.
    grouped = roster.join(sizes.where("n > 1"), "grp").select("node", "grp", "blocks")
    needed = grouped.select("node").union(guests.select("node")).union(pairs.select("a")).union(pairs.select("b")).distinct()
    wanted = needed.join(nodes, "node").select("node", "copies", F.col("first_doc").alias("doc_id"), "text_hash")
    texts = docs.join(wanted, ["doc_id", "text_hash"]).groupBy("node").agg(F.max("copies").alias("copies"), F.min("text").alias("text"))
    # Nodes that only rows without an id hold are found by their n-grams; copies are reduced before the shuffle.
    nameless = docs.where("doc_id is null").mapInPandas(_with_node, "node long, text string").groupBy("node").agg(F.min("text").alias("text"))
    texts = stored(texts.unionByName(nameless.join(wanted.where("doc_id is null"), "node").select("node", "copies", "text")))
    # Groups in blocks of about BLOCK nodes, each compared with each, and with each block of guests.
    block = F.pmod(F.xxhash64("node", F.lit(SEED)), F.col("blocks"))
    to = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    members_in = (
        grouped.join(guest_sizes, "grp", "left")
        .withColumn("own", block)
        .withColumn("with", F.explode(to(F.col("blocks") + F.coalesce("guest_blocks", F.lit(0)))))
        .select(
            "node", "grp", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"),
            F.when(F.col("own") == F.col("with"), 2).when(F.col("own") < F.col("with"), 0).otherwise(1).alias("side"),
        )
    )
    guests_in = (
        guests.join(sizes, "grp")
        .join(guest_sizes, "grp")
        .withColumn("j", F.col("blocks") + F.pmod(F.xxhash64("node", F.lit(SEED)), F.col("guest_blocks")))
        .select("node", "grp", F.explode(to(F.col("blocks"))).alias("i"), "j", F.lit(1).alias("side"))
    )
    units = members_in.unionByName(guests_in).join(texts, "node")
    within = stored(units.groupBy("grp", "i", "j").applyInPandas(_compare_blocks, "node long, links long, root long"))
    pair_texts = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
    )
    across = stored(pair_texts.mapInPandas(_compare_pairs, "a long, b long, copies_a long, copies_b long").distinct())
    edges = within.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).union(across.select("a", "b"))
    classes = components(edges)
    links = (
        within.select("node", "links")
        .union(across.select("a", "copies_b"))
        .union(across.select("b", "copies_a"))
        .groupBy("node")
        .agg(F.sum("links").alias("links"))
    )
    # Nodes with anything to tell; all others are alone in their class.
    told = nodes.join(classes, "node", "left").join(links, "node", "left").where("copies > 1 or component is not null")
    told = told.select("node", "first_doc", "copies", F.coalesce("component", "node").alias("component"), F.coalesce("links", F.lit(0)).alias("links"))
    return signed, nodes, told


def near_classes(docs: DataFrame) -> DataFrame:
    """``(doc_id, class_id, n_links)``, one row per row of ``docs`` (doc_id, text)."""
    signed, _, told = _linked(docs)
    first = told.groupBy("component").agg(F.min("first_doc").alias("class_id"))
    told = stored(told.join(first, "component").select("node", "class_id", (F.col("copies") - 1 + F.col("links")).alias("n_links")))
    out = signed.select("doc_id", "node").join(told, "node", "left")
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each class, with its columns: the one with the smallest id (none: last), then node.

    Texts without a word are no near duplicates: they stay, one for each id and text, and all that have no id.
    """
    signed, nodes, told = _linked(docs)
    classes = nodes.join(told.select("node", "component"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    best = F.struct(F.col("first_doc").isNull().alias("nameless"), F.coalesce("first_doc", F.lit(0)).alias("id"), "node", "text_hash")
    first = classes.groupBy("component").agg(F.min(best).alias("best")).select("best.nameless", "best.id", "best.text_hash")
    wordless = signed.where("node is null").select(F.col("doc_id").isNull().alias("nameless"), F.coalesce("doc_id", F.lit(0)).alias("id"), "text_hash").distinct()
    wordless = stored(wordless)
    first = stored(first.unionByName(wordless.where("not nameless")))
    row = as_rows(docs)
    row = row.select("row", F.col("row.doc_id").isNull().alias("nameless"), F.coalesce("row.doc_id", F.lit(0)).alias("id"), F.xxhash64("row.text").alias("text_hash"))
    # Repeated rows are reduced before the shuffle.
    once = row.groupBy("nameless", "id", "text_hash").agg(F.first("row").alias("row")).join(first, ["nameless", "id", "text_hash"])
    others = row.where("nameless").join(wordless.where("nameless").select("text_hash"), "text_hash", "left_semi")
    return once.select("row.*").unionByName(others.select("row.*"))
