"""Best-fit packing of tokenised documents, with certified bin counts.

Every document becomes token ids plus an end id, and is cut only where it is longer than a
sequence. Pieces are dealt to groups of about ``GROUP`` by a hash; each group is packed by
best-fit decreasing. Dual-feasible functions give a lower bound on the group's sequences: a
group that meets its bound is certified optimal and is left alone. From the groups with a gap,
the pieces of all sequences that are not full are exchanged: dealt anew across those groups and
packed again, and the new packing is taken where it needs fewer sequences. Rounds end when there
is no gap, or an exchange doesn't help.

Only (piece number, length) rows are packed; a group is bounded, and no document's text moves.

Edge cases: a null or empty text is one piece holding the end id; repeated rows are packed each; a
null doc_id is packed like any other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitline.llm.common import only, stored

CAPACITY, END_ID = 4096, 1
GROUP = 16_384
TOKENIZER = "word_bpe_49k.json"
#: Words that a worker keeps, and the longest of them in characters: at most about 200 bytes each.
_CACHE, _LONGEST = 1_000_000, 32

#: Texts of these characters alone are split into words here, with the tokenizer's own rule; others go to it whole.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-įı-ž]*")
# Fixed value: the tokenizer file's splitting pattern, for lower-cased texts of those characters.
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ž]+|[0-9²³¹¼-¾]|[^\sa-zªµºß-öø-ž0-9²³¹¼-¾]+")
_SPECIAL = ("<|startoftext|>", "<|endoftext|>")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Words(dict):
    """Ids of a word, as unsigned 32-bit bytes, found at its first lookup."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        if len(word) <= _LONGEST:
            if len(self) >= _CACHE:
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """``tokenizers`` ids of whole texts; the ids of a word are looked up once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = _Words(self.tokenizer)

    def encode(self, text: str) -> bytes:
        """Ids as unsigned 32-bit bytes."""
        if not _PLAIN.fullmatch(text) or any(s in text for s in _SPECIAL):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.words.__getitem__, _SPLIT.findall(text.lower())))

    def __call__(self, text: str) -> list[int]:
        return list(memoryview(self.encode(text)).cast("I"))


def worker_encoder(path: str) -> Encoder:
    """The encoder of this Python worker: Spark reuses workers, so later tasks find the words of earlier ones.

    Functions come to a worker by value with globals of their own, so it is kept as a module of the process.
    """
    name = f"visitline_encoder:{path}"
    if name not in sys.modules:
        holder = ModuleType(name)
        holder.encoder = Encoder(path)
        sys.modules[name] = holder
    return sys.modules[name].encoder


def tokenised_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """``(uid, doc_id, piece, start, length, ids_crc32)``, written once. ``tokenizer``: path of the file (default: that of the installed package)."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = worker_encoder(tokenizer or tokenizer_path()).encode
        end, width = array("I", [END_ID]).tobytes(), 4 * capacity
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"], b["text"], strict=True):
                ids = encode(text or "") + end
                for piece, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            got = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield got.astype({"doc_id": "Int64"})

    pieces = only(docs, "doc_id", "text").mapInPandas(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")
    return stored(pieces.withColumn("uid", F.monotonically_increasing_id()))


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """The best of several dual-feasible functions: no packing needs fewer bins."""
    return bound_of_counts(np.bincount(lengths, minlength=capacity + 1).astype(np.int64), capacity) if len(lengths) else 0


def bound_of_counts(counts: np.ndarray, capacity: int = CAPACITY) -> int:
    """``lower_bound`` of ``counts[length]`` items of each length."""
    x = np.arange(capacity + 1)
    best = -(-int((counts * x).sum()) // capacity)
    # Small items rounded to 0, large ones to a whole bin.
    for eps in np.flatnonzero(counts[: capacity // 2 + 1]):
        if eps:
            f = np.where(x > capacity - eps, capacity, np.where(x < eps, 0, x))
            best = max(best, -(-int((counts * f).sum()) // capacity))
    # Sizes rounded down to multiples of 1 / k, in units of 1 / (k capacity).
    for k in range(1, 33):
        f = np.where(x * (k + 1) % capacity == 0, x * k, x * (k + 1) // capacity * capacity)
        best = max(best, -(-int((counts * f).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Each item's bin: longest first, into the fullest bin that has room."""
    out = np.zeros(len(lengths), np.int64)
    open_: dict[int, list[int]] = {}  # room -> bins
    rooms: list[int] = []  # sorted, each once
    bins = 0
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        at = bisect_left(rooms, size)
        if at == len(rooms):
            b, room, bins = bins, capacity, bins + 1
        else:
            room = rooms[at]
            b = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(at)
        out[i] = b
        if room > size:
            left = room - size
            if left not in open_:
                open_[left] = []
                insort(rooms, left)
            open_[left].append(b)
    return out


def corpus_bound(pieces: DataFrame, capacity: int = CAPACITY) -> int:
    """The least number of sequences that any packing of all ``pieces`` (length) needs; one count per length comes to the driver."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").agg(F.count(F.lit(1))).collect():
        counts[length] = n
    return bound_of_counts(counts, capacity)


_PACKED = "uid long, length long, grp long, bin long, free long, bins long, bound long"


def _pack(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("uid", kind="stable").reset_index(drop=True)
    lengths = rows["length"].to_numpy()
    bins = best_fit_decreasing(lengths)
    fill = np.bincount(bins, weights=lengths).astype(np.int64)
    return rows.assign(bin=bins, free=CAPACITY - fill[bins], bins=len(fill), bound=lower_bound(lengths))[["uid", "length", "grp", "bin", "free", "bins", "bound"]]


def _dealt(rows: DataFrame, n: int, seed: int) -> DataFrame:
    groups = max(1, -(-n // GROUP))
    return rows.select("uid", "length", F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(groups)).alias("grp"))


def pack(pieces: DataFrame, rounds: int | None = None) -> DataFrame:
    """``(uid, sequence_id, offset, group_bins, group_bound)`` of every piece ``(uid, length)``.

    ``group_bins`` is how many sequences the piece's group took when the piece was placed for good, ``group_bound`` the least it
    could have taken: equal numbers certify the group.
    """
    n = pieces.count()
    packed = stored(_dealt(pieces, n, 0).groupBy("grp").applyInPandas(_pack, _PACKED))
    settled, number = [], 0
    while rounds is None or number < rounds:  # each exchange that goes on saves a sequence, so this ends
        number += 1
        pool = packed.where((F.col("bins") > F.col("bound")) & (F.col("free") > 0))
        size = pool.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("grp", "bin").alias("bins"), F.countDistinct("grp").alias("grps")).first()
        if not size["n"] or (size["grps"] == 1 and number > 1):
            break
        again = stored(_dealt(pool, size["n"], number).groupBy("grp").applyInPandas(_pack, _PACKED))
        if again.select("grp", "bin").distinct().count() >= size["bins"]:
            break
        # Full sequences and certified groups stay as they are; the exchanged pieces go on.
        settled.append((number - 1, packed.where((F.col("bins") <= F.col("bound")) | (F.col("free") == 0))))
        packed = again
    settled.append((number, packed))
    out = None
    for number, rows in settled:
        one = rows.select("uid", "length", (F.lit(number << 48) + F.shiftleft("grp", 20) + F.col("bin")).alias("sequence_id"), F.col("bins").alias("group_bins"), F.col("bound").alias("group_bound"))
        out = one if out is None else out.unionByName(one)

    before = Window.partitionBy("sequence_id").orderBy("uid").rowsBetween(Window.unboundedPreceding, -1)
    return out.select("uid", "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset"), "group_bins", "group_bound")


def packed_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The registered result: one row per piece."""
    pieces = tokenised_pieces(docs, tokenizer)
    return pieces.join(pack(pieces.select("uid", "length")), "uid").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "group_bins", "group_bound"
    )
