"""I-Match document fingerprints.

A corpus pass counts in how many documents each term occurs. The lexicon keeps the
terms within a chosen band of inverse document frequency: neither so common that they
say nothing, nor so rare that a typing slip makes them. A document's distinct lexicon
terms are sorted and hashed, once for each of several randomised lexicon subsets; the
fingerprint is the list of these hashes.

The lexicon's size is bounded by the band, not by the corpus: a term in at least a share
``LOW`` of the documents takes ``LOW`` of the corpus's (document, distinct term) pairs,
so there are at most (distinct terms of an average document) / ``LOW`` of them. It is
handed to the tasks as one constant. Texts are fingerprinted in narrow DataFrame
expressions: no text is exploded into rows or shuffled for it.

The next document is found in blocks of neighbouring rows, bounded in bytes: rows of one
repeated or missing doc_id are parted by a hash of their text, and equal rows that alone
would fill a block are counted before texts are shuffled. The blocks' first keys are one
constant, about 40 bytes for each ``BLOCK_BYTES`` of text.

Edge cases: a null text is empty; a document without a lexicon term is fingerprinted by
all its distinct terms; an empty text has a fingerprint without any hash, alike (1.0) only
to another empty one; equal texts have equal fingerprints; rows with equal doc_id are
ordered by a hash of their text, descending, so the next document of a repeated row is
its copy (but for the last copy); a null doc_id comes last; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitline.llm.common import only, stored

LOW, HIGH = 0.01, 0.2
SUBSETS = 32
#: Neighbouring rows that meet in one task hold about this many bytes of text.
BLOCK_BYTES = 128 << 20
#: Copies of one row that one task writes out.
RUN = 10_000
_HEX = 8
_NONE = "-" * _HEX
_SHELVES = 4096


def terms(text: Column) -> Column:
    """Distinct lower-case runs of letters and digits."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+")), "")


def build_lexicon(texts: DataFrame, low: float = LOW, high: float = HIGH) -> list[str]:
    """The sorted terms in at least a share ``low`` and at most a share ``high`` of the documents ``(text)``."""
    n = texts.count()
    counts = texts.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(F.lit(float(max(n, 1))) / F.col("df"))
    band = counts.where((idf >= math.log(1 / high) - 1e-9) & (idf <= math.log(1 / low) + 1e-9))
    return sorted(r["term"] for r in band.select("term").collect())


def _shelf(term: Column) -> Column:
    return F.pmod(F.hash(term), F.lit(_SHELVES))


def lexicon_column(spark, lexicon: list[str]) -> Column:
    """The lexicon as a constant array of shelves; a term's shelf is `` term term ... ``."""
    shelved = spark.createDataFrame([(t,) for t in lexicon], "term string") if lexicon else None
    shelves = [""] * _SHELVES
    if shelved is not None:
        for r in shelved.groupBy(_shelf(F.col("term")).alias("k")).agg(F.array_join(F.sort_array(F.collect_list("term")), " ").alias("t")).collect():
            shelves[r["k"]] = f" {r['t']} "
    return F.split(F.lit("\n".join(shelves)), "\n")


def fingerprint(text: Column, shelves: Column, subsets: int = SUBSETS) -> Column:
    """``subsets`` hashes of 8 hex digits in one string; ``--------`` for a subset without a term of the text."""
    distinct = terms(text)
    kept = F.filter(distinct, lambda t: F.contains(F.element_at(shelves, _shelf(t) + 1), F.concat(F.lit(" "), t, F.lit(" "))))
    used = F.when(F.size(kept) > 0, kept).otherwise(distinct)
    # Each term is in one randomised subset; sorting "subset term" beside one mark per subset puts every
    # subset's sorted terms between two marks, where one split finds them.
    placed = F.transform(used, lambda t: F.concat(F.lpad(F.pmod(F.xxhash64(t), F.lit(subsets)).cast("string"), 3, "0"), F.lit("_"), t))
    marks = F.array(*[F.lit(f"{i:03d}!") for i in range(subsets)])
    line = F.array_join(F.array_sort(F.concat(placed, marks)), " ")
    parts = F.slice(F.split(line, r"(?:^| )\d{3}!"), F.lit(2), F.lit(subsets))
    hashed = F.transform(parts, lambda p: F.when(p == "", F.lit(_NONE)).otherwise(F.lower(F.lpad(F.hex(F.xxhash64(p)), _HEX, "0")).substr(1, _HEX)))
    return F.array_join(hashed, "")


def likeness(a: Column, b: Column, subsets: int = SUBSETS) -> Column:
    """Of the subsets in which either text has a term, the share with equal hashes (two texts without any: 1.0)."""
    at = F.sequence(F.lit(0), F.lit(subsets - 1))
    piece = lambda c, i: c.substr(i * _HEX + 1, F.lit(_HEX))
    either = F.size(F.filter(at, lambda i: (piece(a, i) != _NONE) | (piece(b, i) != _NONE)))
    both = F.size(F.filter(at, lambda i: (piece(a, i) != _NONE) & (piece(a, i) == piece(b, i))))
    return F.when(a == b, 1.0).when(either > 0, both / either).otherwise(0.0)


def order_key(doc_id: Column, text: Column) -> Column:
    """Text that ascends as rows descend by doc_id (null last), rows of one id by a hash of their text."""
    down = lambda c: F.lpad(F.hex(c.bitwiseXOR(F.lit((1 << 63) - 1))), 16, "0")
    id_ = F.when(doc_id.isNull(), F.lit("1" + "0" * 16)).otherwise(F.concat(F.lit("0"), down(doc_id)))
    return F.concat(id_, down(F.xxhash64(text)))


def block_bounds(keys: DataFrame, limit: int = BLOCK_BYTES) -> tuple[list[str], list[str]]:
    """The first keys of blocks of neighbouring rows ``(_key, _bytes)``, and the keys that alone fill a block.

    A block holds at most ``limit`` bytes besides its last key's rows (less on small tables, so that all cores have
    several). Each list has one entry per block or fewer: about 40 bytes for every ``limit`` bytes of the table.
    """
    keys = stored(keys.groupBy("_key").agg(F.sum("_bytes").alias("_bytes"), F.count(F.lit(1)).alias("_n")))
    total = keys.agg(F.sum("_bytes")).first()[0] or 0
    limit = max(1, min(limit, total // (16 * keys.sparkSession.sparkContext.defaultParallelism)))
    # Ranges of keys, then running sums within each: a range's first key always starts a block.
    ranged = keys.repartitionByRange("_key").withColumn("_part", F.spark_partition_id())
    before = F.sum("_bytes").over(Window.partitionBy("_part").orderBy("_key")) - F.col("_bytes")
    placed = ranged.withColumn("_block", F.floor(before / limit))
    firsts = placed.groupBy("_part", "_block").agg(F.min("_key").alias("_key")).select("_key").collect()
    full = keys.where((F.col("_bytes") > limit) & (F.col("_n") > 1)).select("_key").collect()
    return sorted(r[0] for r in firsts), sorted(r[0] for r in full)


def _find(key: Column, bounds: list[str]) -> tuple[Column, Column]:
    """The number of the last bound at or below ``key``, looked up in two steps, and that bound."""
    width = max(1, math.isqrt(len(bounds)))
    rows = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    table = F.from_json(F.lit(json.dumps(rows)), "array<array<string>>")
    firsts = F.from_json(F.lit(json.dumps([r[0] for r in rows])), "array<string>")
    row = F.greatest(F.size(F.filter(firsts, lambda b: b <= key)), F.lit(1))
    here = F.element_at(table, row)
    within = F.greatest(F.size(F.filter(here, lambda b: b <= key)), F.lit(1))
    return (row - 1) * width + within - 1, F.element_at(here, within)


def merge_copies(docs: DataFrame, full: list[str]) -> DataFrame:
    """``docs`` (doc_id, text, _key) with ``copies``: equal rows whose key alone fills a block become one row, before any shuffle of texts."""
    if not full:
        return docs.withColumn("copies", F.lit(1).cast("long"))
    once = docs.where(F.col("_key").isin(full)).groupBy("doc_id", "text", "_key").agg(F.count(F.lit(1)).alias("copies"))
    return docs.where(~F.col("_key").isin(full)).withColumn("copies", F.lit(1).cast("long")).unionByName(once)


def with_next(docs: DataFrame, bounds: list[str], *columns: str) -> DataFrame:
    """``docs`` (_key, copies, ...) with ``next_<column>`` of the next row by ``_key``; the last row's next is the first.

    Rows are dealt to blocks of neighbouring keys; the first row of every block is also sent to the block before it.
    One shuffle, no global sort in one task. Of several copies only the last has another row's columns: a merged row
    becomes two, one for that copy and one for the others.
    """
    if not bounds:
        return docs.select("*", *[F.col(c).alias(f"next_{c}") for c in columns])
    block, first = _find(F.col("_key"), bounds)
    docs = docs.withColumn("_block", block.cast("int")).withColumn("_first", first == F.col("_key"))
    own = F.struct(F.col("_block").alias("b"), F.lit(0).alias("extra"))
    extra = F.struct(F.pmod(F.col("_block") - 1, F.lit(len(bounds))).alias("b"), F.lit(1).alias("extra"))
    dealt = docs.withColumn("_at", F.explode(F.when(F.col("_first"), F.array(own, extra)).otherwise(F.array(own))))
    dealt = dealt.withColumn("_b", F.col("_at.b")).withColumn("_extra", F.col("_at.extra")).drop("_at", "_block", "_first")
    w = Window.partitionBy("_b").orderBy("_extra", "_key")
    for c in columns:
        dealt = dealt.withColumn(f"next_{c}", F.lead(c).over(w))
    last = F.struct(F.lit(1).cast("long").alias("copies"), F.lit(False).alias("same"))
    others = F.struct((F.col("copies") - 1).alias("copies"), F.lit(True).alias("same"))
    split = F.explode(F.when(F.col("copies") > 1, F.array(last, others)).otherwise(F.array(last)))
    dealt = dealt.where("_extra = 0").withColumn("_split", split)
    dealt = dealt.withColumns({f"next_{c}": F.when(F.col("_split.same"), F.col(c)).otherwise(F.col(f"next_{c}")) for c in columns})
    return dealt.withColumn("copies", F.col("_split.copies")).drop("_split", "_b", "_extra", "_key")


def expand(rows: DataFrame) -> DataFrame:
    """Each row ``copies`` times, dealt to tasks in runs of at most ``RUN``."""
    run = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / RUN)))
    runs = rows.withColumn("_run", run).withColumn("_n", F.least(F.lit(RUN), F.col("copies") - F.col("_run") * RUN).cast("int"))
    runs = runs.repartition(*[F.col(c) for c in ("doc_id", "_run")])
    return runs.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n")))).drop("_i", "_n", "_run", "copies")


def edited_text(text: Column, following: Column) -> Column:
    """The last floor(n/2) code points replaced by the first as many (or all) of the following text."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(text.substr(F.lit(1), F.char_length(text) - half), following.substr(F.lit(1), half))


def fingerprints(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The registered result: one row per document."""
    spark = docs.sparkSession
    docs = only(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    shelves = lexicon_column(spark, build_lexicon(docs))
    docs = docs.withColumn("_key", order_key(F.col("doc_id"), F.col("text")))
    bounds, full = block_bounds(docs.select("_key", (F.octet_length("text") + 64).cast("long").alias("_bytes")), block_bytes)
    docs = merge_copies(docs, full).withColumn("fingerprint", fingerprint(F.col("text"), shelves))
    pairs = with_next(docs, bounds, "text", "fingerprint")
    pairs = pairs.withColumn("_edited", edited_text(F.col("text"), F.col("next_text")))
    out = pairs.select(
        "doc_id",
        "copies",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("_edited", 256).alias("edited_sha256"),
        "fingerprint",
        "next_fingerprint",
        fingerprint(F.col("_edited"), shelves).alias("edited_fingerprint"),
    )
    out = expand(out) if full else out.drop("copies")
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
