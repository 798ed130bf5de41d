"""WARC archives: writing, and reading back with boundary-chain verification.

Writing. Equal payloads are found by digest; of each group the record with the
largest page id is a ``response`` with the payload, the others are ``revisit`` records
that name it and carry no payload. Only (page id, digest) rows are shuffled for that.

Reading. Spark's text source splits the archive at the record magic, so every split
gives pieces that start at a *candidate* boundary: a true record, or the magic inside
some payload. Each piece emits its header's view of its successor: own offset +
header + Content-Length + record end. Per file, runs of pieces that point at the next
piece are folded into segments, and pointer jumping over the segments (doubling the
distance each round) marks what the file's first record reaches. Candidates that are
not reached are payload bytes. Pieces of a payload that itself holds the magic are
joined again for its digest: they are found in a second scan by file, size and content hash, which
don't depend on how either scan was split; equal pieces of a file are interchangeable.

Edge cases: null html is an empty payload; empty payloads are equal payloads like any
other; a null url is an empty target; line breaks and other control characters of a url
are percent-encoded; rows with equal page id and payload are all written, and all are
responses if that id is the group's largest; a null page id never refers, and is a response
only in a group of nulls; an empty table gives an archive without records and an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitline.llm.common import is_empty, only, shared_path, stored

# Fixed values of the format.
MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
ID_PREFIX = "urn:visitline:page:"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_BASE32HEX, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: Records per archive file at most, so that one file's offsets fit one task many times over.
RECORDS_PER_FILE = 100_000


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: each 5 hex digits (20 bits) are 4 base-32 digits."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*parts)), _BASE32HEX, _BASE32)


def _payloads(pages: DataFrame) -> DataFrame:
    pages = only(pages, "page_id", "url", "html").withColumn("html", F.coalesce("html", F.lit("")))
    return pages.withColumn("digest", base32_sha1(F.col("html").cast("binary")))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write one WARC record per page row below ``path`` (uncompressed, one archive per task and ``records_per_file``)."""
    rows = _payloads(pages)
    light = rows.where(F.octet_length("html") >= min_bytes).select("page_id", "digest")
    groups = light.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1")
    revisits = light.join(groups, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    revisits = stored(revisits.select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "refers_to").distinct())
    out = rows.join(revisits, rows["page_id"].eqNullSafe(revisits["_page"]) & (rows["digest"] == revisits["_digest"]), "left")
    out.select(_record().alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(path)


def _record() -> Column:
    size = F.octet_length("html").cast("string")
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    again = F.col("refers_to").isNotNull()
    url = F.coalesce("url", F.lit(""))
    for code in (*range(32), 127):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    head = F.concat(
        F.lit(MAGIC + "WARC-Type: "),
        F.when(again, "revisit").otherwise("response"),
        F.lit(f"\r\nWARC-Record-ID: <{ID_PREFIX}"),
        page,
        F.lit(">\r\nWARC-Target-URI: "),
        url,
        F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Payload-Digest: sha1:"),
        F.col("digest"),
        F.lit("\r\nX-Payload-Length: "),
        size,
        F.when(again, F.concat(F.lit(f"\r\nWARC-Refers-To: <{ID_PREFIX}"), F.col("refers_to").cast("string"), F.lit(f">\r\nWARC-Profile: {PROFILE}"))).otherwise(""),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.when(again, "0").otherwise(size),
        F.lit(END),
    )
    return F.when(again, head).otherwise(F.concat(head, F.col("html")))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What stands between two magics, in file order by ``(block, seq)``."""
    return (
        spark.read.option("lineSep", MAGIC)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
            "value",
        )
    )


def _content_hash() -> Column:
    return F.xxhash64("value")


def _field(name: str) -> Column:
    return F.regexp_extract("head", rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """One row per piece: its offset, and as a candidate record its header fields, digest and successor (null if it has no header)."""
    pieces = _pieces(spark, path)
    cut = F.locate(END, F.col("value"))
    pieces = pieces.withColumn("head", F.when(cut > 0, F.substring_index("value", END, 1)))
    n = F.octet_length("value").cast("long")
    pieces = pieces.select(
        "file", "block", "seq", _content_hash().alias("hash"), n.alias("size"), "head", F.octet_length("head").alias("head_size"), _field("Content-Length").try_cast("long").alias("content"), F.col("value").cast("binary").alias("raw")
    )
    start = F.col("head_size") + len(END)
    whole = F.col("size") >= start + F.col("content")
    light = pieces.select(
        "file",
        "block",
        "seq",
        "hash",
        "size",
        "content",
        (len(MAGIC) + start + F.col("content") + len(END)).alias("extent"),
        whole.alias("whole"),
        F.when(whole, base32_sha1(F.substring(F.col("raw"), start.cast("int") + 1, F.col("content").cast("int")))).alias("digest"),
        _field("WARC-Type").alias("type"),
        _field("WARC-Record-ID").alias("id"),
        _field("WARC-Refers-To").alias("refers"),
        _field("WARC-Payload-Digest").alias("said_digest"),
        _field("X-Payload-Length").try_cast("long").alias("said_size"),
        F.col("head_size"),
    )
    light = stored(light)
    in_file = Window.partitionBy("file").orderBy("block", "seq")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    pos = F.coalesce(F.sum(F.col("size") + len(MAGIC)).over(before), F.lit(0)) - len(MAGIC)
    return light.withColumn("pos", pos).withColumn("next", F.col("pos") + F.col("extent"))


def reachable(cands: DataFrame) -> DataFrame:
    """The pieces with ``owner``: the offset of the record they belong to, found by following the chain from offset 0."""
    in_file = Window.partitionBy("file").orderBy("pos")
    linked = F.coalesce(F.lag("next").over(in_file) == F.col("pos"), F.lit(False))
    runs = cands.withColumn("_break", (~linked).cast("long"))
    runs = stored(runs.withColumn("seg", F.sum("_break").over(in_file.rowsBetween(Window.unboundedPreceding, 0))).drop("_break"))
    ends = runs.groupBy("file", "seg").agg(F.max_by("next", "pos").alias("exit"), F.min("pos").alias("first"))
    doors = runs.select("file", F.col("pos").alias("exit"), F.col("seg").alias("to"))
    # jump: segment -> (segment that its last record leads to, offset of entry there); several records lead on per round.
    jump = stored(ends.join(doors, ["file", "exit"]).select("file", "seg", "to", "exit"))
    reach = runs.where("pos = 0").select("file", "seg", F.col("pos").alias("entry"))
    while not is_empty(jump):
        reach = stored(reach)
        step = reach.join(jump, ["file", "seg"]).select("file", F.col("to").alias("seg"), F.col("exit").alias("entry"))
        new = step.join(reach.select("file", "seg"), ["file", "seg"], "left_anti")
        if is_empty(new):
            break
        reach = reach.unionByName(new)
        far = jump.select("file", F.col("seg").alias("to"), F.col("to").alias("_to"), F.col("exit").alias("_exit"))
        jump = stored(jump.join(far, ["file", "to"]).select("file", "seg", F.col("_to").alias("to"), F.col("_exit").alias("exit")))
        # The last entry into a segment found so far stays valid: a chain enters a segment once.
    reach = reach.select("file", "seg", "entry")
    marked = runs.join(reach, ["file", "seg"], "left")
    record = F.when(F.col("pos") >= F.col("entry"), F.col("pos"))
    return marked.withColumn("owner", F.last(record, ignorenulls=True).over(in_file)).drop("entry", "seg")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``(file, pos, type, id, refers, said_digest, said_size, content, digest)`` of every true record below ``path``."""
    chain = stored(reachable(candidates(spark, path)))
    records = chain.where(F.col("pos") == F.col("owner"))
    parted = records.where(~F.col("whole")).select("file", F.col("pos").alias("owner"), "head_size", F.col("content").alias("_content"))
    # Written first: Spark then knows its size, and while it is small no payload is shuffled to find the few pieces.
    parts = stored(chain.select("file", "pos", "size", "hash", "owner").join(parted, ["file", "owner"]))
    found = _pieces(spark, path).select("file", F.octet_length("value").cast("long").alias("size"), _content_hash().alias("hash"), "value")
    found = found.join(parts.select("file", "size", "hash").distinct(), ["file", "size", "hash"]).groupBy("file", "size", "hash").agg(F.first("value").alias("value"))
    text = parts.join(found, ["file", "size", "hash"])
    text = text.groupBy("file", "owner", "head_size", "_content").agg(F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("_parts"))
    joined = F.array_join(F.col("_parts")["value"], MAGIC).cast("binary")
    payload = F.substring(joined, F.col("head_size") + len(END) + 1, F.col("_content").cast("int"))
    ok = F.octet_length(payload) == F.col("_content")
    rebuilt = text.select("file", F.col("owner").alias("pos"), F.when(ok, base32_sha1(payload)).alias("_digest"))
    out = records.join(rebuilt, ["file", "pos"], "left")
    return out.select(
        "file", "pos", "type", "id", "refers", F.regexp_replace("said_digest", "^sha1:", "").alias("said_digest"), "said_size", "content", F.coalesce("digest", "_digest").alias("digest")
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives, read them back: one row per record.

    The digest of a response is computed from the payload that was read, and must equal
    the one in its header; a revisit's figures are those of its header.
    """
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    write_archives(pages, path)
    records = read_archives(spark, path)
    number = lambda c: F.regexp_extract(c, rf"<{ID_PREFIX}(-?\d+)>", 1).try_cast("long")
    response = F.col("type") == "response"
    bad = response & ~((F.col("digest") == F.col("said_digest")) & (F.col("content") == F.col("said_size")))
    checked = F.when(F.coalesce(bad, F.lit(True)), F.raise_error(F.concat(F.lit("damaged record "), F.col("id")))).otherwise(
        F.when(response, F.col("digest")).otherwise(F.col("said_digest"))
    )
    return records.select(
        number("id").alias("page_id"),
        F.when(response, F.col("content")).otherwise(F.col("said_size")).alias("payload_bytes"),
        checked.cast("string").alias("payload_digest"),
        F.col("type").alias("record_type"),
        number("refers").alias("refers_to"),
    )


WARC_SQL = """
with p as (
  select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, sha1(coalesce(html, '')) as h from pages
), d as (
  select *, array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0],
    lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((('0x' || substr(h, 1 + 5 * i, 5))::bigint) >> k) & 31)::int, 1)), '')), '') as payload_digest
  from p
), m as (
  select *, max(page_id) over (partition by payload_digest) as top from d
)
select page_id, payload_bytes, payload_digest, case when page_id is not distinct from top then 'response' else 'revisit' end as record_type,
       case when page_id is not distinct from top then null else top end as refers_to
from m
"""
