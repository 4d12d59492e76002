"""WARC archives: written from pages with revisits of equal payloads, and read back by verified record chains.

Writing.  Each task writes one archive, a row per record; the blank lines
that end a record are the row separator.  Payloads are grouped by
their SHA-256.  Of equal payloads of at least ``least_bytes`` bytes the one
with the largest page id (then url) is the response, the others revisit
it: they carry its digest, its length and its record id, but no payload.

Reading by boundary chains.  Archives are read in splits, cut at the
version line that opens every record.  A cut is only a candidate: payloads
may hold version lines, even whole records.

1. Candidates.  A task gives for each cut its length and, from its headers,
   how long the record would be; sums over the splits of a file make both
   absolute offsets: a candidate and its successor.
2. Runs.  Neighbours in a split that follow on each other merge into one
   link of the chain, unless a longer jump enters there.
3. Pointer jumping.  From the start of each file, the links reached double
   each round, until the doubled jumps lead past the longest chain.  What is not reached was
   inside a payload (or behind damage: a chain ends where a record's length
   leads to no record).
4. Records.  A reached candidate as long as its headers say is a whole
   record.  Where a payload held version lines, its pieces are read again
   and joined in order.

Null html is the empty payload; null urls and ids stay null; repeated rows
are one record each (of equal rows one is the response); control
characters of a url are percent-encoded; an empty table gives an
empty result; other columns are not read.  Ids are integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillscope.llm.common import saved
from tillscope.llm.vectors import with_groups
from tillscope.session import scratch_path

# --- fixed values: the archive format ---
VERSION = "WARC/1.1\r\n"
BLANK = "\r\n\r\n"  # ends the headers; two line ends also end a record
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: links may be broadcast up to this many (about 100 bytes each)
BROADCAST_LINKS = 500_000


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: four times ten hex digits are eight base-32 digits."""
    digits = [F.lpad(F.conv(F.substring(F.sha1(payload), 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _header(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _record(url: Column, page_id: Column, payload: Column, n_bytes: Column, digest: Column, response: Column, key: Column, top: Column) -> Column:
    """A record's text without the blank lines that end it; ``key``: null for payloads that are not grouped, ``top``: the group's response."""
    name = lambda page, last: F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), last, F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), n_bytes.cast("string"), F.lit(BLANK))
    block = F.when(response, F.concat(http, payload)).otherwise(http)
    # the encoded characters are few and listed one by one, so that the url stays as it is elsewhere
    safe = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit(VERSION), F.lit("WARC-Type: "), F.when(response, F.lit("response")).otherwise(F.lit("revisit")), F.lit("\r\n"),
        _header("WARC-Record-ID", name(page_id, F.when(response & key.isNotNull(), key).otherwise(F.uuid()))),
        _header("WARC-Target-URI", safe),
        _header("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.when(response, F.lit("")).otherwise(F.concat(_header("WARC-Refers-To", name(top, key)), F.lit(f"WARC-Profile: {PROFILE}\r\n"))),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(BLANK), block)


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """One record per row, in archives under ``path``."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).alias("payload"))
    n_bytes = F.octet_length("payload").cast("long")
    rows = rows.withColumns({"n_bytes": n_bytes, "key": F.when(n_bytes >= least_bytes, F.sha2("payload", 256))})
    same = rows.where("key is not null").groupBy("key", "page_id", "url").agg(F.count("*").alias("c"))
    groups = saved(same.groupBy("key").agg(F.max(F.struct("page_id", "url", "c")).alias("top"), F.sum("c").alias("n")).where("n > 1"), "payload-groups")
    grouped = with_groups(rows, groups, "key", F.xxhash64("page_id", "url"))
    is_top = F.col("page_id").eqNullSafe(F.col("top.page_id")) & F.col("url").eqNullSafe(F.col("top.url"))
    # equal rows that are their group's response: one of them is, the others revisit it
    copies = F.col("top").isNotNull() & is_top & (F.col("top.c") > 1)
    if groups.where("top.c > 1").isEmpty():
        records = grouped.withColumn("response", F.col("top").isNull() | is_top)
    else:
        one = grouped.where(copies).groupBy("key", "page_id", "url", "n_bytes", "n", "top").agg(F.first("payload").alias("payload")).select(grouped.columns)
        more = one.withColumn("payload", F.lit("")).select("*", F.explode(F.sequence(F.lit(2).cast("long"), F.col("top.c"))).alias("copy"))
        digests = saved(one.select("key", base32_sha1(F.col("payload")).alias("digest")), "digests")
        again = more.repartition("key", "copy").join(digests, "key").withColumn("response", F.lit(False)).drop("copy")
        records = grouped.where(~copies).withColumn("response", F.col("top").isNull() | is_top).unionByName(
            one.withColumn("response", F.lit(True))).withColumn("digest", F.lit(None).cast("string")).unionByName(again)
    digest = F.coalesce("digest", base32_sha1(F.col("payload"))) if "digest" in records.columns else base32_sha1(F.col("payload"))
    key = F.when(F.col("top").isNotNull(), F.col("key"))
    records.select(_record(F.col("url"), F.col("page_id"), F.col("payload"), F.col("n_bytes"), digest, F.col("response"), key, F.col("top.page_id"))).write.option(
        "lineSep", BLANK).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, split, seq (order within a split), value (what follows a version line, up to the next or the end)."""
    return spark.read.option("lineSep", VERSION).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("seq"), "value")


def _field(headers: str, name: str) -> Column:
    found = F.regexp_extract(headers, rf"(?im)^{name}:[ \t]*([^\r\n]*?)[ \t]*$", 1)
    return F.when(found != "", found)


RECORD = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]


def _parsed(pieces: DataFrame) -> DataFrame:
    """``pieces`` (value, ...) with the fields of a record in place of ``value``; ``n_record`` is its length behind the version line by its headers."""
    others = [c for c in pieces.columns if c != "value"]
    size = F.octet_length("value")
    cut = pieces.withColumn("headers", F.substring_index("value", BLANK, 1)).withColumn(
        "block", F.substring(F.col("value").cast("binary"), F.octet_length("headers") + 5, size - F.octet_length("headers") - 8)).withColumn(
        "http", F.substring_index(F.col("block").cast("string"), BLANK, 1))
    read = cut.select(
        *others, "http", "block",
        F.when(F.octet_length("headers") < size, F.octet_length("headers") + F.lit(8).cast("long") + _field("headers", "Content-Length").try_cast("long")).alias("n_record"),
        size.alias("size"), F.endswith("value", F.lit(BLANK)).alias("ended"),
        _field("headers", "WARC-Record-ID").alias("id"), _field("headers", "WARC-Target-URI").alias("url"), _field("headers", "WARC-Type").alias("record_type"),
        _field("headers", "WARC-Refers-To").alias("refers_to"), F.regexp_replace(_field("headers", "WARC-Payload-Digest"), "^sha1:", "").alias("stated"))
    whole = read.withColumn("whole", F.coalesce((F.col("n_record") == F.col("size")) & F.col("ended"), F.lit(False))).withColumn(
        "payload", F.when(F.col("whole") & (F.col("record_type") == "response"), F.substring(F.col("block"), F.octet_length("http") + 5, F.octet_length("block"))))
    page = lambda name: F.regexp_extract(name, r"^<urn:page:(-?\d*):", 1).try_cast("long").alias("page_id" if name == "id" else name)
    stated = F.col("payload").isNull()
    return whole.select(
        *others, "n_record", "whole", page("id"), "url", "record_type", page("refers_to"),
        F.when(stated, _field("http", "Content-Length").try_cast("long")).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(stated, F.col("stated")).otherwise(base32_sha1(F.col("payload"))).alias("payload_digest"))


def _placed(pieces: DataFrame) -> DataFrame:
    """``pieces`` (file, split, seq, n_bytes, ...) with ``start``, the offset of their version line in the file."""
    taken = F.col("n_bytes") + F.lit(len(VERSION))
    splits = pieces.groupBy("file", "split").agg(F.sum(taken).alias("bytes"))
    base = splits.select("file", "split", (F.coalesce(F.sum("bytes").over(
        Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - len(VERSION)).alias("base"))
    inside = F.sum(taken).over(Window.partitionBy("file", "split").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    return pieces.withColumn("start", F.coalesce(inside, F.lit(0))).join(base, ["file", "split"]).withColumn("start", F.col("start") + F.col("base")).drop("base")


def _small(df: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if its counted rows allow it."""
    return F.broadcast(df) if df.count() <= BROADCAST_LINKS else df


def reached(links: DataFrame, start: int = 0) -> DataFrame:
    """(file, a) of the links that a chain from the start of their file reaches; ``links``: file, a, b (a's successor, null: none)."""
    known = links.where(F.col("a") == start).select("file", "a")
    jumps = saved(links.select("file", "a", "b").join(links.select("file", F.col("a").alias("b")), ["file", "b"]), "jumps")
    while not jumps.isEmpty():
        stepped = known.join(jumps, ["file", "a"]).select("file", F.col("b").alias("a"))
        known = saved(known.unionByName(stepped).distinct(), "reached")
        jumps = saved(jumps.join(jumps.select("file", F.col("a").alias("b"), F.col("b").alias("c")), ["file", "b"]).select("file", "a", F.col("c").alias("b")), "jumps")
    return known


def _chained(candidates: DataFrame) -> DataFrame:
    """The candidates that the chains from the starts of their files reach; ``candidates``: file, split, seq, start, n_bytes, n_record, ..."""
    version = F.lit(len(VERSION))
    order = Window.partitionBy("file", "split").orderBy("start")
    nodes = candidates.withColumn("end", F.col("start") + version + F.col("n_record"))
    nodes = saved(nodes.withColumn("_next", F.lead("start").over(order)).withColumn("_follows", F.coalesce(F.lag("end").over(order) == F.col("start"), F.lit(False))), "candidates")
    entered = saved(nodes.where(F.col("end").isNotNull() & (F.col("_next").isNull() | (F.col("end") != F.col("_next")))).select(
        "file", F.col("end").alias("start")).distinct().withColumn("_entered", F.lit(True)), "entered")
    marked = nodes.join(_small(entered), ["file", "start"], "left")
    run = F.sum(F.when(F.col("_follows") & F.col("_entered").isNull(), 0).otherwise(1)).over(order)
    runs = saved(marked.withColumn("run", run).drop("_next", "_follows", "_entered"), "runs")
    links = saved(runs.groupBy("file", "split", "run").agg(F.min("start").alias("a"), F.max_by("end", "start").alias("b")), "links")
    kept = links.join(reached(links), ["file", "a"], "left_semi").select("file", "split", "run")
    return runs.join(_small(saved(kept, "kept-links")), ["file", "split", "run"], "left_semi").drop("run")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest, file, start of every verified record.

    The digest of a response is computed from the payload as read; a
    revisit states its payload's digest and length in its headers.
    """
    scanned = saved(_parsed(_pieces(spark, path).withColumn("n_bytes", F.octet_length("value").cast("long"))), "pieces")
    # what stands before the first version line of a file starts before the file does: no record
    found = saved(_chained(_placed(scanned).where("start >= 0")), "chain")
    whole = found.where("whole").select(*RECORD, "file", "start")
    broken = saved(found.where("not whole and n_record is not null").select("file", "start", "end"), "broken-records")
    if broken.isEmpty():
        return whole
    # payloads with version lines inside: their files are read again, and the pieces of each such record are joined in order
    files = F.broadcast(broken.select("file").distinct())
    raw = saved(_pieces(spark, path).join(files, "file", "left_semi").withColumn("n_bytes", F.octet_length("value").cast("long")), "raw-pieces")
    places = _placed(raw.select("file", "split", "seq", "n_bytes"))
    marks = places.select("file", "start", "seq").join(broken, ["file", "start"], "left").withColumn(
        "_at", F.when(F.col("end").isNotNull(), F.struct("start", "end")))
    covered = marks.withColumn("_in", F.max("_at").over(Window.partitionBy("file").orderBy("start"))).where(
        F.col("start") < F.col("_in.end")).select("seq", "start", F.col("_in.start").alias("record"))
    parts = raw.join(saved(covered, "covered"), "seq").groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("start", "value"))).alias("parts"))
    joined = parts.select("file", F.col("record").alias("start"), F.array_join(F.col("parts.value"), VERSION).alias("value"))
    return whole.unionByName(saved(_parsed(joined).where("whole").select(*RECORD, "file", "start"), "joined-records"))


def archive_round_trip(pages: DataFrame, least_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Write ``pages`` as archives, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, least_bytes)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def oracle_sql(least_bytes: int = 0) -> str:
    """DuckDB SQL of the round trip's rows."""
    return f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, h, url, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS x FROM p),
b AS (SELECT page_id, h, url, payload_bytes,
        array_to_string([substr('{BASE32}',
          CAST(((CAST('0x' || substr(x, CAST(1 + 10 * (i // 8) AS INTEGER), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31) + 1 AS INTEGER), 1)
          FOR i IN range(32)], '') AS payload_digest FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY page_id DESC NULLS LAST, url DESC) AS k, max(page_id) OVER (PARTITION BY h) AS top FROM b)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes < {least_bytes} OR k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN payload_bytes >= {least_bytes} AND k > 1 THEN top END AS refers_to
FROM r"""
