"""Merkle fixity audit of WARC records.

Pages become records of numbered archive files. Every record has a digest; every range of FANOUT
neighbours, in the order of their offsets, has the digest of its members' digests, and so on up to
a root for each file and above the files to one root. Two replicas are compared from the root down:
of each level's table, only the children of ranges that differ go into the comparison. A record's
place in the tree is a slot that follows from its page id alone, so a lost one moves no other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from poseframes.llm.common import cut

FANOUT = 16
#: Page ids of one archive file, and files among which pages without an id are spread.
PER_FILE, LOOSE_FILES = 1024, 64
CRLF = "\r\n"


def warc_record(url: Column, html: Column) -> Column:
    """A response record: headers, an empty line, the page, and the two line ends that close it.
    Null counts as empty."""
    body = F.coalesce(html, F.lit(""))
    head = F.concat(
        F.lit(f"WARC/1.0{CRLF}WARC-Type: response{CRLF}WARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit(f"{CRLF}Content-Type: text/html{CRLF}Content-Length: "),
        F.octet_length(body).cast("string"), F.lit(f"{CRLF}{CRLF}"),
    )
    return F.concat(head, body, F.lit(CRLF * 2))


def warc_records(pages: DataFrame) -> DataFrame:
    """``file, pos, nth, page_id, offset, n_bytes, sha256`` of each page's record.

    Files hold ranges of page ids; records stand in the order of id, url and digest. ``pos`` is the
    slot of the page id in its range, ``nth`` counts equal records of a slot. Pages without an id go
    to files below 0 and to slots by a hash of the url. Other columns are ignored, repeated rows are
    records of their own, an empty table gives an empty one.
    """
    record = warc_record(F.col("url"), F.col("html"))
    loose = -1 - F.pmod(F.crc32(F.coalesce("url", F.lit("")).cast("binary")), F.lit(LOOSE_FILES))
    slot = F.pmod(F.coalesce(F.col("page_id"), F.xxhash64(F.coalesce("url", F.lit("")))), F.lit(PER_FILE)).cast("long")
    rows = pages.select(
        "page_id", "url", F.coalesce(F.floor(F.col("page_id") / PER_FILE), loose).cast("long").alias("file"), slot.alias("pos"),
        F.octet_length(record).cast("long").alias("n_bytes"), F.sha2(record.cast("binary"), 256).alias("sha256"),
    )
    order = W.partitionBy("file").orderBy("page_id", "url", "sha256")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    nth = F.row_number().over(W.partitionBy("file", "pos", "sha256").orderBy("page_id", "url"))
    return rows.select("file", "pos", nth.alias("nth"), "page_id", F.coalesce(F.sum("n_bytes").over(before), F.lit(0)).cast("long").alias("offset"), "n_bytes", "sha256")


def _up(depth: int) -> tuple[Column, Column]:
    """File and position of the range above a node of this depth (records have depth 0). Up to a
    file's root ranges are of positions in it, above it of files."""
    file, pos, zero = F.col("file"), F.col("pos"), F.lit(0).cast("long")
    if FANOUT ** (depth + 1) < PER_FILE:
        return file, F.floor(pos / FANOUT)
    return (file, zero) if FANOUT**depth < PER_FILE else (F.floor(file / FANOUT), zero)


def fixity_trees(records: DataFrame) -> list[DataFrame]:
    """The trees of all replicas, slots first, roots last: ``replica, file, pos, digest``. A slot
    has the digest of its records' digests; it nearly always has one. Each level is a table, with
    full files an eighth of the one below or less."""
    members = F.concat_ws("", F.sort_array(F.collect_list("sha256")))
    level = records.groupBy("replica", "file", "pos").agg(F.sha2(members.cast("binary"), 256).alias("digest"))
    lowest, highest = (x or 0 for x in records.agg(F.min("file"), F.max("file")).first())
    levels = [level]
    while lowest != 0 or highest != 0 or FANOUT ** (len(levels) - 1) < PER_FILE:
        file, pos = _up(len(levels) - 1)
        if FANOUT ** (len(levels) - 1) >= PER_FILE:
            lowest, highest = lowest // FANOUT, highest // FANOUT
            if (lowest, highest) == (-1, 0) or lowest == highest:
                file, lowest, highest = F.lit(0).cast("long"), 0, 0
        members = F.sort_array(F.collect_list(F.struct("file", "pos", "digest")))["digest"]
        nodes = level.groupBy("replica", file.alias("up_file"), pos.alias("up_pos")).agg(F.sha2(F.concat_ws("", members).cast("binary"), 256).alias("digest"))
        level = cut(nodes.select("replica", F.col("up_file").alias("file"), F.col("up_pos").alias("pos"), "digest"), "level")
        levels.append(level)
    return levels


def damaged_records(levels: list[DataFrame], replicas: int = 2) -> DataFrame:
    """``file, pos`` of the slots that differ or that a replica lacks, found from the roots down:
    of each level only the nodes below those that differ are compared."""
    wanted = None
    for depth in range(len(levels) - 1, -1, -1):
        nodes = levels[depth]
        if wanted is not None:
            file, pos = (F.lit(0).cast("long"),) * 2 if depth == len(levels) - 2 else _up(depth)
            nodes = nodes.withColumns({"up_file": file, "up_pos": pos}).join(wanted, ["up_file", "up_pos"], "left_semi")
        same = (F.count("*") == replicas) & (F.min("digest") == F.max("digest"))
        differ = nodes.groupBy("file", "pos").agg(same.alias("same")).where(~F.col("same"))
        wanted = cut(differ.select(F.col("file").alias("up_file"), F.col("pos").alias("up_pos")), "differ")
    return wanted.select(F.col("up_file").alias("file"), F.col("up_pos").alias("pos"))


def audit(pages: DataFrame, replica: DataFrame) -> DataFrame:
    """``page_id, file, offset, n_bytes, sha256, damaged`` of every record of ``pages``:
    ``damaged`` if the replica has no equal record in its slot. What the replica has besides is not
    reported. Pages of any length are one record each; of a long one only its digest is in the trees.
    Null pages count as empty, ids may be null or repeated, empty tables give empty ones."""
    both = warc_records(pages).withColumn("replica", F.lit(0)).unionByName(warc_records(replica).withColumn("replica", F.lit(1)))
    both = cut(both, "records")
    slots = damaged_records(fixity_trees(both))
    there = both.join(slots, ["file", "pos"], "left_semi")  # of the differing slots alone, record by record
    found = there.where("replica = 0").join(there.where("replica = 1"), ["file", "pos", "sha256", "nth"], "left_anti").select("file", "pos", "sha256", "nth", F.lit(True).alias("damaged"))
    ours = both.where("replica = 0").join(found, ["file", "pos", "sha256", "nth"], "left")
    return ours.select("page_id", "file", "offset", "n_bytes", "sha256", F.coalesce("damaged", F.lit(False)).alias("damaged"))


def worn_replica(pages: DataFrame) -> DataFrame:
    """A replica of the pages as years on a shelf might leave it: one page of 256, by a hash of its
    id, has its last character lost, and another one has its middle one changed."""
    wear = F.substring(F.md5(F.col("page_id").cast("string").cast("binary")), 1, 2)
    n = F.length("html")
    middle = F.floor(n / 2).cast("int")
    changed = F.concat(F.col("html").substr(F.lit(1), middle), F.lit("¤"), F.col("html").substr(middle + 2, n))
    html = F.when(wear == "00", F.col("html").substr(F.lit(1), n - 1)).when(wear == "01", changed).otherwise(F.col("html"))
    return pages.withColumn("html", html)


ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, substr(md5(CAST(page_id AS VARCHAR)), 1, 2) AS wear, length(html) AS n FROM pages),
r AS (SELECT page_id, CAST(floor(page_id / {PER_FILE}.0) AS BIGINT) AS file, wear, n,
  'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
  || 'Content-Length: ' || CAST(strlen(html) AS VARCHAR) || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10) AS record,
  CASE WHEN wear = '00' AND n > 0 THEN true WHEN wear = '01' THEN true ELSE false END AS damaged FROM p)
SELECT page_id, file, CAST(coalesce(sum(strlen(record)) OVER (PARTITION BY file ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
  CAST(strlen(record) AS BIGINT) AS n_bytes, sha256(record) AS sha256, damaged FROM r
"""
