"""Merkle fixity audit of WARC replicas.

A manifest has one row for each record: file, offset, length, id and SHA-256 of the record's bytes. Leaves are ranges of
2**RANGE_BITS offsets of one file, whose hash is over the digests of the records that start there, in order; each upper
level joins 2**FAN_BITS neighbours, first ranges of offsets, then of file numbers, up to one root. Replicas with equal
roots are equal. Otherwise the audit compares level after level the children of mismatching nodes only, and at last the
records of mismatching leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandflow.llm.common import checkpointed

RANGE_BITS, FAN_BITS = 16, 8
#: Consecutive page ids that go to one WARC file.
PAGES_PER_FILE = 1000
#: Files that records without an id are dealt to.
NAMELESS_FILES = 1 << 16


def record(page_id: str, url: str, html: Column) -> Column:
    """A page as a WARC response record; nulls are empty."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    body = F.coalesce(html, F.lit(""))
    head = ["WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:", text(page_id), ">\r\nWARC-Target-URI: ", text(url), "\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: ", F.octet_length(body).cast("string"), "\r\n\r\n", body, "\r\n\r\n"]
    return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in head])


def manifest(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(file, offset, length, record_id, digest) of the WARC files that hold ``pages`` in order of their ids.

    Records without an id go to files -1, -2, ... by a hash of their bytes, so no file has them all. Only digests and lengths are shuffled, never records. Rows that repeat an id follow one
    another by digest; other columns are ignored.
    """
    body = record(page_id, url, F.col(html))
    file = F.coalesce(F.floor(F.col(page_id) / PAGES_PER_FILE), -1 - F.pmod(F.xxhash64(body), F.lit(NAMELESS_FILES))).cast("long")
    rows = pages.select(file.alias("file"), F.col(page_id).cast("long").alias("record_id"), F.octet_length(body).cast("long").alias("length"), F.sha2(body, 256).alias("digest"))
    before = Window.partitionBy("file").orderBy("record_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("file", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset"), "length", "record_id", "digest")


SIDES = ("ours", "theirs")


def _joined(children: list[Column], side: str) -> Column:
    """One side's hash of a node: of its children in order, null if that side has none."""
    kept = F.array_sort(F.collect_list(F.when(F.col(side).isNotNull(), F.struct(*children, F.col(side).alias("hash")))))
    lines = F.transform(kept, lambda c: F.concat_ws(":", *[F.coalesce(c[n].cast("string"), F.lit("-")) for n in ("a", "b", "hash")]))
    return F.when(F.size(kept) > 0, F.sha2(F.array_join(lines, "\n"), 256)).alias(side)


def tree(records: DataFrame, offset_levels: int, file_levels: int) -> list[DataFrame]:
    """Levels (file, node, ours, theirs) from the leaves to the root, of both replicas side by side.

    A leaf has the records of 2**RANGE_BITS offsets, an upper node 2**FAN_BITS children. Each level is settled in the
    checkpoint folder, so the next starts from its files.
    """
    own = [F.col("offset").alias("a"), F.col("record_id").alias("b")]
    level = records.groupBy("file", F.shiftright("offset", RANGE_BITS).alias("node")).agg(*[_joined(own, s) for s in SIDES])
    levels = [checkpointed(level)]
    own = [F.col("file").alias("a"), F.col("node").alias("b")]
    up = [("file", F.shiftright("node", FAN_BITS).alias("node"))] * offset_levels + [(F.shiftright("file", FAN_BITS).alias("file"), "node")] * file_levels
    for key in up:
        levels.append(checkpointed(levels[-1].groupBy(*key).agg(*[_joined(own, s) for s in SIDES])))
    return levels


def _levels(bits: int) -> int:
    return max(0, -(-bits // FAN_BITS))


def _differs() -> Column:
    return ~F.col("ours").eqNullSafe(F.col("theirs"))


def audit(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """(file, offset, record_id, kind, ours, theirs) for each record that differs between two manifests.

    ``kind`` is changed, missing (not in theirs) or extra (not in ours); ``ours`` and ``theirs`` are the digests. Equal
    manifests, two empty ones too, give no rows. Records are told apart by file, offset and id; of several with all
    three alike, their sorted digests are compared.
    """
    none = F.lit(None).cast("string")
    named = [x.select("file", "offset", "record_id", *[F.col("digest").alias(s) if s == side else none.alias(s) for s in SIDES]) for x, side in zip((ours, theirs), SIDES)]
    records = checkpointed(named[0].unionByName(named[1]))
    top = records.agg(F.max("offset").alias("o"), F.max(F.abs("file")).alias("f")).first()
    offset_levels = _levels(max(0, (top["o"] or 0).bit_length() - RANGE_BITS))
    levels = tree(records, offset_levels, _levels((top["f"] or 0).bit_length()))
    # at the top there are at most two nodes, of file -1 and 0
    wrong = levels[-1].where(_differs())
    if wrong.isEmpty():
        return records.sparkSession.createDataFrame([], "file long, offset long, record_id long, kind string, ours string, theirs string")
    for depth in range(len(levels) - 2, -1, -1):
        above = wrong.select(F.col("file").alias("bad_file"), F.col("node").alias("bad_node"))
        file = F.col("file") if depth < offset_levels else F.shiftright("file", FAN_BITS)
        node = F.shiftright("node", FAN_BITS) if depth < offset_levels else F.col("node")
        wrong = levels[depth].where(_differs()).join(above, (file == F.col("bad_file")) & (node == F.col("bad_node")), "left_semi")
    above = wrong.select(F.col("file").alias("bad_file"), F.col("node").alias("bad_node"))
    here = (F.col("file") == F.col("bad_file")) & (F.shiftright("offset", RANGE_BITS) == F.col("bad_node"))
    digests = lambda side: F.when(F.count(side) > 0, F.array_join(F.sort_array(F.collect_list(side)), ",")).alias(side)
    found = records.join(above, here, "left_semi").groupBy("file", "offset", "record_id").agg(*map(digests, SIDES)).where(_differs())
    kind = F.when(F.col("theirs").isNull(), "missing").when(F.col("ours").isNull(), "extra").otherwise("changed")
    return found.select("file", "offset", "record_id", kind.alias("kind"), *SIDES)


def damaged(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """A manifest of a replica of ``pages`` with faults at known records: a flipped byte where the id leaves 13 modulo
    97, a lost record where it leaves 5 modulo 211, a stray copy behind it where it leaves 7 modulo 389."""
    good = manifest(pages, page_id, url, html)
    flipped = F.when(F.length(html) > 0, F.concat(F.lit("#"), F.substring(F.col(html), F.lit(2), F.length(html)))).otherwise(F.col(html))
    bad = pages.where(F.pmod(F.col(page_id), F.lit(97)) == 13).select(F.col(page_id).cast("long").alias("bad_id"), F.sha2(record(page_id, url, flipped), 256).alias("bad_digest"))
    rows = good.join(bad, F.col("record_id") == F.col("bad_id"), "left").withColumn("digest", F.coalesce("bad_digest", "digest")).drop("bad_id", "bad_digest")
    lost = F.coalesce(F.pmod(F.col("record_id"), F.lit(211)) == 5, F.lit(False))
    stray = good.where(F.pmod(F.col("record_id"), F.lit(389)) == 7).withColumn("offset", F.col("offset") + (1 << 32))
    return rows.where(~lost).unionByName(stray)


#: DuckDB SQL for the audit of ``damaged`` against ``manifest`` over the table pages.
SQL = f"""
WITH bodies AS (SELECT page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) AS head, html, chr(13) || chr(10) || chr(13) || chr(10) AS tail FROM pages),
digests AS (SELECT CAST(floor(page_id / {PAGES_PER_FILE}) AS BIGINT) AS file, page_id AS record_id, strlen(head || html || tail) AS length, sha256(head || html || tail) AS digest, sha256(head || CASE WHEN length(html) > 0 THEN '#' || substr(html, 2) ELSE html END || tail) AS flipped FROM bodies),
good AS (SELECT file, record_id, digest, flipped, CAST(coalesce(sum(length) OVER (PARTITION BY file ORDER BY record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM digests)
SELECT file, "offset", record_id, CASE WHEN record_id % 211 = 5 THEN 'missing' ELSE 'changed' END AS kind, digest AS ours, CASE WHEN record_id % 211 = 5 THEN NULL ELSE flipped END AS theirs
FROM good WHERE record_id % 211 = 5 OR record_id % 97 = 13 AND digest <> flipped
UNION ALL SELECT file, "offset" + 4294967296, record_id, 'extra', NULL, digest FROM good WHERE record_id % 389 = 7
"""
