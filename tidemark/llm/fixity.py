"""Fixity audit of WARC replicas by Merkle trees.

Each record of an archive has a digest. Records are grouped by ranges of their offset, ranges by
sixteen to larger ranges, up to one root per archive; a node's digest is that of its children in
order. Two replicas are compared from the roots down: only the children of nodes that differ are
looked at, until the records that differ are known.

An archive is a bounded file, so its tree is built where its records are: one shuffle of the narrow
rows (archive, offset, length, digest), none of record contents, and none between levels.

Defined results: null html or url is an empty string in the record; a null page id is placed by the
content's hash; pages that share an id follow each other in the order of their digests; a record on
one side only is `missing` or `extra`; an archive on one side only has all its records so; empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored
from .wrappers import host_of

#: pages per archive, bytes per lowest range, ranges per node, levels between ranges and root
ARCHIVE_PAGES, RANGE_BYTES, FANOUT, LEVELS = 10_000, 1 << 16, 16, 3


def record_of(page_id: Column, url: Column, html: Column) -> Column:
    """The WARC response record of a page, as binary."""
    body = F.encode(F.coalesce(html, F.lit("")), "utf-8")
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(F.encode(head, "utf-8"), body, F.encode(F.lit("\r\n\r\n"), "utf-8"))


def page_records(pages: DataFrame, damage=None, id: str = "page_id", url: str = "url",
                 html: str = "html") -> DataFrame:
    """archive, page_id, offset, length, digest of each page's record.

    A host's pages lie in archives of ARCHIVE_PAGES ids each. damage: maps (page_id, record) to the
    bytes that a replica has in the record's place, null for none; offsets stay those of the
    undamaged archive, as in a file that was damaged in place.
    """
    page_id, link, body = F.col(id).cast("long"), F.col(url), F.col(html)
    place = F.coalesce(page_id, F.abs(F.xxhash64(link, body) % (1 << 40)))
    record = record_of(page_id, link, body)
    rows = pages.select(
        F.concat_ws("/", host_of(link), F.floor(place / ARCHIVE_PAGES).cast("string")
                    ).alias("archive"), page_id.alias("page_id"), place.alias("place"),
        F.octet_length(record).cast("long").alias("length"),
        F.sha2(record, 256).alias("_sound"),
        F.sha2(damage(page_id, record) if damage else record, 256).alias("digest"))
    before = Window.partitionBy("archive").orderBy("place", "_sound").rowsBetween(
        Window.unboundedPreceding, -1)
    return rows.repartition("archive").withColumn(
        "offset", F.coalesce(F.sum("length").over(before), F.lit(0))).filter(
        "digest is not null").select("archive", "page_id", "offset", "length", "digest")


def tree(records: DataFrame) -> DataFrame:
    """archive, level, node, digest: level 0 holds ranges, the highest one node per archive.

    Records dealt by archive serve all levels; a node's children are few, so gathering them is bounded.
    """
    def combined(rows: DataFrame, level: int, key: Column, columns: list[str]) -> DataFrame:
        parts = F.sort_array(F.collect_list(F.struct(*columns)))
        line = F.transform(parts, lambda p: F.concat_ws(":", *[p[c] for c in columns]))
        return rows.groupBy("archive", key.cast("long").alias("node")).agg(
            F.sha2(F.array_join(line, "\n"), 256).alias("digest")).withColumn(
            "level", F.lit(level))

    levels = [combined(records, 0, F.floor(F.col("offset") / RANGE_BYTES),
                       ["offset", "length", "digest"])]
    for level in range(1, LEVELS + 1):
        levels.append(combined(levels[-1], level, F.floor(F.col("node") / FANOUT),
                               ["node", "digest"]))
    levels.append(combined(levels[-1], LEVELS + 1, F.lit(0), ["node", "digest"]))
    return reduce(DataFrame.unionByName, levels).select("archive", "level", "node", "digest")


def differing(a: DataFrame, b: DataFrame, keys: list[str], parents: DataFrame | None,
              parent: Column | None) -> DataFrame:
    """Keys whose digest is not the same on both sides, below the given parents."""
    sides = []
    for rows, name in ((a, "a"), (b, "b")):
        if parents is not None:
            rows = rows.withColumn("_parent", parent).join(
                parents.select("archive", F.col("node").alias("_parent")),
                ["archive", "_parent"], "left_semi")
        sides.append(rows.select(*keys, F.col("digest").alias(f"digest_{name}")))
    return sides[0].join(sides[1], keys, "full").filter(
        ~F.col("digest_a").eqNullSafe(F.col("digest_b")))


def audit(a: DataFrame, b: DataFrame) -> DataFrame:
    """archive, offset, page_id, length, kind of the records in which replica b differs from a.

    a and b: rows as `page_records` or `file_records` give them. kind: changed, missing (not in b),
    extra (not in a).
    """
    a, b = stored(a, "fixity-records"), stored(b, "fixity-records")
    trees = [stored(tree(x), "fixity-tree") for x in (a, b)]
    keys = ["archive", "node"]
    wrong = None
    for level in range(LEVELS + 1, -1, -1):
        up = None if wrong is None else (
            F.lit(0).cast("long") if level == LEVELS else F.floor(F.col("node") / FANOUT))
        wrong = differing(*(t.filter(F.col("level") == level) for t in trees), keys, wrong, up)
    wrong = stored(wrong.select(*keys), "fixity-ranges")
    found = differing(a, b, ["archive", "offset"], wrong, F.floor(F.col("offset") / RANGE_BYTES))
    kind = F.when(F.col("digest_b").isNull(), "missing").when(
        F.col("digest_a").isNull(), "extra").otherwise("changed")
    found = found.select("archive", "offset", kind.alias("kind"))
    details = ["archive", "offset", "page_id", "length"]
    return found.join(a.select(*details), ["archive", "offset"], "left").join(
        b.select(*[F.col(c).alias(c if c in ("archive", "offset") else f"b_{c}")
                   for c in details]), ["archive", "offset"], "left").select(
        "archive", "offset", F.coalesce("page_id", "b_page_id").alias("page_id"),
        F.coalesce("length", "b_length").alias("length"), "kind")


HEAD = re.compile(rb"WARC/1\.[01]\r\n(.*?)\r\n\r\n", re.S)
LENGTH = re.compile(rb"(?im)^content-length:\s*(\d+)")
PAGE = re.compile(rb"(?im)^warc-record-id:\s*<urn:page:(\d+)>")


def records_in(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """offset, length and bytes of each record of a WARC file, plain or gzipped record by record.

    Bytes that are no record are skipped to the next record's head.
    """
    at = 0
    while at < len(content):
        if content[at:at + 2] == b"\x1f\x8b":
            member = zlib.decompressobj(31)
            try:
                record = member.decompress(content[at:])
                length = len(content) - at - len(member.unused_data)
            except zlib.error:
                record, length = b"", 2
        else:
            m = HEAD.search(content, at)
            if not m:
                return
            at = m.start()
            size = LENGTH.search(m[1])
            length = m.end() - at + (int(size[1]) if size else 0) + 4
            record = content[at:at + length]
        if record:
            yield at, length, record
        at += length


def file_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(),
                                 batch.column("content").to_pylist()):
            rows = []
            for offset, length, record in records_in(content):
                m = PAGE.search(record[:4096])
                rows.append((path.rsplit("/", 1)[-1], int(m[1]) if m else None, offset, length,
                             hashlib.sha256(record).hexdigest()))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("archive", "page_id", "offset", "length", "digest"), r)) for r in rows],
                schema=pa.schema([("archive", pa.string()), ("page_id", pa.int64()),
                                  ("offset", pa.int64()), ("length", pa.int64()),
                                  ("digest", pa.string())]))


def file_records(spark: SparkSession, path: str) -> DataFrame:
    """archive (file name), page_id, offset, length, digest of the records of WARC files."""
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(
        file_rows, "archive string, page_id long, offset long, length long, digest string")


