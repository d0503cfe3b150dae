r"""WARC archives and their Merkle fixity audit.

``write_archives`` writes pages as WARC/1.0 resource records.  Every record ends with two
line breaks, which is what the text writer is told to put between rows, so archives are
written by Spark on any file system.  ``read_archives`` parses them by their lengths.

Each record of a replica is hashed together with its place; neighbouring hashes, in the
order of their offsets, are hashed into nodes over offset ranges, level by level up to one
root per archive.  ``audit`` compares the roots of two replicas and follows only children
of nodes that differ; the records found there are aligned by name and digest, so a lost or
lengthened record does not count against those behind it.  Damaged headers, lengths and
gzip streams are part of the result, not errors.

Defined results: null urls and bodies are empty, null ids are written as ``null``; repeated
pages are records of their own; archives are numbered by a hash of the page, so that none
grows with the number of pages; other columns do not matter; empty tables have no archives.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltworks.llm.tables import quoted, store, sweep_shuffles

END = "\r\n\r\n"
FANOUT = 16
#: bytes of records per archive, on average
ARCHIVE_BYTES = 4 << 20
ARCHIVES_PER_TASK = 4
_START, _END = b"WARC/1.0\r\n", END.encode()
#: compressed bytes read at a time
_CHUNK = 4096
_LENGTH = re.compile(rb"Content-Length: (\d{1,18})\r\n")
_NAME = re.compile(rb"WARC-Record-ID: <([^>]*)>\r\n")


def records(pages: DataFrame, id: str = "page_id", url: str = "url", body: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(archive, name, record): every page as the text of a WARC record without its end."""
    name = F.concat(F.lit("urn:page:"), F.coalesce(quoted(id).cast("string"), F.lit("null")))
    text = F.coalesce(quoted(body), F.lit(""))
    target = F.regexp_replace(F.coalesce(quoted(url), F.lit("")), r"[\r\n]", " ")
    record = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <"), name,
        F.lit(">\r\nWARC-Target-URI: "), target,
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.sha2(text, 256),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(text).cast("string"),
        F.lit(END), text,
    )
    total = pages.agg(F.sum(F.octet_length(quoted(body)))).first()[0] or 0
    archive = F.pmod(F.xxhash64(name, target, text), F.lit(max(1, -(-total // archive_bytes))))
    return pages.select(archive.cast("long").alias("archive"), name.alias("name"), record.alias("record"))


def _dealt(records: DataFrame) -> DataFrame:
    """The records of an archive together, some ``ARCHIVES_PER_TASK`` archives in a task."""
    archives = (records.agg(F.max("archive")).first()[0] or 0) + 1
    return records.repartition(-(-archives // ARCHIVES_PER_TASK), "archive")


def write_replicas(records: DataFrame, path: str, versions: dict[str, Column]) -> None:
    """Archives of several versions of the records in ``path/replica=<name>``, from one shuffle.

    A version that is null leaves the record out.
    """
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("replica"), v.alias("value")) for k, v in versions.items()]))
    rows = _dealt(records).select("archive", "name", "record", each.alias("v"))
    rows = rows.select("v.replica", "archive", "name", "record", "v.value").filter("value IS NOT NULL")
    out = rows.sortWithinPartitions("replica", "archive", "name", "record").select("replica", "archive", "value")
    out.write.partitionBy("replica", "archive").option("lineSep", END).option("compression", "gzip").text(path)
    sweep_shuffles(records.sparkSession)


def write_archives(records: DataFrame, path: str) -> None:
    """One gzip file per archive in ``path``, records ordered by name."""
    ordered = _dealt(records).sortWithinPartitions("archive", "name", "record")
    out = ordered.select("archive", F.col("record").alias("value"))
    out.write.partitionBy("archive").option("lineSep", END).option("compression", "gzip").text(path)
    sweep_shuffles(records.sparkSession)


def unzipped(content: bytes) -> tuple[bytes, bool]:
    """What can be read of a gzip stream, and whether that is all of it."""
    out, rest, whole = [], content, False
    while rest:
        stream, at, whole = zlib.decompressobj(31), 0, False
        while at < len(rest) and not stream.eof:
            before = stream.copy()
            try:
                out.append(stream.decompress(rest[at : at + _CHUNK]))
            except zlib.error:
                # once more byte by byte, up to the one that cannot be read
                for k in range(at, at + _CHUNK):
                    try:
                        out.append(before.decompress(rest[k : k + 1]))
                    except zlib.error:
                        return b"".join(out), False
            at += _CHUNK
        whole, rest = stream.eof, stream.unused_data + rest[at:]
    return b"".join(out), whole


def _block(data: bytes, at: int) -> tuple[int, int] | None:
    """(start, end) of the block of the record at ``at``; None if it is damaged."""
    head = data.find(_END, at) + len(_END)
    if not data.startswith(_START, at) or head < len(_END):
        return None
    size = _LENGTH.search(data, at, head)
    end = head + int(size[1]) if size and _NAME.search(data, at, head) else len(data)
    return (head, end) if data.startswith(_END, end) else None


def parse(data: bytes) -> Iterator[tuple[int, int, str | None, bytes | None]]:
    """(offset, length, name, block) of the records of one archive.

    Bytes that are no whole record reach up to the next start of one; they have no block,
    and the first name found in them or none.
    """
    at = 0
    while at < len(data):
        block = _block(data, at)
        if block:
            end = block[1] + len(_END)
            name = _NAME.search(data, at, block[0])
        else:
            start = data.find(_END + _START, at)
            end = start + len(_END) if start >= 0 else len(data)
            name = _NAME.search(data, at, end)
        yield at, end - at, name and name[1].decode("utf-8", "replace"), block and data[slice(*block)]
        at = end


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(archive, seq, offset, length, name, digest) of every record; the digest covers all its bytes.

    Damaged stretches are rows as well, without a name where none can be read in them.  A
    stream that breaks off ends in a row of length 0 without a name.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, content in zip(batch["archive"], batch["content"]):
                data, whole = unzipped(content)
                rows = [
                    (archive, seq, at, size, name, hashlib.sha256(data[at : at + size]).hexdigest())
                    for seq, (at, size, name, _) in enumerate(parse(data))
                ]
                if not whole:
                    rows.append((archive, len(rows), len(data), 0, None, hashlib.sha256(content).hexdigest()))
                yield pd.DataFrame(rows, columns=["archive", "seq", "offset", "length", "name", "digest"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.gz").load(path)
    archive = F.regexp_extract("path", r"archive=(\d+)", 1).cast("long")
    return files.select(archive.alias("archive"), "content").mapInPandas(
        run, "archive long, seq long, offset long, length long, name string, digest string"
    )


def _node(*parts: Column | str) -> Column:
    return F.sha2(F.concat_ws(":", *parts), 256)


def tree(leaves: DataFrame, depth: int) -> list[DataFrame]:
    """Stored levels of (archive, node, first, last, digest) from the records up to the roots.

    A node covers ``FANOUT`` neighbours; its digest covers their digests in order and its
    offset range, so moved bytes show as well as changed ones.
    """
    last = (F.col("offset") + F.col("length")).cast("long")
    level = leaves.select(
        "archive", F.col("seq").alias("node"), F.col("offset").alias("first"), last.alias("last"),
        _node(F.col("offset").cast("string"), last.cast("string"), "digest").alias("digest"),
    )
    levels = [store(level, "tree")]
    for _ in range(depth):
        child = F.struct("node", "digest")
        level = (
            levels[-1]
            .groupBy("archive", F.floor(F.col("node") / FANOUT).alias("parent"))
            .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sort_array(F.collect_list(child)).alias("children"))
        )
        joined = F.array_join(F.transform("children", lambda c: c["digest"]), ":")
        digest = _node(F.col("first").cast("string"), F.col("last").cast("string"), joined)
        levels.append(store(level.select("archive", F.col("parent").alias("node"), "first", "last", digest.alias("digest")), "tree"))
    return levels


def _aligned(one: DataFrame, two: DataFrame, on: list[str]) -> DataFrame:
    """Full join of the records of two replicas; the n-th of equal ones meets the n-th."""
    number = F.row_number().over(W.partitionBy("archive", *on).orderBy("seq")).alias("n")
    row = F.struct("seq", "name", "offset", "digest")
    sides = [side.select("archive", *on, number, row.alias(alias)) for side, alias in ((one, "a"), (two, "b"))]
    return sides[0].join(sides[1], ["archive", *on, "n"], "full").select("archive", "a", "b")


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """(archive, seq, status, name, other_name, offset, other_offset): the records in which
    two replicas differ, from two stored results of ``read_archives``.

    The trees lead to the places where something differs; there, records are aligned by name
    and digest, then by name.  ``status`` is changed (same name, other bytes), lost (only in
    the first replica), added (only in the second), moved (same bytes at another place) or
    unreadable: a damaged stretch of the second replica without a readable name, and records
    of the first that are missing from an archive with such a stretch.  ``seq`` is the place
    in the first replica, or in the second where the first has no such record and ``offset`` is null.
    """
    sizes = [replica.groupBy("archive").agg(F.max("seq").alias("n")) for replica in (left, right)]
    largest = sizes[0].union(sizes[1]).agg(F.max("n")).first()[0] or 0
    depth = 0
    while FANOUT**depth <= largest:
        depth += 1
    a, b = tree(left, depth), tree(right, depth)
    open_nodes = None
    for level in range(depth, -1, -1):
        sides = []
        for nodes, name in ((a[level], "x"), (b[level], "y")):
            side = nodes.select("archive", "node", F.col("digest").alias(name))
            if open_nodes is not None:  # only children of nodes that differ
                side = side.withColumn("parent", F.floor(F.col("node") / FANOUT)).join(open_nodes, ["archive", "parent"], "left_semi").drop("parent")
            sides.append(side)
        both = sides[0].join(sides[1], ["archive", "node"], "full").filter(~F.col("x").eqNullSafe(F.col("y")))
        found = store(both, "differing-nodes")
        open_nodes = found.select("archive", F.col("node").alias("parent"))
    places = found.select("archive", F.col("node").alias("seq"))
    one, two = (
        side.join(places, ["archive", "seq"], "left_semi").withColumn("key", F.coalesce("name", F.lit("")))
        for side in (left, right)
    )
    same = store(_aligned(one, two, ["key", "digest"]), "aligned-records")
    moved = same.filter("a IS NOT NULL AND b IS NOT NULL").withColumn("status", F.lit("moved"))
    alone = [same.filter(f"{x} IS NULL").select("archive", f"{y}.*").withColumn("key", F.coalesce("name", F.lit(""))) for x, y in ("ba", "ab")]
    broken = right.filter("name IS NULL").select("archive").distinct().withColumn("broken", F.lit(True))
    status = (
        F.when(F.col("a").isNull(), F.when(F.col("b.name").isNull(), "unreadable").otherwise("added"))
        .when(F.col("b").isNotNull(), "changed")
        .otherwise(F.when(F.col("broken"), "unreadable").otherwise("lost"))
    )
    rest = _aligned(*alone, ["key"]).join(broken, "archive", "left").select("archive", "a", "b", status.alias("status"))
    return moved.unionByName(rest).select(
        "archive", F.coalesce("a.seq", "b.seq").alias("seq"), "status", F.col("a.name").alias("name"),
        F.col("b.name").alias("other_name"), F.col("a.offset").alias("offset"), F.col("b.offset").alias("other_offset"),
    )
