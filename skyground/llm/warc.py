"""Fixity of WARC files by Merkle trees.

A replica is a set of archive files of records. Each record has a leaf, the hash of its bytes and of
its place (file and offset); the leaves of a file, in the order of their offsets, are hashed into
nodes of ``FANOUT`` consecutive children, level by level up to one root a file. Two replicas agree
where their roots do. Where they differ, the audit goes down from the root and compares only the
children of nodes that differ, until it reaches the damaged records.
"""

from __future__ import annotations

import gzip
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..plans.stages import shared_folder, stored

FANOUT = 16
#: Records of one archive file. A task holds a file as a whole when it reads it back.
FILE_RECORDS = 1024
_END = "\r\n\r\n"
_ID = re.compile(rb"WARC-Record-ID: <urn:page:(-?[0-9]{1,18})>\r\n")


def record(uri: Column, payload: Column, number: Column) -> Column:
    """The bytes of a WARC response record, without the blank lines that end it."""
    body = F.coalesce(payload, F.lit("")).cast("binary")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(number.cast("string"), F.lit("none")), F.lit(">\r\nWARC-Target-URI: "),
        F.regexp_replace(F.coalesce(uri, F.lit("")), r"[\r\n]", " "),
        F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit(_END)).cast("binary")
    return F.concat(head, body)


def records(pages: DataFrame, file_records: int = FILE_RECORDS) -> DataFrame:
    """``file, page_id, content`` of the pages, dealt to archive files of ``file_records`` records as
    they are read: a task fills files of its own, whatever ids the pages have, and nothing is
    shuffled. Repeated pages and pages without an id are records like others; a null page has an empty body."""
    number = F.monotonically_increasing_id()
    place = F.col("__number").bitwiseAND((1 << 33) - 1)
    return pages.select(
        number.alias("__number"), F.col("page_id"),
        record(F.col("url"), F.col("html"), F.col("page_id")).alias("content")).select(
        (F.shiftright("__number", 33) * (1 << 33) + F.floor(place / file_records)).alias("file"),
        "page_id", "content")


def write_warc(archive: DataFrame, folder: str) -> None:
    """One folder ``file=N`` with one compressed archive file for each ``file`` (0 or more) of ``archive
    (file, content)``, whose rows of one file are in one task. The text writer puts the blank lines behind
    each record."""
    archive.select("file", F.col("content").cast("string").alias("value")).write.option(
        "lineSep", _END).option("compression", "gzip").partitionBy("file").text(folder)


def _files(spark, folder: str) -> DataFrame:
    """``file, content``: the archive files as they are."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).filter(
        "path RLIKE '/file=[0-9]+/part-'").select(
        F.regexp_extract("path", r"/file=([0-9]+)/", 1).cast("bigint").alias("file"), "content")


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    for batch in batches:
        for file, data in zip(batch.column("file").to_pylist(), batch.column("content").to_pylist()):
            yield file, gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


def read_warc(spark, folder: str) -> DataFrame:
    """``file, ordinal, offset, length, page_id, content`` of the archive files under a folder, one
    task a file; offsets are those of the uncompressed file. Bytes that are no record end the file
    with a record of all the rest, so that damage is seen by the audit and not dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, data in _opened(batches):
            found = list(_cut(data))
            ids = [_ID.search(data, at, at + size) for at, _, size in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([file] * len(found), pa.int64()),
                 pa.array(range(len(found)), pa.int64()),
                 pa.array([at for at, _, _ in found], pa.int64()),
                 pa.array([n for _, n, _ in found], pa.int64()),
                 pa.array([m and int(m[1]) for m in ids], pa.int64()),
                 pa.array([data[at:at + size] for at, _, size in found], pa.binary())],
                names=["file", "ordinal", "offset", "length", "page_id", "content"])

    return _files(spark, folder).mapInArrow(run, "file bigint, ordinal bigint, offset bigint,"
                                                 " length bigint, page_id bigint, content binary")


def _cut(data: bytes) -> Iterator[tuple[int, int, int]]:
    """Offset, length with the end, and length of each record."""
    at, end = 0, _END.encode()
    while at < len(data):
        head = data.find(end, at)
        fields = [line.partition(b":") for line in data[at:head].split(b"\r\n")]
        size = next((v.strip() for k, _, v in fields if k.lower() == b"content-length"), b"")
        stop = head + len(end) + int(size) if head >= 0 and size.isdigit() else len(data) + 1
        if data[stop:stop + len(end)] != end:
            yield at, len(data) - at, len(data) - at
            return
        yield at, stop + len(end) - at, stop - at
        at = stop + len(end)


def tree(archive: DataFrame, name: str, fanout: int = FANOUT) -> list[DataFrame]:
    """The levels of the trees of all files, leaves first: ``file, node, hash, start, stop``, where
    start and stop are the range of bytes below the node. Leaves also have ``body``, the hash of the
    record alone, and ``page_id``. The last level has one node a file. Records are hashed where they
    are read; only hashes move."""
    body = F.sha2("content", 256)
    leaf = archive.select(
        "file", F.col("ordinal").alias("node"), body.alias("body"), "page_id",
        F.sha2(F.concat_ws(":", F.col("file").cast("string"), F.col("offset").cast("string"), body),
               256).alias("hash"),
        F.col("offset").alias("start"), (F.col("offset") + F.col("length")).alias("stop"))
    levels = [stored(leaf, f"{name}-leaves")]
    while True:
        most = levels[-1].agg(F.max("node")).first()[0]
        if not most:
            return levels
        # at most ``fanout`` children in a group
        above = levels[-1].groupBy("file", F.floor(F.col("node") / fanout).alias("node")).agg(
            F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", "hash"))),
                                            lambda c: c["hash"]), ""), 256).alias("hash"),
            F.min("start").alias("start"), F.max("stop").alias("stop"))
        levels.append(stored(above, f"{name}-level-{len(levels)}"))


def audit(a: list[DataFrame], b: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """``file, ordinal, start, stop, page_id, state`` of the records in which the replicas differ:
    ``changed``, ``missing`` (only in the first), ``extra`` (only in the second) or ``moved`` (whole,
    at another place of the same file). Places are those in the first replica, of extra ones in
    the second.

    Goes down level by level; below the roots only children of differing nodes are read. The lower
    tree is taken as if it had further roots of one child. A record that is gone or new moves all after it; their own
    hashes tell them from damaged ones.
    """
    levels = max(len(a), len(b))
    above = sides = None
    for k in range(levels - 1, -1, -1):
        sides = []
        for side in (a, b):
            level = side[k] if k < len(side) else side[-1].withColumn("hash", F.concat(
                F.lit("short:"), F.col("hash")))
            if above is not None:
                level = level.withColumn("parent", F.floor(F.col("node") / fanout)).join(
                    above, ["file", "parent"], "left_semi").drop("parent")
            sides.append(level)
        x, y = (side.alias(n) for side, n in zip(sides, "xy"))
        differ = stored(x.join(y, ["file", "node"], "full").filter(
            "NOT (x.hash <=> y.hash)").select("file", "node"), f"audit-{k}")
        above = differ.withColumnRenamed("node", "parent")
    x, y = (_places(side.join(differ, ["file", "node"], "left_semi")) for side in sides)
    # equal records of a file in the order of their places
    whole = x.alias("x").join(y.alias("y"), ["file", "body", "nth"])
    moved = whole.select("file", F.col("x.node").alias("ordinal"), "x.start", "x.stop", "x.page_id",
                         F.lit("moved").alias("state"))
    lost, new = (side.join(whole.select("file", "body", "nth"), ["file", "body", "nth"], "left_anti")
                 for side in (x, y))
    either = lambda c: F.coalesce(f"x.{c}", f"y.{c}").alias(c)
    rest = lost.alias("x").join(new.alias("y"), ["file", "node"], "full").select(
        "file", F.col("node").alias("ordinal"), *map(either, ("start", "stop", "page_id")),
        F.when(F.col("x.body").isNull(), "extra").when(F.col("y.body").isNull(), "missing")
        .otherwise("changed").alias("state"))
    return moved.unionByName(rest)


def _places(leaves: DataFrame) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy("file", "body").orderBy("node"))
    return leaves.select("file", "node", "body", "start", "stop", "page_id", nth.alias("nth"))


def damaged_records(file: int, found: list[bytes]) -> list[bytes]:
    """The records of a file with known damage, chosen by hashes of their places: in about one of 89 the byte
    in the middle is changed, and of four files one has lost the end of its last record, one its
    middle record, and one has a record more there."""
    out = [r[:len(r) // 2] + bytes([r[len(r) // 2] ^ 1]) + r[len(r) // 2 + 1:]
           if r and zlib.crc32(f"{file}:{k}".encode()) % 89 == 0 else r for k, r in enumerate(found)]
    kind, middle = zlib.crc32(f"file {file}".encode()) % 4, len(out) // 2
    if out and kind == 0:
        out[-1] = out[-1][:2 * len(out[-1]) // 3]
    elif out and kind == 1:
        del out[middle]
    elif kind == 2:
        out.insert(middle, b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 5\r\n\r\nextra")
    return out


def write_damaged(spark, folder: str, replica: str) -> None:
    """A replica of an archive with :func:`damaged_records`, file by file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, data in _opened(batches):
            found = damaged_records(file, [data[at:at + size] for at, _, size in _cut(data)])
            yield pa.RecordBatch.from_arrays(
                [pa.array([file] * len(found), pa.int64()), pa.array(found, pa.binary())],
                names=["file", "content"])

    write_warc(_files(spark, folder).mapInArrow(run, "file bigint, content binary"), replica)


def op8_warc(spark, sf_dir: str) -> DataFrame:
    """The pages written as an archive, and as a replica with known damage; both read back and
    audited: every record in which they differ, with its place."""
    folders = [f"{shared_folder(spark)}/archive-{side}-{uuid.uuid4().hex}" for side in "ab"]
    write_warc(records(spark.read.parquet(f"{sf_dir}/pages.parquet"), FILE_RECORDS), folders[0])
    write_damaged(spark, *folders)
    return audit(*(tree(read_warc(spark, folder), f"replica-{side}")
                   for folder, side in zip(folders, "ab")))
