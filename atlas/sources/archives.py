"""Tile-archive headers and directory entries."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values of the archive format, version 3
MAGIC_HEX = "504D54696C6573"
HEADER_BYTES = 127


def _unsigned(offset: int, width: int) -> Column:
    """Little-endian unsigned field. Byte values times powers of 256; 8-byte fields here stay far below 2^63."""
    octet = lambda i: F.conv(F.hex(F.substring("header", offset + i + 1, 1)), 16, 10).cast("bigint")
    total = octet(0)
    for i in range(1, width):
        total = total + F.call_function("shiftleft", octet(i), F.lit(8 * i))
    return total


def _signed32(offset: int) -> Column:
    raw = _unsigned(offset, 4)
    return F.when(raw >= 1 << 31, raw - (1 << 32)).otherwise(raw).cast("int")


def archive_header_audit(headers: DataFrame) -> DataFrame:
    """``headers(path, length, header binary)`` → one row of decoded fields per archive."""
    section = lambda name, at: [_unsigned(at, 8).alias(f"{name}_start"), _unsigned(at + 8, 8).alias(f"{name}_bytes")]
    return headers.select(
        "path", "length", F.length("header").alias("header_bytes"),
        (F.hex(F.substring("header", 1, 7)) == MAGIC_HEX).alias("magic_ok"), _unsigned(7, 1).cast("int").alias("version"),
        *section("root", 8), *section("metadata", 24), *section("leaves", 40), *section("tiles", 56),
        _unsigned(72, 8).alias("addressed"), _unsigned(80, 8).alias("entries"), _unsigned(88, 8).alias("contents"),
        _unsigned(97, 1).cast("int").alias("directory_compression"), _unsigned(98, 1).cast("int").alias("tile_compression"),
        _unsigned(99, 1).cast("int").alias("tile_type"), _unsigned(100, 1).cast("int").alias("min_zoom"), _unsigned(101, 1).cast("int").alias("max_zoom"),
        _signed32(102).alias("west_e7"), _signed32(106).alias("south_e7"), _signed32(110).alias("east_e7"), _signed32(114).alias("north_e7"))


def _opened(uri: str) -> tuple:
    """File system and name of a path as Spark shows it (not escaped)."""
    from pyarrow import fs

    scheme, rest = uri.split(":", 1)
    return (fs.LocalFileSystem(), "/" + rest.lstrip("/")) if scheme == "file" else fs.FileSystem.from_uri(uri)


def write_archive_volumes(archives: DataFrame, path: str) -> DataFrame:
    """Archives ``(path, content binary)`` written one behind the other into a volume per task: the ``members`` of the volumes.

    A file of its own costs each archive at least a block of the file system and an entry of its folder, so small archives by the
    million take volumes. ``path`` is a full URI; volumes go to its folder ``volumes``, and the members ``(volume, path, start,
    length)`` beside them as Parquet. A volume of a task that failed has no members and is never read.
    """
    folder = f"{path}/volumes"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        system, place = _opened(folder)
        system.create_dir(place, recursive=True)
        name, file, at = f"{uuid.uuid4().hex}.volume", None, 0
        try:
            for batch in batches:
                file = file or system.open_output_stream(f"{place}/{name}")
                contents = batch.column("content").to_pylist()
                starts = [*accumulate(map(len, contents), initial=at)]
                file.write(b"".join(contents))
                at = starts.pop()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(contents)), batch.column("path"), pa.array(starts, pa.int64()), pa.array(map(len, contents), pa.int64())],
                    names=["volume", "path", "start", "length"])
        finally:
            if file:
                file.close()

    kind = archives.schema["path"].dataType.simpleString()
    schema = f"volume string, path {kind}, start long, length long"
    archives.select("path", "content").mapInArrow(write, schema).write.parquet(f"{path}/members")
    return archives.sparkSession.read.schema(schema).parquet(f"{path}/members")


def read_archive_headers(spark: SparkSession, path: str, bytes_each: int = HEADER_BYTES, members: DataFrame | None = None) -> DataFrame:
    """(path, length, header): the first bytes of each archive; of a file of any size nothing else is read.

    Spark lists the files (its binary source opens none unless its content is asked for, and leaves out empty ones); the tasks
    then read one short range of each by its URI. Schemes are those Arrow knows: local files, HDFS, S3, GCS, ABFS. Name a folder
    rather than a pattern where there are many files: a folder is listed once, a pattern file by file.

    Without ``members`` each file is one archive. With ``members(volume, path, start, length)``, the files are volumes as
    ``write_archive_volumes`` makes them, and one range is read for each member of a listed volume.
    """
    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, file = None, None
        for batch in batches:
            headers = []
            for uri, start, size in zip(*(batch.column(c).to_pylist() for c in ("uri", "start", "length")), strict=True):
                if uri != last:
                    if file:
                        file.close()
                    system, name = _opened(uri)
                    last, file = uri, system.open_input_file(name)
                headers.append(file.read_at(max(0, min(bytes_each, size, file.size() - start)), start))
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), pa.array(headers, pa.binary())], names=["path", "length", "header"])
        if file:
            file.close()

    files = spark.read.format("binaryFile").load(path).select("path", "length")
    if members is None:
        asked = files.select(F.col("path").alias("uri"), "path", F.lit(0).cast("bigint").alias("start"), "length").repartition(4 * spark.sparkContext.defaultParallelism)
    else:
        volumes = files.select(F.element_at(F.split("path", "/"), -1).alias("volume"), F.col("path").alias("uri"))
        asked = members.join(volumes, "volume").select("uri", "path", "start", "length")
    kind = asked.schema["path"].dataType.simpleString()
    return asked.mapInArrow(ranges, f"path {kind}, length long, header binary")


def tile_directory_expand(entries: DataFrame) -> DataFrame:
    """Directory entries ``(archive, tile_id, offset, length, run)`` → one row per addressed tile; entries
    with run 0 point to leaves and address nothing."""
    tiles = entries.filter("run > 0")
    last = F.col("tile_id") + F.col("run") - 1
    return tiles.select("archive", F.explode(F.sequence(F.col("tile_id"), last)).alias("tile_id"), "offset", "length")


def directory_reconcile(expanded: DataFrame, headers: DataFrame) -> DataFrame:
    """Archives whose directory addresses another number of tiles than their header says."""
    counted = expanded.groupBy("archive").agg(F.count(F.lit(1)).alias("seen"))
    joined = headers.join(counted, "archive", "left").withColumn("seen", F.coalesce("seen", F.lit(0)))
    return joined.filter(F.col("seen") != F.col("addressed")).select("archive", "addressed", "seen")
