"""Zip archives of CSV members as a partitioned source (A3).

The central directory of an archive says where its members are, so the source plans one partition
per (archive, member), and a task reads its member by range reads and streams it.  No archive is
ever held whole, and members of very different size are tasks of their own.  Files are opened
through ``pyarrow.fs``, which knows local paths and the common remote stores.
"""

from __future__ import annotations

import csv
import io
import json
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Rows of a member that are handed on at a time.
CHUNK_ROWS = 10_000
#: Rows of an archive that is written, on average at most: a task sorts and compresses one archive.
ARCHIVE_ROWS = 1_000_000
SCHEMA = "archive string, names array<string>, fields array<string>"
_ARROW = pa.schema([("archive", pa.string()), ("names", pa.list_(pa.string())), ("fields", pa.list_(pa.string()))])


def _place(path: str) -> tuple[arrow_fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (arrow_fs.LocalFileSystem(), path) if path.startswith("/") else arrow_fs.FileSystem.from_uri(path)


def open_archive(path: str) -> zipfile.ZipFile:
    """An archive whose members are read by ranges of the file."""
    store, place = _place(path)
    return zipfile.ZipFile(store.open_input_file(place))


def member_names(path: str) -> list[str]:
    with open_archive(path) as archive:
        return archive.namelist()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of the files that a glob names, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(str(f.getPath()) for f in found or [])


class MemberPartition(InputPartition):
    def __init__(self, path: str, member: str):
        self.path, self.member = path, member


class ZipMembers(DataSource):
    """One member of many archives: a row per CSV row, with its archive and the member's header."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ZipMemberReader(json.loads(self.options["paths"]), self.options["member"])


class ZipMemberReader(DataSourceReader):
    def __init__(self, paths: list[str], member: str):
        self.paths, self.member = paths, member

    def partitions(self) -> list[InputPartition]:
        return [MemberPartition(path, self.member) for path in self.paths]

    def read(self, partition: MemberPartition) -> Iterator[pa.RecordBatch]:
        with open_archive(partition.path) as archive, archive.open(partition.member) as raw:
            rows = csv.reader(io.TextIOWrapper(raw, encoding="utf-8-sig", newline=""))
            names = next(rows, [])
            while part := list(islice(rows, CHUNK_ROWS)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([partition.path] * len(part)), pa.array([names] * len(part), pa.list_(pa.string())), pa.array(part, pa.list_(pa.string()))], schema=_ARROW
                )


def read_members(spark: SparkSession, pattern: str, members: list[str]) -> dict[str, DataFrame]:
    """SCHEMA rows of each member over all archives that ``pattern`` names; a missing member is an error."""
    paths = matching(spark, pattern)
    with ThreadPoolExecutor(16) as pool:  # central directories only
        for path, names in zip(paths, pool.map(member_names, paths)):
            for member in members:
                if member not in names:
                    raise FileNotFoundError(f"{member} not found in {path}")
    spark.dataSource.register(ZipMembers)
    return {m: spark.read.format("zip_members").option("paths", json.dumps(paths)).option("member", m).load() for m in members}


def write_archives(members: dict[str, tuple[DataFrame, str]], folder: str, archives: int, archive_rows: int = ARCHIVE_ROWS) -> None:
    """Write tables as CSV members of ``archives`` zip files, rows dealt by a key column; members: name -> (table, key).

    Large tables make more archives, so that none has more than some ``archive_rows`` rows (a key's rows stay together).
    """
    headers = {name: table.columns for name, (table, _) in members.items()}
    archives = max(archives, -(-sum(table.count() for table, _ in members.values()) // archive_rows))

    def rows(name: str) -> DataFrame:
        table, key = members[name]
        archive = F.pmod(F.xxhash64(key), F.lit(archives)).cast("int")
        return table.select(archive.alias("archive"), F.lit(name).alias("member"), F.to_csv(F.struct(*table.columns)).alias("line"))

    # every member in every archive, also where it has no row: a header line comes first
    spark = next(iter(members.values()))[0].sparkSession
    heads = [(a, name, None) for a in range(archives) for name in headers]
    every = reduce(DataFrame.unionByName, map(rows, headers)).unionByName(spark.createDataFrame(heads, "archive int, member string, line string"))
    sorted_rows = every.repartitionById(archives, F.col("archive")).sortWithinPartitions("archive", "member", F.asc_nulls_first("line"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = member = None
        number, done, lines = None, 0, 0
        for batch in batches:
            for at, name, line in zip(*(batch.column(c).to_pylist() for c in ("archive", "member", "line"))):
                if at != number:
                    if archive is not None:
                        member.close()
                        archive.close()
                        sink.close()
                    store, place = _place(f"{folder}/feed{at}.zip")
                    store.create_dir(place.rpartition("/")[0], recursive=True)
                    sink = store.open_output_stream(place)
                    archive, member, number, done = zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED), None, at, done + 1
                if line is None:
                    if member is not None:
                        member.close()
                    member = archive.open(name, "w", force_zip64=True)
                    member.write((",".join(headers[name]) + "\n").encode())
                else:
                    member.write((line + "\n").encode())
                    lines += 1
        if archive is not None:
            member.close()
            archive.close()
            sink.close()
        yield pa.RecordBatch.from_arrays([pa.array([done]), pa.array([lines])], names=["archives", "lines"])

    sorted_rows.mapInArrow(write, "archives long, lines long").agg(F.sum("lines")).collect()
