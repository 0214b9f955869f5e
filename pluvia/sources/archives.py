"""Landing of yearly ZIP archives as ``<raw>/<year>/<member>``.

The unit of work is the archive member, not the archive: tasks seek to the members they own, so one
huge archive spreads over the cluster, and a member is copied in blocks, so its size does not matter.
"""

from __future__ import annotations

import posixpath
import shutil
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import qualified

#: ``error`` is NULL where all went well; a broken archive gives one row without a member.
MEMBER_SCHEMA = "archive string, ano int, member string, bytes long, error string"
COLUMNS = ["archive", "ano", "member", "bytes", "error"]
_BLOCK = 4 << 20


def filesystem_of(path: str) -> tuple[pafs.FileSystem, str]:
    """The filesystem of a Spark path and the path within it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _safe_member(name: str) -> str:
    """The member's relative path; it cannot leave the folder it is extracted to."""
    parts = [part for part in name.replace("\\", "/").split("/") if part not in ("", ".", "..")]
    return "/".join(parts)


def _list_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, ano in zip(batch["archive"], batch["ano"]):
            filesystem, inner = filesystem_of(path)
            try:
                with filesystem.open_input_file(inner) as raw, zipfile.ZipFile(raw) as archive:
                    rows = [(path, ano, i.filename, i.file_size, None) for i in archive.infolist() if not i.is_dir()]
            except Exception as error:
                rows = [(path, ano, None, None, f"{path}: {error}")]
            yield pd.DataFrame(rows, columns=COLUMNS)


def archive_members(spark: SparkSession, archive_root: str) -> DataFrame:
    """``(archive, ano, member, bytes, error)`` of every member of ``<root>/<year>.zip``, from the directories."""
    archives = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.zip")
        .load(archive_root)
        .select(
            F.col("path").alias("archive"),
            F.regexp_extract("path", "([0-9]+)\\.zip$", 1).try_cast("int").alias("ano"),
        )
        .where("ano is not null")
    )
    return archives.mapInPandas(_list_members, MEMBER_SCHEMA)


def _crc(filesystem: pafs.FileSystem, path: str) -> int:
    checksum = 0
    with filesystem.open_input_stream(path) as file:
        while block := file.read(_BLOCK):
            checksum = zlib.crc32(block, checksum)
    return checksum


def _extract(archive: zipfile.ZipFile, member: str, filesystem: pafs.FileSystem, target: str) -> None:
    """Copy one member to ``target``, unless an earlier attempt already did.

    Spark skips hidden names, so a half-written file is never read as data.
    """
    present, wanted = filesystem.get_file_info(target), archive.getinfo(member)
    if present.type != pafs.FileType.NotFound:
        if present.size == wanted.file_size and _crc(filesystem, target) == wanted.CRC:
            return
        filesystem.delete_file(target)
    folder, name = posixpath.split(target)
    filesystem.create_dir(folder, recursive=True)
    partial = posixpath.join(folder, f".{name}.{uuid.uuid4().hex}")
    with archive.open(member) as source, filesystem.open_output_stream(partial) as sink:
        shutil.copyfileobj(source, sink, _BLOCK)
    filesystem.move(partial, target)


def _extractor(raw_root: str):
    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target_fs, root = filesystem_of(raw_root)
        for batch in batches:
            done = [row for row in batch[COLUMNS].itertuples(index=False, name=None) if row[2] is None]
            for path, members in batch[batch["member"].notna()].groupby("archive", sort=False):
                source_fs, inner = filesystem_of(path)
                with source_fs.open_input_file(inner) as raw, zipfile.ZipFile(raw) as archive:
                    for ano, member, size in zip(members["ano"], members["member"], members["bytes"]):
                        target, error = posixpath.join(root, str(ano), _safe_member(member)), None
                        try:
                            _extract(archive, member, target_fs, target)
                        except (zipfile.BadZipFile, zlib.error, EOFError) as failure:
                            # The archive is at fault: trying again would not help, other years are sound.
                            error = f"{path}: {failure}"
                        done.append((path, ano, member, size, error))
            yield pd.DataFrame(done, columns=COLUMNS)

    return extract


def land_archives(spark: SparkSession, archive_root: str, raw_root: str, years=None) -> DataFrame:
    """Extract the members of the archives (of ``years``); the result lists them, with what is wrong with any.

    The frame extracts as it is computed.  Use ``plans.ingest`` to run it once and log it.
    """
    members = archive_members(spark, archive_root)
    if years is not None:
        members = members.where(F.col("ano").isin(list(years)))
    root = qualified(spark, raw_root)
    # A number of tasks of our own: by the bytes of this list of members, which say nothing, they would become one.
    tasks = 4 * spark.sparkContext.defaultParallelism
    return members.repartition(tasks, "archive", "member").mapInPandas(_extractor(root), MEMBER_SCHEMA)
