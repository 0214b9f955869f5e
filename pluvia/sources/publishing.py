"""Tables that are replaced at once: versions beside each other, and a manifest that says which ones count.

A job writes what it replaces below ``<root>/<table>/versao=<run>``, where no reader looks, and then adds one small file,
the next manifest.  Readers go by the newest manifest, so that they see all tables of one job or none of them, and a job
that fails changes nothing.  A manifest is created under the next free number: of two jobs that began at the same one the
second fails instead of undoing the first.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..errors import PublishError

MANIFESTS = "_manifestos"
#: Manifests whose versions stay readable: the newest, and the one that readers may still be using.
KEPT = 2


@dataclass(frozen=True)
class Manifest:
    """What counts: the folders of each table below the root, and for each Silver year the version it was read in."""

    number: int = 0
    tables: dict[str, list[str]] = field(default_factory=dict)
    years: dict[str, str] = field(default_factory=dict)

    def folders(self) -> set[str]:
        return {folder for folders in self.tables.values() for folder in folders}


class Folder:
    """A folder on any of Spark's file systems, as the driver sees it."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self.path = path.rstrip("/")
        conf = spark._jsc.hadoopConfiguration()
        self._fs = self._at("").getFileSystem(conf)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        """What the folder holds, drafts excepted."""
        if not self._fs.exists(self._at("")):
            return []
        found = [status.getPath().getName() for status in self._fs.listStatus(self._at(""))]
        return sorted(name for name in found if not name.startswith("."))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str, replace: bool = False) -> bool:
        """Write a whole file or none of it; False if there is one and it is not to be replaced."""
        draft = f".{name}.{uuid.uuid4().hex}"
        stream = self._fs.create(self._at(draft), True)
        stream.write(text.encode())
        stream.close()
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        how = self._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE if replace else rename.NONE
        try:
            self._context.rename(self._at(draft), self._at(name), how)
        except Py4JJavaError as error:
            self._fs.delete(self._at(draft), False)
            if "FileAlreadyExists" not in str(error):
                raise
            return False
        return True

    def fingerprint(self) -> str | None:
        """Bytes, files and last change of the folder; None if it holds no file."""
        if not self._fs.exists(self._at("")):
            return None
        summary = self._fs.getContentSummary(self._at(""))
        if not summary.getFileCount():
            return None
        changed = self._fs.getFileStatus(self._at("")).getModificationTime()
        return f"{summary.getLength()}-{summary.getFileCount()}-{changed}"

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


def new_run() -> str:
    return uuid.uuid4().hex


def current(spark: SparkSession, root: str) -> Manifest | None:
    """The newest manifest; none where nothing has been published."""
    folder = Folder(spark, f"{root.rstrip('/')}/{MANIFESTS}")
    names = folder.names()
    return _parsed(folder.read(names[-1])) if names else None


def _parsed(text: str) -> Manifest:
    return Manifest(**json.loads(text))


def publish(
    spark: SparkSession, root: str, before: Manifest | None, tables: dict[str, list[str]], years: dict[str, str]
) -> Manifest:
    """Let the tables' folders count in place of those of ``before``; folders that nobody reads any more go."""
    folder = Folder(spark, f"{root.rstrip('/')}/{MANIFESTS}")
    after = Manifest((before.number if before else 0) + 1, tables, years)
    if not folder.write(f"{after.number:012d}.json", json.dumps(asdict(after))):
        raise PublishError(f"{root} was published by another job in the meantime")
    _sweep(spark, root, folder)
    return after


def _sweep(spark: SparkSession, root: str, folder: Folder) -> None:
    """Remove old manifests and the folders that only they name."""
    old, kept = folder.names()[:-KEPT], folder.names()[-KEPT:]
    if old:
        held = set().union(*(_parsed(folder.read(name)).folders() for name in kept))
        discard(spark, root, set().union(*(_parsed(folder.read(name)).folders() for name in old)) - held)
        for name in old:
            folder.remove(name)


def discard(spark: SparkSession, root: str, folders: Iterable[str]) -> None:
    """Remove folders below ``root``, and those above them that are left without data."""
    for path in folders:
        while "/" in path:
            path, _, name = path.rpartition("/")
            above = Folder(spark, f"{root.rstrip('/')}/{path}")
            above.remove(name)
            if any(not name.startswith("_") for name in above.names()):
                break


def version(run: str) -> str:
    return f"versao={run}"


def read_published(
    spark: SparkSession, root: str, name: str, schema: StructType, manifest: Manifest | None = None
) -> DataFrame:
    """A table as the manifest (by default the newest) has it; without one, the folder ``<root>/<name>``."""
    root = root.rstrip("/")
    manifest = manifest or current(spark, root)
    reader = spark.read.schema(schema)
    if manifest is None or name not in manifest.tables:
        return reader.parquet(f"{root}/{name}")
    folders = [f"{root}/{folder}" for folder in manifest.tables[name]]
    # Below the table's folder all is partitions, of which some are no columns of the table.
    return reader.option("basePath", f"{root}/{name}").parquet(*folders).select(*schema.names)
