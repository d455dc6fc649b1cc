"""S6 with an atomic commit: a table of files that readers see through manifests.

Every task writes a file of its own under a fresh name and reports it; only when
all tasks of a batch are done does the driver publish one manifest that names
the files, by a rename.  A reader follows the manifests: it sees all of a batch
or nothing of it, whatever tasks, attempts or whole jobs were lost in between.
A batch written again under the same version is published once.

The table's folder must be reachable from all executors (a mounted share, or a
URI that ``pyarrow.fs`` opens).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow.parquet as pq
from pyarrow import Table, fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "tidemark_manifest"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


@dataclass
class FileWritten(WriterCommitMessage):
    name: str
    rows: int


class ManifestWriter(DataSourceArrowWriter):
    def __init__(self, path: str, version: str):
        self.path, self.version = path.rstrip("/"), version

    def write(self, iterator) -> WriterCommitMessage:
        where, root = _open(self.path)
        name, rows, out = f"data/{uuid.uuid4().hex}.parquet", 0, None
        where.create_dir(f"{root}/data")
        try:
            for batch in iterator:
                if out is None:
                    out = pq.ParquetWriter(f"{root}/{name}", batch.schema, filesystem=where)
                out.write_table(Table.from_batches([batch]))
                rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return FileWritten(name if rows else "", rows)

    def commit(self, messages) -> None:
        where, root = _open(self.path)
        final = f"{root}/manifests/{self.version}.json"
        where.create_dir(f"{root}/manifests")
        if where.get_file_info(final).type != fs.FileType.NotFound:
            return  # published before: a retried batch
        temp = f"{root}/manifests/.{uuid.uuid4().hex}"
        with where.open_output_stream(temp) as f:
            f.write(json.dumps([m.name for m in messages if m is not None and m.rows]).encode())
        where.move(temp, final)

    def abort(self, messages) -> None:
        where, root = _open(self.path)
        for m in messages:
            if m is not None and m.rows:
                where.delete_file(f"{root}/{m.name}")


class ManifestSource(DataSource):
    """``df.write.format("tidemark_manifest").option("version", ...)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite):
        return ManifestWriter(self.options["path"], self.options["version"])


def write_version(df: DataFrame, path: str, version: str) -> None:
    """Write ``df`` as one version of the table at ``path``: all or nothing."""
    df.sparkSession.dataSource.register(ManifestSource)
    df.write.format(FORMAT).option("path", path).option("version", version).mode("append").save()


def committed_files(path: str) -> list[str]:
    """The files that the published manifests name, oldest version first."""
    where, root = _open(path.rstrip("/"))
    found = where.get_file_info(fs.FileSelector(f"{root}/manifests", allow_not_found=True))
    names = []
    for info in sorted((x for x in found if not x.base_name.startswith(".")), key=lambda x: x.base_name):
        with where.open_input_stream(info.path) as f:
            names += json.loads(f.read())
    return [f"{path.rstrip('/')}/{n}" for n in names]


def atomic_upsert_batch(path: str, run: int = 0) -> Callable[[DataFrame, int], None]:
    """``upsert_batch`` with an atomic commit: a ``foreachBatch`` function whose batch is
    the version (run, epoch).  ``run`` as there."""
    def write(batch: DataFrame, epoch: int) -> None:
        rows = batch.withColumns({"run": F.lit(run).cast("long"), "batch_id": F.lit(epoch).cast("long")})
        write_version(rows, path, f"{run:08d}-{epoch:012d}")
    return write


def read_committed(spark: SparkSession, path: str, keys: Sequence[str], order: str | None = None) -> DataFrame | None:
    """Latest published value per key (of several rows of a key in a batch the one with
    the largest ``order``); None before the first commit."""
    files = committed_files(path)
    if not files:
        return None
    log = spark.read.parquet(*files)
    vals = [c for c in log.columns if c not in [*keys, "run", "batch_id"]]
    by = F.struct("run", "batch_id", *([F.col(order)] if order else []))
    latest = log.groupBy(*keys).agg(F.max_by(F.struct(*vals), by).alias("_v"))
    return latest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in vals])
