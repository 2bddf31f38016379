"""Checked hand-offs between stages, and work folders that their owner removes.

``write_stage`` writes a table and then a manifest beside its files: the rows
counted during the write (``DataFrame.observe``, no second job) and the name and
size of every file. ``read_stage`` compares the folder with its manifest before
it reads: a write that was interrupted, a file that is missing, was added or was
cut short is refused, not read as less data.

A :class:`Workspace` owns the folders of one job. It writes stages into one new
folder below the shared checkpoint folder and removes what is left of them when
it is closed, after success and after failure alike.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from revlens.sources.sinks import write_parquet

log = logging.getLogger(__name__)

#: Name of the manifest; readers of parquet skip names that begin with an underscore.
MANIFEST = "_manifest.json"


class IncompleteStage(Exception):
    """A stage's folder does not hold what its manifest says, or has no manifest."""


@dataclass
class Manifest:
    rows: int
    files: dict[str, int]  # name and size in bytes

    def to_json(self) -> str:
        return json.dumps({"rows": self.rows, "files": dict(sorted(self.files.items()))})

    @staticmethod
    def from_json(text: str) -> "Manifest":
        try:
            held = json.loads(text)
            return Manifest(int(held["rows"]), {str(k): int(v) for k, v in held["files"].items()})
        except (ValueError, KeyError, TypeError, AttributeError) as fault:
            raise IncompleteStage("the manifest cannot be read") from fault


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _data_files(spark: SparkSession, path: str) -> dict[str, int]:
    fs, where = _file_system(spark, path)
    if not fs.exists(where):
        return {}
    held = ((s.getPath().getName(), int(s.getLen())) for s in fs.listStatus(where) if s.isFile())
    return {name: size for name, size in held if not name.startswith(("_", "."))}


def read_manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The manifest of a folder, None if it has none."""
    fs, folder = _file_system(spark, path)
    where = spark._jvm.org.apache.hadoop.fs.Path(folder, MANIFEST)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return Manifest.from_json(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_stage(df: DataFrame | Sequence[DataFrame], path: str, num_files: int | None = None) -> Manifest:
    """Write ``df`` to ``path`` (replacing what is there), then its manifest.

    Several frames are written one after the other, to ``num_files`` files each. Only the last write leaves a ``_SUCCESS`` mark.
    """
    frames = [df] if isinstance(df, DataFrame) else list(df)
    spark = frames[0].sparkSession
    fs, folder = _file_system(spark, path)
    where = spark._jvm.org.apache.hadoop.fs.Path(folder, MANIFEST)
    fs.delete(where, False)  # a manifest of an older write must not vouch for this one
    rows = 0
    for k, frame in enumerate(frames, 1):
        obs = Observation(f"rows-{uuid.uuid4().hex}")
        write_parquet(frame.observe(obs, F.count(F.lit(1)).alias("rows")), path, num_files, "append" if k > 1 else "overwrite", last=k == len(frames))
        rows += int(obs.get["rows"])
    manifest = Manifest(rows, _data_files(spark, path))
    stream = fs.create(where, True)
    try:
        stream.write(bytearray(manifest.to_json().encode()))
    finally:
        stream.close()
    return manifest


def check_stage(spark: SparkSession, path: str) -> Manifest:
    """The manifest of a complete folder; raises :class:`IncompleteStage` otherwise."""
    manifest = read_manifest(spark, path)
    if manifest is None:
        raise IncompleteStage(f"{path} has no manifest: its write did not end, or it is no stage")
    held = _data_files(spark, path)
    if held != manifest.files:
        missing = sorted(manifest.files.keys() - held.keys())
        added = sorted(held.keys() - manifest.files.keys())
        changed = sorted(k for k in held.keys() & manifest.files.keys() if held[k] != manifest.files[k])
        raise IncompleteStage(f"{path}: files missing {missing}, added {added}, of another size {changed}")
    return manifest


def check_source(spark: SparkSession, path: str) -> Manifest | None:
    """Check a folder that another job may have written; ``path`` may end in a file glob.

    With a manifest it must match it. Without one the folder must at least bear
    the ``_SUCCESS`` mark of a write that ended; None is returned then.
    """
    parent, _, last = path.rstrip("/").rpartition("/")
    folder = parent if "*" in last else path
    if read_manifest(spark, folder) is not None:
        return check_stage(spark, folder)
    fs, where = _file_system(spark, folder)
    if not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(where, "_SUCCESS")):
        raise IncompleteStage(f"{folder} has neither a manifest nor a _SUCCESS mark: its write did not end")
    return None


def read_stage(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The table of a complete stage; with ``schema`` under that declared schema."""
    check_stage(spark, path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


class Workspace:
    """Work folders of one job below the shared checkpoint folder, removed by whoever opened it.

    As a context manager it removes all its stages at the end, also when the job
    fails. A result that is read later (a lazy frame) keeps the stages it names::

        work = Workspace(spark, "pairs")
        pairs = work.stage(neighbour_pairs(edges), "pairs")
        ...
        work.close(keep=["pairs"])
    """

    def __init__(self, spark: SparkSession, name: str, root: str | None = None):
        from revlens.plans.session import checkpoint_dir  # the plans import the operators, which import this

        self.spark = spark
        base = root if root is not None else checkpoint_dir(spark)
        self.path = f"{base.rstrip('/')}/revlens-{name}-{uuid.uuid4().hex}"
        self.manifests: dict[str, Manifest] = {}

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def stage(self, df: DataFrame | Sequence[DataFrame], name: str, num_files: int | None = None) -> DataFrame:
        """Write ``df``, or several frames, as a stage and give back its checked reader: the lineage ends there."""
        if name in self.manifests:
            raise ValueError(f"stage {name!r} is already written")
        schema = (df if isinstance(df, DataFrame) else df[0]).schema
        self.manifests[name] = write_stage(df, self.folder(name), num_files)
        return read_stage(self.spark, self.folder(name), schema)

    def rows(self, name: str) -> int:
        return self.manifests[name].rows

    def close(self, keep: Iterable[str] = ()) -> None:
        """Remove every stage but those named, and the folder itself if none is kept."""
        kept = set(keep)
        unknown = kept - self.manifests.keys()
        if unknown:
            raise ValueError(f"no such stages: {sorted(unknown)}")
        if not kept:
            remove_folder(self.spark, self.path)
        for name in self.manifests.keys() - kept:
            if kept:
                remove_folder(self.spark, self.folder(name))
        self.manifests = {k: v for k, v in self.manifests.items() if k in kept}

    def __enter__(self) -> "Workspace":
        return self

    def __exit__(self, *fault) -> None:
        self.close()
