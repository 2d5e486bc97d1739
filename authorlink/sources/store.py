"""Where deliveries leave the master: versions, published whole, in buckets of the slot.

Under the root lie ``data/<id>/master`` and ``data/<id>/stage`` of every version, and a small file
``releases/<number>.json`` that names them. A version is there for readers once this file is, so
master and staging table appear together or not at all, and readers keep the version they opened. The
file is made under another name and renamed to its number, which fails if somebody
else published that number meanwhile.

The master lies in buckets of ``MASTER_SLOT``: the next run compares its feed with it, lays changes over
it and merges into it without moving it.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from authorlink.schemas import MASTER, MASTER_SLOT
from authorlink.sources.buckets import Buckets, write_buckets

#: Master rows that a bucket is meant for, where no number of buckets is given.
ROWS_PER_BUCKET = 2_000_000


@dataclass(frozen=True)
class Release:
    """A published version."""

    number: int
    master: str
    buckets: int
    stage: str | None = None


class StaleRelease(RuntimeError):
    """Another run has published since this one read its master."""


class MasterStore:
    """Versions of the master and its staging table under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark = spark
        self._root = root.rstrip("/")
        self._tables = Buckets(spark)

    # --- reading

    def releases(self) -> list[Release]:
        """All published versions, the oldest first."""
        fs, folder = self._file_system(f"{self._root}/releases")
        if not fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(folder)]
        found = []
        for name in sorted(n for n in names if n.endswith(".json") and not n.startswith(".")):
            text = self._spark.read.text(f"{self._root}/releases/{name}", wholetext=True).first()[0]
            found.append(Release(**json.loads(text)))
        return found

    def current(self) -> Release | None:
        """The version published last."""
        releases = self.releases()
        return releases[-1] if releases else None

    def master(self, release: Release | None = None) -> DataFrame:
        """The master of a version, in its buckets; an empty one if nothing was published yet."""
        release = release or self.current()
        if release is None:
            return self._spark.createDataFrame([], MASTER)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in MASTER)
        return self._tables.open(f"{self._root}/{release.master}", columns, MASTER_SLOT, release.buckets)

    def stage(self, release: Release | None = None) -> DataFrame | None:
        """The rows staged for a version, if it has any."""
        release = release or self.current()
        return self._spark.read.parquet(f"{self._root}/{release.stage}") if release and release.stage else None

    def close(self) -> None:
        """Forget the tables that were opened; their files stay."""
        self._tables.close()

    # --- writing

    def publish(
        self, master: DataFrame, stage: DataFrame | None = None, buckets: int | None = None, after: Release | None = None
    ) -> Release:
        """Write master and stage as a new version, and let readers see both at once.

        ``after`` is the version that the run has read; without it, the current one.
        """
        before = after or self.current()
        if buckets is None:
            buckets = before.buckets if before else max(1, -(-master.count() // ROWS_PER_BUCKET))
        folder = f"data/{uuid.uuid4().hex}"
        write_buckets(master, f"{self._root}/{folder}/master", MASTER_SLOT, buckets)
        if stage is not None:
            stage.write.mode("errorifexists").parquet(f"{self._root}/{folder}/stage")
        number = before.number + 1 if before else 1
        release = Release(number, f"{folder}/master", buckets, f"{folder}/stage" if stage is not None else None)
        self._announce(release)
        return release

    def _announce(self, release: Release) -> None:
        folder = f"{self._root}/releases"
        fs, draft = self._file_system(f"{folder}/.{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(asdict(release)).encode()))
        finally:
            out.close()
        _, place = self._file_system(f"{folder}/{release.number:08d}.json")
        # Renaming to a name that is taken fails, or does nothing, by kind of file system.
        taken = fs.exists(place)
        if taken or not fs.rename(draft, place):
            fs.delete(draft, False)
            raise StaleRelease(f"version {release.number} was published by another run")

    def _file_system(self, path: str):
        jvm = self._spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()), place
