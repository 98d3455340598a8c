"""Tables that change part by part, in versions that readers can pin.

A version writes only the parts it changes and then, in one small file, which version each part has now. Readers of a version see
all of its parts or, before that file is there, the version before; writing a version again replaces it. Parts that no kept version
names are removed by :meth:`VersionedTable.vacuum`.

The list of parts is small by design (hash buckets, hours, or one part for a dimension) and is all that reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class VersionedTable:
    """Rows divided by the text of column ``by`` under ``folder``; versions are whole numbers."""

    def __init__(self, spark: SparkSession, folder: str, by: str = "part"):
        self.spark, self.folder, self.by = spark, folder.rstrip("/"), by

    def _files(self):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))

    def versions(self) -> list[int]:
        """Committed versions, ascending."""
        files, at = self._files(), self._path("manifest")
        if not files.exists(at):
            return []
        names = [s.getPath() for s in files.listStatus(at)]
        return sorted(int(p.getName().split("=")[1]) for p in names if files.exists(self._path("manifest", p.getName(), "_SUCCESS")))

    def parts(self, version: int | None) -> dict[str, int]:
        """The version that holds each part, as of ``version``."""
        if version is None:
            return {}
        return {r["part"]: r["at"] for r in self.spark.read.schema("part string, at bigint").parquet(f"{self.folder}/manifest/version={version}").collect()}

    def read(self, version: int | None, only: Iterable[str] | None = None) -> DataFrame | None:
        """The rows of a version, or of some of its parts; None where there are none."""
        held = self.parts(version)
        wanted = sorted(held if only is None else set(only) & set(held))
        if not wanted:
            return None
        by_version: dict[int, list[str]] = {}
        for part in wanted:
            by_version.setdefault(held[part], []).append(part)
        frames = []
        for at, names in by_version.items():
            rows = self.spark.read.option("basePath", f"{self.folder}/data/version={at}").parquet(*[f"{self.folder}/data/version={at}/{self.by}={n}" for n in names])
            frames.append(rows.withColumn(self.by, F.col(self.by).cast("string")))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

    def commit(self, version: int, rows: DataFrame, changed: Iterable[str], base: int | None = None) -> None:
        """Make ``version``: ``rows`` are the new contents of the ``changed`` parts, the others are as in ``base``."""
        changed = set(changed)
        rows.withColumn(self.by, F.col(self.by).cast("string")).write.mode("overwrite").partitionBy(self.by).parquet(f"{self.folder}/data/version={version}")
        files = self._files()
        held = {p: v for p, v in self.parts(base).items() if p not in changed}
        held |= {p: version for p in changed if files.exists(self._path("data", f"version={version}", f"{self.by}={p}"))}
        manifest = self.spark.createDataFrame(sorted(held.items()), "part string, at bigint")
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/manifest/version={version}")

    def vacuum(self, keep: int = 2) -> int:
        """Remove versions before the last ``keep`` and the parts that only they name; gives the number of removed parts."""
        known = self.versions()
        kept, old = known[-keep:], known[:-keep]
        if not old:
            return 0
        named = {(p, v) for k in kept for p, v in self.parts(k).items()}
        files, removed = self._files(), 0
        for version in [s.getPath().getName() for s in files.listStatus(self._path("data"))]:
            number = int(version.split("=")[1])
            if number >= kept[0]:
                continue
            left = 0
            for part in [s.getPath().getName() for s in files.listStatus(self._path("data", version)) if "=" in s.getPath().getName()]:
                if (part.split("=", 1)[1], number) in named:
                    left += 1
                else:
                    files.delete(self._path("data", version, part), True)
                    removed += 1
            if not left:
                files.delete(self._path("data", version), True)
        for version in old:
            files.delete(self._path("manifest", f"version={version}"), True)
        return removed


class PinnedDimension:
    """A dimension table whose snapshots are versions, with the version of each micro-batch written down.

    ``load`` reads the source; it is asked again when ``every`` batches have passed since the last snapshot. A batch that is run again finds
    its pin and reads the same version, however often the source has changed since.
    """

    def __init__(self, spark: SparkSession, folder: str, load: Callable[[], DataFrame], every: int = 5, keep: int = 3):
        self.table = VersionedTable(spark, f"{folder}/snapshots")
        self.pins, self.load, self.every, self.keep = f"{folder}/pins", load, every, keep

    def _pin(self, batch_id: int) -> str:
        return f"{self.pins}/batch_id={batch_id}"

    def at(self, batch_id: int) -> DataFrame:
        """The snapshot that micro-batch ``batch_id`` uses."""
        spark = self.table.spark
        files, path = self.table._files(), spark._jvm.org.apache.hadoop.fs.Path
        if files.exists(path(f"{self._pin(batch_id)}/_SUCCESS")):
            version = spark.read.schema("snapshot bigint").parquet(self._pin(batch_id)).first()[0]
        else:
            known = self.table.versions()
            if not known or batch_id - known[-1] >= self.every:
                self.table.commit(batch_id, self.load().withColumn("part", F.lit("all")), ["all"])
                known.append(batch_id)
            version = known[-1]
            spark.createDataFrame([(version,)], "snapshot bigint").coalesce(1).write.mode("overwrite").parquet(self._pin(batch_id))
            files.delete(path(self._pin(batch_id - self.keep)), True)
            self.table.vacuum(self.keep + 1)
        found = self.table.read(version)
        return found.drop("part") if found is not None else self.load().limit(0)
