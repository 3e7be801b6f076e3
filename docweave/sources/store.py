"""Collections as numbered Parquet snapshots, committed by creating a file that must not exist."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import CONFLICT, DUPLICATE, DocumentError
from ..functions.files import Files
from ..operators.mutate import duplicates
from ..operators.versions import Conflicts


class Store:
    """One collection: <path>/data/<id> folders of Parquet, and <path>/commits/<n> files that name the folder of version n.

    Creating a commit file fails if it exists (see Files), so of two writers that read version n one becomes n + 1 and
    the other starts again from there.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark, path)

    def versions(self) -> list[int]:
        return self.files.numbers("commits")

    def _folder(self, version: int) -> str:
        return f"{self.path}/data/" + self.files.text(f"commits/{version:09d}")

    def read(self, version: int | None = None) -> DataFrame:
        """The newest snapshot, or a given one."""
        known = self.versions()
        if not known:
            raise DocumentError(CONFLICT, f"nothing committed at {self.path}")
        return self.spark.read.parquet(self._folder(known[-1] if version is None else version))

    def create(self, df: DataFrame, partition_by: list[str] | None = None) -> int:
        return self._commit(df, 0, partition_by)

    def _commit(self, df: DataFrame, version: int, partition_by: list[str] | None = None) -> int:
        name = uuid.uuid4().hex
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(f"{self.path}/data/{name}")
        if not self.files.create(f"commits/{version:09d}", name):  # another writer was first
            self.files.delete(f"data/{name}")
            raise DocumentError(CONFLICT, f"version {version} exists")
        return version

    def change(self, transform: Callable[[DataFrame], DataFrame], unique: list[list[str]] = (), options: Conflicts = Conflicts()) -> int:
        """Commit transform(newest snapshot) as the next version; on a conflict the transform runs again on the new newest.

        unique lists key columns that no two documents may share; a violation raises and nothing is committed.
        """
        for attempt in range(options.retries + 1):
            newest = self.versions()[-1]
            after = transform(self.read(newest))
            for keys in unique:
                if not duplicates(after, keys).isEmpty():
                    raise DocumentError(DUPLICATE, ",".join(keys))
            try:
                return self._commit(after, newest + 1)
            except DocumentError as e:
                if e.code != CONFLICT or attempt == options.retries or not options.detection:
                    raise
        raise AssertionError("unreachable")

    def healthy(self) -> dict[str, object]:
        """Whether the folder can be listed and the newest snapshot has a schema."""
        try:
            known = self.versions()
            fields = len(self.read().schema.fields) if known else 0
            self.spark.range(1).agg(F.count("*")).first()
            return {"ok": True, "versions": len(known), "fields": fields}
        except Exception as e:  # a probe reports, it doesn't raise
            return {"ok": False, "error": str(e)[:200]}
