"""Small files on the file systems that Spark reaches, and the folder for checkpoints."""

from __future__ import annotations

import tempfile
import time

from pyspark.sql import SparkSession

from ..errors import CONFLICT, DocumentError


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's spark.checkpoint.dir; a local session without one gets a temporary folder."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="docweave-"))


class Files:
    """Files below a folder that are created once and never changed.

    Needs a file system whose create fails if the file exists (HDFS, local disks); on an object store without it two
    writers may both believe that they were first.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path, self.make = path.rstrip("/"), spark._jvm.org.apache.hadoop.fs.Path
        self.system = self.make(self.path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        self.spark = spark

    def numbers(self, folder: str) -> list[int]:
        """The files of a folder whose names are numbers, in order."""
        at = self.make(f"{self.path}/{folder}")
        if not self.system.exists(at):
            return []
        return sorted(int(s.getPath().getName()) for s in self.system.listStatus(at) if s.getPath().getName().isdigit())

    def create(self, name: str, text: str) -> bool:
        """Whether this call made the file; False if it exists. Other failures are raised."""
        at = self.make(f"{self.path}/{name}")
        try:
            out = self.system.create(at, False)
        except Exception:
            if self.system.exists(at):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def text(self, name: str, wait: float = 10.0) -> str:
        """What the file holds; one that another writer has made but not yet filled is waited for."""
        until = time.monotonic() + wait
        while True:
            rows = self.spark.read.text(f"{self.path}/{name}", wholetext=True).collect()
            if rows and rows[0][0]:
                return rows[0][0]
            if time.monotonic() > until:
                raise DocumentError(CONFLICT, f"{name} is empty")
            time.sleep(0.1)

    def delete(self, name: str) -> None:
        self.system.delete(self.make(f"{self.path}/{name}"), True)
