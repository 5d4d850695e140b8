"""Intermediate results that later steps share, kept as tables while their input stays as it is."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from clicklake.session import shared_base


class Stages:
    """Named results of one set of input files, each computed once per application.

    A result is a table in the shared folder, filed under a fingerprint of the input: the names,
    sizes and times of change of all files in ``inputs`` (files or folders). Where the input has changed
    the results are computed anew and those of the former input are deleted.
    """

    def __init__(self, spark: SparkSession, inputs: Sequence[str]) -> None:
        self.spark, self.inputs = spark, sorted(inputs)
        name = hashlib.sha256("\n".join(self.inputs).encode()).hexdigest()[:16]
        self.folder = f"{shared_base(spark)}/clicklake-stages-{spark.sparkContext.applicationId}/{name}"

    def _path(self, text: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(text)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def fingerprint(self) -> str:
        """A hash of the names, sizes and times of change of all input files."""
        files = []
        for name in self.inputs:
            path, system = self._path(name)
            found = system.listFiles(path, True)
            while found.hasNext():
                file = found.next()
                files.append(f"{file.getPath()} {file.getLen()} {file.getModificationTime()}")
        return hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest()[:16]

    def get(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stored result, or that of ``build`` once it is stored.

        A lost executor only re-reads files instead of repeating the derivation.
        """
        print_now = self.fingerprint()
        target = f"{self.folder}/{print_now}/{name}"
        done, system = self._path(f"{target}/_SUCCESS")
        if not system.exists(done):
            self._drop_others(print_now)
            build().write.mode("overwrite").option("compression", "zstd").parquet(target)
        return self.spark.read.parquet(target)

    def get_folder(self, name: str, write: Callable[[str], object]) -> str:
        """A folder of several tables that ``write`` fills, once it is filled."""
        print_now = self.fingerprint()
        target = f"{self.folder}/{print_now}/{name}"
        done, system = self._path(f"{target}/_SUCCESS")
        if not system.exists(done):
            self._drop_others(print_now)
            system.delete(self._path(target)[0], True)  # what a failed attempt left
            write(target)
            system.create(done).close()
        return target

    def _drop_others(self, kept: str) -> None:
        top, system = self._path(self.folder)
        if system.exists(top):
            for entry in system.listStatus(top):
                if entry.getPath().getName() != kept:
                    system.delete(entry.getPath(), True)

    def drop(self) -> None:
        """Delete all results of these inputs."""
        top, system = self._path(self.folder)
        system.delete(top, True)
