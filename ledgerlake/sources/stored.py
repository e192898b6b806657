"""Tables that are replaced as a whole: a folder for each version, one pointer.

A load writes a new version folder next to the old ones and then moves the
table's pointer to it, in one rename. Until then every reader sees the old
rows; a reader that has begun stays on the version that it opened. A load
that is killed leaves a folder that nothing points to, and the old rows.

The rename must replace its target in one step, as HDFS and local disks do.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

POINTER = "CURRENT"


class TableStore:
    """Named tables below one folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # ------------------------------------------------------------- file system
    def _hadoop(self, path: str):
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        return jvm, conf, fs, fs.makeQualified(p)

    def _move_pointer(self, name: str, version: str) -> None:
        jvm, conf, fs, target = self._hadoop(f"{self.path}/{name}/{POINTER}")
        _, _, _, draft = self._hadoop(f"{self.path}/{name}/{POINTER}-{version}")
        out = fs.create(draft, True)
        out.write(bytearray(version.encode()))
        out.close()
        overwrite = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
        how = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        how[0] = overwrite
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(draft, target, how)

    def version(self, name: str) -> str | None:
        """The version that readers get, or None if nothing was loaded yet."""
        jvm, _, fs, pointer = self._hadoop(f"{self.path}/{name}/{POINTER}")
        if not fs.exists(pointer):
            return None
        stream = fs.open(pointer)
        try:
            return jvm.java.util.Scanner(stream).next()
        finally:
            stream.close()

    # ------------------------------------------------------------------- tables
    def folder(self, name: str, version: str) -> str:
        return f"{self.path}/{name}/v-{version}"

    def replace(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> str:
        """Write ``df`` as the next version of ``name`` and point to it; returns the version."""
        version = uuid.uuid4().hex
        df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(self.folder(name, version))
        self._move_pointer(name, version)
        return version

    def read(self, name: str, schema: T.StructType, version: str | None = None) -> DataFrame:
        """The rows of the current (or the given) version, whatever is loaded meanwhile."""
        version = version or self.version(name)
        if version is None:
            raise ValueError(f"{name} was never loaded into {self.path}")
        return self.spark.read.schema(schema).parquet(self.folder(name, version))

    def versions(self, name: str) -> list[str]:
        _, _, fs, folder = self._hadoop(f"{self.path}/{name}")
        if not fs.exists(folder):
            return []
        found = sorted((s.getModificationTime(), s.getPath().getName()) for s in fs.listStatus(folder) if s.isDirectory())
        return [n[2:] for _, n in found if n.startswith("v-")]

    def drop_old_versions(self, name: str, keep: int = 1) -> list[str]:
        """Remove all but the current version and the ``keep`` newest others; readers of those must have ended."""
        current = self.version(name)
        others = [v for v in self.versions(name) if v != current]
        gone = others[: max(len(others) - keep, 0)]
        for v in gone:
            _, _, fs, folder = self._hadoop(self.folder(name, v))
            fs.delete(folder, True)
        return gone
