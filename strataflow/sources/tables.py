"""Tables between the steps of a job, and publishing several tables as one."""

from __future__ import annotations

import datetime
import json
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a folder of our own, but only with a local master."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="strataflow-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def kept(df: DataFrame) -> DataFrame:
    """df written as Parquet to the shared folder and read again: cuts the lineage, and survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/strataflow/step-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class _Files:
    """The few file operations that a publication needs, on whatever file system the root is on."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._jvm = spark._jvm
        self._fs = self._path(root).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def move(self, old: str, new: str) -> None:
        self._fs.mkdirs(self._path(new).getParent())
        if not self._fs.rename(self._path(old), self._path(new)):
            raise OSError(f"could not move {old} to {new}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def write(self, path: str, text: str) -> None:
        """Written aside and moved into place, so that it is there whole or not at all."""
        out = self._fs.create(self._path(path + ".part"), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.move(path + ".part", path)

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


PLAN = "_publication.json"


class Publication:
    """A10, A13. Several tables below one root that change together.

    publish() writes all of them aside, counts what can be read back, records the plan, and only then swaps: each live table moves to a backup folder named by the time, and the new one takes its place. A run
    that breaks off before the plan leaves the live tables alone; after it, recover() (which publish() calls first) goes on with the swap, step by step; each step looks at what is there, so it may be run
    any number of times. Readers find a table missing for the moment between two renames, never half written. One publisher at a time.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = _Files(spark, self.root)

    def publish(self, tables: dict[str, DataFrame], write=None, expected: dict[str, int] | None = None, at: datetime.datetime | None = None) -> str:
        """Publishes tables (name: DataFrame) and returns the backup folder. write(df, path) writes one (Parquet if None). expected: rows that a table must have; other ones must have been
        counted alike before and after writing, so a table whose source moves meanwhile isn't published."""
        self.recover()
        run = uuid.uuid4().hex[:8]
        staging = f"{self.root}/.staging-{run}"
        stamp = (at or datetime.datetime.now(datetime.UTC)).strftime("%Y%m%dT%H%M%S")
        write = write or (lambda df, path: df.write.parquet(path))
        try:
            for name, df in tables.items():
                write(df, f"{staging}/{name}")
                want = (expected or {}).get(name)
                want = df.count() if want is None else want
                found = self._rows(f"{staging}/{name}")
                if found != want:
                    raise ValueError(f"{name}: {found} rows were written, not {want}")
        except BaseException:
            self.files.delete(staging)
            raise
        backup = f"{self.root}/.backup-{stamp}-{run}"
        self.files.write(f"{self.root}/{PLAN}", json.dumps({"staging": staging, "backup": backup, "tables": sorted(tables)}))
        self.recover()
        return backup

    def _rows(self, path: str) -> int:
        """Rows of a staged table; text formats count lines, less a header a file if they are CSV."""
        names = [n for n in self.spark.read.format("binaryFile").load(path).select("path").inputFiles() if not n.rpartition("/")[2].startswith(("_", "."))]
        if any(n.endswith(".parquet") for n in names) or not names:
            return self.spark.read.parquet(path).count()
        if any(".csv" in n for n in names):
            return self.spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True).count()
        return self.spark.read.text(path).count()

    def recover(self) -> bool:
        """Finishes a swap that was begun; says whether there was one."""
        plan_at = f"{self.root}/{PLAN}"
        if not self.files.exists(plan_at):
            return False
        plan = json.loads(self.files.read(plan_at))
        for name in plan["tables"]:
            live, new, old = f"{self.root}/{name}", f"{plan['staging']}/{name}", f"{plan['backup']}/{name}"
            if self.files.exists(new):  # else this one is done
                if self.files.exists(live):
                    self.files.move(live, old)
                self.files.move(new, live)
        self.files.delete(plan["staging"])
        self.files.delete(plan_at)
        return True
