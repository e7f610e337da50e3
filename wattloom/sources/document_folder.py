"""A folder of documents, scanned again and again: each scan reads only the files that are new or changed since the last one.

Layout below the state folder, all Parquet:

* ``files/scan=<n>``: one row per file that scan n read: path, time, size and content.
* ``dead/scan=<n>``: (file, scan that read it) of what scan n found changed or gone.
* ``commits/scan=<n>``: one row per finished scan. A scan that breaks off is done anew under its number and replaces what it left.

A scan lists the files without opening them and compares path, modification time and size with what is stored; a change that alters neither time (in
milliseconds) nor size is not seen. A file without a byte counts as absent, as Spark's readers skip it. One scan at a time may write.

Plain text in a folder that all machines have mounted is listed and read by the tasks themselves (``shared_files``), anything else by Spark's readers;
both name files alike and give the same rows, so a state may be kept by either.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.session import settings, small_side, store
from wattloom.sources import shared_files
from wattloom.sources.documents import path_below, wanted

FILES = "file_url string, relative_path string, modified timestamp, size long, content string, scan int"
DEAD = "file_url string, in_scan int, scan int"
COMMITS = "read long, dropped long, scan int"
#: Up to so many changed files are named one by one in the scan's filter; more are found by a join within their span of modification times.
NAMED_FILES = 10_000
#: Documents are small files, of which a task should read thousands; at Spark's own figure (4 MB) it reads 32.
SMALL_FILES = {"spark.sql.files.openCostInBytes": str(16 << 10)}
#: Ends of the patterns of files that Spark's reader takes as they are, whatever codecs it knows.
PLAIN = (".md", ".txt")


class DocumentFolder:
    """Documents below ``root``, with their state below ``path``."""

    def __init__(self, spark: SparkSession, root: str, path: str, patterns: tuple[str, ...] = ("%.md", "%.txt"),
                 named_files: int = NAMED_FILES) -> None:
        self.spark, self.root, self.path = spark, root, path.rstrip("/")
        self.patterns, self.named_files = patterns, named_files

    def commits(self) -> list:
        """Finished scans, oldest first: one row each."""
        try:
            return self.spark.read.schema(COMMITS).parquet(f"{self.path}/commits").orderBy("scan").collect()
        except AnalysisException as fault:
            if fault.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def documents(self, commits: list | None = None) -> DataFrame:
        """The documents as of the last finished scan."""
        done = len(self.commits() if commits is None else commits)
        if not done:
            return self.spark.createDataFrame([], FILES)
        read, dead = (self.spark.read.schema(layout).parquet(f"{self.path}/{kind}").where(F.col("scan") < done)
                      for kind, layout in (("files", FILES), ("dead", DEAD)))
        gone = dead.select("file_url", F.col("in_scan").alias("scan"))  # a few bytes a row; contents don't move where it is small
        return read.join(small_side(gone), ["file_url", "scan"], "left_anti").select(*read.columns)

    def _files(self, source: str) -> DataFrame:
        reader = self.spark.read.option("recursiveFileLookup", "true")
        files = reader.format("binaryFile").load(self.root) if source == "listing" else reader.text(self.root, wholetext=True)
        content = [] if source == "listing" else [F.col("value").alias("content")]
        listed = files.select(F.col("_metadata.file_path").alias("file_url"), F.col("_metadata.file_modification_time").alias("modified"),
                              F.col("_metadata.file_size").alias("size"), *content)
        return listed.where(wanted(F.col("file_url"), self.patterns))

    def _contents(self, changed: DataFrame) -> DataFrame:
        """The changed files as they are now; filters on path and time keep the others from being opened."""
        files = self._files("contents")
        named = [r.file_url for r in changed.select("file_url").limit(self.named_files + 1).collect()]  # bounded
        if len(named) <= self.named_files:
            return files.where(F.col("file_url").isin(named))
        earliest = changed.agg(F.min("modified")).first()[0]
        return files.where(F.col("modified") >= F.lit(earliest)).join(changed.select("file_url"), "file_url", "left_semi")

    def _shared(self) -> str | None:
        """The path of the folder if tasks can list and read it themselves; a root that is missing or a file is left to Spark's readers."""
        path = shared_files.shared_path(self.spark, self.root)
        return path if path and os.path.isdir(path) and all(p.lower().endswith(PLAIN) for p in self.patterns) else None

    def scan(self) -> dict[str, int]:
        """Read what is new or changed, drop what is gone; returns how many files were read and how many stored versions dropped."""
        with settings(self.spark, SMALL_FILES):
            return self._scan()

    def _scan(self) -> dict[str, int]:
        commits = self.commits()
        number = len(commits)
        known = self.documents(commits).select("file_url", F.col("modified").alias("known_modified"), F.col("size").alias("known_size"),
                                               F.col("scan").alias("in_scan"))
        shared = self._shared()
        listed = shared_files.listed(self.spark, shared).where(wanted(F.col("file_url"), self.patterns)) if shared else self._files("listing")
        state = listed.join(known, "file_url", "full")
        same = F.col("modified").eqNullSafe(F.col("known_modified")) & F.col("size").eqNullSafe(F.col("known_size"))
        state = store(state.where(~same), "document-scan")
        folder = f"scan={number}"
        (state.where("in_scan is not null").select("file_url", "in_scan").write.mode("overwrite").parquet(f"{self.path}/dead/{folder}"))
        changed = state.where("size is not null").select("file_url", "modified", "size")
        contents = shared_files.contents(changed) if shared else self._contents(changed)
        (contents.withColumn("relative_path", path_below(self.root, F.col("file_url")))
         .write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/files/{folder}"))  # texts, in about two thirds of Snappy's bytes
        counts = [self.spark.read.schema(layout).parquet(f"{self.path}/{kind}/{folder}").count()  # from footers
                  for kind, layout in (("files", "file_url string"), ("dead", "file_url string"))]
        done = self.spark.createDataFrame([tuple(counts)], "read long, dropped long").coalesce(1)
        done.write.mode("overwrite").parquet(f"{self.path}/commits/{folder}")
        return {"read": counts[0], "dropped": counts[1]}
