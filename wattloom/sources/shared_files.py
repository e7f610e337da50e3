"""Many small files in a folder that the driver and all executors have mounted: listed, read and written by Arrow functions, without Hadoop's client.

For such folders that client starts a ``chmod`` for each file it makes, writes a checksum file beside it, and lists all files on the driver. Names,
times and sizes are those of Spark's readers. Other stores have none of this, and their folders stay with Spark's readers and writers.
"""

from __future__ import annotations

import errno
import os
import re
import shutil
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LISTED = "file_url string, modified timestamp, size long"
STAMP = pa.timestamp("us", "UTC")
LISTED_ARROW = [("file_url", pa.string()), ("modified", STAMP), ("size", pa.int64())]
READ_ARROW = pa.schema([*LISTED_ARROW, ("content", pa.binary())])
#: Rows and bytes of contents in a batch, at least.
BATCH_ROWS, BATCH_BYTES = 4096, 4 << 20
#: Bytes of files that a task reads, and how many files.
TASK_BYTES, TASK_FILES = 32 << 20, 20_000
#: The driver looks into folders, level by level, until it has so many for the tasks to list.
FOLDERS = 64
SCHEME = "file:"
#: What a Java URI escapes in a path: all but these characters, and white space beyond ASCII.
ESCAPED = re.compile(r"[^A-Za-z0-9_@\-!.~'()*:&=+$,;/\u00a1-\U0010ffff]|[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
NOT_UTF8 = re.compile(r"[\ud800-\udfff]")
#: A file or folder that has just gone, and a link that leads nowhere.
GONE = {errno.ENOENT, errno.ENOTDIR, errno.ELOOP}


def shared_path(spark: SparkSession, root: str) -> str | None:
    """The path of ``root`` if it is in the machines' own file system, else None."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    uri = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(path).toUri()
    return uri.getPath().rstrip("/") or "/" if uri.getScheme() == "file" else None


def escaped(path: str) -> str:
    return ESCAPED.sub(lambda m: quote(m[0], safe=""), path)


def file_url(path: str) -> str:
    return SCHEME + escaped(path)


def hidden(name: str, is_folder: bool) -> bool:
    """Whether Spark's readers pass over a file or folder of this name."""
    odd = name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_")
    return odd and not (is_folder and name.startswith(("_metadata", "_common_metadata"))) or NOT_UTF8.search(name) is not None


@contextmanager
def if_there() -> Iterator[None]:
    """What has gone is passed over; any other fault is raised."""
    try:
        yield
    except OSError as fault:
        if fault.errno not in GONE:
            raise


def seen(folder: str) -> Iterator[tuple[os.DirEntry, bool]]:
    """What Spark's readers see in a folder: (entry, is it a folder?)."""
    with if_there(), os.scandir(folder) as found:
        for entry in found:
            with if_there():
                if not hidden(entry.name, is_folder := entry.is_dir()):
                    yield entry, is_folder


def stamp(found: os.stat_result) -> int:
    """Time of change in microseconds, cut to milliseconds."""
    return found.st_mtime_ns // 1_000_000 * 1000


def files_in(folder: str, deep: bool) -> Iterator[tuple[str, int, int]]:
    """(URL, time, size) of the files in a folder, and in those below it if ``deep``; files without a byte are left out."""
    left = [folder]
    while left:
        at = left.pop()
        above = file_url(at.rstrip("/") + "/")
        for entry, is_folder in seen(at):
            if is_folder:
                left += [entry.path] * deep
            else:
                with if_there():
                    if (found := entry.stat()).st_size:
                        yield above + escaped(entry.name), stamp(found), found.st_size


def to_list(top: str, enough: int = FOLDERS) -> list[tuple[str, bool]]:
    """(folder, with all below it?), each to be listed by one task; the driver looks into no more levels than it needs for ``enough``."""
    flat, deep = [], [top]
    while deep and len(deep) < enough:
        flat += deep
        deep = [entry.path for folder in deep for entry, is_folder in seen(folder) if is_folder]
    return [(folder, False) for folder in flat] + [(folder, True) for folder in deep]


def in_batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches; the last field counts by its length if it is of bytes."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += len(row[-1]) if isinstance(row[-1], bytes) else 0
        if len(held) >= BATCH_ROWS or weight >= BATCH_BYTES:
            yield _batch(held, schema)
            held, weight = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema)


def listed(spark: SparkSession, top: str) -> DataFrame:
    """Every file below a folder: URL, time and size. Tasks list the folders; the driver holds no list of files."""

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for folder in zip(*(c.to_pylist() for c in batch.columns)) for row in files_in(*folder))
        return in_batches(rows, pa.schema(LISTED_ARROW))

    return spark.createDataFrame(to_list(top), "folder string, deep boolean").mapInArrow(files, LISTED)


def read_file(url: str) -> tuple[str, int, int, bytes] | None:
    """A file as it is now, or None if it is gone or empty. Its time is taken first, so that a change while it is read shows at the next look."""
    with if_there(), open(unquote(url[len(SCHEME):]), "rb") as file:
        found = os.fstat(file.fileno())
        if found.st_size:
            return url, stamp(found), found.st_size, file.read()
    return None


def contents(files: DataFrame) -> DataFrame:
    """The files of a stored list (columns as in ``listed``) as they are now, with their text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_batches((row for batch in batches for url in batch.column(0).to_pylist() if (row := read_file(url))), READ_ARROW)

    total = files.agg(F.count("*").alias("files"), F.sum("size").alias("bytes")).first()
    tasks = max(1, -(-total.files // TASK_FILES), -(-(total.bytes or 0) // TASK_BYTES))
    dealt = files.select("file_url").repartition(tasks, "file_url")
    return dealt.mapInArrow(read, f"{LISTED}, content binary").withColumn("content", F.col("content").cast("string"))


def put_files(texts: DataFrame, root: str, folders: tuple[str, ...], tasks: int) -> None:
    """Column ``value`` of each row and a line feed as a file of its own below ``root``, in subfolders by the whole numbers in columns ``folders``.

    Subfolders that get rows are replaced, the others stay. Files appear whole and under their names only when all are written. Where Spark's writer
    makes them, so many tasks write, each whole subfolders.
    """
    spark = texts.sparkSession
    top = shared_path(spark, root)
    if top is None:
        (texts.select("value", *folders).repartition(tasks, *folders).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("maxRecordsPerFile", 1).partitionBy(*folders).text(root))
        return
    staged = f"{top}/.write-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, row = TaskContext.get(), set(), 0
        for batch in batches:
            for folder, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                if folder not in made:
                    os.makedirs(f"{staged}/{folder}", exist_ok=True)
                    made.add(folder)
                # an attempt that breaks off leaves what readers pass over; another one writes the same names
                name, open_name = f"part-{task.partitionId():05d}-{row}.txt", f".{task.taskAttemptId()}-{row}"
                with open(f"{staged}/{folder}/{open_name}", "wb") as file:
                    file.write((value or b"") + b"\n")
                os.replace(f"{staged}/{folder}/{open_name}", f"{staged}/{folder}/{name}")
                row += 1
        if made:
            yield pa.RecordBatch.from_pydict({"folder": sorted(made)})

    number = [F.concat(F.lit(f"{name}="), F.coalesce(F.col(name).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))) for name in folders]
    os.makedirs(staged)
    try:
        done = texts.select(F.concat_ws("/", *number).alias("folder"), "value").mapInArrow(write, "folder string").distinct().collect()  # one row a folder
        for folder, in done:
            shutil.rmtree(f"{top}/{folder}", ignore_errors=True)
            os.makedirs(os.path.dirname(f"{top}/{folder}"), exist_ok=True)
            os.rename(f"{staged}/{folder}", f"{top}/{folder}")
    finally:
        shutil.rmtree(staged, ignore_errors=True)
