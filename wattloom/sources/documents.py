"""Text documents: folder scan with name patterns, collections, preview."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.texts import file_title


def wanted(file_url: Column, patterns: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [file_url.ilike(p) for p in patterns])


def path_below(root: str, file_url: Column) -> Column:
    """Path of a file below ``root``, an absolute path or URL without patterns, with the URL's escapes resolved."""
    scheme = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"
    top = re.sub(scheme, "", root).rstrip("/")
    if top and not top.startswith("/"):
        raise ValueError(f"root {root!r} is not absolute")
    path = F.url_decode(F.replace(file_url, F.lit("+"), F.lit("%2B")))
    return F.substr(F.regexp_replace(path, scheme, ""), F.lit(len(top) + 2))


def scan_documents(spark: SparkSession, root: str, patterns: tuple[str, ...] = ("%.md", "%.txt")) -> DataFrame:
    """Every file below ``root`` whose path matches one of the ILIKE patterns, as one row each."""
    files = (spark.read.option("recursiveFileLookup", "true").text(root, wholetext=True)
             .select(F.col("_metadata.file_path").alias("file_url"), F.col("value").alias("content")))
    return files.where(wanted(F.col("file_url"), patterns)).select(
        path_below(root, F.col("file_url")).alias("relative_path"), "file_url", "content")


def collection(parsed: DataFrame, folder: str) -> DataFrame:
    """Documents of one folder, with the file name as title."""
    return (parsed.where(F.concat(F.lit("/"), "relative_path").ilike(f"%/{folder}/%"))
            .withColumn("title", file_title(F.col("relative_path"))))


def preview(parsed: DataFrame, rows: int = 5, characters: int = 200) -> DataFrame:
    return (parsed.orderBy("relative_path").limit(rows)
            .select("relative_path", F.left("content", F.lit(characters)).alias("content_preview")))
