"""A bounded walk through a folder tree, level by level: the folders of a level are listed by many tasks, and excluded ones are never opened."""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import patterns as P
from ..operators.lint import is_candidate, is_secret
from ..operators.ordered import positions
from .shared import written

MOST_DEPTH, MOST_FILES = 16, 5_000
_ENTRIES = "parent string, name string, kind string, size long, problem string"


def _local(path: str) -> str | None:
    return path.removeprefix("file://").removeprefix("file:") if "://" not in path.removeprefix("file://") else None


def _entries(root: str, parent: str) -> list[tuple]:
    """(parent, name, kind, size, problem) of what lies directly in a folder; links are named, not followed."""
    where = f"{root}/{parent}" if parent else root
    local = _local(where)
    if local is not None:
        with os.scandir(local) as found:
            return [(parent, e.name, "link" if e.is_symlink() else "folder" if e.is_dir(follow_symlinks=False) else "file", e.stat(follow_symlinks=False).st_size, None) for e in found]
    from pyarrow import fs

    files, path = fs.FileSystem.from_uri(where)
    found = files.get_file_info(fs.FileSelector(path, recursive=False))
    return [(parent, os.path.basename(i.path), "folder" if i.type == fs.FileType.Directory else "file", i.size, None) for i in found]


def _list(root: str):
    def run(batches):
        for b in batches:
            for parent in b.column("parent").to_pylist():
                try:
                    rows = _entries(root, parent)
                except OSError as e:  # one closed folder does not end the walk; it is reported
                    rows = [(parent, "", "folder", None, type(e).__name__)]
                columns = list(zip(*rows)) or [()] * 5
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()))], names=["parent", "name", "kind", "size", "problem"])

    return run


def walk(spark: SparkSession, root: str, most_depth: int = MOST_DEPTH, most_files: int | None = MOST_FILES, include_documents: bool = True, tasks: int | None = None) -> DataFrame:
    """(level, path, kind, size, excluded, problem) of everything met below a root; `excluded` is null for folders that were opened and files that are listed.

    Links, secret and excluded folders and those below `most_depth` are met but not opened; links, secret files, files that are no
    candidates (`lint.is_candidate`) and, in path order, those beyond `most_files` are left out with that reason. A folder that
    cannot be read has a row with the error's name in `problem`; the walk goes on.
    """
    root = root.rstrip("/")
    frontier = spark.createDataFrame([("",)], "parent string")
    out, level = None, 0
    while True:
        listed = frontier.repartition(tasks or spark.sparkContext.defaultParallelism, "parent").mapInArrow(_list(root), _ENTRIES)
        rows = listed.select(F.lit(level).alias("level"), F.concat_ws("/", F.nullif("parent", F.lit("")), F.nullif("name", F.lit(""))).alias("path"), "name", "kind", "size", "problem")
        low = F.lower("name")
        why_folder = F.when(low.isin(*P.SECRET_FOLDERS), "secret-path").when(low.isin(*P.EXCLUDED_FOLDERS), "excluded-directory").when(F.lit(level + 1 > most_depth), "depth-limit")
        why_file = F.when(is_secret(F.col("name")), "secret-path").when(~is_candidate(F.col("path"), include_documents), "no-candidate")
        why = F.when(F.col("problem").isNotNull(), "unreadable").when(F.col("kind") == "link", "symlink").when(F.col("kind") == "folder", why_folder).otherwise(why_file)
        rows = written(rows.withColumn("excluded", why).drop("name"), f"walk{level}")
        out = rows if out is None else out.unionByName(rows)
        frontier = rows.where("kind = 'folder' and excluded is null").select(F.col("path").alias("parent"))
        if not frontier.limit(1).count():
            break
        level += 1
    if most_files is None:
        return out
    kept = positions(out.where("kind = 'file' and excluded is null"), ["path"], "n")
    kept = kept.withColumn("excluded", F.when(F.col("n") >= most_files, "file-limit")).drop("n")
    return out.where("kind <> 'file' or excluded is not null").unionByName(kept)


def exclusions(found: DataFrame) -> DataFrame:
    """(excluded, n): how much was left out, and why."""
    return found.where("excluded is not null").groupBy("excluded").agg(F.count("*").alias("n"))
