"""Readers of text, chunk, claim and record files, and writers of their formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.chunks import catalogue, parse_chunks
from ..operators.index import canonical_copies

CLAIM_COLUMNS = ["claim_id", "record_id", "disease", "clinical_domain", "claim_type", "claim_text"]


def whole_texts(spark: SparkSession, root: str, glob: str = "*.md") -> DataFrame:
    """(path, text) of all files below a folder whose names fit; the folder may be on any file system Spark reads."""
    return (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(root, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    )


def folders(paths: DataFrame, root: str) -> DataFrame:
    """Distinct folders directly below the root, hidden and underscored ones left out."""
    rest = F.substring_index(F.regexp_replace("path", F.lit(f"^.*?{root.strip('/').split('/')[-1]}/"), F.lit("")), "/", 1)
    return paths.select(rest.alias("folder")).where(~F.col("folder").rlike(r"^[_.]")).distinct()


def chapter_of(path) -> F.col:
    """The folder of a file, or the one above where the folder is a generic output folder."""
    parts = F.split(path, "/")
    own, above = F.element_at(parts, -2), F.element_at(parts, -3)
    return F.when(F.lower(own).isin("rag_pipeline_output", "output"), above).otherwise(own)


def discover(spark: SparkSession, root: str, suffix: str = "_RAG_Optimised.md", folder: str = "rag_pipeline_output") -> DataFrame:
    """(chapter, path, text): one copy of each chunk file below a root, side copies left out."""
    files = whole_texts(spark, root, f"*{suffix}")
    kept = canonical_copies(files.select("path"), folder).select("path")
    return files.join(kept, "path").select(chapter_of(F.col("path")).alias("chapter"), "path", "text")


def read_chunks(spark: SparkSession, root: str) -> DataFrame:
    """The chunks of all chunk files below a root."""
    return parse_chunks(discover(spark, root))


def read_catalogue(spark: SparkSession, root: str) -> DataFrame:
    """X08 over files."""
    return catalogue(discover(spark, root))


def read_strings(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, every column a string, quoted line ends allowed."""
    return spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(path)


def last_by_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key, the last in order."""
    return rows.withColumn("__n", F.row_number().over(W.partitionBy(key).orderBy(F.desc(order)))).where("__n = 1").drop("__n")


def read_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines under an explicit schema; blank lines are none."""
    return spark.read.schema(schema).json(path)


def read_document(spark: SparkSession, path: str, schema: T.StructType, strict: bool = True) -> DataFrame:
    """One JSON document; strict reading fails on what does not fit, else such rows keep their text in _corrupt_record."""
    if strict:
        return spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(path)
    whole = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(whole).option("multiLine", "true").option("mode", "PERMISSIVE").json(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A JSON file's rows, or none where the path has no file."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return read_document(spark, path, schema)
    return spark.createDataFrame([], schema)


def read_table(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """Distinct chunk ids of a database table over JDBC, for sessions that have the driver."""
    rows = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    column = next(c for c in rows.columns if c.lower() in ("chunk_id", "full_chunk_id"))
    return rows.select(F.col(column).cast("string").alias("chunk_id")).where("chunk_id is not null").distinct()


def file_hashes(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(path, length, md5, sha256) of files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    return files.select("path", "length", F.md5("content").alias("md5"), F.sha2("content", 256).alias("sha256"))


# ------------------------------------------------------------------ sinks


def write_text(rows: DataFrame, path: str, by: str | None = None, mode: str = "errorifexists") -> None:
    """One text a row, in folders by a column if given; a job commits all files or none."""
    writer = rows.write.mode(mode).option("lineSep", "\n")
    (writer.partitionBy(by) if by else writer).text(path)


def write_both(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The same rows as CSV with a header and as JSON lines."""
    rows.write.mode(mode).option("header", "true").option("escape", '"').csv(f"{path}/csv")
    rows.write.mode(mode).json(f"{path}/jsonl")


def write_cards(cards: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Tab-separated cards whose first column is headed #Card_ID; tabs and line ends in texts become spaces."""
    flat = cards.select(*[F.translate(F.col(c).cast("string"), "\t\r\n", "   ").alias(c) for c in cards.columns])
    flat = flat.withColumnRenamed(cards.columns[0], "#Card_ID")
    flat.write.mode(mode).option("sep", "\t").option("header", "true").option("comment", "\u0001").csv(path)


def write_json(rows: DataFrame, path: str, dry_run: bool = False, mode: str = "errorifexists") -> int:
    """JSON lines; a dry run counts the rows and writes nothing."""
    if dry_run:
        return rows.count()
    rows.write.mode(mode).json(path)
    return -1


class Refused(RuntimeError):
    """A write that its flags do not allow."""


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str, write: bool = False, in_place: bool = False, verify=None) -> dict[str, str]:
    """Several tables as one transaction.

    Each is written to a new version folder; the manifest that names the version is written last and is the commit.
    Without `write` nothing is written; over an existing manifest `in_place` is needed; a failed check removes the
    new version, and readers keep the old one.
    """
    import uuid

    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    manifest = jvm.org.apache.hadoop.fs.Path(f"{root}/MANIFEST")
    fs = manifest.getFileSystem(conf)
    if not write:
        return {name: f"{root}/<version>/{name}" for name in tables}
    if fs.exists(manifest) and not in_place:
        raise Refused("a manifest exists; in_place is needed to publish over it")
    version = uuid.uuid4().hex
    paths = {name: f"{root}/{version}/{name}" for name in tables}
    try:
        for name, rows in tables.items():
            rows.write.parquet(paths[name])
        if verify is not None and not verify({name: spark.read.parquet(p) for name, p in paths.items()}):
            raise Refused("the written tables do not pass the check")
    except Exception:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/{version}"), True)
        raise
    out = fs.create(manifest, True)
    out.write(bytearray(version.encode()))
    out.close()
    return paths


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the version that the manifest names."""
    version = spark.read.text(f"{root}/MANIFEST").first()[0]
    return spark.read.parquet(f"{root}/{version}/{name}")
