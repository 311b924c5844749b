"""Files in and out: JSON documents, JSON lines, CSV with flattened values, content manifests and published snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


def json_documents(spark: SparkSession, patterns: Sequence[str], schema: str) -> DataFrame:
    """One row per JSON document: its fields, ``source_file``, and ``source_order`` for files by pattern and then path. A file that can't be parsed has its text in ``corrupt``."""
    out = None
    for i, pattern in enumerate(patterns):
        found = spark.read.schema(f"{schema}, corrupt STRING").option("multiLine", True).option("columnNameOfCorruptRecord", "corrupt").json(pattern)
        found = found.select("*", F.col("_metadata.file_path").alias("source_file")).withColumn("source_order", F.struct(F.lit(i).alias("pattern"), F.col("source_file").alias("path")))
        out = found if out is None else out.unionByName(found)
    return out


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row per line; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def csv_rows(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Rows of a CSV file with a header, all strings; a byte order mark is tolerated."""
    return spark.read.schema(", ".join(f"`{n}` STRING" for n in names)).option("header", True).option("multiLine", True).option("encoding", "UTF-8").option("escape", '"').csv(path)


def by_priority(rows: DataFrame, priority: str, *ties: str) -> list[Column]:
    """Order by a number in text; what is no number comes last."""
    return [F.coalesce(F.col(priority).try_cast("int"), F.lit(1_000_000_000)), *map(F.col, ties)]


def latest_per_key(rows: DataFrame, key: str, order: str, fixture_prefix: str | None = "fixture") -> DataFrame:
    """The last document of each key; documents without a key go, and with ``fixture_prefix`` those of fixtures."""
    own = rows.filter(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")
    if fixture_prefix is not None:
        own = own.filter(~F.startswith(F.lower(F.col(key).cast("string")), F.lit(fixture_prefix)))
    return own.groupBy(key).agg(F.max_by(F.struct("*"), order).alias("r")).select("r.*")


def flat_value(value: Column, kind) -> Column:
    """A value as CSV holds it: nothing for null, lists joined by bars, maps and structs as ``key=value`` with semicolons."""
    if isinstance(kind, ArrayType):
        text = F.array_join(F.transform(value, lambda x: x.cast("string")), "|", "")
    elif isinstance(kind, MapType):
        text = F.array_join(F.transform(F.map_entries(value), lambda e: F.concat(e["key"].cast("string"), F.lit("="), F.coalesce(e["value"].cast("string"), F.lit("")))), "; ")
    elif isinstance(kind, StructType):
        text = F.when(value.isNotNull(), F.concat_ws("; ", *[F.concat(F.lit(f"{f.name}="), F.coalesce(value[f.name].cast("string"), F.lit(""))) for f in kind.fields]))
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(""))


def write_csv(rows: DataFrame, path: str, names: Sequence[str]) -> None:
    """The named columns, flattened, with a header; columns that aren't there are empty."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    flat = [(flat_value(F.col(n), kinds[n]) if n in kinds else F.lit("")).alias(n) for n in names]
    rows.select(*flat).write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", True).option("emptyValue", "").csv(path)


def write_json(rows: DataFrame, path: str) -> None:
    """JSON lines, nulls kept. Spark's committer writes aside and renames, so readers see a whole result or none."""
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def manifest(spark: SparkSession, folder: str, suffixes: Sequence[str]) -> DataFrame:
    """(path, bytes, sha256) of the files under a folder with one of the suffixes and no hidden part, path from the folder on."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    path = F.regexp_replace(F.element_at(F.split("path", F.lit("/" + folder.rstrip("/").rpartition("/")[2] + "/")), -1), "^/+", "")
    rows = found.select(path.alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    return rows.filter(F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)).isin(*suffixes) & ~F.col("path").rlike(r"(^|/)[._]"))


def manifest_hash(rows: DataFrame) -> str:
    """One hash for a manifest, whatever the order of its rows."""
    lines = F.array_join(F.sort_array(F.collect_list(F.concat_ws(" ", "sha256", "bytes", "path"))), "\n")
    return rows.agg(F.sha2(F.coalesce(lines, F.lit("")), 256)).first()[0]


def differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(path, problem): files that are missing, unexpected or changed."""
    a = expected.select("path", F.struct("bytes", "sha256").alias("a"))
    b = actual.select("path", F.struct("bytes", "sha256").alias("b"))
    problem = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "unexpected").when(F.col("a") != F.col("b"), "changed")
    return a.join(b, "path", "full").select("path", problem.alias("problem")).filter("problem IS NOT NULL")


def publish(spark: SparkSession, source: str, destination: str, suffixes: Sequence[str]) -> str:
    """Publish the source's files that have an allowed suffix as a snapshot; return its manifest's hash.

    Files are copied aside and verified against the manifest; then the folders are swapped, and the former snapshot
    comes back if that fails. The list of files is a published export's, so the driver copies them.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(destination).getFileSystem(conf)
    staged, former = f"{destination.rstrip('/')}-staged", f"{destination.rstrip('/')}-former"
    for p in (staged, former):
        fs.delete(path(p), True)
    expected = manifest(spark, source, suffixes)
    for row in expected.collect():
        jvm.org.apache.hadoop.fs.FileUtil.copy(path(f"{source}/{row.path}").getFileSystem(conf), path(f"{source}/{row.path}"), fs, path(f"{staged}/{row.path}"), False, conf)
    wrong = differences(expected, manifest(spark, staged, suffixes)).limit(5).collect()
    if wrong:
        fs.delete(path(staged), True)
        raise RuntimeError(f"the staged snapshot differs: {wrong}")
    there = fs.exists(path(destination))
    if there and not fs.rename(path(destination), path(former)):
        raise RuntimeError("the former snapshot can't be moved aside")
    if not fs.rename(path(staged), path(destination)):
        if there:
            fs.rename(path(former), path(destination))
        raise RuntimeError("the staged snapshot can't be moved into place")
    fs.delete(path(former), True)
    return manifest_hash(expected)
