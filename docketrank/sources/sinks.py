"""Writing layers and exports."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


# Older versions that stay behind the current one, for readers that began before a switch.
KEPT_VERSIONS = 1


def _storage(spark: SparkSession, path: str):
    """Hadoop's view of a path: its file system, and a maker of paths."""
    jvm = spark.sparkContext._jvm
    make = jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _numbers(names: Iterable[str]) -> list[int]:
    return sorted(int(found[1]) for name in names if (found := re.fullmatch(r"(?:.*__)?v(\d+)(?:_[0-9a-f]+)?", name)))


def _listed(spark: SparkSession, folder: str) -> list[int]:
    """Version numbers of what lies in a folder."""
    files, at = _storage(spark, folder)
    return _numbers(entry.getPath().getName() for entry in files.listStatus(at(folder))) if files.exists(at(folder)) else []


def _commit(spark: SparkSession, path: str, version: int) -> None:
    """Make a version the current one: one new, empty file, which is there or isn't on any storage."""
    files, at = _storage(spark, path)
    # Never over an existing one: of two writers that took the same number the second fails.
    files.create(at(f"{path}/_committed/v{version:06d}"), False).close()


def write_version(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Write rows as the next version of a layer, not readable yet; returns its number."""
    version = max([0, *_listed(df.sparkSession, path), *_listed(df.sparkSession, f"{path}/_committed")]) + 1
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/v{version:06d}")
    return version


def commit_version(spark: SparkSession, path: str, version: int) -> None:
    """Switch a layer to a written version and clear versions that nobody reads any more."""
    _commit(spark, path, version)
    files, at = _storage(spark, path)
    committed = _listed(spark, f"{path}/_committed")
    keep = set(committed[-1 - KEPT_VERSIONS :])
    # What is newer than the current version may belong to a writer that is still at work.
    for old in {*_listed(spark, path), *committed}:
        if old not in keep and old < max(committed):
            files.delete(at(f"{path}/_committed/v{old:06d}"), False)
            files.delete(at(f"{path}/v{old:06d}"), True)


def replace_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh of a layer: new rows are complete beside the old before one file makes them current.

    A layer is a folder of versions (``v000001`` and so on) and of markers, one per finished version. A
    job that fails or is killed at any moment leaves the old version or the new one; nothing is
    renamed, so it holds on object stores as well. ``read_parquet_layer`` reads the newest version
    that has a marker.
    """
    commit_version(df.sparkSession, path, write_version(df, path, partition_by))


def current_version(spark: SparkSession, path: str) -> str:
    """The folder of a layer's current version."""
    committed = _listed(spark, f"{path}/_committed")
    if not committed:
        raise LookupError(f"layer {path} not found; run the step that writes it first")
    return f"{path}/v{committed[-1]:06d}"


def read_parquet_layer(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a layer."""
    return spark.read.parquet(current_version(spark, path))


def _table_versions(spark: SparkSession, name: str) -> list[str]:
    """Names of all versions of a table, oldest first."""
    *database, table = name.split(".")
    within = f" IN {'.'.join(database)}" if database else ""
    found = [row["tableName"] for row in spark.sql(f"SHOW TABLES{within} LIKE '{table}__v*'").collect()]
    return [".".join([*database, version]) for version in sorted(found)]


def write_table_version(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), bucket_by: str | None = None, buckets: int = 0
) -> str:
    """Write rows as the next version of a table, under a name of its own, which is returned.

    With ``bucket_by`` rows are dealt by that key into files that later steps need not shuffle again;
    it suits layers in which no key holds a large share of the rows.
    """
    number = max([0, *_numbers(_table_versions(df.sparkSession, name))]) + 1
    # What a killed writer left behind has another name.
    version = f"{name}__v{number:06d}_{uuid.uuid4().hex[:8]}"
    writer = (df.repartition(buckets, bucket_by) if bucket_by else df).write.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(version)
    return version


def commit_table_version(spark: SparkSession, name: str, version: str) -> None:
    """Point a table's name at a written version and drop versions that nobody reads any more.

    The name is a view; replacing it is one change of the catalog, whatever columns the version has.
    """
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    versions = _table_versions(spark, name)
    for old in versions[: max(0, versions.index(version) - KEPT_VERSIONS)]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")


def replace_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), bucket_by: str | None = None, buckets: int = 0
) -> None:
    """Full refresh of a table in the session catalog: the new rows are complete before the name means them."""
    commit_table_version(df.sparkSession, name, write_table_version(df, name, partition_by, bucket_by, buckets))


def plain_double_text(value: Column) -> Column:
    """A double as text without an exponent, where Spark would write ``1.25E7``; no digit is lost.

    The digits are those of Spark's shortest text, with the point moved by the exponent.
    """
    text = value.cast("string")
    digits = F.regexp_replace(F.regexp_extract(text, r"^-?([\d.]+)E", 1), r"\.", "")
    digits = F.regexp_replace(digits, r"(?<=\d)0$", "")
    whole = F.regexp_extract(text, r"E(\d+)$", 1).try_cast("int") + 1
    padded = F.rpad(digits, F.greatest(whole + 1, F.length(digits)), "0")
    plain = F.concat(
        F.when(value < 0, "-").otherwise(""), F.substring(padded, F.lit(1), whole), F.lit("."),
        F.substring(padded, whole + 1, F.length(padded)),
    )
    return F.when(F.abs(value) >= 1e7, F.coalesce(plain, text)).otherwise(text)


# How exports are written.
_EXPORT = {"quote": '"', "escape": '"'}


def _plain_numbers(df: DataFrame) -> DataFrame:
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({name: plain_double_text(F.col(name)) for name in doubles}) if doubles else df


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV folder with headers; ``single_file`` is for results known to be small."""
    out = _plain_numbers(df)
    out = out.coalesce(1) if single_file else out
    out.write.mode("overwrite").options(header="true", **_EXPORT).csv(path)


def csv_lines(df: DataFrame, *keep: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns ``keep`` and each row's line (column ``text``) as ``export_csv`` writes it."""
    cells = F.struct(*(F.col(f"`{name}`") for name in columns or df.columns))
    return _plain_numbers(df).select(*keep, F.to_csv(cells, _EXPORT).alias("text"))


def _balance_first() -> list[Column]:
    return [F.desc_nulls_last("outstanding_balance"), F.asc("rank")]


def export_ranked_csv(ranked: DataFrame, path: str) -> None:
    """The ranked list as one CSV file, largest balance first; it is as short as its limit."""
    export_csv(ranked.orderBy(*_balance_first()), path, single_file=True)


def ranked_csv_lines(ranked: DataFrame) -> DataFrame:
    """The lines of the ranked list's file with their numbers; the header is line 0."""
    place = F.row_number().over(Window.orderBy(*_balance_first()))  # as many rows as the list is long
    numbered = ranked.withColumn("line", place)
    lines = csv_lines(numbered, "line", columns=ranked.columns)
    header = ranked.sparkSession.createDataFrame([(0, ",".join(ranked.columns))], "line int, text string")
    return header.unionByName(lines)


def export_schema(snapshot: DataFrame, path: str) -> None:
    """Column list of the raw tables, tab separated; a few dozen rows."""
    ordered = snapshot.coalesce(1).sortWithinPartitions(F.desc("table"), "position")
    ordered.write.mode("overwrite").options(header="true", sep="\t").csv(path)


def export_match_report(report: DataFrame, path: str) -> None:
    """The join report, a line of text per row, in its order; a few dozen lines."""
    report.coalesce(1).sortWithinPartitions("line").select("text").write.mode("overwrite").text(path)
