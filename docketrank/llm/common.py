"""What the operators share: settings, shared storage, tables, small column helpers."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# ASCII white space, the separators of words in most contracts.
ASCII_SPACE = r"[\x20\x09-\x0D]"

# Rows travel to Python workers in batches bounded by rows and, as texts may be very long, by bytes.
ARROW_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16777216",
}


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, once per application, in case they can't import it.

    As ``--py-files`` would; where the package itself came as an archive there is nothing to do.
    """
    context, root = spark.sparkContext, Path(__file__).resolve().parent.parent
    if getattr(context, "_docketrank_shipped", False) or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="docketrank-")) / f"docketrank-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(archive, "w") as files:
        for source in sorted(root.rglob("*.py")):
            files.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._docketrank_shipped = True


def prepare(spark: SparkSession) -> SparkSession:
    """Set the bounds of Arrow batches on a session somebody else made, and send it this package."""
    for key, value in ARROW_SETTINGS.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which all executors and the driver see.

    Only where the session names none and runs on this machine alone (tests, a laptop) a folder of
    it is made; on a cluster executors would write where nobody else reads.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="docketrank-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it again.

    This cuts the lineage in a way that survives lost executors, keeps costly steps from running
    twice, and gives Spark the table's true size, by which it decides on broadcasts.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/docketrank-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also if ``body`` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def split_words(text: Column, separators: str) -> Column:
    """The non-empty pieces of a text between runs of separators; NULL has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)
