"""What the operators share: tables in the shared folder, and words as the queries define them."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: white space as the word rules name it (space and \x09 to \x0D).
BLANKS = r"\x20\x09-\x0D"


def shared_folder(spark: SparkSession) -> str:
    """A new folder below `spark.checkpoint.dir`, which driver and executors share.

    Only a local master may do without that setting; on a cluster executors
    would write to disks of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tickloom-")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per context: a checkout is not installed there."""
    context = spark.sparkContext
    if getattr(context, "_tickloom_sent", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tickloom-")) / "tickloom.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for file in sorted(package.rglob("*.py")):
            packed.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._tickloom_sent = True


def saved(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it: cuts lineage, survives lost executors.

    What was shuffled to make the table is let go once it is written: Spark's own setting for
    that stays on in the session. `discard` removes the table.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    writer = df.write.option("compression", "zstd")
    if spark.conf.get(_CLEANUP) != "true":
        spark.conf.set(_CLEANUP, "true")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(folder)
    found = spark.read.schema(df.schema).parquet(folder)
    found._saved_in = folder
    return found


def discard(*tables: DataFrame) -> None:
    """Remove tables that `saved` has written, after all that reads them has been written itself."""
    for table in tables:
        folder = getattr(table, "_saved_in", None)
        if folder:
            context = table.sparkSession.sparkContext
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


# Spark's setting for removing shuffle files at the end of a query.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def held_out(doc_id: Column, parts: int, left_out: int) -> Column:
    """Whether crc32 of the id as text, modulo `parts`, is `left_out`; a NULL id is empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % parts == left_out


def id_and_text(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string): NULL texts are empty, other columns are let go."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def one_label(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, label double): one label per document, the larger where they differ."""
    return (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("label").cast("double").alias("label"))
    )
