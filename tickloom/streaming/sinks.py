"""Writing streams: message encoding, one checkpointed sink, and routing by window label."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..widths import LABELS

# Fixed value: ISO-8601 with microseconds and offset. Spark's own default
# stops at milliseconds, which merges tick times.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def encode(
    df: DataFrame, key: str | None = None, columns: Iterable[str] | None = None
) -> DataFrame:
    """Rows as messages: `value` is a JSON object, `key` a string if asked for.

    NULL fields are left out of the object; decoding gives them back as NULL.
    """
    body = F.struct(*(columns or df.columns))
    value = F.to_json(body, {"timestampFormat": TIME_FORMAT}).alias("value")
    if key is None:
        return df.select(value)
    return df.select(F.col(key).cast("string").alias("key"), value)


def start_sink(
    df: DataFrame,
    format: str,
    options: dict[str, str] | None = None,
    checkpoint: str | None = None,
    path: str | None = None,
    processing_time: str | None = None,
    available_now: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Start one append-mode query.

    Without a trigger, micro-batches follow each other at once; `available_now`
    works off what is there and stops. Any sink but a console needs a checkpoint
    folder of its own, on storage all executors share.
    """
    writer = df.writeStream.format(format).outputMode("append").options(**(options or {}))
    return _start(writer, checkpoint, processing_time, available_now, name, path)


def route(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str | None = None,
    processing_time: str | None = None,
    available_now: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Run one query and hand each batch, and its number, to `write`."""
    writer = df.writeStream.outputMode("append").foreachBatch(write)
    return _start(writer, checkpoint, processing_time, available_now, name, None)


def route_by_window(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str | None = None,
    processing_time: str | None = None,
    available_now: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Run one query over rows with a `window` label and hand its batches to a router.

    `write` is one of `to_folders` and `to_outputs`, or any function of a batch
    and its number. The source is read once, whatever the number of outputs. A
    batch may be handed over again after a failure, with the same number.
    """
    return route(df, write, checkpoint, processing_time, available_now, name)


def to_folders(path: str, labels: Iterable[str] = LABELS, format: str = "parquet"):
    """Route to `path/batch_id=<n>/window=<label>`; a repeated batch replaces itself."""
    labels = list(labels)

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.filter(F.col("window").isin(labels))
            .write.mode("overwrite")
            .partitionBy("window")
            .format(format)
            .save(f"{path}/batch_id={batch_id}")
        )

    return write


def to_outputs(
    format: str,
    options: Callable[[str], dict[str, str]],
    labels: Iterable[str] = LABELS,
    mode: str = "append",
    commits: str | None = None,
):
    """Route each label to an output of its own, such as a collection or a topic.

    `options` gives the sink options for a label. A batch that is repeated after a failure leaves
    out what `commits`, a folder on shared storage, has a record of; see `Commits`. The batch's
    number also goes along as the option `batchId`, for sinks that can tell.
    """
    labels = list(labels)

    def write(batch: DataFrame, batch_id: int) -> None:
        def append(label: str) -> None:
            rows = batch.filter(F.col("window") == label)
            rows.write.mode(mode).format(format).options(**options(label)).option("batchId", str(batch_id)).save()

        write_each(batch, batch_id, {label: partial(append, label) for label in labels}, commits)

    return write


def write_each(batch: DataFrame, batch_id: int, writes: dict[str, Callable[[], None]], commits: str | None = None) -> None:
    """Several outputs from one batch, which is computed once; those with a record are not written again."""
    done = Commits(batch.sparkSession, commits) if commits else None
    batch.persist()
    try:
        for output, write in writes.items():
            if done is None:
                write()
            elif not done.has(output, batch_id):
                write()
                done.add(output, batch_id)
    finally:
        batch.unpersist()


class Commits:
    """Which outputs have had which batch: an empty file per output, named by the batch.

    A file is made after its output was written, so a run that fails between two outputs, or
    between the outputs and Spark's own commit, goes on behind what was written. Only
    a failure within a write, or between it and its record, can repeat that one output;
    there `batchId` tells. Only the last batch of a query is ever repeated, so older files go.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self.folder = folder.rstrip("/")
        self.files = self.hadoop.Path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def has(self, output: str, batch_id: int) -> bool:
        return self.files.exists(self._path(output, batch_id))

    def add(self, output: str, batch_id: int) -> None:
        self.files.create(self._path(output, batch_id), True).close()
        for status in self.files.listStatus(self._path(output)):
            name = status.getPath().getName()
            if name.isdigit() and int(name) < batch_id:
                self.files.delete(status.getPath(), False)

    def _path(self, *parts):
        return self.hadoop.Path("/".join([self.folder, *map(str, parts)]))


def _start(writer, checkpoint, processing_time, available_now, name, path) -> StreamingQuery:
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    if name:
        writer = writer.queryName(name)
    return writer.start(path) if path else writer.start()
