"""Streaming form of the landing sink: changes into hour partitions, exactly once.

``stream_land`` reads a stream of change rows and lands every micro-batch in the same hour
partitions that ``bronze.land_hourly`` writes, so scans, registration and the silver
stream see no difference. Spark's own file sink is exactly once only for readers of its
log, which grows with all history and hides files of other writers; full loads and batch
landings share these folders, so each batch is made idempotent instead:

1. its rows are written to a staging folder beside the tables (one Spark job);
2. the names of the staged files, with the names that they get, go into one small manifest
   in the stream's checkpoint folder, in one rename;
3. the staged files are renamed into their hours.

A batch that is repeated after a failure finds its manifest and only goes on with the
renames that are missing; without a manifest nothing of it was visible, and the staging
folder is written anew. Only the newest manifest is kept. File names hold the batch's
number and the stream's own id, so streams with different checkpoints can feed one table.

The driver handles one name per file of the batch in hand, never rows. While a batch is
being moved, readers may see part of its files, as with any writer of plain folders. Batch
silver loads of order lines have no replay window, so run them when no batch is being
landed; the silver stream goes by files and misses none.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources import bronze as B
from tidemark.sources.files import Files
from tidemark.sources.schemas import bronze_schema


class BatchLander:
    """Lands numbered batches of one stream in a table, each exactly once."""

    def __init__(self, spark: SparkSession, root: str, table: str, checkpoint: str):
        self.files = Files(spark)
        self.table = table
        self.base = B.table_root(root, table)
        self.state = f"{checkpoint.rstrip('/')}/landed"
        self.id = self.files.read_text(f"{self.state}/id")
        if self.id is None:
            self.id = uuid.uuid4().hex
            self.files.write_text(f"{self.state}/id", self.id)
        self.stage_root = f"{root.rstrip('/')}/_landing/{self.id}"

    def manifest(self, batch: int) -> str:
        return f"{self.state}/{batch}.files"

    def stage(self, rows: DataFrame, batch: int) -> list[tuple[str, str]]:
        """Write the rows to the staging folder; (staged, final) paths of the files."""
        self.files.delete(f"{self.stage_root}/{self.table}")
        B.land_hourly(rows, self.stage_root, self.table)
        staged = self.files.walk(f"{self.stage_root}/{self.table}", ".parquet")
        return [(name, f"{name.rpartition('/')[0]}/part-{batch:010d}-{self.id}-{i:06d}.gz.parquet") for i, name in enumerate(staged)]

    def land(self, rows: DataFrame, batch: int) -> None:
        text = self.files.read_text(self.manifest(batch))
        if text is None:
            text = "\n".join(f"{a}\t{b}" for a, b in self.stage(rows, batch))
            self.files.write_text(self.manifest(batch), text)
        for line in text.splitlines():
            staged, final = line.split("\t")
            self.publish(f"{self.stage_root}/{self.table}/{staged}", f"{self.base}/{final}")
        self.files.delete(f"{self.stage_root}/{self.table}")
        for name in self.files.names(self.state):
            if name.endswith(".files") and int(name.removesuffix(".files")) < batch:
                self.files.delete(f"{self.state}/{name}")

    def publish(self, staged: str, final: str) -> None:
        """Move one file, unless an earlier try has moved it."""
        if not self.files.exists(final):
            self.files.move(staged, final)


def stream_land(spark: SparkSession, source: DataFrame, root: str, table: str, checkpoint: str,
                available_now: bool = True) -> StreamingQuery:
    """Land a stream of change rows (operation, change time, payload) in hour partitions."""
    lander = BatchLander(spark, root, table, checkpoint)

    def land(rows: DataFrame, epoch_id: int) -> None:
        lander.land(rows, epoch_id)

    w = source.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="15 minutes")
    return w.start()


def change_files(spark: SparkSession, path: str, table: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of change files as the capture drops them: payload only, no hours."""
    reader = spark.readStream.schema(bronze_schema(table, with_partitions=False))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
