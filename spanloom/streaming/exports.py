"""Bronze load of export documents as a stream that takes what is new and stops."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..schemas import PARTITION_COLUMN
from ..sources.export import document_rows


def load_new_exports(
    spark: SparkSession, source: str, target: str, checkpoint: str, table: str, short_rows: str = "fail", files_at_once: int = 1000
) -> None:
    """Add the rows of the documents in ``source`` that no earlier call has read to the folder ``target``, by date.

    ``checkpoint`` remembers which documents were read, and the sink's log makes each batch count once, so a
    call that breaks off can be repeated. Documents are parsed whole; a malformed one fails the call.
    """
    documents = spark.readStream.format("text").option("wholetext", "true").option("maxFilesPerTrigger", files_at_once).load(source)
    rows = document_rows(documents, table, short_rows)
    query = (
        rows.writeStream.format("parquet").partitionBy(PARTITION_COLUMN)
        .option("path", target).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
