"""Documents as they land: the same operators over a stream, without state across batches, for scores are per document."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from termloom import schema


def read_documents(spark: SparkSession, folder: str, files_a_batch: int = 64) -> DataFrame:
    """(doc_id, view, text): JSON lines files that land in a folder."""
    return spark.readStream.schema(schema.DOCS).option("maxFilesPerTrigger", files_a_batch).json(folder)


def annotate_stream(docs: DataFrame, plan: Callable[[DataFrame], dict[str, DataFrame]], out: str, checkpoint: str) -> StreamingQuery:
    """Runs a plan over each batch of documents and writes its tables under `out`; a batch that is run again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        try:
            for name, df in plan(kept).items():
                df.write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")
        finally:
            kept.unpersist()

    return docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
