"""Incremental loads of pages as they land."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tributary.operators.infer import collect_profile, merge_profiles, profile, profile_of_text, profile_text, to_columns
from tributary.operators.merge import BATCH_ORDER
from tributary.session import stage, staging_scope
from tributary.sinks.tables import table_profile, write_upsert
from tributary.spec import TableSpec


def landed_stream(spark: SparkSession, folder: str, *, layout: str = "lines", files_per_batch: int | None = None) -> DataFrame:
    """Newly landed text files as a stream of ``raw, file, landed_at``."""
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder, wholetext=layout == "files").select(
        F.col("value").alias("raw"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
    )


def stream_upsert(
    landed: DataFrame,
    shape: Callable[[DataFrame], DataFrame],
    table_path: str,
    spec: TableSpec,
    checkpoint: str,
    *,
    parts: int = 16,
    order: Sequence[str] = BATCH_ORDER,
) -> StreamingQuery:
    """Shape each micro-batch and upsert it by primary key; stops when all landed files are in.

    The checkpoint remembers which files are loaded. A batch that failed half way is run again under the
    same number: the table's commits carry the highest number of each checkpoint, so a batch that did commit is not
    applied twice, even when another stream has loaded the table since.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        write_upsert(shape(batch), table_path, spec, parts=parts, order=order, load_id=f"{checkpoint}#{batch_id}")

    return _started(landed, load, checkpoint)


def stream_documents(
    landed: DataFrame,
    documents: Callable[[DataFrame], DataFrame],
    table_path: str,
    spec: TableSpec,
    checkpoint: str,
    *,
    types: str = "widen",
    parts: int = 16,
) -> StreamingQuery:
    """Load documents whose columns aren't known beforehand (``documents`` gives ``page_no, ordinal, raw, doc`` of a batch).

    Only the batch is looked at: its profile is merged with the one the table carries, and the columns and types of the
    batch follow from both. So a column keeps what earlier batches said about it, the table widens when a batch needs it,
    and after any number of batches columns and types are those of all documents.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with staging_scope(spark):
            rows = stage(documents(batch).select("page_no", "ordinal", "raw"), "batch").withColumn("doc", F.parse_json("raw"))
            # Kept as text, so that the columns and the commit go by one pass over the batch.
            own, known = profile_of_text(spark, profile_text(profile(rows))), table_profile(spark, table_path)
            found = collect_profile(own if known is None else merge_profiles(known, own))
            if not found.n_rows:
                return
            shaped = to_columns(rows, found.names, found.types(types), BATCH_ORDER)
            write_upsert(shaped, table_path, spec, parts=parts, load_id=f"{checkpoint}#{batch_id}", profile=own)

    return _started(landed, load, checkpoint)


def _started(landed: DataFrame, load: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        landed.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
