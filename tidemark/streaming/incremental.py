"""Incremental upsert of newly arrived files.

``availableNow`` takes everything that arrived since the last run and ends, so it
replaces the ingestion high-water mark of the batch refresh: the stream's
checkpoint remembers which files were taken.  A batch that is replayed after a
failure carries the same origin and the table skips it.  The origin holds the query's
own id, which a new checkpoint changes even at the same path.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark import fixed_values as fv
from tidemark.operators.dedup import latest_by_key
from tidemark.operators.upsert import in_batch
from tidemark.sources.tables import LakeTable


def upsert_new_files(spark: SparkSession, folder: str, schema: T.StructType, target: LakeTable,
                     keys: Sequence[str], checkpoint: str, *, fmt: str = "parquet",
                     newest: Sequence[str] = (fv.INGESTED_AT,),
                     transform: Callable[[DataFrame], DataFrame] = lambda df: df,
                     keep_newest: bool = False, options: dict[str, str] | None = None) -> StreamingQuery:
    """Merge files that are new in ``folder`` into ``target``; the returned query ends by itself.

    Normally the last ingestion wins, whatever it holds.  With ``keep_newest`` a
    stored row that is newer by the ``newest`` columns stays.
    """
    arriving = spark.readStream.format(fmt).schema(schema).options(**(options or {})).load(folder)

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch)
        if keep_newest and target.exists():
            rows = rows.unionByName(in_batch(target.read(), rows, keys), allowMissingColumns=True)
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        target.upsert(latest_by_key(rows, keys, newest), keys, origin=f"{query_id}#{batch_id}")

    return (
        arriving.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
