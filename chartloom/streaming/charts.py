"""Chart batches as they arrive: each micro-batch is merged into the store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import upsert_chart
from ..sources.store import Store


def merge_stream(batches: DataFrame, store: Store, checkpoint: str, table: str = "fact") -> StreamingQuery:
    """Merges all that is there and stops. A batch that comes again changes nothing, so a restart is safe."""

    def merge(batch: DataFrame, _: int) -> None:
        if batch.isEmpty():
            return
        held = batch.persist()
        read = store.version(table)
        old = store.read(table) if read else held.limit(0)
        store.publish({table: store.stage(table, upsert_chart(old, held))}, {table: read})
        held.unpersist()

    return batches.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
