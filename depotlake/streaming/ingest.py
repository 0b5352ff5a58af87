"""Changed trades as a stream, upserted batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from depotlake.operators.upsert import upsert_into
from depotlake.plans.jobs import write_audit_publish
from depotlake.sources.store import MAIN, Store


def stream_upsert(store: Store, table: str, folder: str, schema: StructType, checkpoint: str,
                  name: str, audit: Callable[[DataFrame], None], layout: Mapping[str, str] | None = None,
                  sort_by: Sequence[str] = (), files_per_batch: int = 1000) -> None:
    """Bring a table up to date with the change files that arrived in ``folder``.

    Every batch is upserted on a stage, and what it brings is audited before it
    is published; ``audit`` raises to stop the stream, whose stage then stays for
    inspection while main shows the last good batch.

    A batch that is delivered again after a failure is known by the id of its
    checkpoint and its number. With a new checkpoint all files come again in
    other batches; the upsert then finds that nothing in them is newer.
    """
    def apply(batch: DataFrame, number: int) -> None:
        feed = store.files.read(f"{checkpoint}/metadata")["id"]
        if store.applied(table, MAIN, feed) >= number:
            return
        write_audit_publish(
            store, name,
            lambda ref: upsert_into(store, table, batch, ref, sort_by=sort_by, layout=layout, batch=(feed, number)),
            lambda ref: audit(batch))

    source = (store.spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", files_per_batch).parquet(folder))
    running = (source.writeStream.queryName(name).foreachBatch(apply)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    running.awaitTermination()
