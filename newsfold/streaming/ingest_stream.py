"""Feed files as a stream into the stored tables.

A duplicate may arrive at any time and must still merge, so there is no watermark: the state is the
table, and each micro-batch is one upsert. A micro-batch that Spark runs again after a failure is
recognised by its id and applied once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from newsfold.sources.feed import array_documents, line_documents, text_lines
from newsfold.sources.store import MentionStore


def start_ingest(
    store: MentionStore,
    feed_path: str,
    checkpoint: str,
    name: str = "feed",
    lines: bool = False,
    max_files: int = 10_000,
    once: bool = False,
    maintain: bool = True,
) -> StreamingQuery:
    """Keep ``store`` current with files that appear under ``feed_path``.

    A file holds one JSON array, or one record per line with ``lines``. ``name`` identifies the
    stream and must stay the same for one ``checkpoint``. With ``once`` the query takes what is
    there and stops. With ``maintain`` due compactions run between batches.
    """
    reader = store.spark.readStream.option("maxFilesPerTrigger", max_files)
    files = text_lines(reader.text(feed_path, wholetext=not lines))

    def apply(batch: DataFrame, batch_id: int) -> None:
        feed = line_documents(batch) if lines else array_documents(batch)
        store.ingest(feed, stream=name, batch_id=batch_id)
        if maintain:
            store.maintain()

    writer = files.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).queryName(f"ingest-{name}")
    return (writer.trigger(availableNow=True) if once else writer).start()
