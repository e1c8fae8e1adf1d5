"""The same linkage on a stream of requests.

The answers of a directory are a static keyed table, so linking by the newest life is a stream-static
join and holds no state. The dated linkage chooses its way by counting, so it runs on each micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..functions import status as st
from ..functions.keys import request_key


def link_stream(requests: DataFrame, answers: DataFrame, postcode: str = "postcode") -> DataFrame:
    """Requests joined to a table of answers per postcode_key (latest_table or lookup_table)."""
    asked = requests.withColumn("postcode_key", request_key(postcode))
    return asked.join(answers, "postcode_key", "left").withColumn("postcode_status", st.request_status())


def link_batches(requests: DataFrame, link: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch through `link`, written under its own number so that a repeated batch replaces itself."""
    def write(batch: DataFrame, number: int) -> None:
        link(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")
    return requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
