"""The dated linkage on a stream, with the directory as state that changes while the stream runs.

The state of a key is its stretches of days with their answers, as `plans.linkage.as_of_table` works them out, links followed. A stream of
directory changes brings the stretches of the keys that changed, all those of a key under one version; a stream of requests is
answered from the state. A change holds for the requests of its own micro-batch and of later ones; an older version than the
state's is passed over, so changes may come again or out of order.

State is kept by RocksDB: spark.sql.streaming.stateStore.providerClass names its provider.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions import status as st
from ..functions.keys import request_key

SPREAD = 1024           # keys over which requests without a key are spread


class Stretches(StatefulProcessor):
    """Per key: the version of the directory, and (seg_from, seg_to, answer) of each stretch, days as text in order of time."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.version = handle.getValueState("version", "version long")
        self.spans = handle.getListState("spans", "seg_from string, seg_to string, answer string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:  # noqa: N802
        asked, changes = [], []
        for part in rows:
            change = part["version"].notna()
            changes.append(part[change])
            asked.append(part.loc[~change, ["request", "day"]])
        changed = pd.concat(changes)
        if len(changed):
            newest = int(changed["version"].max())
            if not self.version.exists() or newest >= int(self.version.get()[0]):
                rows_of = changed[(changed["version"] == newest) & changed["answer"].notna()].drop_duplicates(["seg_from", "seg_to", "answer"])
                self.version.update((newest,))
                self.spans.clear()
                if len(rows_of):
                    self.spans.put([tuple(None if pd.isna(v) else v for v in r) for r in rows_of[["seg_from", "seg_to", "answer"]].itertuples(index=False)])
        requests = pd.concat(asked)
        if not len(requests):
            return
        spans = list(self.spans.get()) if self.spans.exists() else []
        table = {(a or ""): (b, answer) for a, b, answer in spans}
        starts = sorted(table)

        def answer(day: str | None) -> str | None:
            from bisect import bisect_right
            if day is None or pd.isna(day):
                return table.get("", (None, None))[1]
            k = bisect_right(starts, day) - 1
            if k < 0:
                return None
            until, found = table[starts[k]]
            return found if until is None or pd.isna(until) or day < until else None

        yield pd.DataFrame({"request": requests["request"], "answer": [answer(d) for d in requests["day"]]})

    def close(self) -> None:
        pass


def changes_of(answers: DataFrame, version) -> DataFrame:
    """A table of stretches (as_of_table) as changes of one version of the directory: a column or a number."""
    value = [c for c in answers.columns if c not in ("postcode_key", "seg_from", "seg_to", "n_marks")]
    number = F.lit(version).cast("long") if isinstance(version, int) else version.cast("long")
    return answers.select("postcode_key", number.alias("version"), F.col("seg_from").cast("string").alias("seg_from"), F.col("seg_to").cast("string").alias("seg_to"),
                          F.to_json(F.struct(*value), {"ignoreNullFields": "false"}).alias("answer"))


def gone(keys: DataFrame, version: int) -> DataFrame:
    """Keys that the directory has no longer, as changes."""
    none = F.lit(None).cast("string")
    return keys.select("postcode_key", F.lit(version).cast("long").alias("version"), none.alias("seg_from"), none.alias("seg_to"), none.alias("answer"))


def link_dated_stream(requests: DataFrame, changes: DataFrame, answer: T.StructType, postcode: str = "postcode", date: str = "address_date") -> DataFrame:
    """Each request with the answer of the stretch that its date falls in, and its status. `answer` is the schema of what changes carry
    (the columns of as_of_table without its key and span)."""
    none = lambda kind="string": F.lit(None).cast(kind)
    key = request_key(postcode)
    row = F.to_json(F.struct(*requests.columns), {"ignoreNullFields": "false"})
    # A request without a key has no state to meet and is spread.
    asked = requests.select(F.coalesce(key, F.concat(F.lit("#"), F.pmod(F.xxhash64(row), F.lit(SPREAD)).cast("string"))).alias("key"), none("long").alias("version"),
                            none().alias("seg_from"), none().alias("seg_to"), none().alias("answer"), row.alias("request"), F.col(date).cast("string").alias("day"))
    told = changes.select(F.col("postcode_key").alias("key"), "version", "seg_from", "seg_to", "answer", none().alias("request"), none().alias("day"))
    out = asked.union(told).groupBy("key").transformWithStateInPandas(
        statefulProcessor=Stretches(), outputStructType="request string, answer string", outputMode="Append", timeMode="None")
    found = out.select(F.from_json("request", requests.schema).alias("r"), F.from_json("answer", answer).alias("a")).select("r.*", "a.*")
    found = found.withColumn("postcode_key", request_key(postcode))
    if date != "address_date":
        found = found.withColumn("address_date", F.col(date))
    dated = lambda c: F.when(F.col("address_date").isNotNull(), F.col(c))
    return found.withColumns({"postcode_status": st.request_status(date="address_date"), "from_previous_life": F.coalesce("from_previous_life", F.lit(False)),
                              "previous_life_deleted_on": dated("previous_life_deleted_on"), "next_life_introduced_on": dated("next_life_introduced_on")})
