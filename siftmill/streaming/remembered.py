"""A ledger as stream state: first judgment wins, unjudged rows are not remembered, entries are forgotten after a time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SETTINGS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
OUT = "key string, first_seen timestamp, run_id string, verdict string, item_id string, outcome string"


class Remember(StatefulProcessor):
    """State of a key: its entry. ``outcome`` of a row: ``added``, ``known`` (there is an entry; the row bears its verdict) or ``left``
    (not judged, so that a later run looks at it again)."""

    def __init__(self, unjudged: str, hours: int):
        self.unjudged, self.hours = unjudged, hours

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.entry = handle.getValueState("entry", "first_seen timestamp, run_id string, verdict string, item_id string", ttlDurationMs=self.hours * 3_600_000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = tuple(self.entry.get()) if self.entry.exists() else None
        for frame in rows:
            out = []
            for r in frame.sort_values(["at", "run_id"], kind="stable").itertuples(index=False):
                outcome = "known" if held else "left" if r.code == self.unjudged or r.verdict is None else "added"
                if outcome == "added":
                    held = (r.at, r.run_id, r.verdict, r.item_id)
                    self.entry.update(held)
                shown = held if held else (r.at, r.run_id, r.verdict, r.item_id)
                out.append((key[0], *shown, outcome))
            yield pd.DataFrame(out, columns=["key", "first_seen", "run_id", "verdict", "item_id", "outcome"])

    def close(self) -> None:
        pass


def remembered(stream: DataFrame, unjudged: str = "NOT_JUDGED", hours: int = 120 * 24) -> DataFrame:
    """Rows ``key, at, run_id, code, verdict, item_id`` of judged candidates -> ``OUT``, one row each. The session needs ``SETTINGS``: RocksDB as
    its state store, and no batches without data, which processing time would otherwise ask for without end when a stream is
    run until its input is used up. Entries leave the state ``hours`` after they were made."""
    return stream.groupBy("key").transformWithStateInPandas(statefulProcessor=Remember(unjudged, hours), outputStructType=OUT, outputMode="Append", timeMode="ProcessingTime")
