"""What the state store remembers: each device's last reading of every day, and
the reading ids of the stream.

A lag across micro-batches needs, for a day that gets new readings, the reading
before it, and has to reach the day after it, whose first reading has a new
predecessor. ``day_ends`` is a stateful operator (``transformWithState``) keyed
by device that remembers the last reading of each of its days and answers both:
a micro-batch reads and writes the state of its own devices and months only,
whatever the stream has seen before, and no table of earlier batches.

The state is one entry per device and day, held per month, so an update rewrites
at most 31 entries. Readings may come in any order and any number of times: the
entry is the latest reading of the day and, of equal times, the one with the
least reading id, as in the batch de-duplication. There is no watermark and no
eviction: a reading is never too late. A null device is a device.
"""

from __future__ import annotations

import bisect
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructField, StructType

#: What a stateful query needs of the session when it starts.
CONF = {"spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}

#: A day to look at again, and the device's last reading on an earlier day.
EDGES = ("device_id string, date string, earlier_date string, earlier_timestamp timestamp, "
         "earlier_temperature double")

_MONTHS = StructType([StructField("months", StringType())])
_DAYS = StructType([StructField("days", StringType())])
_MONTH = StructType([StructField("month", StringType())])


class DayEnds(StatefulProcessor):
    """State: the device's months in order, and per month its days' ends, as
    ``day micros id temperature`` entries (JSON)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.months = handle.getValueState("months", _MONTHS)
        self.days = handle.getMapState("days", _MONTH, _DAYS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ends: dict[str, list] = {}
        for frame in rows:
            # the greatest (time, then least id) of each day of this part of the rows
            frame = frame.sort_values(["micros", "reading_id"], ascending=[True, False])
            for r in frame.groupby("date", sort=False).tail(1).itertuples():
                temperature = None if pd.isna(r.air_temperature) else float(r.air_temperature)
                self._take(ends, r.date, [int(r.micros), r.reading_id, temperature])
        if not ends:
            return
        months, held = self._months(), {}
        touched = sorted(ends)
        for day in touched:
            self._take(self._month(held, day[:7]), day, ends[day])
        grown = sorted({*months, *(d[:7] for d in touched)})
        if grown != months:
            self.months.update((",".join(grown),))
        for month in {d[:7] for d in touched}:
            self.days.updateValue((month,), (json.dumps(held[month]),))
        again = {}
        for day in touched:
            again[day] = self._beside(held, grown, day, -1)
            after = self._beside(held, grown, day, +1)
            if after is not None and after[0] not in ends:
                again[after[0]] = self._beside(held, grown, after[0], -1)
        device = key[0][1:] if key[0][0] == "d" else None
        out = [(device, day, *((e[0], e[1][0], e[1][2]) if e else (None, None, None))) for day, e in again.items()]
        made = pd.DataFrame(out, columns=["device_id", "date", "earlier_date", "earlier_timestamp",
                                          "earlier_temperature"])
        made["earlier_timestamp"] = pd.to_datetime(made["earlier_timestamp"], unit="us")
        made["earlier_temperature"] = made["earlier_temperature"].astype(float).astype(object).where(
            made["earlier_temperature"].notna(), None)
        yield made

    @staticmethod
    def _take(ends: dict, day: str, new: list) -> None:
        old = ends.get(day)
        if old is None or (new[0], old[1]) > (old[0], new[1]):
            ends[day] = new

    def _months(self) -> list[str]:
        return self.months.get()[0].split(",") if self.months.exists() else []

    def _month(self, held: dict, month: str) -> dict:
        """Day -> end of one month, read from the state once."""
        if month not in held:
            held[month] = json.loads(self.days.getValue((month,))[0]) if self.days.containsKey((month,)) else {}
        return held[month]

    def _beside(self, held: dict, months: list[str], day: str, way: int):
        """(day, end) of the nearest day with readings before or after."""
        at = bisect.bisect_left(months, day[:7])
        while 0 <= at < len(months):
            found = [d for d in self._month(held, months[at]) if (d < day if way < 0 else d > day)]
            if found:
                best = max(found) if way < 0 else min(found)
                return best, held[months[at]][best]
            at += way
        return None

    def close(self) -> None:
        pass


#: Device-days whose ends a task collects before it passes them on.
_HELD_DAYS = 100_000


def _ends_of_task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Before the shuffle: the last reading of each device-day among a task's rows
    (the one that ``DayEnds`` takes), so that a busy device sends a row a day and
    task instead of its readings."""
    columns = ["device", "date", "micros", "reading_id", "air_temperature"]
    days = ["device", "date"]

    def last(frame: pd.DataFrame) -> pd.DataFrame:
        top = frame[frame["micros"] == frame.groupby(days, sort=False)["micros"].transform("max")]
        return top.sort_values("reading_id").drop_duplicates(days)

    held: list[pd.DataFrame] = []
    for frame in frames:
        held.append(last(frame))
        if len(held) >= 64:
            held = [last(pd.concat(held))]
            if len(held[0]) > _HELD_DAYS:
                yield held.pop()[columns]
    if held:
        yield last(pd.concat(held))[columns]


def day_ends(cleaned: DataFrame) -> DataFrame:
    """The days of each device that a micro-batch of cleaned readings changes
    (those with readings in it, and the next one that has any), each with the
    device's last reading on an earlier day (null on its first). Readings
    without time have no day and change none."""
    rows = (cleaned.filter("date IS NOT NULL")
            .select(F.coalesce(F.concat(F.lit("d"), "device_id"), F.lit("n")).alias("device"), "date", F.unix_micros(F.col("processing_timestamp")).alias("micros"),
                    F.coalesce("reading_id", F.lit("")).alias("reading_id"), "air_temperature"))
    rows = rows.mapInPandas(_ends_of_task, rows.schema)
    return rows.groupBy("device").transformWithStateInPandas(
        statefulProcessor=DayEnds(), outputStructType=EDGES, outputMode="Update", timeMode="None")


def new_ids(flat: DataFrame) -> DataFrame:
    """The reading ids that a micro-batch of decoded readings brings for the first
    time in the stream, whatever their event times: one row each. Ids alone are
    shuffled and kept; the state store looks up those of the batch, so the cost does
    not depend on what came before. Rows that become dead letters claim no id, and
    there is no watermark: an id is never forgotten."""
    return (flat.filter("reading_id IS NOT NULL AND processing_timestamp IS NOT NULL")
            .select("reading_id").dropDuplicates(["reading_id"]))


class stateful_session:
    """Within this block queries start with the state store that
    ``transformWithState`` needs, and that holds ids on disk; the session's own settings come back."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self):
        self.before = {k: self.spark.conf.get(k, None) for k in CONF}
        for k, v in CONF.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *exc):
        for k, v in self.before.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
