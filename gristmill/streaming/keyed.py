"""State by key with timers: carried-over records that expire, events already written, models that are exhausted for a day.

Rows of a key are handled in the order of their times, whatever batches they come in: they wait in the key's state until the
watermark has passed them. A state may have a deadline; it is settled between the rows as if a row came just behind it, and
once the watermark has passed it. One timer a key stands at the next time that matters, so an idle key costs nothing.

Rows behind the watermark are dropped, as everywhere in Spark. A key's rows meet in one task, as their order is the meaning.
State lives in RocksDB, so a query must run with the session setting that with_state() makes.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from typing import Any
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: The rows of a key that came in one batch, as one JSON list of (at, seq, row): a row by itself would be a call to the state's server each.
PENDING = T.StructType([T.StructField("rows", T.StringType())])
STATE = T.StructType([T.StructField("next", T.LongType()), T.StructField("state", T.StringType())])
OUT = T.StructType([T.StructField("key", T.StringType()), T.StructField("at", T.TimestampType()), T.StructField("what", T.StringType()), T.StructField("detail", T.StringType()), T.StructField("since", T.TimestampType())])
DAY_MS = 86_400_000


def with_state(spark: SparkSession) -> SparkSession:
    """The session, set to keep state in RocksDB, which timers need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    return spark


def _time(ms: int | None) -> datetime | None:
    """An instant as Spark takes one from Python."""
    return None if ms is None else datetime.fromtimestamp(ms / 1000, UTC)


@dataclass(frozen=True)
class Made:
    """A row that a step gives: what happened, at which time (ms), a detail, and since when the state holds."""

    at: int
    what: str
    detail: str | None = None
    since: int | None = None


class InOrder(StatefulProcessor):
    """Handles the rows of a key in the order of (at, seq). Subclasses say what a row and a deadline do to the state, a dict."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", PENDING)
        self.held = handle.getValueState("held", STATE)

    def close(self) -> None:
        pass

    # --- what a subclass says -------------------------------------------------------------------------------------

    def step(self, state: dict, at: int, row: dict) -> Iterator[Made]:
        """Change state by a row at a time (ms)."""
        raise NotImplementedError

    def deadline(self, state: dict) -> int | None:
        """The last instant (ms) at which the state still holds as it is."""
        raise NotImplementedError

    def settle(self, state: dict) -> Iterator[Made]:
        """Change state as its deadline has passed."""
        raise NotImplementedError

    # --- order ----------------------------------------------------------------------------------------------------

    def _load(self) -> tuple[int | None, dict]:
        held = self.held.get()
        return (held[0], json.loads(held[1])) if held else (None, {})

    def _store(self, was: int | None, next_: int | None, state: dict) -> None:
        if was != next_:
            if was is not None:
                self.handle.deleteTimer(was)
            if next_ is not None:
                self.handle.registerTimer(next_)
        if next_ is None and not state:
            self.held.clear()
        else:
            self.held.update((next_, json.dumps(state)))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        next_, state = self._load()
        fresh = [r["row"] for r in rows]
        self.pending.appendValue((f"[{','.join(fresh)}]",))
        soonest = min(int(x[1 : x.index(",")]) for x in fresh) + 1
        if next_ is None or soonest < next_:
            self._store(next_, soonest, state)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        _, state = self._load()
        rows = [x for (part,) in self.pending.get() for x in json.loads(part)]
        due, later = sorted((x for x in rows if x[0] < now), key=lambda x: (x[0], x[1], str(x[2]))), [x for x in rows if x[0] >= now]
        if due:
            self.pending.put([(json.dumps(later),)]) if later else self.pending.clear()
        made: list[Made] = []
        for at, _, row in due:
            self._settle(state, at, made)
            made += self.step(state, at, row)
        self._settle(state, now, made)
        times = [x[0] + 1 for x in later]
        if (limit := self.deadline(state)) is not None:
            times.append(limit + 1)
        # the timer that fired is gone already
        self._store(None, min(times, default=None), state)
        return iter([Row(key=key[0], at=_time(m.at), what=m.what, detail=m.detail, since=_time(m.since)) for m in made])

    def _settle(self, state: dict, at: int, made: list[Made]) -> None:
        while (limit := self.deadline(state)) is not None and limit < at:
            made += self.settle(state)


class CarriedOver(InOrder):
    """Records held for a later run. Rows {kind: held, lane, published (ms)} or {kind: done}.

    A record is held from its first row on; later ones may change its lane and date, not since when. It is let go when it is done
    (processed), or when its date is more than `days` days past (expired), whenever that is noticed. Records without a date
    never expire. A done record that isn't held gives nothing; a record may be held again.
    """

    def __init__(self, days: int, lanes: tuple[str, ...] | None = None) -> None:
        self.days, self.lanes = days, lanes

    def step(self, state: dict, at: int, row: dict) -> Iterator[Made]:
        if row["kind"] == "done":
            if state:
                yield Made(at, "processed", state["lane"], state["since"])
                state.clear()
            return
        if self.lanes is not None and row["lane"] not in self.lanes:
            yield Made(at, "no lane", row["lane"], state.get("since"))
            state.clear()
            return
        first = not state
        state.update(lane=row["lane"], published=row["published"], since=state.get("since", at))
        if (limit := self.deadline(state)) is not None and limit < at:
            yield Made(at, "expired", state["lane"], state["since"])
            state.clear()
        else:
            yield Made(at, "held" if first else "kept", state["lane"], state["since"])

    def deadline(self, state: dict) -> int | None:
        return state["published"] + self.days * DAY_MS if state and state["published"] is not None else None

    def settle(self, state: dict) -> Iterator[Made]:
        yield Made(self.deadline(state), "expired", state["lane"], state["since"])
        state.clear()


class WrittenEvents(InOrder):
    """Events not to be written again within `days` days. Rows {}: a record of the event. written or known, the last time written."""

    def __init__(self, days: int) -> None:
        self.days = days

    def step(self, state: dict, at: int, row: dict) -> Iterator[Made]:
        if state:
            yield Made(at, "known", None, state["at"])
        else:
            state["at"] = at
            yield Made(at, "written", None, at)

    def deadline(self, state: dict) -> int | None:
        return state["at"] + self.days * DAY_MS if state else None

    def settle(self, state: dict) -> Iterator[Made]:
        state.clear()
        return iter(())


class DailyChain(InOrder):
    """A chain of models of which some are exhausted until the quota's day ends. Rows {kind: exhausted, model} or {kind: ask}.

    An answer is the chain without the exhausted models; if none is left, the whole chain, as the record may be wrong. The first
    report of a model a day is marked; the state goes when the day in `zone` is over.
    """

    def __init__(self, chain: tuple[str, ...], zone: str = "America/Los_Angeles") -> None:
        self.chain, self.zone = chain, zone

    def step(self, state: dict, at: int, row: dict) -> Iterator[Made]:
        if row["kind"] == "ask":
            left = [m for m in self.chain if m not in state.get("dead", ())]
            yield Made(at, "chain", ",".join(left or self.chain), state.get("since"))
        elif row["model"] not in state.get("dead", ()):
            state.setdefault("since", at)
            state["dead"] = [*state.get("dead", ()), row["model"]]
            yield Made(at, "marked", row["model"], state["since"])

    def deadline(self, state: dict) -> int | None:
        if not state:
            return None
        day = datetime.fromtimestamp(state["since"] / 1000, ZoneInfo(self.zone)).date() + timedelta(days=1)
        return round(datetime(day.year, day.month, day.day, tzinfo=ZoneInfo(self.zone)).timestamp() * 1000) - 1

    def settle(self, state: dict) -> Iterator[Made]:
        yield Made(self.deadline(state), "reset", ",".join(state["dead"]), state["since"])
        state.clear()


def kept_by_key(stream: DataFrame, key: str, time: str, seq: str, fields: list[str], processor: InOrder, late: str) -> DataFrame:
    """(key, at, what, detail, since): what the processor makes of the rows of each key. Rows later than `late` are dropped.

    seq orders rows of one time; fields are what the processor reads of a row. Times are kept in milliseconds.
    """
    at = F.col(time).cast("timestamp")
    # [ms, seq, fields] as text, so that Python reads a row only when its turn comes
    row = F.concat(F.lit("["), F.round(F.unix_micros(at) / 1000).cast("long"), F.lit(","), F.coalesce(F.col(seq).cast("long").cast("string"), F.lit("null")), F.lit(","), F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), F.lit("]"))
    rows = stream.select(F.col(key).cast("string").alias("key"), at.alias("at"), row.alias("row"))
    return rows.withWatermark("at", late).groupBy("key").transformWithState(statefulProcessor=processor, outputStructType=OUT, outputMode="append", timeMode="EventTime")
