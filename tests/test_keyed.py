"""State by key against plain loops: rows out of order, late rows, and runs that stop and go on from the checkpoint."""

import random
from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from gristmill.streaming import keyed

ZERO = datetime(2024, 3, 1, tzinfo=UTC)
DAY = timedelta(days=1)
FIELDS = "k string, t timestamp, seq long, kind string, lane string, published long, model string"


def ms(t):
    return round(t.timestamp() * 1000)


def carried(rows, days, lanes, end):
    out, held = [], {}
    for k, t, _, kind, lane, published, _ in sorted(rows, key=lambda r: (r[1], r[2])):
        for key, h in list(held.items()):
            if h[1] is not None and h[1] + days * keyed.DAY_MS < ms(t) and key == k:
                out.append((key, h[1] + days * keyed.DAY_MS, "expired", h[0], h[2]))
                del held[key]
        h = held.get(k)
        if kind == "done":
            if h:
                out.append((k, ms(t), "processed", h[0], h[2]))
                del held[k]
        elif lane not in lanes:
            out.append((k, ms(t), "no lane", lane, h[2] if h else None))
            held.pop(k, None)
        else:
            since = h[2] if h else ms(t)
            if published is not None and published + days * keyed.DAY_MS < ms(t):
                out.append((k, ms(t), "expired", lane, since))
                held.pop(k, None)
            else:
                out.append((k, ms(t), "kept" if h else "held", lane, since))
                held[k] = (lane, published, since)
    return out + [(k, h[1] + days * keyed.DAY_MS, "expired", h[0], h[2]) for k, h in held.items() if h[1] is not None and h[1] + days * keyed.DAY_MS < end]


def chained(rows, chain):
    out, dead, day_of = [], {}, lambda t: t.astimezone(ZoneInfo("America/Los_Angeles")).date()
    for k, t, _, kind, _, _, model in sorted(rows, key=lambda r: (r[1], r[2])):
        marks = dead.setdefault((k, day_of(t)), [])
        if kind == "ask":
            left = [m for m in chain if m not in [x[1] for x in marks]]
            out.append((k, ms(t), "chain", ",".join(left or chain), marks[0][0] if marks else None))
        elif model not in [x[1] for x in marks]:
            marks.append((ms(t), model))
            out.append((k, ms(t), "marked", model, marks[0][0]))
    for (k, day), marks in dead.items():
        if marks:
            midnight = datetime.combine(day + DAY, datetime.min.time(), ZoneInfo("America/Los_Angeles"))
            out.append((k, ms(midnight) - 1, "reset", ",".join(x[1] for x in marks), marks[0][0]))
    return out


def run(spark, folder, parts, fields, processor, late):
    """Each part is one run: it stops at its end, and the next run goes on from the checkpoint."""
    for part in parts:
        spark.createDataFrame(part, FIELDS).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(spark.read.parquet(f"{folder}/in").schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        out = keyed.kept_by_key(stream, "k", "t", "seq", fields, processor, late)
        out.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    made = spark.read.schema(keyed.OUT).parquet(f"{folder}/out").where("key is distinct from 'end'")
    return sorted((tuple(r) for r in made.select("key", F.unix_millis("at"), "what", "detail", F.unix_millis("since")).collect()), key=str)


@pytest.fixture
def stateful(spark):
    was = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    yield keyed.with_state(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", was)


def rows_of(seed, n):
    rng, rows = random.Random(seed), []
    for i in range(n):
        t = ZERO + timedelta(minutes=rng.randrange(20 * 24 * 60))
        published = rng.choice([None, ms(t - rng.randrange(6) * DAY)])
        kind = rng.choice(["held", "held", "done"]) if seed == 1 else rng.choice(["ask", "exhausted"])
        rows.append((rng.choice(["hot", "hot", "a", "b", None]), t, i, kind, rng.choice(["x", "y", "gone"]), published, rng.choice(["m0", "m1", "m2"])))
    return rows


def parts_of(rows):
    """Three runs whose rows overlap by up to a day, then the end of time."""
    rng = random.Random(0)
    placed = [(r, min(2, max(0, int(((r[1] - ZERO) / DAY + rng.random()) // 7)))) for r in rows]
    end = ("end", ZERO + 60 * DAY, -1, "none", "x", None, None)
    return [*([r for r, p in placed if p == k] for k in range(3)), [end]]


def test_carried_over(stateful, tmp_path):
    rows = rows_of(1, 150)
    late = ("hot", ZERO + DAY, 999, "held", "x", None, None)  # comes with the last part, days behind the watermark
    parts = parts_of(rows)
    parts[3] = parts[3] + []
    parts.insert(3, [late])
    processor = keyed.CarriedOver(3, ("x", "y"))
    got = run(stateful, str(tmp_path), parts, ["kind", "lane", "published"], processor, "8 days")
    assert got == sorted(carried(rows, 3, ("x", "y"), ms(ZERO + 50 * DAY)), key=str)
    assert {x[2] for x in got} == {"held", "kept", "processed", "expired", "no lane"}


def test_daily_chain(stateful, tmp_path):
    rows = rows_of(2, 120)
    got = run(stateful, str(tmp_path), parts_of(rows), ["kind", "model"], keyed.DailyChain(("m0", "m1")), "8 days")
    assert got == sorted(chained(rows, ("m0", "m1")), key=str)


class Counting:
    """State that counts calls."""

    def __init__(self):
        self.calls, self.items, self.value = [], [], None

    def getListState(self, *_):
        return self

    getValueState = getListState

    def __getattr__(self, name):
        def call(*args):
            self.calls.append(name)
            self.items += args if name == "appendValue" else []
            return None

        return call


def test_rows_of_a_batch_are_one_call():
    handle, processor = Counting(), keyed.WrittenEvents(2)
    processor.init(handle)
    list(processor.handleInputRows(("k",), iter([{"row": f'[{9 - i % 5},{i},{{"kind":"a"}}]'} for i in range(200)]), None))
    assert len(handle.items) == 1 and len(handle.calls) <= 4
