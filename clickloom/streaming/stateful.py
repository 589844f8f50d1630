"""Alerts and sequences on streams.

Every function takes a stream with a watermark on ``ts`` and gives the rows that the table form of the
same name gives. A key's rows wait until the watermark has passed them and are then handled in order;
what the key remembers between batches is small. Results appear when the watermark passes the row or
the deadline that decides them, so what lies behind the last watermark is still open.

Waiting rows are typed state, in slots of time. A batch adds to the slots of its rows without reading
them, and a timer reads the slots that the watermark has reached, whatever waits behind them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clickloom.times import micros

#: Length of a slot of waiting rows.
SLOT = "10 seconds"

_US = "at_us"  # names with a leading underscore are not kept in the processor's rows
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


class Queue:
    """Values of a key that leave in the order in which they came, one state entry each."""

    def __init__(self, state: Any, memory: dict) -> None:
        self.state, self.memory = state, memory

    def _bounds(self) -> tuple[int, int]:
        return self.memory.get("head") or 0, self.memory.get("tail") or 0

    def __bool__(self) -> bool:
        head, tail = self._bounds()
        return head < tail

    def first(self) -> Any:
        return self.state.getValue((self._bounds()[0],))[0]

    def push(self, value: Any) -> None:
        tail = self._bounds()[1]
        self.state.updateValue((tail,), (_plain(value),))
        self.memory["tail"] = tail + 1

    def pop(self) -> Any:
        value, head = self.first(), self._bounds()[0]
        self.state.removeKey((head,))
        self.memory["head"] = head + 1
        return value


# memory, rows in order, watermark (us), queue -> results, time (us) to be called again or None
Step = Callable[[dict, list[dict], int, Queue], tuple[list[dict], int | None]]


class InOrder(StatefulProcessor):
    """Holds a key's rows back until the watermark has passed them, then runs ``step`` on them.

    ``row`` is the type of a waiting row, ``memory`` and ``queued`` what the step keeps. An index tells for
    each slot how many lists of rows it has and its first row's time.
    """

    def __init__(self, step: Step, row: T.StructType, memory: str, queued: str, order: list[str], out: list[str], times: list[str], keys: list[str], slot: int):
        self.step, self.row, self.order, self.out, self.times, self.keys, self.slot = step, row, order, out, times, keys, slot
        self.fields = ["head", "tail", *T.StructType.fromDDL(memory).names] if memory else ["head", "tail"]
        self.kinds = {
            "rows": f"rows array<{row.simpleString()}>",
            "memory": f"head bigint, tail bigint{', ' if memory else ''}{memory}",
            "queued": f"value {queued}",
        }

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.index = handle.getValueState("index", "slots array<bigint>, lists array<int>, firsts array<bigint>")
        self.waiting = handle.getMapState("waiting", "slot bigint, list int", self.kinds["rows"])
        self.memory = handle.getValueState("memory", self.kinds["memory"])
        self.queue = handle.getMapState("queue", "n bigint", self.kinds["queued"])

    def _call_at(self, us: int) -> None:
        self.handle.registerTimer(us // 1000 + 1)

    def _slots(self) -> dict[int, tuple[int, int]]:
        """For each slot that rows wait in: its number of lists and its first row's time."""
        if not self.index.exists():
            return {}
        return {s: (n, first) for s, n, first in zip(*self.index.get())}

    def _keep(self, slots: dict[int, tuple[int, int]]) -> None:
        if slots:
            self.index.update(([*slots], [n for n, _ in slots.values()], [first for _, first in slots.values()]))
        else:
            self.index.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new: dict[int, list] = {}
        for r in rows:
            new.setdefault(r[_US] // self.slot, []).append(_plain([r[c] for c in self.row.names]))
        if not new:
            return
        slots, at = self._slots(), self.row.names.index(_US)
        for slot, values in new.items():
            first = min(v[at] for v in values)
            lists, earlier = slots.get(slot, (0, first))
            self.waiting.updateValue((slot, lists), (values,))
            slots[slot] = lists + 1, min(first, earlier)
        self._keep(dict(sorted(slots.items())))
        self._call_at(min(first for _, first in slots.values()))
        yield from ()

    def _due(self, watermark: int) -> list[dict]:
        """The rows that the watermark has passed, in order; they leave the state."""
        slots, due = self._slots(), []
        reached = [slot for slot, (_, first) in slots.items() if first < watermark]
        for slot in reached:
            rows = []
            for i in range(slots[slot][0]):
                rows += [dict(zip(self.row.names, r)) for r in self.waiting.getValue((slot, i))[0]]
                self.waiting.removeKey((slot, i))
            due += sorted((r for r in rows if r[_US] < watermark), key=lambda r: [_rank(r[c]) for c in self.order])
            rest = [r for r in rows if r[_US] >= watermark]
            if rest:
                self.waiting.updateValue((slot, 0), ([_plain(list(r.values())) for r in rest],))
                slots[slot] = 1, min(r[_US] for r in rest)
            else:
                del slots[slot]
        if reached:
            self._keep(slots)
            if slots:
                self._call_at(min(first for _, first in slots.values()))
        return due

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        due = self._due(watermark)
        memory = dict(zip(self.fields, self.memory.get())) if self.memory.exists() else {}
        results, wake = self.step(memory, due, watermark, Queue(self.queue, memory))
        self.memory.update(tuple(_plain(memory.get(f)) for f in self.fields))
        if wake is not None:
            self._call_at(wake)
        for found in results:
            found |= dict(zip(self.keys, key))
            for name in self.times:
                found[name] = None if found[name] is None else _EPOCH + dt.timedelta(microseconds=found[name])
            yield Row(**{c: found.get(c) for c in self.out})

    def close(self) -> None:
        pass


def _plain(value):
    """Structs as lists, as state takes them."""
    return [_plain(v) for v in value] if isinstance(value, (list, tuple)) else value


def _rank(value):
    """Sorts as a table does: what is missing first, what is no number last, structs field by field."""
    if value is None:
        return 0, 0
    if isinstance(value, (list, tuple)):
        return 1, [_rank(v) for v in value]
    return (2, 0) if value != value else (1, value)


def _stored(df: DataFrame) -> DataFrame:
    """Columns as state takes them: timestamps as microseconds, maps as their entries."""
    kinds = {f.name: f.dataType for f in df.schema}
    changed = {n: F.unix_micros(n) for n, k in kinds.items() if isinstance(k, T.TimestampType)}
    changed |= {n: F.map_entries(n) for n, k in kinds.items() if isinstance(k, T.MapType)}
    return df.withColumns(changed)


def _restored(found: DataFrame, like: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    kinds = {f.name: f.dataType for f in like.schema if f.name in found.columns and f.name not in skip}
    changed = {n: F.timestamp_micros(n) for n, k in kinds.items() if isinstance(k, T.TimestampType)}
    changed |= {n: F.map_from_entries(n) for n, k in kinds.items() if isinstance(k, T.MapType)}
    return found.withColumns(changed)


def _in_order(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    step: Step,
    out: dict[str, T.DataType | str],
    memory: str = "",
    queued: str = "bigint",
    rows: bool = False,
    event_time: str | None = None,
    **more: Column,
) -> DataFrame:
    """Run ``step`` per key on the columns of ``df`` and ``more``; ``order`` begins with the event time.

    ``out`` names the result's columns behind the keys, and with ``rows`` behind those of ``df``. Times are
    microseconds inside, and in columns that ``out`` types as ``us``. ``event_time`` names the result's event
    time, which later windows and joins then go by.
    """
    ts, keys = order[0], list(keys)
    kinds = {"us": "bigint", "time": "timestamp"}
    stored = _stored(df).select(*[c for c in df.columns if c not in keys])
    marked = df.withColumns({**more, _US: F.unix_micros(ts)})
    row = T.StructType([*stored.schema.fields, *[marked.schema[n] for n in (*more, _US)]])
    row = T.StructType([T.StructField(f.name, f.dataType) for f in row])
    # The event time stays beside the row for the watermark; the step reads microseconds.
    inner = marked.select(*keys, F.col(ts).alias("event_ts"), *[_stored_column(marked, n).alias(n) for n in row.names])
    head = [marked.schema[k] for k in keys]
    whole = [T.StructField(f.name, f.dataType if f.name != event_time else T.TimestampType()) for f in stored.schema] if rows else []
    given = [T.StructType.fromDDL(f"`{n}` {kinds.get(t, t)}")[0] for n, t in out.items()]
    schema = T.StructType([*head, *whole, *given])
    times = [n for n, t in out.items() if t == "time"] + ([event_time] if rows and event_time else [])
    by_time = [_US if c == ts else c for c in order]
    processor = InOrder(step, row, memory, queued, by_time, schema.names, times, keys, micros(SLOT))
    found = inner.groupBy(*keys).transformWithState(processor, schema, "Append", "EventTime", eventTimeColumnName=event_time or "")
    found = found.withColumns({n: F.timestamp_micros(n) for n, t in out.items() if t == "us"})
    return _restored(found, df, [*out, *times]) if rows else found


def _stored_column(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name)
    return F.map_entries(name) if isinstance(kind, T.MapType) else F.col(name)


def rolling(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, val: str) -> DataFrame:
    """Each row with the count and average of its value and the ``n`` before it."""

    def step(memory, rows, watermark, queue):
        found = []
        for r in rows:
            last = memory["last"] = [*(memory.get("last") or []), r["v"]][-(n + 1) :]
            there = [v for v in last if v is not None]
            found.append({**r, "count": len(last), "avg": sum(there) / len(there) if there else None})
        return found, None

    out = {"count": "bigint", "avg": "double"}
    return _in_order(df, keys, order, step, out, "last array<double>", rows=True, v=F.col(val).cast("double"))


def rolling_reduce(df: DataFrame, keys: Sequence[str], order: Sequence[str], val: str, kind: str) -> DataFrame:
    """Each row with the running ``sum``, ``min`` or ``max`` of its key."""
    fold = {"sum": lambda a, b: a + b, "min": min, "max": max}[kind]
    type_of = df.schema[val].dataType.simpleString()

    def step(memory, rows, watermark, queue):
        found = []
        for r in rows:
            if r["v"] is not None:
                memory["v"] = r["v"] if memory.get("v") is None else fold(memory["v"], r["v"])
            found.append({**r, kind: memory.get("v")})
        return found, None

    return _in_order(df, keys, order, step, {kind: type_of}, f"v {type_of}", rows=True, v=F.col(val))


def jump_alert(df: DataFrame, keys: Sequence[str], order: Sequence[str], val: str, threshold: float) -> DataFrame:
    """Rows whose value is more than ``threshold`` away from the key's previous one."""
    type_of = df.schema[val].dataType.simpleString()

    def step(memory, rows, watermark, queue):
        found = []
        for r in rows:
            last, memory["last"] = memory.get("last"), r["v"]
            if last is not None and r["v"] is not None and abs(r["v"] - last) > threshold:
                found.append({**r, "previous": last})
        return found, None

    return _in_order(df, keys, order, step, {"previous": type_of}, f"last {type_of}", rows=True, v=F.col(val))


def rise_alert(df: DataFrame, keys: Sequence[str], order: Sequence[str], val: str, span: str) -> DataFrame:
    """Alerts when a key's value has not fallen for ``span`` since it rose; the timer fires by itself."""
    us = micros(span)
    type_of = df.schema[val].dataType.simpleString()

    def step(memory, rows, watermark, queue):
        found = []

        def fire(before):
            if memory.get("armed") is not None and memory["armed"] + us < before:
                found.append({"start_ts": memory["armed"], "alert_ts": memory["armed"] + us})
                memory["armed"] = None

        for r in rows:
            fire(r[_US])
            value, last = r["v"], memory.get("last")
            if value is not None and last is not None:
                if value < last:
                    memory["armed"] = None
                elif value > last and memory.get("armed") is None:
                    memory["armed"] = r[_US]
            memory["last"] = value
        fire(watermark)
        armed = memory.get("armed")
        return found, None if armed is None else armed + us

    out = {"start_ts": "us", "alert_ts": "us"}
    slim = df.select(*keys, *dict.fromkeys(c for c in (*order, val) if c not in keys))
    return _in_order(slim, keys, order, step, out, f"armed bigint, last {type_of}", v=F.col(val))


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], lts: str, rts: str, tolerance: str) -> DataFrame:
    """Match rows of two streams one to one; see ``joins.reconcile``. Open rows are a queue, an entry each."""
    reach = micros(tolerance)
    l_cols, r_cols = ([c for c in df.columns if c not in keys] for df in (left, right))
    sides = [_stored(df).select(F.struct(*cols).alias("x")).schema["x"].dataType for df, cols in ((left, l_cols), (right, r_cols))]

    def side(df, ts, number, cols):
        own = F.struct(*[_stored_column(df, c).alias(c) for c in cols])
        rows = [own if i == number else F.lit(None).cast(kind) for i, kind in enumerate(sides)]
        return df.select(*keys, F.col(ts).alias("ts"), F.lit(number).alias("side"), rows[0].alias("l"), rows[1].alias("r"))

    def step(memory, rows, watermark, queue):
        found = []

        def expire(before):
            while queue and queue.first()["at"] + reach < before:
                row = queue.pop()
                found.append({"l": row["l"], "r": row["r"], "status": ("left_only", "right_only")[row["side"]]})

        for r in rows:
            expire(r[_US])
            if queue and queue.first()["side"] != r["side"]:
                partner = queue.pop()
                l, r_ = (partner["l"], r["r"]) if r["side"] else (r["l"], partner["r"])
                found.append({"l": l, "r": r_, "status": "matched"})
            else:
                queue.push([r[_US], r["side"], r["l"], r["r"]])
        expire(watermark)
        return found, queue.first()["at"] + reach if queue else None

    l_type, r_type = (kind.simpleString() for kind in sides)
    both = side(left, lts, 0, l_cols).unionByName(side(right, rts, 1, r_cols))
    out = {"l": l_type, "r": r_type, "status": "string"}
    found = _in_order(both, keys, ["ts", "side", "l", "r"], step, out, queued=f"struct<at: bigint, side: int, l: {l_type}, r: {r_type}>")
    flat = []
    for name, df, cols in (("l", left, l_cols), ("r", right, r_cols)):
        for c in cols:
            kind, value = df.schema[c].dataType, F.col(name)[c]
            value = F.timestamp_micros(value) if isinstance(kind, T.TimestampType) else value
            flat.append((F.map_from_entries(value) if isinstance(kind, T.MapType) else value).alias(c))
    return found.select(*keys, *flat, "status")


def burst_alert(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], is_fail: Column, n: int, span: str
) -> DataFrame:
    """Windows of ``span`` from a failure on, with at least ``n`` failures and no success."""
    us = micros(span)

    def step(memory, rows, watermark, queue):
        found = []

        def close(before):
            start = memory.get("start")
            if start is not None and start + us < before:
                if memory["n"] >= n:
                    found.append({"start_ts": start, "n_fails": memory["n"]})
                memory["start"] = None

        for r in rows:
            close(r[_US])
            if not r["fail"]:
                memory["start"] = None
            elif memory.get("start") is not None:
                memory["n"] += 1
            else:
                memory.update(start=r[_US], n=1)
        close(watermark)
        start = memory.get("start")
        return found, None if start is None else start + us

    out = {"start_ts": "us", "n_fails": "bigint"}
    marked = _flagged(df, keys, order, {"fail": is_fail})
    return _in_order(marked, keys, order, step, out, "start bigint, n bigint")


def strict_sequence(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], steps: Sequence[Column], within: str
) -> DataFrame:
    """First and last time of consecutive rows that meet the steps in turn within the span."""
    us, count = micros(within), len(steps)

    def step(memory, rows, watermark, queue):
        found = []
        for r in rows:
            last = [*(memory.get("last") or []), [r[_US], [r[f"s{i}"] for i in range(count)]]][-count:]
            memory["last"] = last
            met = len(last) == count and all(flags[i] for i, (_, flags) in enumerate(last))
            if met and r[_US] < last[0][0] + us:
                found.append({"start_ts": last[0][0], "end_ts": r[_US]})
        return found, None

    out = {"start_ts": "us", "end_ts": "us"}
    marked = _flagged(df, keys, order, {f"s{i}": s for i, s in enumerate(steps)})
    return _in_order(marked, keys, order, step, out, "last array<struct<at: bigint, met: array<boolean>>>")


def followed_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], first: Column, then: Column, within: str
) -> DataFrame:
    """Each ``first`` row's time with that of the next ``then`` row, null after a timeout. Open times are a queue."""
    us = micros(within)

    def step(memory, rows, watermark, queue):
        found = []
        for r in rows:
            if r["b"]:
                while queue:
                    start = queue.pop()
                    found.append({"first_ts": start, "then_ts": r[_US] if r[_US] < start + us else None})
            if r["a"]:
                queue.push(r[_US])
        while queue and queue.first() + us < watermark:
            found.append({"first_ts": queue.pop(), "then_ts": None})
        return found, queue.first() + us if queue else None

    out = {"first_ts": "us", "then_ts": "us"}
    marked = _flagged(df, keys, order, {"a": first, "b": then})
    return _in_order(marked.filter(F.col("a") | F.col("b")), keys, order, step, out)


def daily_cap(df: DataFrame, keys: Sequence[str], order: Sequence[str], cap: int) -> DataFrame:
    """Whole rows up to the cap per key and day with ``alert`` false, and the one that broke it with true.

    The rows keep their event time, so that windows can follow.
    """
    day_us = micros("1 day")

    def step(memory, rows, watermark, queue):
        found = []
        for r in rows:
            day = r[_US] // day_us
            if memory.get("day") != day:
                memory.update(day=day, n=0)
            memory["n"] += 1
            if memory["n"] <= cap + 1:
                found.append({**r, "alert": memory["n"] > cap})
        return found, None

    return _in_order(df, keys, order, step, {"alert": "boolean"}, "day bigint, n bigint", rows=True, event_time=order[0])


def _flagged(df: DataFrame, keys: Sequence[str], order: Sequence[str], flags: dict[str, Column]) -> DataFrame:
    """Keys, order and flags only; a condition that is not known is not met."""
    told = {n: F.coalesce(c, F.lit(False)) for n, c in flags.items()}
    return df.select(*keys, *[c for c in order if c not in keys], *[c.alias(n) for n, c in told.items()])
