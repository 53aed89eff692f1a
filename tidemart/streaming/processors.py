"""Keyed-state processors for ``groupBy(key).transformWithState`` (stream forms of STA1-STA5, STA8, STA9, AGG6, AGG7).

State lives in the RocksDB state store, so it is checkpointed with the query and survives executor loss. It is one
small value per key (a date, the previous record), or a map or list of entries written one by one where it grows
(distinct values, seen pairs, rows that wait). Rows of a key inside one micro-batch carry no order, so every processor
sorts them by the arrival columns before applying the per-record rule, rows of equal arrival by their other plain
columns; a key's rows of one micro-batch are held in one task's memory, so the trigger's intake (files or offsets per
batch) bounds it. Batch forms of the same rules are in :mod:`tidemart.operators.stateful`, :mod:`~tidemart.operators.scan`
and :mod:`~tidemart.operators.routing`; tests check that both agree.
"""

from __future__ import annotations

import sys

import math
from collections.abc import Iterator, Sequence
from datetime import timedelta

import xxhash
from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

# Python workers run this module's UDF/processor code: ship it by value so that executors
# need no installed copy of the package (they may not have it on their path).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["NewVisitorFix", "VisitFlags", "FirstPerDay", "RetractDedupe", "BloomDedupe", "PairDedupe", "RunningProfile",
           "HoldForRules", "LastPerProcessingWindow", "bloom_size", "STATE_PROVIDER"]

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _sorted(rows: Iterator[Row], order: Sequence[str]) -> list[Row]:
    """Rows of a key in arrival order, nulls first; rows of equal arrival by their other plain columns."""
    rows = list(rows)
    if not rows:
        return rows
    nested = {c for r in rows for c in r.__fields__ if isinstance(r[c], (dict, list, tuple))}
    by = [*order, *(c for c in rows[0].__fields__ if c not in order and c not in nested)]
    return sorted(rows, key=lambda r: tuple((r[c] is not None, r[c]) for c in by))


class NewVisitorFix(StatefulProcessor):
    """STA1: memory set once by a key's first record (its date if new, else the day before);
    a later 'new' record on another date is corrected to '0'. ``date_col`` holds a DATE."""

    def __init__(self, order: Sequence[str], date_col: str, is_new_col: str = "is_new"):
        self.order, self.date_col, self.is_new_col = list(order), date_col, is_new_col

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("first_date", "d date")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = self.state.get()[0] if self.state.exists() else None
        for r in _sorted(rows, self.order):
            d = r[self.date_col]
            rec = r.asDict()
            if d is None:
                yield r  # no date: nothing to compare, and no memory of it
                continue
            if first is None:
                first = d if rec[self.is_new_col] == "1" else d - timedelta(days=1)
                self.state.update((first,))
            elif rec[self.is_new_col] == "1" and first != d:
                rec[self.is_new_col] = "0"
            yield Row(**rec)

    def close(self) -> None:
        pass


class VisitFlags(StatefulProcessor):
    """STA2: uv_ct = 1 when the date differs from the key's previous record; sv_ct = 1 without a
    last page; pv_ct = 1."""

    def __init__(self, order: Sequence[str], date_col: str, last_page_col: str):
        self.order, self.date_col, self.last_page_col = list(order), date_col, last_page_col

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("last_date", "d date")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = self.state.get()[0] if self.state.exists() else None
        for r in _sorted(rows, self.order):
            d = r[self.date_col]
            uv = 1 if last is None or last != d else 0
            last = d
            lp = r[self.last_page_col]
            yield Row(**r.asDict(), uv_ct=uv, sv_ct=1 if not lp else 0, pv_ct=1)
        if last is not None:
            self.state.update((last,))

    def close(self) -> None:
        pass


class FirstPerDay(StatefulProcessor):
    """STA3: the first record per (key, day). Group the stream by *both* key and day: the state is
    one "seen" flag per (key, day), so a day that comes back out of order is not emitted twice
    (D2 fixed). Give the flag a TTL (``ttl_ms``, processing time) to bound state on long streams."""

    def __init__(self, order: Sequence[str], ttl_ms: int | None = None):
        self.order, self.ttl_ms = list(order), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("seen", "s boolean", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        ordered = _sorted(rows, self.order)
        if ordered and not self.state.exists():
            self.state.update((True,))
            yield ordered[0]

    def close(self) -> None:
        pass


class RetractDedupe(StatefulProcessor):
    """STA4/STA5: on a repeated id emit the previous record with its amounts negated, then the new one.

    With ``ttl_ms`` the memory expires that long after its last write (use
    ``timeMode="ProcessingTime"``). The previous record is kept in columns of the
    input's own types (``schema``). Output = input columns + ``sign``.
    """

    def __init__(self, order: Sequence[str], amounts: Sequence[str], schema: T.StructType, ttl_ms: int | None = None):
        self.order, self.amounts, self.schema, self.ttl_ms = list(order), set(amounts), schema, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("prev", self.schema, self.ttl_ms)

    def _remembered(self) -> dict | None:
        if not self.state.exists():
            return None
        values = self.state.get()
        return {f.name: f.dataType.fromInternal(v) if isinstance(v, int) and f.dataType.needConversion() else v
                for f, v in zip(self.schema.fields, values, strict=True)}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        prev = self._remembered()
        for r in _sorted(rows, self.order):
            rec = r.asDict()
            if prev is not None:
                yield Row(**{k: (-v if k in self.amounts and v is not None else v) for k, v in prev.items()}, sign=-1)
            yield Row(**rec, sign=1)
            prev = rec
        if prev is not None:
            self.state.update(tuple(prev[f.name] for f in self.schema.fields))

    def close(self) -> None:
        pass


def bloom_size(n: int, p: float) -> tuple[int, int]:
    """Bits ``m = -n ln p / ln^2 2`` and hashes ``k = max(1, round(m/n ln 2))``."""
    m = int(math.ceil(-n * math.log(p) / (math.log(2) ** 2)))
    k = max(1, int(round(m / n * math.log(2))))
    return m, k


class BloomDedupe(StatefulProcessor):
    """STA8 fixed-memory form: drop records whose ``a + '_' + b`` was (probably) seen before for the key.

    One bit array of ``m`` bits per grouping key, ``k`` positions from two
    64-bit xxhash values (double hashing). False positives drop a new pair
    with probability about ``p``; the exact batch form has none.
    """

    def __init__(self, order: Sequence[str], a: str, b: str, n: int = 1_000_000, p: float = 0.01):
        self.order, self.a, self.b = list(order), a, b
        self.m, self.k = bloom_size(n, p)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("bits", "b binary")

    def _positions(self, text: str) -> list[int]:
        raw = text.encode("utf-8")
        h1, h2 = xxhash.xxh64_intdigest(raw, seed=0), xxhash.xxh64_intdigest(raw, seed=1) | 1
        return [(h1 + i * h2) % self.m for i in range(self.k)]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        bits = bytearray(self.state.get()[0]) if self.state.exists() else bytearray((self.m + 7) // 8)
        for r in _sorted(rows, self.order):
            pos = self._positions(f"{r[self.a]}_{r[self.b]}")
            if all(bits[q >> 3] & (1 << (q & 7)) for q in pos):
                continue
            for q in pos:
                bits[q >> 3] |= 1 << (q & 7)
            yield r
        self.state.update((bytes(bits),))

    def close(self) -> None:
        pass


class PairDedupe(StatefulProcessor):
    """STA8 exact form: drop records whose pair ``(a, b)`` was seen before; no record is dropped falsely.

    State is one entry per pair. Group the stream by anything that puts equal pairs together, such as a bucket of the
    pair's hash, so that no key of the data is heavy. An entry is forgotten ``ttl_ms`` (processing time) after it was
    written; None keeps it for good. Nulls are values of their own.
    """

    def __init__(self, order: Sequence[str], a: str, b: str, ttl_ms: int | None = None):
        self.order, self.a, self.b, self.ttl_ms = list(order), a, b, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "a string, b string", "s boolean", self.ttl_ms)

    @staticmethod
    def _text(value) -> str:
        return "" if value is None else f"={value}"

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for r in _sorted(rows, self.order):
            pair = (self._text(r[self.a]), self._text(r[self.b]))
            if not self.seen.containsKey(pair):
                self.seen.updateValue(pair, (True,))
                yield r

    def close(self) -> None:
        pass


class RunningProfile(StatefulProcessor):
    """AGG7: running record count and running distinct sets of fields per key, one row out per row in.

    State is the count and one entry per distinct (field, value), written once when the value first appears: a
    micro-batch writes what is new, not the sets. The entries of a key are read once per micro-batch, since every
    output row carries them.
    """

    def __init__(self, order: Sequence[str], fields: Sequence[str], sep: str = ","):
        self.order, self.fields, self.sep = list(order), list(fields), sep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n long")
        self.values = handle.getMapState("values", "f string, v string", "s boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n = self.count.get()[0] if self.count.exists() else 0
        sets: dict[str, set] = {f: set() for f in self.fields}
        for f, v in self.values.keys() if n else ():
            sets[f].add(v)
        text = {f: self.sep.join(sorted(sets[f])) for f in self.fields}
        for r in _sorted(rows, self.order):
            n += 1
            for f in self.fields:
                if r[f] is not None and str(r[f]) not in sets[f]:
                    sets[f].add(str(r[f]))
                    self.values.updateValue((f, str(r[f])), (True,))
                    text[f] = self.sep.join(sorted(sets[f]))
            yield Row(**r.asDict(), page_count=n, **{f"{f}_set": text[f] for f in self.fields})
        self.count.update((n,))

    def close(self) -> None:
        pass


class LastPerProcessingWindow(StatefulProcessor):
    """AGG6 on processing time: per key and tumbling window of ``size_ms`` the last record by arrival.

    A processing-time timer closes the window at its end, whether or not more input comes. Output: the record (input
    columns) with ``window_start`` and ``window_end`` in epoch ms. Use ``timeMode="ProcessingTime"``.
    """

    def __init__(self, order: Sequence[str], size_ms: int, schema: T.StructType):
        self.order, self.size_ms, self.schema = list(order), size_ms, schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.start = handle.getValueState("start", "s long")
        self.last = handle.getValueState("last", self.schema)

    def _remembered(self) -> dict:
        return {f.name: f.dataType.fromInternal(v) if isinstance(v, int) and f.dataType.needConversion() else v
                for f, v in zip(self.schema.fields, self.last.get(), strict=True)}

    def _closed(self) -> Row:
        start = self.start.get()[0]
        row = Row(**self._remembered(), window_start=start, window_end=start + self.size_ms)
        self.start.clear()
        self.last.clear()
        return row

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        start = now // self.size_ms * self.size_ms
        ordered = _sorted(rows, self.order)
        if self.start.exists() and self.start.get()[0] != start:
            yield self._closed()  # its timer is due in this batch but fires after the input
        if not ordered:
            return
        best = ordered[-1].asDict()
        if self.start.exists():
            best = _sorted([Row(**self._remembered()), Row(**best)], self.order)[-1].asDict()
        else:
            self.start.update((start,))
            self.handle.registerTimer(start + self.size_ms)
        self.last.update(tuple(best[f.name] for f in self.schema.fields))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.start.exists() and self.start.get()[0] + self.size_ms <= expiredTimerInfo.getExpiryTimeInMs():
            yield self._closed()

    def close(self) -> None:
        pass


class HoldForRules(StatefulProcessor):
    """STA9/PRJ6: rows of a change feed meet the rules that hold at their position; rows wait while there are none.

    Input: rule changes (``is_rule``; copied to every grouping slot) and feed rows, both placed by ``pos``; a rule comes
    before a row of its position. Rules are kept per source table and changed one by one, an older change than the one
    kept is ignored, a delete takes the rule away. A row without any rule in force waits in a list; a processing-time
    timer looks at the list every ``wait_ms`` and lets the rows out, in order, once rules are there. A later row of the
    slot lets them out before itself. Output: ``pos, source_table, value`` with the rule's columns, null for a table
    without a rule (a fact). Use ``timeMode="ProcessingTime"``.
    """

    RULE = ("sink_table", "sink_family", "sink_columns", "sink_row_key")

    def __init__(self, wait_ms: int = 5000):
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        fields = ", ".join(f"{c} string" for c in self.RULE)
        self.rules = handle.getMapState("rules", "source_table string", f"pos long, gone boolean, {fields}")
        self.held = handle.getListState("held", "pos long, source_table string, value string")

    def _change(self, rules: dict, r: Row) -> None:
        table, known = r["source_table"], rules.get(r["source_table"])
        if table is not None and (known is None or known[0] <= r["pos"]):
            rules[table] = (r["pos"], r["op"] == "d", *(r[c] for c in self.RULE))
            self.rules.updateValue((table,), rules[table])

    def _routed(self, rules: dict, pos: int, table: str | None, value: str) -> Row:
        rule = rules.get(table)
        cells = rule[2:] if rule and not rule[1] else (None,) * len(self.RULE)
        return Row(pos=pos, source_table=table, value=value, **dict(zip(self.RULE, cells, strict=True)))

    def _release(self, rules: dict) -> Iterator[Row]:
        for pos, table, value in self.held.get():
            yield self._routed(rules, pos, table, value)
        self.held.clear()

    def _known(self) -> dict:
        return {k[0]: tuple(v) for k, v in self.rules.iterator()}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        rules, waiting = self._known(), self.held.exists()
        active = sum(not r[1] for r in rules.values())
        for r in sorted(rows, key=lambda r: (r["pos"], not r["is_rule"], r["source_table"] or "", r["value"] or "")):
            if r["is_rule"]:
                self._change(rules, r)
                active = sum(not x[1] for x in rules.values())
            elif not active:
                if not waiting:
                    self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait_ms)
                self.held.appendValue((r["pos"], r["source_table"], r["value"]))
                waiting = True
            else:
                if waiting:
                    yield from self._release(rules)
                    waiting = False
                yield self._routed(rules, r["pos"], r["source_table"], r["value"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.held.exists():
            return
        rules = self._known()
        if any(not r[1] for r in rules.values()):
            yield from self._release(rules)
        else:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait_ms)

    def close(self) -> None:
        pass
