"""The three keyed steps of the streaming facts job, a lane of keys at a time.

A lane is a hash bucket of keys. It is what Spark groups and keeps timers by, so one call works on
columns of many keys instead of a few rows of one, and state is read and written per lane where
that is bounded by what is in flight. Each step takes two inputs merged into one, told apart by
``kind``, as columns of numbers and one or two texts that only pass through. Records come in Arrow
chunks; shuffles do not keep arrival order, so a call orders the numbers of its lane's new records
by key and arrival. The source's limit per trigger over the number of lanes bounds these.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

LOOKED_UP = "match_id bigint, arrival_ms bigint, log_offset bigint, payload string, name string"
EMITTED = (
    "match_id bigint, complete boolean, is_fact boolean, fire_ms bigint, event string, "
    "payload string, name string"
)
RANKED = "match_id bigint, event string, payload string, name string, rank string"

# The kinds of records of each step, in the order in which they count at one instant.
PLAYER, PARTICIPANT = 0, 1
ROSTER, EVENT = 0, 1
RANK, FACT = 0, 1

#: Rows of an emitted chunk.
CHUNK = 10_000
#: A player's versions are kept in one state entry per so many milliseconds (thirty days).
SPAN_MS = 30 * 86_400_000
NEVER = -(2**62)


def columns(chunks: Iterator[pd.DataFrame]) -> dict[str, list | np.ndarray]:
    """The chunks of one lane as numbers in arrays and texts in lists."""
    parts: dict[str, list] = {}
    for chunk in chunks:
        for name in chunk.columns:
            parts.setdefault(name, []).append(chunk[name].to_numpy())
    out = {}
    for name, arrays in parts.items():
        whole = np.concatenate(arrays)
        out[name] = whole.tolist() if whole.dtype == object else whole.astype(np.int64)
    return out


def chunks(names: list[str], rows: list[tuple]) -> Iterator[pd.DataFrame]:
    for start in range(0, len(rows), CHUNK):
        yield pd.DataFrame(rows[start : start + CHUNK], columns=names)


def _names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(",")]


def _starts(keys: np.ndarray) -> np.ndarray:
    """Whether each of the ordered keys is the first of its kind."""
    return np.append(True, keys[1:] != keys[:-1])


class PlayerLookup(StatefulProcessor):
    """Stamps participants with the last player version that had arrived."""

    def __init__(self, ttl_ms: int | None = None) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.players = handle.getMapState("players", "id bigint", "name string", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        new = columns(rows)
        order = np.lexsort((new["log_offset"], new["kind"], new["arrival_ms"], new["id"]))
        ids, version = new["id"][order], new["kind"][order] == PLAYER
        first = np.maximum.accumulate(np.where(_starts(ids), np.arange(len(ids)), 0))
        last = np.maximum.accumulate(np.where(version, np.arange(len(ids)), -1))
        known = last >= first
        payload, at = new["payload"], order.tolist()
        stored = {i: self._stored(i) for i in np.unique(ids[~known]).tolist()}
        # The last row of a player tells its last new version, if it has any.
        for n in np.flatnonzero(np.append(_starts(ids)[1:], True) & known).tolist():
            self.players.updateValue((int(ids[n]),), (payload[at[last[n]]],))
        arrival, offset, match = (new[c].tolist() for c in ("arrival_ms", "log_offset", "match_id"))
        out = []
        for n in np.flatnonzero(~version).tolist():
            r = at[n]
            name = payload[at[last[n]]] if known[n] else stored[int(ids[n])]
            out.append((match[r], arrival[r], offset[r], payload[r], name))
        return chunks(_names(LOOKED_UP), out)

    def _stored(self, player: int) -> str | None:
        value = self.players.getValue((player,))
        return value[0] if value else None


class RosterGate(StatefulProcessor):
    """Holds a match until nothing arrives for it for a while, then emits all or nothing.

    Arrival times decide where a session ends, so a replayed log gives the same sessions as
    the live one. Processing time only flushes the last session of a match: a lane has one timer,
    for the first of its open sessions that falls due. Open sessions of a lane are one list.
    """

    def __init__(self, quiet_ms: int, flush_ms: int, roster_size: int) -> None:
        self.quiet_ms = quiet_ms
        self.flush_ms = flush_ms
        self.roster_size = roster_size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState(
            "open",
            "match_id bigint, held int, last_ms bigint, due_ms bigint, event string, "
            "payloads array<string>, names array<string>",
        )
        self.timer = handle.getValueState("timer", "at_ms bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        new = columns(rows)
        order = np.lexsort((new["log_offset"], new["kind"], new["arrival_ms"], new["id"]))
        matches, arrival = new["id"][order], new["arrival_ms"][order]
        kind = new["kind"][order]
        held = {row[0]: list(row[1:]) for row in self.open.get()}
        first = _starts(matches)
        heads = np.flatnonzero(first)
        seen = [held[m][1] if m in held else NEVER for m in matches[heads].tolist()]
        stored = np.repeat(np.array(seen, np.int64), np.diff(np.append(heads, len(matches))))
        before = np.where(first, stored, np.maximum(stored, np.append(NEVER, arrival[:-1])))
        # A session ends where nothing came for longer than the quiet period.
        cuts = np.flatnonzero(first | (arrival - before > self.quiet_ms))
        due = timerValues.getCurrentProcessingTimeInMs() + self.flush_ms
        payload, name, at = new["payload"], new["name"], order.tolist()
        out: list[tuple] = []
        for start, stop in zip(cuts.tolist(), [*cuts[1:].tolist(), len(matches)]):
            match = int(matches[start])
            session = held.get(match)
            if session is not None and arrival[start] - session[1] > self.quiet_ms:
                self._fire(match, session, out)
                session = None
            if session is None:
                session = held[match] = [0, NEVER, due, None, [], []]
            mine = at[start:stop]
            events = np.flatnonzero(kind[start:stop] == EVENT)
            if len(events):
                session[3] = payload[mine[events[-1]]]
            roster = [r for r, k in zip(mine, kind[start:stop].tolist()) if k == ROSTER]
            session[0] += len(roster)
            session[1] = max(session[1], int(arrival[stop - 1]))
            session[2] = due
            # An overfull roster can only be dropped, so its number is enough.
            if session[0] > self.roster_size:
                session[4], session[5] = [], []
            else:
                session[4] = [*session[4], *[payload[r] for r in roster]]
                session[5] = [*session[5], *[name[r] for r in roster]]
        self.open.put([(m, *s) for m, s in held.items()])
        if not self.timer.exists():
            self._wake(min(s[2] for s in held.values()))
        return chunks(_names(EMITTED), out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.timer.clear()
        now = expiredTimerInfo.getExpiryTimeInMs()
        held, left, out = list(self.open.get()), [], []
        for match, *session in held:
            if session[2] <= now:
                self._fire(match, session, out)
            else:
                left.append((match, *session))
        if left:
            self.open.put(left)
            self._wake(min(s[3] for s in left))
        else:
            self.open.clear()
        return chunks(_names(EMITTED), out)

    def _wake(self, at_ms: int) -> None:
        self.handle.registerTimer(at_ms)
        self.timer.update((at_ms,))

    def _fire(self, match: int, session, out: list[tuple]) -> None:
        held, last, _, event, payloads, names = session
        complete = event is not None and held == self.roster_size
        fire = last + self.quiet_ms
        out.append((match, complete, False, fire, None, None, None))
        if complete:
            out += [(match, True, True, fire, event, p, n) for p, n in zip(payloads, names)]


class RankAsOf(StatefulProcessor):
    """Finds each fact's rank in the player's history as it stood when the match fired.

    The history is kept by spans of time, so a call touches the spans it needs and not a whole
    career.
    """

    def __init__(self, ttl_ms: int | None = None) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.spans = handle.getMapState("spans", "id bigint", "spans array<bigint>", self.ttl_ms)
        self.history = handle.getMapState(
            "history",
            "id bigint, span bigint",
            "updated array<bigint>, arrived array<bigint>, offsets array<bigint>, ranks array<string>",
            self.ttl_ms,
        )

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        new = columns(rows)
        ids, at, arrival = (new[c].tolist() for c in ("id", "at_ms", "arrival_ms"))
        offset, payload = new["log_offset"].tolist(), new["payload"]
        fresh: dict[int, dict[int, list[tuple]]] = {}
        for r in np.flatnonzero(new["kind"] == RANK).tolist():
            version = (at[r], arrival[r], offset[r], payload[r])
            fresh.setdefault(ids[r], {}).setdefault(at[r] // SPAN_MS, []).append(version)
        loaded: dict[tuple[int, int], list[tuple]] = {}
        spans: dict[int, list[int]] = {}
        for player, by_span in fresh.items():
            for span, versions in by_span.items():
                loaded[player, span] = sorted(self._versions(player, span) + versions)
                self.history.updateValue((player, span), tuple(map(list, zip(*loaded[player, span]))))
            old = self._spans(player)
            spans[player] = sorted({*old, *by_span})
            if len(spans[player]) > len(old):
                self.spans.updateValue((player,), (spans[player],))
        out = []
        match, event, name = new["match_id"].tolist(), new["event"], new["name"]
        for r in np.flatnonzero(new["kind"] == FACT).tolist():
            if ids[r] not in spans:
                spans[ids[r]] = self._spans(ids[r])
            rank = self._as_of(ids[r], at[r], arrival[r], spans[ids[r]], loaded)
            out.append((match[r], event[r], payload[r], name[r], rank))
        return chunks(_names(RANKED), out)

    def _spans(self, player: int) -> list[int]:
        value = self.spans.getValue((player,))
        return list(value[0]) if value else []

    def _versions(self, player: int, span: int) -> list[tuple]:
        value = self.history.getValue((player, span))
        return list(zip(*value)) if value else []

    def _as_of(self, player, started_ms, fire_ms, spans, loaded) -> str | None:
        """The last version by then that had arrived when the match fired."""
        for n in range(bisect_right(spans, started_ms // SPAN_MS) - 1, -1, -1):
            place = player, spans[n]
            if place not in loaded:
                loaded[place] = self._versions(*place)
            versions = loaded[place]
            for i in range(bisect_right(versions, (started_ms + 1,)) - 1, -1, -1):
                if versions[i][1] <= fire_ms:
                    return versions[i][3]
        return None
