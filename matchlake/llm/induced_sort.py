"""External suffix sorting by induction, with common-prefix values.

Suffixes that are smaller than the next one and follow a larger one (starred) are sorted by
naming the stretches between them and sorting the suffixes of the names, recursively. From these
all larger-than-next suffixes are induced in rising order, and from those all smaller-than-next
ones in falling order: whenever a suffix is put out, the one that begins a symbol earlier enters a
priority queue by that symbol. The queue is monotone, keeps the order of entry within a symbol and
holds its sorted runs on disk beyond a given room, as are the text and every long array.

Each tuple carries how much its suffix has in common with the one before it in the queue: one more
than the least common prefix between the two suffixes that induced them. Common prefixes are
capped, so suffixes that agree up to the cap may come in any order.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np

#: Suffixes that are put out at a time, and names sorted in memory by doubling.
BLOCK = 1 << 16
SORTED_IN_MEMORY = 1 << 21
KEY_BITS = 63


class Files:
    """Arrays in memory, or in files of a folder of the task where they need more than ``room``."""

    def __init__(self, folder: str, room: int):
        self.folder, self.room, self.made = folder, room, 0

    def array(self, size: int, dtype) -> np.ndarray:
        if size * np.dtype(dtype).itemsize <= self.room:
            return np.zeros(size, dtype)
        self.made += 1
        path = os.path.join(self.folder, f"{self.made}.bin")
        mapped = np.memmap(path, dtype, "w+", shape=(size,))
        # The space is given back once nothing refers to the mapping.
        os.unlink(path)
        return mapped

    def keep(self, values: np.ndarray) -> np.ndarray:
        if values.nbytes <= self.room:
            return values
        out = self.array(len(values), values.dtype)
        out[:] = values
        return out


class Queue:
    """A monotone priority queue of tuples in sorted runs; equal keys leave in order of entry.

    Young runs are merged while they are small; a run above the room goes to disk as it is.
    """

    def __init__(self, files: Files):
        self.files = files
        self.runs: list[list] = []

    def push(self, keys: np.ndarray, *columns: np.ndarray) -> None:
        """Add tuples whose keys rise."""
        if not len(keys):
            return
        self.runs.append([0, keys, *columns])
        while len(self.runs) > 1 and self._small(-2) and self._left(-2) <= 2 * self._left(-1):
            b, a = self.runs.pop(), self.runs.pop()
            parts = [np.concatenate([x[a[0] :], y[b[0] :]]) for x, y in zip(a[1:], b[1:])]
            order = np.argsort(parts[0], kind="stable")
            self.runs.append([0, *[p[order] for p in parts]])
        if not self._small(-1):
            last = self.runs[-1]
            last[1:] = [self.files.keep(c) for c in last[1:]]

    def push_any(self, keys: np.ndarray, *columns: np.ndarray) -> None:
        order = np.argsort(keys, kind="stable")
        self.push(keys[order], *[c[order] for c in columns])

    def _left(self, n: int) -> int:
        return len(self.runs[n][1]) - self.runs[n][0]

    def _small(self, n: int) -> bool:
        return self.runs[n][1].nbytes <= self.files.room

    def first(self) -> int | None:
        """The smallest key."""
        self.runs = [r for r in self.runs if r[0] < len(r[1])]
        return min((int(r[1][r[0]]) for r in self.runs), default=None)

    def pop(self, key: int, limit: int) -> list[np.ndarray] | None:
        """Columns of up to ``limit`` oldest tuples of the smallest key, or None without any."""
        parts, room = [], limit
        for run in self.runs:
            start = run[0]
            stop = start + int(np.searchsorted(run[1][start : start + room], key, "right"))
            if stop > start:
                parts.append([c[start:stop] for c in run[2:]])
                run[0], room = stop, room - (stop - start)
            if not room:
                break
        return [np.concatenate(p) for p in zip(*parts)] if parts else None

    def drain(self) -> Iterator[list[np.ndarray]]:
        """All tuples in order, with their keys, block by block."""
        while (key := self.first()) is not None:
            # Below the smallest last key of the next blocks every run is complete.
            edge = min(int(r[1][min(r[0] + BLOCK, len(r[1])) - 1]) for r in self.runs)
            parts = []
            for run in self.runs:
                start = run[0]
                stop = start + int(np.searchsorted(run[1][start : start + BLOCK], edge, "left"))
                if stop > start:
                    parts.append([c[start:stop] for c in run[1:]])
                    run[0] = stop
            if parts:
                whole = [np.concatenate(p) for p in zip(*parts)]
                order = np.argsort(whole[0], kind="stable")
                yield [c[order] for c in whole]
            elif edge == key:
                while (same := self.pop(key, BLOCK)) is not None:
                    yield [np.full(len(same[0]), key, self.runs[0][1].dtype), *same]


class _Least:
    """Least common prefixes of ranges of the suffixes put out so far.

    Of earlier blocks only suffix minima are kept: as values are capped, there are few.
    """

    def __init__(self) -> None:
        self.count = 0
        self.places, self.values = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def block(self, common: np.ndarray) -> None:
        self.start, self.common = self.count, common
        self.rising = np.minimum.accumulate(common)
        self.levels = [common]

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum from ``first`` to ``last``, both ends in; ``last`` lies in the block."""
        out = np.empty(len(first), np.int64)
        here = first >= self.start
        if not here.all():
            earlier = self.values[np.searchsorted(self.places, first[~here])]
            out[~here] = np.minimum(earlier, self.rising[last[~here] - self.start])
        if here.any():
            a, b = first[here] - self.start, last[here] - self.start
            level = np.frexp((b - a + 1).astype(float))[1] - 1
            while len(self.levels) <= level.max():
                low, width = self.levels[-1], 1 << (len(self.levels) - 1)
                self.levels.append(np.minimum(low[:-width], low[width:]))
            found = np.empty(len(a), np.int64)
            for n in np.unique(level):
                mine = level == n
                table = self.levels[n]
                found[mine] = np.minimum(table[a[mine]], table[b[mine] - (1 << int(n)) + 1])
            out[here] = found
        return out

    def end(self) -> None:
        falling = np.minimum.accumulate(self.common[::-1])[::-1]
        edges = np.flatnonzero(np.append(falling[1:] > falling[:-1], True))
        kept = self.values < falling[0]
        self.places = np.concatenate([self.places[kept], edges + self.start])
        self.values = np.concatenate([self.values[kept], falling[edges]])
        self.count += len(self.common)


class _Inducer:
    """One direction of the induction: which predecessors enter the queue, and in which order."""

    def __init__(self, text, rises, size: int, smaller: bool, cap: int, files: Files):
        self.text, self.rises, self.smaller, self.cap = text, rises, smaller, cap
        self.top = size - 1
        # Narrow keys are sorted digit by digit.
        self.kind = np.uint16 if size <= 1 << 16 else np.int64
        self.queue, self.least = Queue(files), _Least()
        self.last = files.array(size, np.int64)
        self.last[:] = -1

    def key(self, symbol):
        return self.top - symbol if self.smaller else symbol

    def put_out(self, places: np.ndarray, common: np.ndarray) -> None:
        """Suffixes in their order, each with its common prefix with the one before it."""
        least = self.least
        least.block(common)
        before = places - 1
        source = np.flatnonzero((places > 0) & (self.rises[np.maximum(before, 0)] == self.smaller))
        if len(source):
            keys = self.key(self.text[before[source]].astype(np.int64))
            keys = keys.astype(self.kind)
            order = np.argsort(keys, kind="stable")
            keys, source = keys[order], source[order]
            here = source + least.start
            first = np.append(True, keys[1:] != keys[:-1])
            previous = np.append(-1, here[:-1])
            previous[first] = self.last[keys[first]]
            ends = np.append(first[1:], True)
            self.last[keys[ends]] = here[ends]
            shared = np.zeros(len(here), np.int64)
            known = previous >= 0
            if known.any():
                shared[known] = 1 + least.of(previous[known] + 1, here[known])
            self.queue.push(keys, before[source], np.minimum(shared, self.cap))
        least.end()


def classify(text: np.ndarray, files: Files) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last one counts as smaller."""
    size = len(text)
    rises = files.array(size, bool)
    rises[-1] = carried = True
    for stop in range(size - 1, 0, -BLOCK * 4):
        start = max(0, stop - BLOCK * 4)
        here = text[start : stop + 1].astype(np.int64)
        step = here[1:] - here[:-1]
        at = np.where(step != 0, np.arange(len(step)), len(step))
        at = np.minimum.accumulate(at[::-1])[::-1]
        rises[start:stop] = np.append(step > 0, carried)[at]
        carried = bool(rises[start])
    return rises


def starred(rises: np.ndarray, files: Files) -> np.ndarray:
    """Places of the starred suffixes, in order of the text; the last one is among them."""
    parts = []
    for start in range(0, len(rises) - 1, BLOCK * 4):
        here = rises[start : start + BLOCK * 4 + 1]
        parts.append(np.flatnonzero(here[1:] & ~here[:-1]) + start + 1)
    return files.keep(np.concatenate(parts)) if parts else np.zeros(0, np.int64)


def _names(text, rises, stars, size: int, files: Files) -> tuple[np.ndarray, int]:
    """Numbers of the stretches between starred suffixes, in their order; equal ones are equal.

    Symbols are packed into a key, some at a time, and sorted within the order so far by two
    passes of the queue, which keeps the order of equal keys.
    """
    bits = (2 * size + 1).bit_length()
    per = KEY_BITS // bits
    count = len(stars)
    names = files.array(count, np.int64)
    ends = np.append(stars[1:], stars[-1])
    open_, offset, fresh = np.arange(count), 0, 0
    while len(open_):
        by_key, by_name = Queue(files), Queue(files)
        for start in range(0, len(open_), BLOCK):
            at = open_[start : start + BLOCK]
            key = np.zeros(len(at), np.int64)
            for n in range(per):
                place = stars[at] + offset + n
                inside = place <= ends[at]
                place = np.minimum(place, len(text) - 1)
                symbol = 2 * text[place].astype(np.int64) + rises[place] + 1
                key = key << bits | np.where(inside, symbol, 0)
            by_key.push_any(key, at)
        for key, at in by_key.drain():
            by_name.push_any(names[at], key, at)
        still, seen = [], None
        # Names stay sparse while open: a group's first member's rank in the whole order.
        base, rank = None, 0
        for name, key, at in by_name.drain():
            last_name = np.append(seen[0] if seen else -1, name[:-1])
            last_key = np.append(seen[1] if seen else -1, key[:-1])
            group = name != last_name
            new = group | (key != last_key)
            place = np.arange(rank, rank + len(at))
            # Within a group, places count from the group's own name.
            start = np.where(group, place, -1)
            start[0] = place[0] if group[0] else base
            start = np.maximum.accumulate(start)
            head = np.where(new, place, -1)
            head[0] = place[0] if new[0] else fresh
            head = np.maximum.accumulate(head)
            names[at] = name + head - start
            still.append((at, key & ((1 << bits) - 1) != 0))
            base, fresh, rank = start[-1], head[-1], rank + len(at)
            seen = name[-1], key[-1]
        open_ = np.sort(np.concatenate([a[o] for a, o in still]))
        offset += per
    return _dense(names, files)


def _dense(names: np.ndarray, files: Files) -> tuple[np.ndarray, int]:
    queue = Queue(files)
    for start in range(0, len(names), BLOCK):
        part = names[start : start + BLOCK].copy()
        queue.push_any(part, np.arange(start, start + len(part)))
    out, count, last = files.array(len(names), np.int64), -1, -1
    for name, at in queue.drain():
        number = count + np.cumsum(np.append(name[0] != last, name[1:] != name[:-1]))
        out[at] = number
        count, last = int(number[-1]), name[-1]
    return out, count + 1


def _doubled(names: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of dense names in order and common prefixes up to ``cap`` names, in memory.

    A suffix's rank is where its group begins in the order; groups of one are done, and only the
    others are sorted again, by twice as many names each time.
    """
    size, width = len(names), 1
    order = np.argsort(names, kind="stable")
    heads = np.flatnonzero(np.append(True, names[order][1:] != names[order][:-1]))
    rank = np.empty(size, np.int64)
    rank[order] = np.repeat(heads, np.diff(np.append(heads, size)))
    ranks = [rank]
    slots = np.arange(size)
    while width < cap:
        # Places in the order that belong to groups of several.
        held = ranks[-1][order[slots]]
        alone = np.append(held[1:] != held[:-1], True) & np.append(True, held[1:] != held[:-1])
        slots = slots[~alone]
        if not len(slots):
            break
        rank = ranks[-1].copy()
        mine = order[slots]
        after = mine + width
        key = rank[mine] * (size + 1)
        key[after < size] += rank[after[after < size]] + 1
        by = np.argsort(key, kind="stable")
        key, mine = key[by], mine[by]
        order[slots] = mine
        new = np.append(True, key[1:] != key[:-1])
        rank[mine] = np.maximum.accumulate(np.where(new, slots, -1))
        ranks.append(rank)
        width *= 2
    common = np.zeros(size, np.int64)
    a, b = order[:-1], order[1:]
    shared = np.zeros(size - 1, np.int64)
    for n in range(len(ranks) - 1, -1, -1):
        x, y = a + shared, b + shared
        on = np.flatnonzero((x < size) & (y < size))
        shared[on] += (ranks[n][x[on]] == ranks[n][y[on]]).astype(np.int64) << n
    common[1:] = np.minimum(shared, cap)
    return order, common


def _grown(text, a: np.ndarray, b: np.ndarray, shared: np.ndarray, cap: int) -> np.ndarray:
    """``shared`` symbols and as many more as the suffixes at a and b have in common."""
    shared = np.minimum(shared, cap)
    on = np.flatnonzero(shared < cap)
    while len(on):
        x, y = a[on] + shared[on], b[on] + shared[on]
        inside = (x < len(text)) & (y < len(text))
        on, x, y = on[inside], x[inside], y[inside]
        same = text[x] == text[y]
        on = on[same]
        shared[on] += 1
        on = on[shared[on] < cap]
    return shared


def _run(text, place: int, cap: int) -> int:
    """How often the symbol at ``place`` stands there in a row, up to ``cap``."""
    here = np.asarray(text[place : place + cap])
    other = np.flatnonzero(here != here[0])
    return int(other[0]) if len(other) else len(here)


def _stars_in_order(text, rises, stars, size, cap, files) -> tuple[np.ndarray, np.ndarray]:
    """The starred suffixes in rising order, and their common prefixes in symbols."""
    names, count = _names(text, rises, stars, size, files)
    if len(names) <= SORTED_IN_MEMORY:
        order, shared = _doubled(np.asarray(names), cap)
    else:
        order, shared = files.array(len(names), np.int64), files.array(len(names), np.int64)
        stop = len(names)
        # Blocks come in falling order, with the common prefix with the suffix above.
        for places, common in falling(names, count, cap, files):
            start = stop - len(places)
            order[start:stop] = places[::-1]
            above = np.append(common[1:], 0)
            shared[start + 1 : stop] = above[::-1][1:]
            if stop < len(names):
                shared[stop] = common[0]
            stop = start
        # The last stretch is the end of the text alone, which is not put out.
        order[0] = len(names) - 1
    places, common = files.array(len(order), np.int64), files.array(len(order), np.int64)
    for start in range(0, len(order), BLOCK):
        now = np.asarray(order[max(0, start - 1) : start + BLOCK])
        spots = stars[now]
        fresh = spots if start == 0 else spots[1:]
        places[start : start + len(fresh)] = fresh
        in_names = np.asarray(shared[start + (start == 0) : start + BLOCK])
        a, b = spots[:-1], spots[1:]
        # Names in common are all of their symbols in common, then the next names differ.
        reach = np.minimum(now[:-1] + in_names, len(stars) - 1)
        symbols = _grown(text, a, b, stars[reach] - a, cap)
        common[start + (start == 0) : start + len(fresh)] = symbols
    return places, common


def falling(text: np.ndarray, size: int, cap: int, files: Files) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffixes of ``text`` in falling order, block by block, each with its common prefix (up to
    ``cap`` symbols) with the suffix before it, which is the next larger one.

    Symbols are below ``size``; the last one is 0 and stands nowhere else.
    """
    rises = classify(text, files)
    stars = starred(rises, files)
    if len(stars) <= 1:
        star_places, star_common = np.array([len(text) - 1]), np.zeros(1, np.int64)
    else:
        star_places, star_common = _stars_in_order(text, rises, stars, size, cap, files)
    # Rising: the larger-than-next suffixes of a symbol, then its starred ones.
    up = _Inducer(text, rises, size, False, cap, files)
    total = len(text) - int(np.count_nonzero(rises))
    kept, kept_common = files.array(total, np.int64), files.array(total, np.int64)
    star_symbols = files.keep(np.asarray(text[star_places]))
    symbols, bounds, filled, at = [], [], 0, 0
    while True:
        symbol = up.queue.first()
        star = int(star_symbols[at]) if at < len(star_places) else None
        if symbol is None and star is None:
            break
        symbol = min(s for s in (symbol, star) if s is not None)
        begin = filled
        while (batch := up.queue.pop(symbol, BLOCK)) is not None:
            places, common = batch
            kept[filled : filled + len(places)] = places
            kept_common[filled : filled + len(places)] = common
            filled += len(places)
            up.put_out(places, common)
        if filled > begin:
            symbols.append(symbol)
            bounds.append((begin, filled))
        end = at + int(np.searchsorted(star_symbols[at:], symbol, "right"))
        for start in range(at, end, BLOCK):
            places = np.asarray(star_places[start : min(end, start + BLOCK)])
            common = np.array(star_common[start : start + len(places)])
            if start == at:
                common[0] = (
                    min(_run(text, kept[filled - 1], cap), _run(text, places[0], cap))
                    if filled > begin
                    else 0
                )
            up.put_out(places, common)
        at = end
    del up
    # Falling: the smaller-than-next suffixes of a symbol, then its others.
    down = _Inducer(text, rises, size, True, cap, files)
    while True:
        key = down.queue.first()
        symbol = None if key is None else down.key(key)
        if symbol is None and not symbols:
            break
        symbol = max(s for s in (symbol, symbols[-1] if symbols else None) if s is not None)
        last = None
        while (batch := down.queue.pop(down.key(symbol), BLOCK)) is not None:
            down.put_out(*batch)
            last = batch[0][-1]
            yield batch[0], batch[1]
        if symbols and symbols[-1] == symbol:
            symbols.pop()
            begin, stop = bounds.pop()
            while stop > begin:
                start = max(begin, stop - BLOCK)
                places = np.array(kept[start:stop])[::-1]
                # A suffix has its own value with the smaller one before it.
                common = np.append(0, np.array(kept_common[start + 1 : stop])[::-1])
                if last is not None:
                    seam = min(_run(text, last, cap), _run(text, places[0], cap))
                    common[0] = seam if rises[last] else kept_common[stop]
                down.put_out(places, common)
                yield places, common
                last, stop = places[-1], start
