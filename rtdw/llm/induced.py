"""Suffix array and common prefixes of one shard by external induced sorting.

The order of few suffixes induces that of all: a suffix is S if it is less than the next one, else L, and the S suffixes
behind an L suffix (the seeds) are sorted first. The strings between seeds get numbers by rank; where these are not all
different, the string of numbers is sorted by the same procedure. Then a scan over the seeds in ascending order pushes
each scanned suffix's predecessor, if it is L, into a priority queue, and is fed by that queue; a scan in descending
order does the same for the S suffixes.

The queue's keys are (first symbol, rank of the suffix behind it). Ranks are pushed in scanning order, so the queue is one
first-in first-out file per range of symbols: held in memory up to a budget, on disk beyond it, read in blocks. A tuple
holds a suffix and the length of its common prefix with the one pushed before it to the same symbol: one symbol more than
the least common prefix scanned between the two, for which a running minimum is kept per symbol. Blocks are processed by
array operations. In a range of several symbols, suffixes that the range itself feeds are merged in by passes.

Prefix lengths are bytes on every level: a number's weight is the length of its string, and the common prefix of two
different numbers is the least one between their ranks. They stop at ``cap``.

Everything that grows with the shard (queues, types, orders) goes to unnamed scratch files beyond the budget, as Spark's
own spill does: a task that is lost leaves nothing behind and starts anew. Sorting strings needs the strings of one range
of leading symbols at a time.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np

BUDGET = 64 << 20  # bytes in memory for each family of queues or array, beyond it on disk
BLOCK = 1 << 16  # suffixes processed at a time
RANGE = 1 << 13  # suffixes in a range of several symbols
FEW = 4  # ranges whose minima are taken one by one
DENSE = 512  # up to so many symbols each has a range of its own
SHIFT = 16  # bits of a tuple that hold the common prefix
LOW = (1 << SHIFT) - 1


def scratch(n: int, dtype, budget: int = BUDGET) -> np.ndarray:
    """An array in memory or, beyond the budget, in an unnamed file."""
    if n * np.dtype(dtype).itemsize <= budget:
        return np.empty(n, dtype)
    return np.memmap(tempfile.TemporaryFile(), dtype, "w+", shape=n)


class Queues:
    """First-in first-out queues of numbers (64-bit tuples mostly) with one budget of memory; the rest is on disk."""

    def __init__(self, n: int, budget: int = BUDGET):
        self.parts: list[list[np.ndarray]] = [[] for _ in range(n)]
        self.files: dict[int, object] = {}
        self.held, self.budget = 0, budget

    def push(self, queue: int, values: np.ndarray) -> None:
        self.parts[queue].append(values)
        self.held += values.nbytes
        if self.held > self.budget:
            for number, parts in enumerate(self.parts):
                if parts:
                    file = self.files.get(number) or self.files.setdefault(number, tempfile.TemporaryFile())
                    for part in parts:
                        file.write(part.tobytes())
                    self.parts[number] = []
            self.held = 0

    def _take(self, queue: int, dtype=np.int64) -> np.ndarray:
        parts, file = self.parts[queue], self.files.pop(queue, None)
        self.parts[queue] = []
        self.held -= sum(p.nbytes for p in parts)
        if file is None:
            return np.concatenate(parts) if parts else np.empty(0, dtype)
        for part in parts:
            file.write(part.tobytes())
        file.flush()
        return np.memmap(file, dtype, "r")

    def pull(self, queue: int) -> Iterator[np.ndarray]:
        """Blocks of the queue, with what is pushed while it is read, until it is empty; and whether a block was all there was."""
        while len(values := self._take(queue)):
            for i in range(0, len(values), BLOCK):
                yield np.array(values[i : i + BLOCK]), len(values) <= BLOCK

    def all(self, queue: int = 0, dtype=np.int64) -> np.ndarray:
        return self._take(queue, dtype)


def range_min(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least value from ``first`` to ``last`` (inclusive), pair by pair."""
    out = np.empty(len(first), values.dtype)
    if len(first) <= FEW:
        for i, (a, b) in enumerate(zip(first.tolist(), last.tolist(), strict=True)):
            out[i] = values[a : b + 1].min()
        return out
    # Pairs by the power of two below their length, so that each level takes its own and no others.
    power = np.frexp(np.maximum(last - first + 1, 1))[1].astype(np.uint8)
    order = np.argsort(power, kind="stable")
    ends = np.cumsum(np.bincount(power)).tolist()
    width, table = 1, values
    for begin, end in zip(ends, ends[1:], strict=False):
        now = order[begin:end]
        out[now] = np.minimum(table[first[now]], table[last[now] - width + 1])
        if end < len(order):
            table = np.minimum(table[:-width], table[width:])
            width *= 2
    return out


class Level:
    """A string of symbols that ends with the symbol 0 (which stands nowhere else), and what its symbols stand for.

    ``weight`` is the number of bytes of a symbol, ``shared`` the bytes that it has in common with the symbol before it,
    ``place`` the byte where each position begins (None: bytes and positions are the same).
    """

    def __init__(self, text: np.ndarray, symbols: int, weight: np.ndarray, shared: np.ndarray, place: np.ndarray | None, cap: int, budget: int):
        self.text, self.symbols, self.weight, self.shared, self.place = text, symbols, weight, shared, place
        self.cap, self.budget, self.n = cap, budget, len(text) - 1
        self.plain = not shared.any()
        self._types()

    def _types(self) -> None:
        """Which positions are S, and the length of the run of equal symbols from each."""
        n, text = self.n, self.text
        self.is_s, self.run = scratch(n + 1, np.bool_, self.budget), scratch(n + 1, np.int32, self.budget)
        self.is_s[n], self.run[n] = True, 1
        for end in range(n, 0, -BLOCK):
            begin = max(0, end - BLOCK)
            here, after = np.asarray(text[begin:end]), np.asarray(text[begin + 1 : end + 1])
            change = np.where(here != after, np.arange(begin, end), n + 1)
            change = np.minimum.accumulate(change[::-1])[::-1]
            open_ = change > n  # the run goes on beyond the block
            change[open_] = end + self.run[end] - 1
            self.run[begin:end] = change - np.arange(begin, end) + 1
            less = here < after
            kind = less[np.minimum(change, end - 1) - begin]
            kind[open_] = self.is_s[end]
            self.is_s[begin:end] = kind
        #: How many equal symbols stand directly before each position.
        self.before = scratch(n + 1, np.int32, self.budget)
        self.before[0] = 0
        for begin in range(1, n + 1, BLOCK):
            end = min(begin + BLOCK, n + 1)
            change = np.where(text[begin:end] != text[begin - 1 : end - 1], np.arange(begin, end), 0)
            change[0] = change[0] or begin - 1 - self.before[begin - 1]
            self.before[begin:end] = np.arange(begin, end) - np.maximum.accumulate(change)

    def seeds(self) -> np.ndarray:
        """Positions of S suffixes behind an L suffix, in text order; the last is the end of the text."""
        found = Queues(1, self.budget)
        for begin in range(1, self.n + 1, BLOCK):
            end = min(begin + BLOCK, self.n + 1)
            found.push(0, np.flatnonzero(self.is_s[begin:end] & ~self.is_s[begin - 1 : end - 1]) + begin)
        return found.all()

    def bytes_from(self, start: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        return symbols if self.place is None else self.place[start + symbols] - self.place[start]

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Common bytes of different symbols."""
        if self.plain:
            return np.zeros(len(x), np.int64)
        return range_min(self.shared, np.minimum(x, y) + 1, np.maximum(x, y)).astype(np.int64)

    def seam(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common bytes of an S and an L suffix (either way round) with the same first symbol."""
        both = np.minimum(self.run[a], self.run[b]).astype(np.int64)
        x, y = self.text[a + both].astype(np.int64), self.text[b + both].astype(np.int64)
        return np.minimum(self.cap, self.bytes_from(a, both) + self.apart(x, y))

    # Strings between seeds

    def named(self, seeds: np.ndarray):
        """Numbers of the strings at the seeds, how many there are, their weights and shared bytes; and the order if all differ.

        A string reaches from its seed over the next one to the end of that one's run of equal symbols and one symbol
        on: so no string is the beginning of another one, and bytes alone decide order and common prefix.
        """
        m, text, n = len(seeds), self.text, self.n
        lead = self._lead(seeds)
        queues = Queues(int(lead.max()) + 1, self.budget)
        for i in range(0, m, BLOCK):
            part = lead[i : i + BLOCK]
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[order])) + 1
            for group in np.split(order, cuts):
                queues.push(int(part[group[0]]), group + i)
        names, orders, weights, shares = scratch(m, np.int32, self.budget), Queues(1, self.budget), [], []
        bits, per = (9, 7) if self.symbols <= DENSE else (31, 2)
        count, before = 0, -1
        for queue in range(len(queues.parts)):
            items = np.asarray(queues.all(queue))
            if not len(items):
                continue
            start = seeds[items]
            following = seeds[np.minimum(items + 1, m - 1)]
            end = np.minimum(following + self.run[following], n)
            order, common = _sorted_strings(text, start, end - start + 1, bits, per)
            items, start = items[order], start[order]
            if before >= 0:
                common[0] = _common(text, before, int(start[0]))
            fresh = common >= 0
            fresh[0] = True
            names[items] = count + np.cumsum(fresh) - 1
            count += int(fresh.sum())
            chosen = items[fresh]
            following = seeds[np.minimum(chosen + 1, m - 1)]
            weights.append(np.minimum(self.cap, self.bytes_from(seeds[chosen], following - seeds[chosen])))
            previous = np.concatenate([[before if before >= 0 else start[0]], start[:-1]])[fresh]
            shares.append(self._shared(previous, start[fresh], np.maximum(common[fresh], 0), before < 0))
            orders.push(0, items)
            before = int(start[-1])
        return names, count, np.concatenate(weights), np.concatenate(shares), orders.all() if count == m else None

    def _lead(self, seeds: np.ndarray) -> np.ndarray:
        """A number for each seed that grows with its first symbols, so that few seeds share one."""
        first = self.text[seeds].astype(np.int64)
        if self.symbols <= DENSE:
            first = first * DENSE + self.text[np.minimum(seeds + 1, self.n)]
        counts = np.bincount(first)
        return (np.cumsum(counts) - counts)[first] // RANGE

    def _shared(self, a: np.ndarray, b: np.ndarray, common: np.ndarray, first: bool) -> np.ndarray:
        x, y = self.text[a + common].astype(np.int64), self.text[b + common].astype(np.int64)
        if first:  # the very first string has none before it
            y[0] = x[0] + 1 if x[0] + 1 < self.symbols else x[0] - 1 if x[0] else y[0]
        out = self.bytes_from(a, common) + (0 if self.plain else self.apart(x, np.where(x == y, x + 1, y)))
        if first:
            out[0] = 0
        return np.minimum(self.cap, out)

    # Induction

    def induce(self, wanted_s: bool, seeds: np.ndarray, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All S suffixes in descending order from the L ones in that order, or all L ones in ascending order from the S seeds.

        ``prefix`` holds each seed's common bytes with the seed before it; likewise returned.
        """
        scan = _Scan(self, wanted_s, seeds, prefix)
        out = scan.run()
        return out >> SHIFT, (out & LOW).astype(np.int64)


class _Scan:
    """One scan of a level: symbols are counted from the far end where the order is descending."""

    def __init__(self, level: Level, wanted_s: bool, seeds: np.ndarray, prefix: np.ndarray):
        self.level, self.wanted_s, self.seeds, self.prefix = level, wanted_s, seeds, prefix
        self.cap = level.cap
        k = level.symbols
        counts, starts = np.zeros(k, np.int64), np.zeros(k, np.int64)
        runs = np.zeros(k, bool)
        for i in range(0, level.n, BLOCK):
            part = np.arange(i, min(i + BLOCK, level.n))
            counts += np.bincount(self.symbol(part[level.is_s[part] == wanted_s]), minlength=k)
            runs[self.symbol(part[level.run[part] > 2])] = True
        for i in range(0, len(seeds), BLOCK):
            starts += np.bincount(self.symbol(seeds[i : i + BLOCK]), minlength=k)
        self.first_seed = np.concatenate([[0], np.cumsum(starts)])
        both = counts + starts
        alone = (both > RANGE // 4) | runs if k > DENSE else np.ones(k, bool)
        band = np.cumsum(np.where(alone, 0, both)) // RANGE
        border = alone | np.concatenate([[True], alone[:-1] | (np.diff(band) > 0)])
        self.range_of = np.cumsum(border) - 1
        self.bounds = np.concatenate([np.flatnonzero(border), [k]])
        self.queues, self.out = Queues(len(self.bounds) - 1, level.budget), Queues(1, level.budget)
        # Least common bytes since the last push to each symbol: to the end of that push's block, and of each block since
        # then; of these minima only those that are less than all later ones are kept, so at most ``cap`` of them.
        self.running, self.since = np.full(k, self.cap, np.uint16), np.zeros(k, np.int32)
        self.blocks, self.minima, self.block = [], [], 0
        self.last_symbol = -1

    def symbol(self, at: np.ndarray) -> np.ndarray:
        found = self.level.text[at].astype(np.int64)
        return self.level.symbols - 1 - found if self.wanted_s else found

    def weight(self, symbol: np.ndarray) -> np.ndarray:
        return self.level.weight[self.level.symbols - 1 - symbol if self.wanted_s else symbol]

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return self.level.apart(x, y) if not self.wanted_s else self.level.apart(self.level.symbols - 1 - x, self.level.symbols - 1 - y)

    def run(self) -> np.ndarray:
        for number, (begin, end) in enumerate(zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist(), strict=True)):
            if end - begin == 1:
                self._single(number, begin)
            else:
                self._several(number, begin, end)
        return self.out.all()

    def _begin(self, symbol: int) -> int:
        if self.last_symbol < 0:
            return 0
        return int(self.apart(np.array([self.last_symbol]), np.array([symbol]))[0])

    def _single(self, number: int, symbol: int) -> None:
        last = None
        for block, whole in self.queues.pull(number):
            at, common = block >> SHIFT, block & LOW
            if last is None:
                common[0] = self._begin(symbol)
                self.last_symbol = symbol
            beyond = 0
            if (more := self.level.before[at].astype(np.int64)).any() and whole and more.sum() <= 4 * BLOCK:
                at, common = self._runs(at, common, more)
                beyond = symbol + 1
            self.out.push(0, at << SHIFT | common)
            self._push(at, common, beyond)
            last = int(at[-1])
        for i in range(self.first_seed[symbol], self.first_seed[symbol + 1], BLOCK):
            j = min(i + BLOCK, self.first_seed[symbol + 1])
            at, common = np.array(self.seeds[i:j]), np.array(self.prefix[i:j])
            if i == self.first_seed[symbol]:
                common[0] = self._begin(symbol) if last is None else self.level.seam(np.array([last]), at[:1])[0]
                self.last_symbol = symbol
            self._push(at, common, 0)

    def _runs(self, at: np.ndarray, common: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes and all that their runs of the same symbol add before them: all by one symbol, then by two, and so on."""
        place = np.repeat(np.arange(len(at)), more + 1)
        step = np.arange(len(place)) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
        order = np.argsort(step, kind="stable")
        place, step = place[order], step[order]
        out, prefix = at[place] - step, common[place]
        inner = np.flatnonzero((step[1:] == step[:-1]) & (step[1:] > 0)) + 1
        weight = self.weight(self.symbol(at[:1]))[0]
        prefix[inner] = np.minimum(self.cap, step[inner] * weight + range_min(common, place[inner - 1] + 1, place[inner]))
        border = np.flatnonzero(step[1:] != step[:-1]) + 1
        prefix[border] = self.level.seam(out[border - 1], out[border])
        return out, prefix

    def _several(self, number: int, begin: int, end: int) -> None:
        known = [b for b, _ in self.queues.pull(number)]
        known = np.concatenate(known) if known else np.empty(0, np.int64)
        known = known[np.argsort(self.symbol(known >> SHIFT), kind="stable")]
        seeds = slice(self.first_seed[begin], self.first_seed[end])
        seed_at, own = np.asarray(self.seeds[seeds]), np.empty(0, np.int64)
        if not len(known) and not len(seed_at):
            return
        while True:  # each pass finds the suffixes that those of the last pass feed within the range
            at = np.concatenate([known >> SHIFT, own, seed_at])
            kind = np.repeat([0, 1, 2], [len(known), len(own), len(seed_at)])
            order = np.argsort(self.symbol(at) * 3 + kind, kind="stable")
            seq = at[order]
            feeds = self._feeds(seq)
            feeds[feeds] = self.symbol(seq[feeds] - 1) < end
            fed = seq[feeds] - 1
            if np.array_equal(fed, own):
                break
            own = fed
        kind, symbol = kind[order], self.symbol(seq)
        source = np.zeros(len(at), np.int64)
        source[len(known) : len(known) + len(own)] = np.flatnonzero(feeds)
        source = source[order]
        value = np.concatenate([known & LOW, np.full(len(own), self.cap), np.asarray(self.prefix[seeds])])[order]
        border = np.concatenate([[True], symbol[1:] != symbol[:-1]])
        value[0] = self._begin(int(symbol[0]))
        inner = np.flatnonzero(border[1:]) + 1
        value[inner] = self.apart(symbol[inner - 1], symbol[inner])
        seam = np.flatnonzero(~border[1:] & (kind[1:] == 2) & (kind[:-1] < 2)) + 1
        if len(seam):
            value[seam] = self.level.seam(seq[seam - 1], seq[seam])
        mine = np.flatnonzero(~border & (kind == 1))
        if len(mine):
            after = kind[mine - 1] == 1  # the one before was fed by the range too
            first = np.where(after, source[mine - 1] + 1, 0)
            bound = np.where(after, self.cap, self._running(symbol[mine]))
            weight = self.weight(symbol[mine])
            while True:  # values depend on earlier ones only, so this settles
                new = np.minimum(self.cap, weight + np.minimum(bound, range_min(value, first, source[mine])))
                if np.array_equal(new, value[mine]):
                    break
                value[mine] = new
        fed = kind < 2
        self.out.push(0, seq[fed] << SHIFT | value[fed])
        self._push(seq, value, end)
        self.last_symbol = int(symbol[-1])

    def _feeds(self, at: np.ndarray) -> np.ndarray:
        """Whether the suffix before is of the wanted type (the end of the text is fed by none)."""
        return (at > 0) & (self.level.is_s[np.maximum(at - 1, 0)] == self.wanted_s)

    def _running(self, symbol: np.ndarray) -> np.ndarray:
        place = np.searchsorted(np.array(self.blocks, np.int64), self.since[symbol])
        return np.minimum(self.running[symbol], np.array([*self.minima, self.cap], np.int64)[place])

    def _close(self, least: int) -> None:
        while self.minima and self.minima[-1] >= least:
            self.minima.pop()
            self.blocks.pop()
        self.minima.append(least)
        self.blocks.append(self.block)
        self.block += 1

    def _push(self, at: np.ndarray, common: np.ndarray, beyond: int) -> None:
        """Queue the suffixes before the scanned ones, with their common bytes, where their symbol is at least ``beyond``."""
        places = np.flatnonzero(self._feeds(at))
        symbol = self.symbol(at[places] - 1)
        if beyond:
            places, symbol = places[symbol >= beyond], symbol[symbol >= beyond]
        if not len(places):
            self._close(int(common.min()))
            return
        order = np.argsort(symbol.astype(np.uint16) if self.level.symbols <= DENSE else symbol, kind="stable")
        places, symbol = places[order], symbol[order]
        first = np.concatenate([[True], symbol[1:] != symbol[:-1]])
        # A symbol's first push takes the minimum from the block's begin on, each later one from the push before it.
        found = np.minimum.accumulate(common)[places]
        found[first] = np.minimum(found[first], self._running(symbol[first]))
        again = np.flatnonzero(~first)
        found[again] = range_min(common, places[again - 1] + 1, places[again])
        self._close(int(common.min()))
        rest = np.append(np.minimum.accumulate(common[::-1])[::-1], self.cap)
        final = np.concatenate([first[1:], [True]])
        self.running[symbol[final]] = rest[places[final] + 1]
        self.since[symbol[final]] = self.block
        values = (at[places] - 1) << SHIFT | np.minimum(self.cap, self.weight(symbol) + found)
        target = self.range_of[symbol]
        cuts = [0, *(np.flatnonzero(np.diff(target)) + 1).tolist(), len(target)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            self.queues.push(int(target[i]), values[i:j])


def _words(text: np.ndarray, start: np.ndarray, left: np.ndarray, bits: int, per: int) -> np.ndarray:
    """The next ``per`` symbols of each string as one number; nothing after a string's end."""
    out, last = np.zeros(len(start), np.int64), len(text) - 1
    for i in range(per):
        out = out << bits | np.where(left > i, text[np.minimum(start + i, last)], 0)
    return out


def _sorted_strings(text: np.ndarray, start: np.ndarray, length: np.ndarray, bits: int, per: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of strings, and each one's common symbols with the one before (-1 where equal; the first has 0)."""
    order, group = np.arange(len(start)), np.zeros(len(start), np.int64)
    common = np.full(len(start), -1, np.int64)
    common[0] = 0
    active, done = np.arange(len(start)), 0
    while len(active):
        items = order[active]
        word = _words(text, start[items] + done, length[items] - done, bits, per)
        sort = np.lexsort((word, group[active]))
        items, word = items[sort], word[sort]
        order[active] = items
        near = (np.diff(active) == 1) & (group[active][1:] == group[active][:-1])
        border = np.flatnonzero(near & (word[1:] != word[:-1])) + 1
        change = word[border] ^ word[border - 1]
        same = np.zeros(len(border), np.int64)
        for i in range(1, per):
            same += (change >> (bits * (per - i))) == 0
        common[active[border]] = done + same
        lead = np.concatenate([[True], ~near])
        lead[border] = True
        heads = np.flatnonzero(lead)
        size = np.diff(np.append(heads, len(active)))
        group[active] = np.repeat(active[heads], size)
        done += per
        active = active[np.repeat(size > 1, size) & (length[items] > done)]
    return order, common


def _common(text: np.ndarray, a: int, b: int) -> int:
    at = 0
    while text[a + at] == text[b + at]:
        at += 1
    return at


def _sort(level: Level) -> tuple[np.ndarray, np.ndarray]:
    """The order of a level's suffixes (the end of the text first) and each one's common bytes with the one before."""
    n, budget = level.n, level.budget
    if not n:
        return np.zeros(1, np.int64), np.zeros(1, np.int64)
    seeds = level.seeds()
    names, count, weight, shared, order = level.named(seeds)
    if order is None:
        place = seeds if level.place is None else level.place[seeds]
        order, prefix = _sort(Level(names, count, weight, shared, place, level.cap, budget))
    else:
        prefix = shared
    large, large_prefix = level.induce(False, seeds[order], prefix)
    down = large[::-1]
    small, small_prefix = level.induce(True, down, np.concatenate([[0], large_prefix[:0:-1]]))
    small = small[::-1]
    small_prefix = np.concatenate([[0], small_prefix[:0:-1]])

    out, common = scratch(n + 1, np.int64, budget), scratch(n + 1, np.int64, budget)
    out[0] = n
    common[0] = 0
    l_counts, s_counts = _counts(level, large), _counts(level, small)
    l_before, s_before = np.cumsum(l_counts), np.cumsum(s_counts) - s_counts
    for part, values, before in ((large, large_prefix, s_before), (small, small_prefix, l_before)):
        for i in range(0, len(part), BLOCK):
            at = np.asarray(part[i : i + BLOCK])
            to = np.arange(i, i + len(at)) + before[level.text[at].astype(np.int64)] + 1
            out[to], common[to] = at, values[i : i + BLOCK]
    for i in range(1, n + 1, BLOCK):
        at, before = np.asarray(out[i : i + BLOCK]), np.asarray(out[i - 1 : min(i - 1 + BLOCK, n)])
        x, y = level.text[before].astype(np.int64), level.text[at].astype(np.int64)
        border = np.flatnonzero(x != y)
        common[i + border] = level.apart(x[border], y[border])
        seam = np.flatnonzero((x == y) & (level.is_s[before] != level.is_s[at]))
        common[i + seam] = level.seam(before[seam], at[seam])
    return out, common


def _counts(level: Level, at: np.ndarray) -> np.ndarray:
    out = np.zeros(level.symbols, np.int64)
    for i in range(0, len(at), BLOCK):
        out += np.bincount(level.text[at[i : i + BLOCK]], minlength=level.symbols)
    return out


def suffix_array(fill: Callable[[np.ndarray], None], n: int, symbols: int, cap: int, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray]:
    """Order and common prefixes (at most ``cap``, below 2**16) of the suffixes of ``n`` symbols from 1 to ``symbols - 1``.

    ``fill`` writes the symbols into the given array. The first entry is the empty suffix.
    """
    if not 0 < cap < 1 << SHIFT or symbols > DENSE:
        raise ValueError("prefixes are counted to 65,535 at most, over at most 512 symbols")
    text = scratch(n + 1, np.uint16, budget)
    fill(text[:n])
    text[n] = 0
    return _sort(Level(text, symbols, np.ones(symbols, np.int64), np.zeros(symbols, np.int64), None, cap, budget))
