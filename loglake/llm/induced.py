"""Suffix sorting by external recursive induction, with common prefixes.

Suffixes are sorted from the suffixes after them: scanning what is sorted in order, each
suffix puts the one before it into a priority queue on its first symbol, first in, first
out among equal ones. The entries are tuples of symbol, suffix and the length of the
common prefix with the entry before it, capped at what the caller needs. A pushed suffix
shares one symbol more with its forerunner than the least common prefix scanned between
the two, so lengths are carried through the induction; only where two runs meet are texts
compared.

The queue deals its entries over ranges of symbols. Only the range at the front is put in
order, in memory; the others keep what came, on disk beyond `held` entries in all. Sorted
runs are tapes and texts, names and positions are tables, both in files beyond `held`.
What is taken from the queue at once is the longest run of entries that no push of the run
itself could come before, found by a running minimum: about the root of the string's length
for large alphabets, so numpy handles blocks at every level of the recursion.

The seeds of the induction are the leftmost suffixes of the S type (LMS): their substrings
are sorted by an induction without common prefixes and named, and if names repeat the
string of names is sorted by the same procedure, down to a string that a quarter of what may
be held in memory holds: that one is sorted there, by doubling. Its common prefixes, in
names, say where the comparison of the symbols may start.

Files have no name and are in the executor's scratch space: they are gone with their task.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

#: Entries handled at once at most; entries or symbols that a structure keeps in memory.
BLOCK = 1 << 16
HELD = 1 << 22
#: Ranges of symbols that are counted at the most when they are dealt.
COUNTED = 1 << 16
#: Symbols up to which each is scanned by itself.
FEW = 1024
#: Symbols compared at once.
WIDE = 16
ROW = np.dtype([("s", "<i4"), ("at", "<i4"), ("c", "u1")], align=True)


def table(n: int, kind: type, held: int) -> np.ndarray:
    """An array of zeros; in a file beyond `held` entries."""
    return np.zeros(n, kind) if n <= held else np.memmap(tempfile.TemporaryFile(), dtype=kind, mode="w+", shape=(n,))


def _rows(s: np.ndarray, at: np.ndarray, c: np.ndarray | int) -> np.ndarray:
    out = np.empty(len(at), ROW)
    out["s"], out["at"], out["c"] = s, at, c
    return out


def _chained(parts: list[np.ndarray]) -> np.ndarray:
    """Rows one after the other; as plain bytes, which numpy copies faster than fields."""
    if len(parts) == 1:
        return parts[0]
    return np.concatenate([p.view(f"V{ROW.itemsize}") for p in parts]).view(ROW) if parts else np.empty(0, ROW)


class Tape:
    """Rows that are written at the end and read in blocks; in a file beyond `held` rows."""

    def __init__(self, held: int):
        self.held, self.n, self.parts, self.file = held, 0, [], None

    def append(self, rows: np.ndarray) -> None:
        self.n += len(rows)
        self.parts.append(rows)
        if self.n > self.held:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.seek(0, 2)
            for part in self.parts:
                self.file.write(part.tobytes())
            self.parts = []

    def read(self, a: int, b: int) -> np.ndarray:
        if self.file is not None:
            self.file.seek(a * ROW.itemsize)
            return np.frombuffer(self.file.read((b - a) * ROW.itemsize), ROW)
        if len(self.parts) != 1:
            self.parts = [_chained(self.parts)]
        return self.parts[0][a:b]


class Reader:
    """A tape from its begin, or back from its end: then a row has the common prefix of the row that it is read after, and symbols count from `flip` down."""

    def __init__(self, tape: Tape, back: bool = False, flip: int | None = None):
        self.tape, self.back, self.flip = tape, back, flip
        self.left, self.rows = tape.n, np.empty(0, ROW)

    def peek(self, n: int) -> np.ndarray:
        """The next rows, n of them if there are as many."""
        if len(self.rows) < n and self.left:
            take = min(max(n, BLOCK), self.left)
            if self.back:
                more = self.tape.read(self.left - take, min(self.left + 1, self.tape.n))[::-1].copy()
                if self.left < self.tape.n:
                    more["c"][1:], more = more["c"][:-1].copy(), more[1:]
                else:
                    more["c"] = np.append(np.uint8(0), more["c"][:-1])
            else:
                more = self.tape.read(self.tape.n - self.left, self.tape.n - self.left + take).copy()
            if self.flip is not None:
                more["s"] = self.flip - more["s"]
            self.left -= take
            self.rows = _chained([self.rows, more]) if len(self.rows) else more
        return self.rows[:n]

    def skip(self, n: int) -> None:
        self.rows = self.rows[n:]

    def more_than(self, n: int) -> bool:
        return self.left > 0 or len(self.rows) > n


class Queue:
    """A priority queue on symbols, first in, first out among equal ones. What is pushed is never less than what was taken."""

    def __init__(self, counts: np.ndarray, shift: int, held: int):
        """counts: of the entries to come, by symbol >> shift."""
        wide = int(min(BLOCK, max(4096, 8 * np.sqrt(counts.sum()))))
        large = counts > wide
        chunk = (np.cumsum(counts) - counts) // wide
        new = np.ones(len(counts), dtype=bool)
        if len(counts) > FEW or shift:
            new[1:] = (chunk[1:] != chunk[:-1]) | large[1:] | large[:-1]
        self.lows = np.append(np.flatnonzero(new) << shift, len(counts) << shift)
        self.held, self.kept, self.file = held, 0, None
        self.parts: list[list[np.ndarray]] = [[] for _ in self.lows[1:]]
        self.on_disk: list[list[tuple[int, int]]] = [[] for _ in self.lows[1:]]
        self.front, self.rows = 0, np.empty(0, ROW)

    @property
    def end(self) -> int:
        """The symbol after those of the range at the front."""
        return int(self.lows[self.front + 1])

    @property
    def hidden(self) -> bool:
        """Whether the range at the front has more than `rows`: only one of a single symbol, which is read in parts."""
        return bool(self.parts[self.front] or self.on_disk[self.front])

    def push(self, rows: np.ndarray) -> None:
        """rows: by symbol."""
        s = rows["s"]
        cuts = np.append(0, np.flatnonzero(s[1:] != s[:-1]) + 1)
        at = np.searchsorted(self.lows, s[cuts], side="right") - 1
        new = np.append(True, at[1:] != at[:-1])
        cuts, at = [*cuts[new].tolist(), len(rows)], at[new].tolist()
        for k, a, b in zip(at, cuts[:-1], cuts[1:], strict=True):
            if k == self.front and self.end - self.lows[k] > 1:
                both = _chained([self.rows, rows[a:b]])
                self.rows = both[np.argsort(both["s"], kind="stable")]
            else:
                self.parts[k].append(rows[a:b])
                self.kept += b - a
        if self.kept > self.held:
            self.file = self.file or tempfile.TemporaryFile()
            for k, parts in enumerate(self.parts):
                if parts:
                    self.on_disk[k].append((self.file.seek(0, 2), sum(map(len, parts))))
                    self.file.write(b"".join(p.tobytes() for p in parts))
                    self.parts[k] = []
            self.kept = 0

    def _next(self, k: int, n: int) -> np.ndarray | None:
        """The oldest rows of a range, n at most."""
        if self.on_disk[k]:
            begin, size = self.on_disk[k][0]
            take = min(n, size)
            self.file.seek(begin)
            if take < size:
                self.on_disk[k][0] = (begin + take * ROW.itemsize, size - take)
            else:
                self.on_disk[k].pop(0)
            return np.frombuffer(self.file.read(take * ROW.itemsize), ROW)
        if not self.parts[k]:
            return None
        rows = self.parts[k].pop(0)
        if len(rows) > n:
            self.parts[k].insert(0, rows[n:])
            rows = rows[:n]
        self.kept -= len(rows)
        return rows

    def _split(self, k: int) -> None:
        """Deal a range that is too large over smaller ones."""
        a, b = int(self.lows[k]), int(self.lows[k + 1])
        inner = np.unique(np.linspace(a, b, min(b - a, 1024) + 1).astype(np.int64))
        old_parts, old_disk = self.parts[k], self.on_disk[k]
        self.lows = np.concatenate([self.lows[:k], inner, self.lows[k + 2 :]])
        self.parts[k : k + 1] = [[] for _ in inner[1:]]
        self.on_disk[k : k + 1] = [[] for _ in inner[1:]]
        for begin, size in old_disk:
            for done in range(0, size, BLOCK):
                self.file.seek(begin + done * ROW.itemsize)
                rows = np.frombuffer(self.file.read(min(BLOCK, size - done) * ROW.itemsize), ROW)
                self.push(rows[np.argsort(rows["s"], kind="stable")])
        for rows in old_parts:
            self.kept -= len(rows)
            self.push(rows)

    def load(self, limit: int | None) -> None:
        """Bring entries to the front, of ranges that begin at `limit` or before."""
        while not len(self.rows):
            if self.hidden:
                k = self.front
                if self.end - self.lows[k] == 1:
                    got = [self._next(k, BLOCK)]
                    while self.hidden and sum(map(len, got)) < BLOCK:
                        got.append(self._next(k, BLOCK - sum(map(len, got))))
                    self.rows = _chained(got)
                    return
                if sum(n for _, n in self.on_disk[k]) + sum(map(len, self.parts[k])) > self.held:
                    # No range is at the front while entries are dealt.
                    self.front = -1
                    self._split(k)
                    self.front = k
                    continue
                got = []
                while (rows := self._next(k, 1 << 62)) is not None:
                    got.append(rows)
                rows = _chained(got)
                self.rows = rows[np.argsort(rows["s"], kind="stable")]
                return
            if self.front + 2 >= len(self.lows) or limit is not None and self.end > limit:
                return
            self.front += 1

    def take(self, n: int) -> None:
        self.rows = self.rows[n:]


def common(text: np.ndarray, a: np.ndarray, b: np.ndarray, known: np.ndarray, cap: int) -> np.ndarray:
    """Capped common prefixes of pairs of suffixes that share `known` symbols, by comparison of WIDE symbols at once."""
    out, n = np.minimum(known, cap).astype(np.int64), len(text)
    wide = np.ndarray((max(0, n - WIDE + 1),), f"V{WIDE * text.itemsize}", text, strides=(text.itemsize,))
    open_ = np.flatnonzero(out < cap)
    while len(open_):
        x, y = a[open_] + out[open_], b[open_] + out[open_]
        last = np.maximum(x, y)
        far = last <= n - WIDE
        same = np.zeros(len(open_), dtype=np.int64)
        differ = (wide[x[far]].view(np.uint64) ^ wide[y[far]].view(np.uint64)).reshape(-1, WIDE * text.itemsize // 8)
        word = (differ != 0).argmax(axis=1)
        bits = differ[np.arange(len(differ)), word]
        # The lowest bit of the first word that differs is in the first symbol that does.
        lowest = np.frexp((bits & (~bits + np.uint64(1))).astype(np.float64))[1] - 1
        same[far] = np.where(bits == 0, WIDE, (word * 64 + lowest) // (8 * text.itemsize))
        near = np.flatnonzero(~far & (last < n))
        same[near] = text[x[near]] == text[y[near]]
        out[open_] += same
        open_ = open_[same == np.where(far, WIDE, 1)]
        open_ = open_[out[open_] < cap]
    return np.minimum(out, cap)


class Least:
    """Least common prefixes scanned between two pushes to a symbol.

    Lengths are at most `cap`, so the last rank with a length of at most x, for each x, answers all queries back from
    now; within a batch a table of minima does.
    """

    def __init__(self, symbols: int, cap: int, held: int):
        self.pushed = table(symbols, np.int64, held)
        self.last = np.full(cap + 1, -1, dtype=np.int64)
        self.rank = 0

    def between(self, shared: np.ndarray, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """For pushes by the batch's entries `at` to `symbol` (sorted by symbol, then entry)."""
        n = len(shared)
        out = np.empty(0, np.uint8)
        if len(at):
            first = np.ones(len(at), dtype=bool)
            first[1:] = symbol[1:] != symbol[:-1]
            low = np.where(first, 0, np.concatenate([[0], at[:-1] + 1]))
            levels = [shared]
            widest = int((at - low).max()) + 1
            while 2 << (len(levels) - 1) <= widest:
                k, t = len(levels) - 1, levels[-1].copy()
                np.minimum(t[: -(1 << k)], levels[-1][1 << k :], out=t[: -(1 << k)])
                levels.append(t)
            k = np.frexp((at - low + 1).astype(np.float64))[1].astype(np.int64) - 1
            flat = np.concatenate(levels)
            out = np.minimum(flat[k * n + low], flat[k * n + at + 1 - (1 << k)])
            before = np.minimum(np.searchsorted(self.last, self.pushed[symbol[first]], side="right"), len(self.last) - 1)
            out[first] = np.minimum(out[first], before)
            final = np.append(first[1:], True)
            self.pushed[symbol[final]] = self.rank + at[final]
        seen = np.full(len(self.last), -1, dtype=np.int64)
        seen[shared] = np.arange(n)
        seen = np.maximum.accumulate(seen)
        self.last = np.where(seen >= 0, self.rank + seen, self.last)
        self.rank += n
        return out


def _merged(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows by symbol, those of `one` first among equal ones; and whether they are of `two`."""
    if not len(two):
        return one, np.zeros(len(one), dtype=bool)
    if not len(one):
        return two, np.ones(len(two), dtype=bool)
    rows = _chained([one, two])
    order = np.argsort(rows["s"], kind="stable")
    return rows[order], order >= len(one)


def induce(text: np.ndarray, symbols: int, queue: Queue, other: Reader, down: bool, cap: int, carry: bool, held: int) -> Tape:
    """Scan the queue and, after its entries of the same symbol, the other rows; the sorted rows of the queue.

    Each scanned suffix pushes the one before it if that is of the type that the queue sorts. down: symbols are
    counted from the last one; the queue and `other` have them so.
    """
    out, least, size = Tape(held), Least(symbols if carry else 0, cap, held), BLOCK
    last_s, last_at, last_other = -1, 0, False
    while True:
        two = other.peek(size)
        queue.load(int(two["s"][0]) if len(two) else None)
        one = queue.rows[:size]
        if not len(one) and not len(two):
            return out
        if symbols <= FEW:
            # All of one symbol and kind: what they push comes after them.
            is_two = not len(one) or len(two) > 0 and two["s"][0] < one["s"][0]
            rows = two if is_two else one
            first = int(rows["s"][0])
            if rows["s"][-1] != first:
                rows = rows[: np.searchsorted(rows["s"], first, side="right")]
            n, at = len(rows), rows["at"].astype(np.int64)
            q = text[at - 1].astype(np.uint16)
            if down:
                q = np.uint16(symbols - 1) - q
            pushes = np.flatnonzero(((q > first) if is_two else (q >= first)) & (at > 0))
            shared = rows["c"].copy()
            if last_s != first:
                shared[0] = 0
            elif carry and is_two and not last_other:
                shared[0] = common(text, np.array([last_at]), at[:1], np.zeros(1, np.int64), cap)[0]
            last_s, last_at, last_other, taken = first, at[-1], is_two, 0 if is_two else n
            if taken:
                out.append(_rows(symbols - 1 - first if down else first, at, shared))
        else:
            # Nothing is taken that what isn't seen yet could come before.
            bound = 2 * int(one["s"][-1]) if len(queue.rows) > size or queue.hidden else 2 * queue.end - 1
            if other.more_than(len(two)):
                bound = min(bound, 2 * int(two["s"][-1]) + 1)
            rows, of_two = _merged(one[: np.searchsorted(one["s"], bound // 2, side="right")], two[: np.searchsorted(two["s"], (bound - 1) // 2, side="right")])
            s, at = rows["s"].astype(np.int64), rows["at"].astype(np.int64)
            q = text[at - 1].astype(np.int64)
            if down:
                q = symbols - 1 - q
            pushes = (at > 0) & ((q > s) | (q == s) & ~of_two)
            # Nor beyond the least of what the entries before would push.
            late = np.minimum.accumulate(np.where(pushes, 2 * q, np.iinfo(np.int64).max)) < 2 * s + of_two
            n = int(np.argmax(late)) if late.any() else len(rows)
            s, at, of_two, pushes, shared = s[:n], at[:n], of_two[:n], np.flatnonzero(pushes[:n]), rows["c"][:n]
            if carry:
                shared = shared.copy()
                before_s, before_at, before_other = np.append(last_s, s[:-1]), np.append(last_at, at[:-1]), np.append(last_other, of_two[:-1])
                shared[before_s != s] = 0
                meet = np.flatnonzero((before_s == s) & of_two & ~before_other)
                if len(meet):
                    shared[meet] = common(text, before_at[meet], at[meet], np.zeros(len(meet), np.int64), cap)
            last_s, last_at, last_other, taken = s[-1], at[-1], of_two[-1], int(n - of_two.sum())
            if taken:
                mine = ~of_two
                out.append(_rows(symbols - 1 - s[mine] if down else s[mine], at[mine], shared[mine]))
        queue.take(taken)
        other.skip(n - taken)
        pushes = pushes[np.argsort(q[pushes], kind="stable")]
        symbol = q[pushes]
        c = np.minimum(least.between(shared, pushes, symbol).astype(np.int64) + 1, cap) if carry else 0
        if len(pushes):
            queue.push(_rows(symbol, at[pushes] - 1, c))
        size = BLOCK if symbols <= FEW else min(BLOCK, max(256, 2 * n))


def leftmost(text: np.ndarray, shift: int, symbols: int, held: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the LMS suffixes, and the numbers of L and S suffixes by symbol >> shift. The last symbol counts as S."""
    n, width = len(text), (symbols - 1 >> shift) + 1
    out, free = table(n // 2 + 1, np.int32, held), n // 2 + 1
    counts = [np.zeros(width, dtype=np.int64), np.zeros(width, dtype=np.int64)]
    after, after_s = -1, True
    for b in range(n, 0, -(BLOCK << 2)):
        a = max(0, b - (BLOCK << 2))
        x = np.asarray(text[a:b]).astype(np.int64)
        following = np.append(x[1:], after)
        differ = np.flatnonzero(x != following)
        rises = np.append((x < following)[differ], after_s)
        if b == n:
            rises[-2] = True
        s = rises[np.searchsorted(differ, np.arange(len(x)))]
        inner = a + 1 + np.flatnonzero(s[1:] & ~s[:-1])
        if b < n and after_s and not s[-1]:
            inner = np.append(inner, b)
        out[free - len(inner) : free] = inner
        free -= len(inner)
        for kind in (0, 1):
            counts[kind] += np.bincount(x[s == bool(kind)] >> shift, minlength=width)
        after, after_s = int(x[0]), bool(s[0])
    return out[free:], counts[0], counts[1]


def _induced(text: np.ndarray, symbols: int, seeds: Tape, counts: tuple[np.ndarray, np.ndarray], shift: int, cap: int, carry: bool, held: int) -> tuple[Tape, Tape]:
    """L suffixes in order and S suffixes in falling order, from LMS suffixes in order."""
    of_l = induce(text, symbols, Queue(counts[0], shift, held), Reader(seeds), False, cap, carry, held)
    # Counted from the last symbol, ranges of symbols begin elsewhere.
    width = len(counts[1]) << shift
    queue = Queue(counts[1][::-1], shift, held)
    queue.lows = np.maximum(queue.lows - (width - symbols), 0)
    queue.push(_rows(np.array([symbols - 1 - int(text[-1])]), np.array([len(text) - 1]), 0))
    return of_l, induce(text, symbols, queue, Reader(of_l, back=True, flip=symbols - 1), True, cap, carry, held)


def _joined(text: np.ndarray, of_l: Tape, of_s: Tape, cap: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes in order, with common prefixes."""
    one, two = Reader(of_l), Reader(of_s, back=True)
    last_s, last_at, last_two = -1, 0, False
    while True:
        a, b = one.peek(BLOCK), two.peek(BLOCK)
        if not len(a) and not len(b):
            return
        bound = min(2 * int(a["s"][-1]) if one.more_than(len(a)) else 1 << 62, 2 * int(b["s"][-1]) + 1 if two.more_than(len(b)) else 1 << 62)
        rows, of_two = _merged(a[: np.searchsorted(a["s"], bound // 2, side="right")], b[: np.searchsorted(b["s"], (bound - 1) // 2, side="right")])
        s, at, c = rows["s"], rows["at"].astype(np.int64), rows["c"].copy()
        before_s, before_at, before_two = np.append(last_s, s[:-1]), np.append(last_at, at[:-1]), np.append(last_two, of_two[:-1])
        meet = np.flatnonzero((before_s == s) & of_two & ~before_two)
        c[meet] = common(text, before_at[meet], at[meet], np.zeros(len(meet), np.int64), cap)
        last_s, last_at, last_two = s[-1], at[-1], of_two[-1]
        taken = int(of_two.sum())
        one.skip(len(rows) - taken)
        two.skip(taken)
        yield at, c


def _named(text: np.ndarray, lms: np.ndarray, of_s: Tape, held: int) -> tuple[np.ndarray, int]:
    """The string of names of the LMS substrings, equal ones with one name in their order; and how many names there are."""
    names, name, last = table(len(lms), np.int32, held), -1, np.empty(0, np.int64)
    rows = Reader(of_s, back=True)
    while len(some := rows.peek(BLOCK)):
        rows.skip(len(some))
        at = some["at"].astype(np.int64)
        at = at[(at > 0) & (text[at - 1] > text[at])]
        if not len(at):
            continue
        chain = np.append(last, at)
        where = np.searchsorted(lms, chain)
        size = lms[np.minimum(where + 1, len(lms) - 1)].astype(np.int64) - chain
        same = size[1:] == size[:-1]
        open_, k = np.flatnonzero(same), 0
        while len(open_):
            open_ = open_[size[open_] >= k]
            differ = text[chain[open_] + k] != text[chain[open_ + 1] + k]
            same[open_[differ]] = False
            open_, k = open_[~differ], k + 1
        new = np.append([True] * (not len(last)), ~same)
        names[where[len(last) :]] = name + np.cumsum(new)
        name += int(new.sum())
        last = at[-1:]
    return names, name + 1


def suffixes(text: np.ndarray, cap: int = 100, held: int = HELD) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of suffixes in order, and each one's common prefix with the one before, capped.

    text: integers from 0; the last one must be smaller than all others. cap: at most 254. Memory is bounded by `held`
    and the blocks, however long the text is; it has less than 2**31 symbols.
    """
    if len(text) < 2:
        yield np.arange(len(text)), np.zeros(len(text), dtype=np.uint8)
        return
    symbols = 1 + max(int(np.asarray(text[a : a + BLOCK]).max()) for a in range(0, len(text), BLOCK))
    shift = max(0, int(symbols - 1).bit_length() - COUNTED.bit_length() + 1)
    lms, of_l, of_s = leftmost(text, shift, symbols, held)
    seeds = Tape(held)
    if len(lms) < 2:
        seeds.append(_rows(text[lms], lms, 0))
    else:
        by_symbol = Queue(of_s, shift, held)
        for a in range(0, len(lms), BLOCK):
            at = np.asarray(lms[a : a + BLOCK])
            order = np.argsort(text[at], kind="stable")
            by_symbol.push(_rows(text[at][order], at[order], 0))
        while by_symbol.load(None) or len(by_symbol.rows):
            seeds.append(by_symbol.rows)
            by_symbol.take(len(by_symbol.rows))
        names, several = _named(text, lms, _induced(text, symbols, seeds, (of_l, of_s), shift, cap, False, held)[1], held)
        seeds, last = Tape(held), 0
        if several == len(lms):
            places = table(len(lms), np.int32, held)
            for a in range(0, len(lms), BLOCK):
                places[names[a : a + BLOCK]] = np.arange(a, min(a + BLOCK, len(lms)))
            sorted_ = ((np.asarray(places[a : a + BLOCK]).astype(np.int64), np.zeros(min(BLOCK, len(lms) - a), np.int64)) for a in range(0, len(lms), BLOCK))
        elif len(lms) <= held // 4:
            sorted_ = iter([(x := _doubled(np.asarray(names), cap // 2 + 2), np.zeros(len(x), np.int64))])
        else:
            sorted_ = suffixes(names, cap // 2 + 1, held)
        for order, shared in sorted_:
            at = lms[order].astype(np.int64)
            # Names in common are whole substrings in common.
            known = lms[np.minimum(order + shared.astype(np.int64), len(lms) - 1)] - at
            seeds.append(_rows(text[at], at, common(text, np.append(last, at[:-1]), at, known, cap)))
            last = at[-1]
    yield from _joined(text, *_induced(text, symbols, seeds, (of_l, of_s), shift, cap, True, held), cap)


def _doubled(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of a string of names, by its first `depth` names at least."""
    rank, n, k = names.astype(np.int64), len(names), 1
    while k < depth:
        second = np.zeros(n, dtype=np.int64)
        second[: n - k] = rank[k:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key)
        new = np.empty(n, dtype=np.int64)
        new[order] = np.cumsum(np.append(False, key[order][1:] != key[order][:-1]))
        rank, k = new, 2 * k
        if rank[order[-1]] == n - 1:
            break
    return order


def suffix_order(symbols: np.ndarray, cap: int = 100, held: int = HELD) -> tuple[np.ndarray, np.ndarray]:
    """As suffixes(), in one piece."""
    got = list(suffixes(symbols, cap, held))
    return np.concatenate([x[0] for x in got]), np.concatenate([x[1] for x in got]).astype(np.uint8)
