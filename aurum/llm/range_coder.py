"""Adaptive context-mixing range coder for token ids, for many blocks at a time.

Each block is coded on its own: its model starts anew, and a damaged block spoils no other.  Blocks
are lanes: one step codes the next id of every block with array operations, so that the adaptive,
serial work of a block costs array time.

Model of a block.  Ids get numbers in the order in which they first occur in the block.  The next number's
distribution is a mix of those of four models:

* order 2: the number that followed the last two when they were seen before;
* order 1: the number that followed the last one, and another one that did before;
* order 0: the numbers by their frequencies so far.

Each has a weight, kept by how often the predictions of orders 2 and 1 have held; after each id, the weights move
towards the models' shares in the probability that it was given.  A chance of its own says that the id is a
new one, which is then coded in full, its high and its low byte by adaptive frequencies.  The mixed cumulative
distribution (a number's order-0 interval, widened and moved by the single predictions at or below it) makes one
interval out of 2**36, which narrows a 64-bit carry-less range coder.  All arithmetic is in integers,
so that every machine decodes alike.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 2048
#: Blocks that are coded side by side, at some 50 KB each. A call of an array operation costs as much as some thousand lanes.
LANES = 3072
#: Steps between two sums of the order-0 frequencies; ids new since then have one unit each.
REFRESH = 64
#: Lanes whose tables are summed, and blocks that are numbered, at a time.
SOME = 128
UNITS = 1 << 14          # order-0 frequencies add up to this
NUMBERS = BLOCK + REFRESH

U = np.uint64
_TOP, _FLOOR = U(1 << 48), U(1 << 48)

#: Weights (out of 2**16) of order 2, of both predictions of order 1 and of order 0, by how often order 2 (rows) and
#: order 1 (columns) have held: 0 (nothing known yet) to 3.
_HELD = np.array([0.004, 0.25, 0.5, 0.75])
_SHARES = np.zeros((4, 4, 4))
_SHARES[..., 0] = _HELD[:, None]
_SHARES[..., 1] = (1 - _HELD[:, None]) * _HELD * 0.6
_SHARES[..., 2] = _SHARES[..., 1] * 0.4
_SHARES[..., 3] = 1 - _SHARES[..., :3].sum(-1)
_SHARES = np.round(_SHARES * 65536).astype(np.int64).reshape(16, 4)


#: How often a prediction has held from now on, by how often it had (0 to 3) and, in the upper half, when it holds again;
#: it has to fail more often the more often it has held.
_HELD_NEXT = np.array([1, 1, 1, 2, 1, 2, 3, 3], np.int32)


class Lanes:
    """The models of some blocks.  Ids are below 2**16.

    The single predictions stand in rows of one array (order 2, order 1, order 1's other one), as their number plus one, 0 for
    none, so that one array operation serves all of them.  What fits is kept and computed in 32 bits.
    """

    def __init__(self, n: int):
        self.n, self.lane = n, np.arange(n)
        self.row, self.count_row, self.byte_row = self.lane * BLOCK, self.lane * NUMBERS, self.lane * 257
        self.counts = np.zeros(n * NUMBERS, np.int16)
        self.after2 = np.zeros(n * BLOCK, np.int32)  # prediction << 2 | held, by a hash of the last two numbers
        self.after1 = np.zeros(n * BLOCK, np.int32)  # prediction << 14 | other one << 2 | held, by the last number
        self.weights = np.tile(_SHARES.T.astype(np.int32), n).ravel()  # by model, lane, and how both have held
        self.weight_row = np.arange(4)[:, None] * (n << 4) + (self.lane << 4)
        self.fresh = np.full(n, 1 << 15, np.int32)  # chance of a new id, out of 2**16
        self.known = np.zeros(n, np.int32)
        self.last, self.before = np.zeros(n, np.int32), np.zeros(n, np.int32)
        self.high_counts, self.low_counts = np.ones(n * 256, np.uint16), np.ones(n * 256, np.uint16)
        self.predicted, self.run = np.zeros((3, n), np.int32), np.zeros((2, n), np.int32)
        self.step = 0

    def _refresh(self) -> None:
        width = int(self.known.max()) + REFRESH + 1  # numbers beyond can't come up before the next time
        self.sums, self.sum_row, self.highest = np.empty((self.n, width), np.int16), self.lane * width, width - 2
        place, counts = np.arange(width, dtype=np.int32), self.counts.reshape(self.n, NUMBERS)
        for k in range(0, self.n, SOME):
            known = self.known[k:k + SOME, None]
            sums = np.zeros((len(known), width), np.int32)
            np.cumsum(counts[k:k + SOME, :width - 1], axis=1, out=sums[:, 1:])
            # each known number and each of the next REFRESH ones keeps one unit at least; the product is below 2**25
            sums *= UNITS - REFRESH - known
            sums //= np.int32(max(self.step, 1))
            sums += np.minimum(place, known + REFRESH)
            self.sums[k:k + SOME] = sums
        self.sums = self.sums.ravel()
        self.high_sums, self.low_sums = self._byte_sums(self.high_counts), self._byte_sums(self.low_counts)

    def _byte_sums(self, counts: np.ndarray) -> np.ndarray:
        """Cumulative frequencies out of 4096; each value keeps one at least."""
        out, counts = np.empty((self.n, 257), np.int32), counts.reshape(self.n, 256)
        for k in range(0, self.n, SOME):
            sums = out[k:k + SOME]
            sums[:, 0] = 0
            np.cumsum(counts[k:k + SOME], axis=1, out=sums[:, 1:])
            # at most 256 + 24 * BLOCK in all, so that the product fits
            total = sums[:, -1:].copy()
            sums *= np.int32(3840)
            sums //= total
            sums += np.arange(257, dtype=np.int32)
        return out.ravel()

    def predict(self) -> None:
        """This step's single predictions and the weights of all models, out of 4096."""
        if self.step % REFRESH == 0:
            self._refresh()
        self.at1 = self.row + self.last
        self.at2 = self.row + (self.last * 40503 + self.before * 10007 >> 2 & BLOCK - 1)
        two, one = self.after2.take(self.at2), self.after1.take(self.at1)
        predicted, run = self.predicted, self.run
        np.right_shift(two, 2, out=predicted[0])
        np.right_shift(one, 14, out=predicted[1])
        np.bitwise_and(one >> 2, 4095, out=predicted[2])
        np.bitwise_and(two, 3, out=run[0])
        np.bitwise_and(one, 3, out=run[1])
        self.weight_at = self.weight_row + ((run[0] << 2) + run[1])
        self.weight = self.weights.take(self.weight_at)
        self.new = 16 + (self.fresh * 4000 >> 16)
        rest = 4096 - self.new
        self.shares = (self.weight[:3] * (rest - 4) >> 16) + 1
        self.share0 = rest - self._sum(self.shares)

    @staticmethod
    def _sum(rows: np.ndarray) -> np.ndarray:
        return rows[0] + rows[1] + rows[2]

    def _below(self, numbers: np.ndarray) -> np.ndarray:
        """The shares of the single predictions below the numbers."""
        return self._sum(self.shares * (self.predicted <= numbers))

    def intervals(self, numbers: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and size of the ids' intervals out of 2**36, and the lanes whose id is new (has the next number)."""
        at = self.sum_row + numbers
        sums = self.sums.take(at)
        # which single predictions the numbers are, and their order-0 frequencies
        self.hit = self.predicted == numbers + 1
        self.own = self.share0 * (self.sums.take(at + 1) - sums)
        self.hit_share = self.shares * self.hit
        start = ((self._below(numbers).astype(np.int64) << 14) + self.share0 * sums) << 10
        size = ((self._sum(self.hit_share).astype(np.int64) << 14) + self.own) << 10
        new = np.flatnonzero(numbers == self.known)
        if len(new):
            some, row = ids[new], self.byte_row[new]
            high, low = row + (some >> 8), row + (some & 255)
            self._in_full(start, size, new, self.high_sums[high], self.high_sums[high + 1], self.low_sums[low], self.low_sums[low + 1])
        return start, size, new

    def _in_full(self, start, size, new, high, high_next, low, low_next) -> None:
        share, wide = self.new[new].astype(np.int64), (high_next - high).astype(np.int64)
        start[new] = (4096 - share << 24) + share * ((high.astype(np.int64) << 12) + wide * low)
        size[new] = share * wide * (low_next - low)

    @staticmethod
    def _found(sums: np.ndarray, row: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The last entry of each row that isn't above the value."""
        at, step = row, 128
        while step:
            at = at + step * (sums.take(at + step) <= value)
            step >>= 1
        return at

    def _number(self, value: np.ndarray) -> np.ndarray:
        """The last numbers whose intervals don't begin above the values.

        A prediction is below the number if its own interval ends at or below the value. Without the shares of those, the
        order-0 intervals alone lead to the number, which is not above any other prediction.
        """
        predicted, shares, units = self.predicted, self.shares, value >> 10
        below = np.stack([self._below(p) for p in predicted])
        # a prediction is its number plus one, where the number's interval ends
        ended = (below.astype(np.int64) << 14) + self.share0 * self.sums.take(self.sum_row + predicted) <= units
        most = np.minimum.reduce(predicted + ended * np.int32(NUMBERS)) - 1
        rest = units - (self._sum(shares * ended).astype(np.int64) << 14)
        rest = self._quotient(rest, self.share0)
        at, last, step = self.sum_row, self.sum_row + self.highest, 1 << max(self.highest.bit_length() - 1, 0)
        while step:
            higher = np.minimum(at + step, last)
            at = at + (higher - at) * (self.sums.take(higher) <= rest)
            step >>= 1
        return np.maximum(np.minimum((at - self.sum_row).astype(np.int32), most), 0)

    def decode(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The numbers whose intervals hold the values; start, size, lanes with a new id, and those ids."""
        numbers = self._number(value)
        new = np.flatnonzero(value >> 24 >= 4096 - self.new)
        numbers[new] = self.known[new]
        ids = np.zeros(self.n, np.int32)
        if len(new):
            share, row = self.new[new], self.byte_row[new]
            rest = (value[new] - (4096 - share.astype(np.int64) << 24)) // share
            at = self._found(self.high_sums, row, (rest >> 12).astype(np.int32))
            high, high_next = self.high_sums[at], self.high_sums[at + 1]
            inner = ((rest - (high.astype(np.int64) << 12)) // (high_next - high)).astype(np.int32)
            at_low = self._found(self.low_sums, row, inner)
            ids[new] = (at - row) << 8 | at_low - row
        start, size, _ = self.intervals(numbers, ids)
        return numbers, start, size, new, ids[new]

    @staticmethod
    def _quotient(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """a // b in doubles, which divide faster: exact for 0 <= a < 2**45 and 0 < b < 2**27, as a quotient below a whole number
        is below it by 1/b or more, and is rounded by less."""
        return (a / b).astype(np.int32)

    def update(self, numbers: np.ndarray, new: np.ndarray, new_ids: np.ndarray) -> None:
        """Learn the coded numbers; ``new`` are the lanes whose number is a new one, with ``new_ids``."""
        parts = np.empty((4, self.n))
        np.multiply(self.hit_share, 1 << 30, out=parts[:3], dtype=float)
        np.multiply(self.own, 1 << 16, out=parts[3], dtype=float)
        change = self._quotient(parts, (self._sum(parts) + parts[3]) / 65536) - self.weight >> 4
        change[:, new] = 0
        self.weights[self.weight_at] = self.weight + change
        given = np.zeros(self.n, np.int32)
        given[new] = 65535
        self.fresh += given - self.fresh >> 5
        self.counts[self.count_row + numbers] += 1
        self.known[new] += 1
        self.high_counts[(new << 8) + (new_ids >> 8)] += 24
        self.low_counts[(new << 8) + (new_ids & 255)] += 24
        # orders 2 and 1: one prediction each, which stays after a failure if it has held often
        hit, number = self.hit[:2], numbers + 1
        keep = (self.run > 1) & ~hit
        two, one = number + (self.predicted[:2] - number) * keep
        held2, held1 = _HELD_NEXT.take(self.run + (hit << 2))
        # order 1's other prediction: the first one's when that has failed and goes
        other = np.where(hit[1], self.predicted[2], np.where(keep[1], number, self.predicted[1]))
        self.after2[self.at2] = (two << 2) + held2
        self.after1[self.at1] = (one << 14) + (other << 2) + held1
        self.before, self.last = self.last, numbers
        self.step += 1


def numbered(table: np.ndarray) -> np.ndarray:
    """The ids of each row by the order of their first occurrence in it."""
    order = np.argsort(table, axis=1, kind="stable")
    ids = np.take_along_axis(table, order, 1)
    fresh = np.ones(table.shape, bool)
    fresh[:, 1:] = ids[:, 1:] != ids[:, :-1]
    head = np.maximum.accumulate(np.where(fresh, np.arange(table.shape[1]), 0), axis=1)
    first = np.take_along_axis(order, head, 1)  # the place where the id occurs first
    at_first = np.zeros(table.shape, bool)
    np.put_along_axis(at_first, order, fresh, 1)
    number = np.cumsum(at_first, axis=1) - 1
    out = np.empty(table.shape, np.int64)
    np.put_along_axis(out, order, np.take_along_axis(number, first, 1), 1)
    return out


#: The three choices share 36 bits.
_SHIFT = U(36)
_LOW_MASK = U((1 << 48) - 1)


def encode(ids: np.ndarray) -> list[bytes]:
    """Code blocks of ``BLOCK`` ids (the last may be shorter), each to bytes of its own."""
    out: list[bytes] = []
    blocks = -(-len(ids) // BLOCK)
    for start in range(0, blocks, LANES):
        out.extend(_encode(ids[start * BLOCK:(start + LANES) * BLOCK]))
    return out


def _narrowed(low: np.ndarray, width: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unit = width >> _SHIFT
    return low + unit * start.view(U), unit * size.view(U)


def _full(low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which coders have 16 bits that can leave them, and their low ends and widths (cut where a carry could come)."""
    same = (low ^ low + width) < _TOP
    emit = np.flatnonzero(same | (width < _FLOOR))
    low, width, same = low[emit], width[emit], same[emit]
    cut = np.flatnonzero(~same)
    width[cut] = (U(0) - low[cut]) & _LOW_MASK
    return emit, low, width


def _encode(ids: np.ndarray) -> list[bytes]:
    n = -(-len(ids) // BLOCK)
    padded = np.zeros((n, BLOCK), np.uint16)
    padded.ravel()[:len(ids)] = ids
    numbers, table = np.empty((BLOCK, n), np.int16), np.ascontiguousarray(padded.T)
    for k in range(0, n, SOME):
        numbers[:, k:k + SOME] = numbered(padded[k:k + SOME]).T
    del padded
    steps = min(BLOCK, len(ids))
    model = Lanes(n)
    low, width = np.zeros(n, U), np.full(n, 0xFFFFFFFFFFFFFFFF, U)
    words = np.zeros((steps * 3 + 4, n), np.uint16)  # lanes side by side: they write at about the same place
    count, lane = np.zeros(n, np.int64), np.arange(n)
    with np.errstate(over="ignore"):
        for t in range(steps):
            model.predict()
            now = numbers[t].astype(np.int32)
            start, size, new = model.intervals(now, table[t].astype(np.int32))
            low, width = _narrowed(low, width, start, size)
            going, (emit, l, w) = lane, _full(low, width)
            while len(emit):
                going = going[emit]
                at = count[going]
                words[at, going] = l >> U(48)
                count[going] = at + 1
                l, w = l << U(16), w << U(16)
                low[going], width[going] = l, w
                emit, l, w = _full(l, w)
            model.update(now, new, table[t, new].astype(np.int64))
        for _ in range(4):
            words[count, lane] = (low >> U(48)).astype(np.uint16)
            count += 1
            low <<= U(16)
    # what pads the last block is coded too; its reader stops at the number of ids
    words = words[:count.max()]
    return [words[:c, k].astype("<u2").tobytes() for k, c in enumerate(count.tolist())]


def decode(blocks: list[bytes], n_ids: int) -> np.ndarray:
    """The ids of consecutive blocks, ``n_ids`` in all."""
    out = []
    for start in range(0, len(blocks), LANES):
        some = blocks[start:start + LANES]
        out.append(_decode(some, min(len(some) * BLOCK, n_ids - start * BLOCK)))
    return np.concatenate(out) if out else np.empty(0, np.int32)


def _decode(blocks: list[bytes], n_ids: int) -> np.ndarray:
    n = len(blocks)
    steps = min(BLOCK, n_ids)
    words = np.zeros((n, max(map(len, blocks)) // 2 + 8), np.uint16)
    for k, data in enumerate(blocks):
        words[k, :len(data) // 2] = np.frombuffer(data, "<u2")
    words = np.ascontiguousarray(words.T)
    low, width = np.zeros(n, U), np.full(n, 0xFFFFFFFFFFFFFFFF, U)
    code = np.zeros(n, U)
    for k in range(4):
        code = code << U(16) | words[k]
    count, lane = np.full(n, 4), np.arange(n)
    model, table = Lanes(n), np.zeros((BLOCK, n), np.uint16)
    row, names = lane * NUMBERS, np.zeros(n * NUMBERS, np.uint16)  # the id of each number
    with np.errstate(over="ignore"):
        for t in range(steps):
            model.predict()
            value = np.minimum((code - low) // (width >> _SHIFT), U((1 << 36) - 1)).view(np.int64)
            numbers, start, size, new, new_ids = model.decode(value)
            low, width = _narrowed(low, width, start, size)
            going, (emit, l, w) = lane, _full(low, width)
            while len(emit):
                going = going[emit]
                at = count[going]
                code[going] = code[going] << U(16) | words[at, going]
                count[going] = at + 1
                l, w = l << U(16), w << U(16)
                low[going], width[going] = l, w
                emit, l, w = _full(l, w)
            at = row + numbers
            names[at[new]] = new_ids
            table[t] = names.take(at)
            model.update(numbers, new, new_ids)
    return table.T.astype(np.int32).ravel()[:n_ids]


def checksum(data: bytes) -> int:
    return zlib.crc32(data)
