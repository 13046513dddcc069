"""An adaptive context-mixing range coder for token ids, all blocks of a segment side by side.

A block's next id is predicted by the id that last followed the same two ids (order 2), the id that last followed
the same one (order 1), and the counts of the block's ids so far (order 0, counted anew at the block's EPOCHS). The
weights of the three adapt to how often each was right in the same situation. The order that is taken and the id's place in
the counts are one interval, so an id is one step; an id that the block has not
counted yet is then coded as one of the segment's ids. Each block starts from nothing and has a checksum of its own, so
any block can be read by itself. Blocks are lanes of numpy arrays: one step codes one id of every block. A writer knows
all ids, so it works out the intervals for whole blocks first, and only narrows them step by step.

A segment: magic, version, sizes, the ids that occur (rising), doc ids and lengths, a table of blocks
(ids, words, crc32 of the ids as little-endian 32-bit numbers), the blocks' 32-bit words.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 2048
EPOCHS = (64, 256, 1024)
SLOTS = 2048
MOST_BLOCK = (1 << 16) - 1  # ids of a block: its place in the head, and an interval's total stays below 2^32
GROUP = 1 << 15  # ids whose intervals are worked out together
VERSION = 2
MAGIC = b"TIDR"
HEAD = struct.Struct("<4sHHIIII")  # magic, version, block size, ids, different ids, documents, blocks
TOP, WORD, ONE = np.uint64(1 << 32), np.uint64(32), np.uint64(1)
MASK = np.uint64((1 << 32) - 1)
# weights of a situation, 21 bits each (order 2, order 1, order 0): all one at first, and what each choice adds
FIELD, FIELDS = np.uint64((1 << 21) - 1), (np.uint64(21), np.uint64(42))
EVEN, STEPS = np.uint64(1 | 1 << 21 | 1 << 42), np.array([2, 2 << 21, 2 << 42], np.uint64)


class Order0:
    """Counts of each lane's ids so far, as intervals: a lane's ids in order, so that a place in them tells the id."""

    def __init__(self, seen: np.ndarray):
        """``seen``: ids so far, a row for each lane."""
        lanes, self.steps = seen.shape
        rows = np.sort(seen, axis=1)
        head = np.ones(rows.shape, bool)
        head[:, 1:] = rows[:, 1:] != rows[:, :-1]
        self.first = np.flatnonzero(head)
        self.count = np.diff(np.append(self.first, rows.size))
        self.rows = rows.reshape(-1)
        self.escape = head.sum(axis=1) + 1 if self.steps else np.ones(lanes, np.int64)
        self.total = (self.escape + self.steps).astype(np.uint64)

    def intervals(self, ids: np.ndarray, lane: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, width, known) of ids; unknown ones get the escape interval. Fast where ``lane`` rises."""
        if not self.steps:
            return np.zeros(len(ids), np.int64), np.ones(len(ids), np.int64), np.zeros(len(ids), bool)
        keys = (self.first // self.steps) << 32 | self.rows[self.first]
        key = lane << 32 | ids
        i = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        known = keys[i] == key
        return np.where(known, self.first[i] % self.steps, self.steps), np.where(known, self.count[i], self.escape[lane]), known

    def cells(self) -> np.ndarray:
        """For each place of each lane's counts: id, start (16 bits), width (16 bits)."""
        own = self.rows[self.first] << 32 | (self.first % max(self.steps, 1)) << 16 | self.count
        return np.repeat(own.astype(np.uint64), self.count)


def _rows(ids: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """The blocks as rows, the last one filled up with zeros, and their lengths."""
    lanes = -(-len(ids) // block)
    full = np.zeros(lanes * block, np.int64)
    full[: len(ids)] = ids
    lens = np.full(lanes, block)
    lens[-1] = len(ids) - (lanes - 1) * block
    return full.reshape(lanes, block), lens


def _slot2(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return (one * 40503 + two * 30011 >> 3) & (SLOTS - 1)


def _followed(slot: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For each place of each row the id that last stood at the same slot before, or -1."""
    lanes, block = rows.shape
    bits = (block - 1).bit_length()
    key = np.sort((slot << bits | np.arange(block)).astype(np.uint32), axis=1)  # SLOTS and a block take 27 bits
    at = ((key & np.uint32((1 << bits) - 1)).astype(np.int64) + np.arange(lanes)[:, None] * block).reshape(-1)
    key >>= np.uint32(bits)
    ids = rows.reshape(-1)[at]
    last = np.full(rows.shape, -1, np.int64)
    last[:, 1:] = np.where(key[:, 1:] == key[:, :-1], ids.reshape(rows.shape)[:, :-1], -1)
    out = np.empty(rows.size, np.int64)
    out[at] = last.reshape(-1)
    return out.reshape(rows.shape)


def _intervals(rows: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, width, total, new) of each id of each row; a new one is coded as one of the segment's ids after that."""
    one, two = np.zeros_like(rows), np.zeros_like(rows)
    one[:, 1:], two[:, 2:] = rows[:, :-1], rows[:, :-2]
    c1, c2 = _followed(one & (SLOTS - 1), rows), _followed(_slot2(one, two), rows)
    have2 = c2 >= 0
    case = (c1 >= 0) + 2 * have2 + ((c1 == c2) & have2)
    hit2 = rows == c2
    hit1 = (rows == c1) & ~hit2
    step = STEPS.take(2 - 2 * hit2 - hit1)
    taken = np.full(rows.shape, EVEN)
    for k in range(5):
        own = np.where(case == k, step, np.uint64(0))
        taken += np.where(case == k, np.cumsum(own, axis=1) - own, np.uint64(0))
    w2, w1, w0 = _weights(taken)  # of order 2, 1, 0
    start, width, new = np.zeros(rows.shape, np.uint64), np.ones(rows.shape, np.uint64), ~(hit2 | hit1)
    scale = np.ones(rows.shape, np.uint64)
    for begin, end in _epochs(block):
        table = Order0(rows[:, :begin])
        scale[:, begin:end] = table.total[:, None]
        at = np.flatnonzero(new[:, begin:end])
        lane = at // (end - begin)
        at = at - lane * (end - begin) + lane * block + begin
        start.reshape(-1)[at], width.reshape(-1)[at], known = table.intervals(rows.reshape(-1)[at], lane)
        new.reshape(-1)[at] = ~known
    a, b = w2 * scale, (w2 + w1) * scale
    start = np.where(hit2, np.uint64(0), np.where(hit1, a, b + w0 * start))
    width = np.where(hit2, a, np.where(hit1, b - a, w0 * width))
    return start, width, b + w0 * scale, new


def _weights(taken: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights of order 2, 1, 0: twice the times that each was taken, and one."""
    return taken & FIELD, taken >> FIELDS[0] & FIELD, taken >> FIELDS[1]


def digits(kinds: int) -> list[tuple[int, int]]:
    """(shift, number of values) of the symbols that a new id takes: one up to 2^16 different ids, else two."""
    return [(0, kinds)] if kinds <= 1 << 16 else [(16, (kinds - 1 >> 16) + 1), (0, 1 << 16)]


def _epochs(block: int) -> list[tuple[int, int]]:
    cuts = [0, *(e for e in EPOCHS if e < block), block]
    return list(zip(cuts, cuts[1:]))


def settle(lo: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lanes whose interval [lo, lo + w) has settled its upper 32 bits or grew narrow, the width that they go on with).
    A narrow interval (at most 2^32; a total is below that) across a border is cut at it. A settled one of exactly 2^32 goes on
    as one less: it would be 0 when shifted."""
    k = np.flatnonzero(w <= TOP)  # a wider one can't be settled
    a, v = lo[k], w[k]
    return k, np.where((a ^ (a + (v - ONE))) < TOP, np.minimum(v, MASK), (~a + ONE) & MASK)


def encode_blocks(ids: np.ndarray, kinds: int, block: int = BLOCK) -> list[np.ndarray]:
    """The 32-bit words of each block; ``ids`` are below ``kinds`` (at most 2^31)."""
    if not len(ids):
        return []
    rows, lens = _rows(ids, block)
    lanes = len(lens)
    start, freq, total = (np.empty((block, lanes), np.uint32) for _ in range(3))
    fresh = np.empty((block, lanes), bool)
    many = max(1, GROUP // block)
    for i in range(0, lanes, many):
        start[:, i:i + many], freq[:, i:i + many], total[:, i:i + many], fresh[:, i:i + many] = (x.T for x in _intervals(rows[i:i + many], block))
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, ~np.uint64(0))
    out, used = np.zeros((lanes, 3 * block + 4), np.uint32), np.zeros(lanes, np.int64)  # at most three symbols an id, a word each

    def put(lane, start, freq, total):
        r = width[lane] // total
        lo, w = low[lane] + start * r, freq * r
        k, b = settle(lo, w)
        if len(k):
            at = k if isinstance(lane, slice) else lane[k]
            a = lo[k]
            out[at, used[at]] = (a >> WORD).astype(np.uint32)
            used[at] += 1
            lo[k], w[k] = a << WORD, b << WORD
        low[lane], width[lane] = lo, w

    for t in range(block):
        n = lanes if lens[-1] > t else lanes - 1  # the last lane may be shorter
        if not n:
            break
        put(slice(0, n), *(x[t, :n].astype(np.uint64) for x in (start, freq, total)))
        new = np.flatnonzero(fresh[t, :n])
        for shift, values in digits(kinds) if len(new) else ():
            put(new, (rows[new, t] >> shift & 0xFFFF).astype(np.uint64), ONE, np.uint64(values))
    lane_ids = np.arange(lanes)
    out[lane_ids, used] = (low >> WORD).astype(np.uint32)
    out[lane_ids, used + 1] = (low & MASK).astype(np.uint32)
    return [out[i, : used[i] + 2] for i in range(lanes)]


def decode_blocks(blocks: list[np.ndarray], lens: np.ndarray, kinds: int, block: int = BLOCK) -> np.ndarray:
    """The ids of the blocks one after the other. All blocks but the last given one must be of one length."""
    if not blocks:
        return np.zeros(0, np.int64)
    lanes = len(blocks)
    width_ = max(map(len, blocks)) + 3
    words = np.zeros((lanes, width_), np.uint32)
    for i, b in enumerate(blocks):
        words[i, : len(b)] = b
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, ~np.uint64(0))
    code, used = words[:, 0].astype(np.uint64) << WORD | words[:, 1], np.full(lanes, 2)
    words, first = words.reshape(-1), np.arange(lanes) * width_
    grid = np.zeros((block, lanes), np.int64)
    bases, cases = np.arange(lanes, dtype=np.int64) * SLOTS, np.arange(lanes, dtype=np.int64) * 5
    follow1, follow2 = np.full(lanes * SLOTS, -1, np.int32), np.full(lanes * SLOTS, -1, np.int32)
    taken = np.full(lanes * 5, EVEN)

    def take(lane, r, start, freq):
        lo, w = low[lane] + start * r, freq * r
        k, b = settle(lo, w)
        if len(k):
            at = k if isinstance(lane, slice) else lane[k]
            a = lo[k]
            code[at] = code[at] << WORD | words[first[at] + np.minimum(used[at], width_ - 1)]
            used[at] += 1
            lo[k], w[k] = a << WORD, b << WORD
        low[lane], width[lane] = lo, w

    zero = np.zeros(lanes, np.int64)
    last = int(lens[-1])
    for begin, end in _epochs(block):
        table = Order0(grid[:begin].T)
        cells, steps = table.cells(), table.steps
        escape = table.escape.astype(np.uint64)
        for t in range(begin, end):
            n = lanes if last > t else lanes - 1
            if not n:
                break
            one, two = grid[t - 1, :n] if t else zero[:n], grid[t - 2, :n] if t > 1 else zero[:n]
            slot1, slot2 = bases[:n] + (one & (SLOTS - 1)), bases[:n] + _slot2(one, two)
            c1, c2 = follow1.take(slot1), follow2.take(slot2)
            have2 = c2 >= 0
            case = cases[:n] + ((c1 >= 0).view(np.int8) + (have2.view(np.int8) << 1) + ((c1 == c2) & have2).view(np.int8))
            before = taken.take(case)
            w2, w1, w0 = _weights(before)
            scale = table.total[:n]
            a, b = w2 * scale, (w2 + w1) * scale
            total = b + w0 * scale
            r = width[:n] // total
            goal = np.minimum((code[:n] - low[:n]) // r, total - ONE)
            known2, miss = goal < a, goal >= b
            start, freq = a * ~known2, np.where(known2, a, b - a)
            x = np.where(known2, c2, c1)
            missed = np.flatnonzero(miss)
            place = (goal[missed] - b[missed]) // w0[missed]
            known = place < np.uint64(steps)
            new = missed[~known]
            if len(new):
                start[new] = b[new] + w0[new] * np.uint64(steps)
                freq[new] = w0[new] * escape[new]
                x[new] = 0
                missed, place = missed[known], place[known]
            if len(missed):
                cell = cells.take(missed * steps + place.astype(np.int64))
                x[missed] = cell >> WORD
                start[missed] = b[missed] + w0[missed] * (cell >> np.uint64(16) & np.uint64(0xFFFF))
                freq[missed] = w0[missed] * (cell & np.uint64(0xFFFF))
            take(slice(0, n), r, start, freq)
            for shift, values in digits(kinds) if len(new) else ():
                r = width[new] // np.uint64(values)
                goal = np.minimum((code[new] - low[new]) // r, np.uint64(values - 1))
                take(new, r, goal, ONE)
                x[new] |= goal.astype(np.int32) << shift
            grid[t, :n] = x
            follow1[slot1] = x
            follow2[slot2] = x
            taken[case] = before + STEPS.take((~known2).view(np.int8) + miss.view(np.int8))
    return np.concatenate([grid[: lens[i], i] for i in range(lanes)])


def write_segment(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, block: int = BLOCK) -> bytes:
    """One segment: whole documents one after the other."""
    if not 0 < block <= MOST_BLOCK:
        raise ValueError(f"a block holds 1 to {MOST_BLOCK} ids")
    ids = np.asarray(ids, np.int64)
    kinds = np.flatnonzero(np.bincount(ids)) if len(ids) else ids
    place = np.zeros(int(kinds[-1]) + 1 if len(kinds) else 1, np.int64)
    place[kinds] = np.arange(len(kinds))
    dense = place[ids]
    blocks = encode_blocks(dense, max(1, len(kinds)), block)
    raw = ids.astype("<u4")
    table = np.array([(min(block, len(ids) - i * block), len(b), zlib.crc32(raw[i * block:(i + 1) * block].tobytes())) for i, b in enumerate(blocks)], "<u4")
    known = np.array([d is not None for d in doc_ids], bool)
    return b"".join([
        HEAD.pack(MAGIC, VERSION, block, len(ids), len(kinds), len(lengths), len(blocks)), kinds.astype("<u4").tobytes(),
        np.array([d if d is not None else 0 for d in doc_ids], "<i8").tobytes(), np.packbits(known).tobytes(),
        np.asarray(lengths).astype("<u4").tobytes(), table.tobytes(), *(b.astype("<u4").tobytes() for b in blocks)])


def read_segment(data: bytes, only: list[int] | None = None) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc ids, lengths, ids) of a segment, or with ``only`` the ids of these blocks (rising numbers). A block whose
    checksum does not match raises ValueError."""
    magic, version, block, n_ids, n_kinds, n_docs, n_blocks = HEAD.unpack_from(data)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a token segment")
    at = HEAD.size

    def read(kind, n):
        nonlocal at
        out = np.frombuffer(data, kind, n, at)
        at += out.nbytes
        return out

    kinds, docs, bits = read("<u4", n_kinds), read("<i8", n_docs), read("u1", -(-n_docs // 8))
    known = np.unpackbits(bits, count=n_docs).astype(bool) if n_docs else np.zeros(0, bool)
    lengths, table = read("<u4", n_docs).astype(np.int64), read("<u4", 3 * n_blocks).reshape(-1, 3)
    words = [read("<u4", int(n)) for n in table[:, 1]]
    chosen = list(range(n_blocks)) if only is None else only
    if chosen:
        dense = decode_blocks([words[i] for i in chosen], table[chosen, 0].astype(np.int64), max(1, n_kinds), block)
    else:
        dense = np.zeros(0, np.int64)
    if dense.size and dense.max() >= n_kinds:
        raise ValueError("a block holds an id that the segment lacks")
    ids = kinds[dense] if n_kinds else np.zeros(0, "<u4")
    place = 0
    for i in chosen:
        n = int(table[i, 0])
        if zlib.crc32(ids[place:place + n].astype("<u4").tobytes()) != table[i, 2]:
            raise ValueError(f"checksum of block {i} does not match")
        place += n
    return [d if k else None for d, k in zip(docs.tolist(), known.tolist())], lengths, ids
