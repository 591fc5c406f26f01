"""Members that meet in lists, with every list sent once to each block its members are dealt to.

Members are numbered, and a number's remainder is its block. A list travels as
the gaps between its sorted numbers, some two bytes a member, so what is
shuffled is lists and never pairs: a list of n members goes to min(n, blocks)
blocks. Pairs exist only inside a task, ``PIECE`` of them at a time.

There are as few blocks as keep all cores busy and ``BLOCK_MEMBERS`` numbers in
a block's lists. One list is always whole in a task, at 4 bytes a member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logassay.functions.packing import pack, unpack
from logassay.sources.workers import map_arrow

BLOCK_MEMBERS = 1 << 25
PIECE = 1 << 20
FLUSH = 1 << 18
LOW = 40  # bits of a number in a pair's key
PACKED = "block long, names binary, sizes binary, gaps binary"


def block_count(pairs: DataFrame, group: str, members: int, limit: int) -> int:
    """Blocks such that about ``limit`` numbers meet in one; sizes differ in at most sqrt(2 * rows) ways."""
    sizes = pairs.groupBy(group).agg(F.count(F.lit(1)).alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("lists"))
    rows = sizes.collect()
    n = np.array([r.n for r in rows], dtype=np.float64)
    lists = np.array([r.lists for r in rows], dtype=np.float64)
    blocks = 2 * pairs.sparkSession.sparkContext.defaultParallelism
    while blocks < members and (lists * n * (1 - (1 - 1 / blocks) ** n)).sum() > limit:
        blocks *= 2
    return blocks


def spread(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions begin, begin + 1, ... of all stretches one after the other."""
    before = np.cumsum(length) - length
    return np.repeat(begin - before, length) + np.arange(int(length.sum()))


def packed_lists(rows: DataFrame, blocks: int, tails: bool = False, flush: int = FLUSH) -> DataFrame:
    """Rows (g, m, partitioned by g, sorted by g and m) as lists for each block.

    With ``tails`` a block gets a list from its own first member on, which is
    enough for pairs with a larger number. ``names`` holds g where it is a long.
    """
    named = rows.schema["g"].dataType.simpleString() == "bigint"

    def dealt(names: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> Iterator[pa.RecordBatch]:
        first = np.cumsum(sizes) - sizes
        of = np.repeat(np.arange(len(sizes)), sizes)
        pairs, at = np.unique(of * blocks + codes % blocks, return_index=True)
        of, block = np.divmod(pairs, blocks)
        begin = at if tails else first[of]
        length = first[of] + sizes[of] - begin
        order = np.argsort(block, kind="stable")
        order = order[length[order] > 1]  # one member meets nobody
        of, block, begin, length = of[order], block[order], begin[order], length[order]
        cum = np.cumsum(length)
        s = 0
        while s < len(block):
            e = max(s + 1, int(np.searchsorted(cum, cum[s] - length[s] + PIECE, side="right")))
            own = codes[spread(begin[s:e], length[s:e])]
            gaps = np.diff(own, prepend=0)
            starts = cum[s:e] - length[s:e] - (cum[s] - length[s])
            gaps[starts] = own[starts]
            edges = np.flatnonzero(np.diff(block[s:e], prepend=-1, append=-1))
            cells = [(i, j, starts[i], starts[j - 1] + length[s + j - 1]) for i, j in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(block[s + i]) for i, _, _, _ in cells], pa.int64()),
                    pa.array([pack(names[of[s + i : s + j]]) if named else None for i, j, _, _ in cells], pa.binary()),
                    pa.array([pack(length[s + i : s + j]) for i, j, _, _ in cells], pa.binary()),
                    pa.array([pack(gaps[x:y]) for _, _, x, y in cells], pa.binary()),
                ],
                names=["block", "names", "sizes", "gaps"],
            )
            s = e

    def joined(held: list) -> tuple[pa.Array, np.ndarray, list[int]]:
        """The rows so far, and where a list follows another one."""
        groups, codes = pa.concat_arrays([x for x, _ in held]), np.concatenate([x for _, x in held])
        places = groups.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        return groups, codes, (np.flatnonzero(np.diff(places)) + 1).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append((batch.column("g"), batch.column("m").to_numpy()))
                count += batch.num_rows
            if count >= flush:
                groups, codes, cuts = joined(held)
                if cuts:
                    # The last list may go on in the next batch.
                    yield from lists(groups[: cuts[-1]], codes[: cuts[-1]], cuts[:-1])
                    groups, codes = groups[cuts[-1] :], codes[cuts[-1] :]
                held, count = [(groups, codes)], 0
        if held:
            yield from lists(*joined(held))

    def lists(groups: pa.Array, codes: np.ndarray, cuts: list[int]) -> Iterator[pa.RecordBatch]:
        first = np.array([0, *cuts], dtype=np.int64)
        names = groups.take(pa.array(first)).to_numpy() if named else first
        sizes = np.diff(first, append=len(codes))
        yield from dealt(names, sizes, codes)

    return map_arrow(rows, PACKED, run)


class Lists:
    """The lists of one block."""

    def __init__(self, table: pa.Table):
        self.block = table.column("block")[0].as_py()
        self.sizes = np.concatenate([unpack(raw.as_py()).astype(np.int64) for raw in table.column("sizes")])
        self.first = np.cumsum(self.sizes) - self.sizes
        self.codes = np.empty(int(self.sizes.sum()), dtype=np.int32)
        self.names = None
        if table.column("names").null_count == 0:
            self.names = np.concatenate([unpack(raw.as_py()) for raw in table.column("names")]).astype(np.int64)
        list_at = at = 0
        for raw in table.column("gaps"):
            gaps = unpack(raw.as_py()).astype(np.int64)
            list_end = int(np.searchsorted(self.first, at + len(gaps)))
            first = self.first[list_at:list_end] - at
            total = np.cumsum(gaps)
            total -= np.repeat(total[first] - gaps[first], self.sizes[list_at:list_end])
            if total.max() >= 2**31 and self.codes.dtype != np.int64:
                self.codes = self.codes.astype(np.int64)
            self.codes[at : at + len(gaps)] = total
            list_at, at = list_end, at + len(gaps)

    def members(self, blocks: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the block's own members stand, sorted by member, and in which list."""
        step = PIECE
        at = np.concatenate([
            s + np.flatnonzero(self.codes[s : s + step] % blocks == self.block)
            for s in range(0, len(self.codes), step)
        ])
        at = at[np.argsort(self.codes[at], kind="stable")]
        return at, np.searchsorted(self.first, at, side="right") - 1

    def hold(self, of: np.ndarray, member: np.ndarray) -> np.ndarray:
        """Whether each list holds the member beside it: binary search in all of them at once."""
        low, high = self.first[of], self.first[of] + self.sizes[of]
        for _ in range(int(self.sizes[of].max(initial=0)).bit_length()):
            middle = (low + high) >> 1
            less = (self.codes[np.minimum(middle, len(self.codes) - 1)] < member) & (low < high)
            low, high = np.where(less, middle + 1, low), np.where(less, high, middle)
        end = self.first[of] + self.sizes[of]
        return (low < end) & (self.codes[np.minimum(low, end - 1)] == member)


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a run of equal keys begins, and its length."""
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return starts, np.diff(starts, append=len(keys))


def counted(lists: Lists, blocks: int, piece: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """a, b, lists both stand in: for the block's members, sorted by a and b, each a whole in one yield."""
    at, of = lists.members(blocks)
    a = lists.codes[at].astype(np.int64)
    cum = np.cumsum(lists.sizes[of])
    held = None
    s = 0
    while s < len(a):
        e = max(s + 1, int(np.searchsorted(cum, cum[s] - lists.sizes[of[s]] + piece, side="right")))
        length = lists.sizes[of[s:e]]
        own, rank = np.unique(a[s:e], return_inverse=True)
        b = lists.codes[spread(lists.first[of[s:e]], length)].astype(np.int64)
        keys = np.repeat(rank << LOW, length) | b
        keys = keys[np.repeat(a[s:e], length) != b]
        keys.sort()
        starts, n = runs(keys)
        keys = keys[starts]
        x, y = own[keys >> LOW], keys & ((1 << LOW) - 1)
        if held is not None:
            # A member with more than a piece of pairs goes on.
            same = x == held[0][0]
            y0, back = np.unique(np.concatenate((held[1], y[same])), return_inverse=True)
            n0 = np.bincount(back, weights=np.concatenate((held[2], n[same]))).astype(np.int64)
            x = np.concatenate((np.full(len(y0), held[0][0]), x[~same]))
            y, n = np.concatenate((y0, y[~same])), np.concatenate((n0, n[~same]))
            held = None
        if e < len(a) and a[e] == a[e - 1]:
            last = x == a[e - 1]
            if last.any():
                held = x[last], y[last], n[last]
            x, y, n = x[~last], y[~last], n[~last]
        if len(x):
            yield x, y, n
        s = e


def similar(
    lists: Lists, blocks: int, shared: int, piece: int = PIECE
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """a, b, lists in common, and those lists' names pair by pair, sorted: for the block's members a < b.

    ``lists`` are tails. Two members of ``shared`` common lists have one among
    all but the ``shared`` - 1 lists of a with the largest names, so only the
    others are run through; whether b stands in the rest is looked up.
    """
    at, of = lists.members(blocks)
    order = np.lexsort((lists.names[of], lists.codes[at]))
    at, of = at[order], of[order]
    starts, n = runs(lists.codes[at])
    known = np.repeat(n >= shared, n)
    at, of = at[known], of[known]
    starts, n = runs(lists.codes[at])
    left = np.repeat(starts + n, n) - np.arange(len(at))  # entries of the member from here on
    tail = np.where(left >= shared, lists.first[of] + lists.sizes[of] - at - 1, 0)
    before = np.concatenate(([0], np.cumsum(tail)))
    of_member = before[np.append(starts, len(at))]
    m = 0
    while m < len(starts):
        end = max(m + 1, int(np.searchsorted(of_member, of_member[m] + piece, side="right")) - 1)
        # A member with more than a piece of pairs comes in parts, by its partner's remainder.
        parts = max(1, -int(-(of_member[m + 1] - of_member[m]) // piece)) if end == m + 1 else 1
        for part in range(parts):
            got = _similar(lists, at, of, tail, before, starts, n, m, end, shared, parts, part, piece)
            if got is not None:
                yield got
        m = end


def _similar(lists, at, of, tail, before, starts, n, m, end, shared, parts, part, piece):
    """``similar`` for the members m to end, or one part of the partners of a single member."""
    s, last = int(starts[m]), int(starts[end - 1] + n[end - 1])
    owner = np.repeat(np.arange(end - m), n[m:end])
    keys, where = [], []
    while s < last:
        e = min(last, max(s + 1, int(np.searchsorted(before, before[s] + piece, side="right")) - 1))
        b = lists.codes[spread(at[s:e] + 1, tail[s:e])].astype(np.int64)
        own = np.repeat(owner[s - starts[m] : e - starts[m]], tail[s:e]).astype(np.int64)
        lst = np.repeat(of[s:e], tail[s:e])
        if parts > 1:
            kept = b % parts == part
            b, own, lst = b[kept], own[kept], lst[kept]
        keys.append(own << LOW | b)
        where.append(lst)
        s = e
    keys, where = np.concatenate(keys), np.concatenate(where)
    order = np.argsort(keys)
    keys, where = keys[order], where[order]
    first, count = runs(keys)
    own, b = keys[first] >> LOW, keys[first] & ((1 << LOW) - 1)
    # The lists that were left out, from the largest name down.
    hits = []
    for k in range(1, shared):
        hub = of[starts[m:end] + n[m:end] - k][own]
        hits.append((hub, lists.hold(hub, b)))
    total = count + sum((hit.astype(np.int64) for _, hit in hits), np.zeros(len(count), np.int64))
    good = total >= shared
    if not good.any():
        return None
    pair = np.cumsum(good) - 1
    inside = np.repeat(good, count)
    pairs = [np.repeat(pair, count)[inside], *[pair[good & hit] for _, hit in hits]]
    names = [lists.names[where[inside]], *[lists.names[hub[good & hit]] for hub, hit in hits]]
    pairs, names = np.concatenate(pairs), np.concatenate(names)
    order = np.lexsort((names, pairs))
    a = lists.codes[at[starts[m:end]]].astype(np.int64)
    return a[own[good]], b[good], total[good], names[order]
