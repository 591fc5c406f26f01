"""Members that meet in lists: what is sent, and the counts inside a task, against plain versions."""

from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from logassay.functions.packing import pack, unpack
from logassay.operators import meetings, neighbours
from logassay.roles import Roles

BLOCKS = 3


def made_lists():
    """Lists by name: random ones, two that hold every member, one of a single member."""
    r = np.random.default_rng(11)
    lists = {int(n): sorted(set(r.integers(1, 40, int(r.integers(1, 12))).tolist())) for n in r.permutation(60) + 1}
    return {**lists, 100: list(range(1, 40)), 101: list(range(1, 40)), 102: [7]}


def table(block, tails):
    names, sizes, gaps = [], [], []
    for name, codes in made_lists().items():
        own = [c for c in codes if c % BLOCKS == block]
        sent = [c for c in codes if not tails or own and c >= own[0]]
        if own and len(sent) > 1:
            names.append(name)
            sizes.append(len(sent))
            gaps += np.diff(sent, prepend=0).tolist()
    cells = {"names": names, "sizes": sizes, "gaps": gaps}
    return pa.table({"block": [block], **{k: [pack(np.array(v))] for k, v in cells.items()}})


@pytest.mark.parametrize("piece", [1, 50, 1 << 20])
def test_counts_in_pieces(piece):
    want = Counter()
    for codes in made_lists().values():
        want.update((a, b) for a in codes for b in codes if a != b)
    got, whole = {}, []
    for block in range(BLOCKS):
        for a, b, n in meetings.counted(meetings.Lists(table(block, False)), BLOCKS, piece):
            whole += np.unique(a).tolist()
            got.update(zip(zip(a.tolist(), b.tolist(), strict=True), n.tolist(), strict=True))
    assert got == want
    assert len(whole) == len(set(whole))  # a member's pairs come at once


@pytest.mark.parametrize("shared", [1, 2, 3, 4])
@pytest.mark.parametrize("piece", [1, 50, 1 << 20])
def test_similar_in_pieces(piece, shared):
    want = defaultdict(list)
    for name, codes in sorted(made_lists().items()):
        for pair in combinations(codes, 2):
            want[pair].append(name)
    got = {}
    for block in range(BLOCKS):
        for a, b, n, names in meetings.similar(meetings.Lists(table(block, True)), BLOCKS, shared, piece):
            cut = np.split(names, np.cumsum(n)[:-1])
            assert not got.keys() & set(zip(a.tolist(), b.tolist(), strict=True))
            got.update(((int(x), int(y)), own.tolist()) for x, y, own in zip(a, b, cut, strict=True))
    assert got == {pair: names for pair, names in want.items() if len(names) >= shared}


@pytest.mark.parametrize("tails", [False, True])
def test_a_list_is_sent_once_to_each_of_its_blocks(spark, tails):
    lists = made_lists()
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        rows = spark.createDataFrame([(n, c) for n, codes in lists.items() for c in codes], "g long, m long")
        rows = rows.repartition(2, "g").sortWithinPartitions("g", "m")
        cells = meetings.packed_lists(rows, BLOCKS, tails, flush=10).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    got = []
    for cell in cells:
        sizes, gaps = unpack(cell.sizes).astype(int), unpack(cell.gaps).astype(int)
        for name, own in zip(unpack(cell.names).tolist(), np.split(gaps, np.cumsum(sizes)[:-1]), strict=True):
            got.append((cell.block, name, np.cumsum(own).tolist()))
    want = []
    for block in range(BLOCKS):
        for name, codes in lists.items():
            own = [c for c in codes if c % BLOCKS == block]
            sent = [c for c in codes if not tails or own and c >= own[0]]
            if own and len(sent) > 1:
                want.append((block, name, sent))
    assert sorted(got) == sorted(want)


def test_pairs_are_no_rows(spark):
    """Neither query deals out pairs of a list's members: that took 60 to 90 times the input on disk."""
    rows = spark.createDataFrame([(u, i) for u in range(20) for i in range(u % 5, 30, 3)], "user_id long, item_id long")
    for query in (neighbours.item_neighbours, neighbours.swing_neighbours):
        assert "Generate" not in query(rows, Roles(), 3)._jdf.queryExecution().executedPlan().toString()


def test_equal_values_of_unequal_counts(spark):
    """1 / sqrt(1 * 1) and 2 / sqrt(2 * 2) tie with ids against the order of counts, and more ties than places."""
    baskets = [(0, 1), (0, 5), (0, 3), (0, 4), (0, 2), (1, 9), (1, 8), (2, 9), (2, 8), (2, 7), (3, 7)]
    rows = spark.createDataFrame(baskets, "user_id long, item_id long")
    got = sorted((r.item_id, r.rank, r.neighbour_item_id) for r in neighbours.item_neighbours(rows, Roles(), 2).collect())
    assert [x for x in got if x[0] == 1] == [(1, 1, 2), (1, 2, 3)]
    assert [x for x in got if x[0] == 5] == [(5, 1, 1), (5, 2, 2)]
    assert [x for x in got if x[0] == 7] == [(7, 1, 8), (7, 2, 9)]
    a, b = np.zeros(4, np.int64), np.arange(4)
    kept = neighbours.nearest(a, b, np.array([1, 1, 1, 2]), np.full(4, 4), np.array([1, 1, 1, 4]), 2)
    assert sorted(kept.tolist()) == [0, 1, 3]  # 1 / sqrt(4 * 1) = 2 / sqrt(4 * 4): the last may have the smallest id
