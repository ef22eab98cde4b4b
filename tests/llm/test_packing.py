import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kamienica.llm import packing

from .fixtures import clashing, frame


def one_by_one(sizes, capacity):
    """Loads and sizes by bin when every unit enters the tightest bin by itself."""
    room, held = [], []
    for size in sorted(sizes, reverse=True):
        fits = [(left, i) for i, left in enumerate(room) if left >= size]
        if not fits:
            room.append(capacity)
            held.append([])
        i = min(fits)[1] if fits else len(room) - 1
        room[i] -= size
        held[i].append(size)
    return held


@given(st.lists(st.integers(1, 100), max_size=80), st.integers(100, 160))
@settings(max_examples=80, deadline=None)
def test_classes_are_packed_like_units_one_by_one(sizes, capacity):
    held = defaultdict(list)
    for size, members, bin_ in packing.best_fit_decreasing(list(Counter(sizes).items()), capacity):
        held[bin_] += [size] * members
    assert [held[i] for i in range(len(held))] == one_by_one(sizes, capacity)


@given(st.lists(st.integers(1, 1000), min_size=1, max_size=80), st.integers(1, 8))
@settings(max_examples=60, deadline=None)
def test_exactly_as_many_bins_as_asked(sizes, bins):
    runs = packing.pack_classes(list(Counter(sizes).items()), bins)
    loads, members = defaultdict(int), Counter()
    for size, n, bin_ in runs:
        loads[bin_] += size * n
        members[size] += n
    assert members == Counter(sizes) and set(loads) <= set(range(bins))
    assert [size for size, *_ in runs] == sorted((size for size, *_ in runs), reverse=True)
    assert max(loads.values()) <= max(max(sizes), sum(sizes) / bins + max(sizes))


@pytest.mark.parametrize("hot", [1, 40, 4096])
def test_every_group_lies_where_its_rank_puts_it(spark, monkeypatch, hot):
    """The shards equal the packing of all groups one by one, those of one size in the order of their digests, whether
    groups are looked up by broadcast or by join."""
    monkeypatch.setattr(packing, "HOT", hot)
    monkeypatch.setattr(packing, "CELL_ROWS", hot)
    docs = [(i, "w" * (1 + i * i % 23) + f" {i % 60}", "en", "a", 1) for i in range(300)]
    groups = defaultdict(int)
    for _, text, *_ in docs:
        groups[text] += len(text) + 1
    order = sorted(groups, key=lambda t: (-groups[t], hashlib.sha256(t.encode()).hexdigest()))
    bins = [bin_ for _, n, bin_ in packing.pack_classes(list(Counter(groups.values()).items()), 5) for _ in range(n)]
    wanted = dict(zip(order, bins))
    got = packing.shard(frame(spark, docs), 5).collect()
    assert len(got) == 300 and all(r["shard"] == wanted[r["text"]] for r in got)
    slots = Counter((r["shard"], r["slot"]) for r in got)
    assert set(slots.values()) == {1}
    assert all((s, n - 1) in slots for s, n in slots if n)


def test_shards_hold_whole_groups_and_gapless_slots(spark):
    rows = packing.shard(frame(spark), 4).collect()
    slots, shards, loads = defaultdict(list), defaultdict(set), defaultdict(int)
    for r in rows:
        raw = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        slots[r["shard"]].append(r["slot"])
        shards[r["text"]].add(r["shard"])
        loads[r["shard"]] += r["size"]
    assert all(len(s) == 1 for s in shards.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(rows) == frame(spark).count()


def test_even_shards_and_a_group_too_large_for_one(spark):
    rows = [(i, f"text {i} " + "x" * (i % 37), "en", "a", 1) for i in range(4000)]
    loads = defaultdict(int)
    for r in packing.shard(frame(spark, rows)).collect():
        loads[r["shard"]] += r["size"]
    assert len(loads) == 16 and max(loads.values()) < 1.05 * min(loads.values())
    loads.clear()
    hot = rows[:1500] + [(9000 + i, "hot text of many copies " * 3, "en", "a", 1) for i in range(1500)]
    shard_of = defaultdict(set)
    for r in packing.shard(frame(spark, hot)).collect():
        loads[r["shard"]] += r["size"]
        shard_of[r["text"]].add(r["shard"])
    big, = shard_of["hot text of many copies " * 3]
    rest = [n for s, n in loads.items() if s != big]
    assert len(rest) == 15 and max(rest) < 1.2 * min(rest)


def test_empty_and_clashing(spark):
    assert packing.shard(frame(spark, [])).collect() == []
    got = packing.shard(clashing(frame(spark), packing.RESULT + ("digest", "bytes", "rows", "sought", "hot", "own", "place", "rank", "cell")))
    plain = packing.shard(frame(spark))
    pick = ["doc_id", "text", "size", "shard", "slot"]
    assert sorted(map(repr, got.select(pick).collect())) == sorted(map(repr, plain.select(pick).collect()))
