"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Documents with equal texts form one group. Groups of one size are a class; the driver gets the classes (size, number of
groups) and packs every group: in decreasing order of size a group enters the bin with the tightest remaining capacity
that holds it, found in a balanced search order of remaining capacities. The tightest bin stays the tightest until it is
full, so a class enters a bin with as many members as fit in one step. There are at most sqrt(2 * bytes) classes, as their
sizes differ, and far fewer where texts have usual lengths. The capacity is the smallest for which the wanted number of
bins is enough. A group above a fair share of what is left gets a shard of its own first.

Groups are ranked by size and digest (a range-partitioned sort, so that a class may spread over many tasks), and the members
of a class are dealt to its bins by rank. Documents find the shard of their group by digest; groups with a large share of
all rows, of which there can only be a few, are looked up without a shuffle.

Slots number the rows of a shard without gaps: rows are counted by (shard, cell), cells being hashes of the id whose
number grows with the rows, the counts are summed up to offsets, and rows are ordered only within a cell.

Defined cases: a null text is a group of its own apart from the empty text, with size 1 and check sum 0; repeated rows
each have their slot; an empty table gives an empty result; input columns with the names of result columns are replaced.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kamienica.session import settle

RESULT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
HOT = 4096  # a group with more than 1 / HOT of all rows is looked up by broadcast: fewer than HOT groups
CELL_ROWS = 16384  # rows of a shard that are ordered together, about
Run = tuple[int, int, int]  # size of the class, members, bin


def best_fit_decreasing(classes: list[tuple[int, int]], capacity: int, bins: int | None = None) -> list[Run] | None:
    """Runs of members of the classes (size, members), largest first. Bins open as needed, up to `bins`; None if they do
    not suffice."""
    room: list[tuple[int, int]] = []  # (remaining capacity, bin), always in order
    runs, opened = [], 0
    for size, members in sorted(classes, reverse=True):
        while members:
            at = bisect_left(room, (size, -1))
            if at < len(room):
                left, bin_ = room.pop(at)
            elif size <= capacity and (bins is None or opened < bins):
                left, bin_ = capacity, opened
                opened += 1
            else:
                return None
            entered = min(members, left // size)
            insort(room, (left - entered * size, bin_))
            runs.append((size, entered, bin_))
            members -= entered
    return runs


def pack_classes(classes: list[tuple[int, int]], bins: int) -> list[Run]:
    """All members into exactly `bins` bins at the smallest capacity found by halving; oversize ones get bins of their own."""
    classes = sorted(classes, reverse=True)
    runs, first, total = [], 0, sum(size * members for size, members in classes)
    at = 0
    while at < len(classes) and bins - first > 1 and classes[at][0] * (bins - first) > total:
        size, members = classes[at]
        runs.append((size, 1, first))
        first, total = first + 1, total - size
        classes[at] = (size, members - 1)
        at += members == 1
    classes = classes[at:]
    if not classes:
        return runs
    low = max(-(-total // (bins - first)), classes[0][0])
    high, best = low, None
    while best is None:  # the first capacity that is enough, a little higher each time
        best = best_fit_decreasing(classes, high, bins - first)
        if best is None:
            low, high = high + 1, high + max(1, high // 64)
    while low < high:
        middle = (low + high) // 2
        found = best_fit_decreasing(classes, middle, bins - first)
        if found is None:
            low = middle + 1
        else:
            high, best = middle, found
    return runs + [(size, members, first + bin_) for size, members, bin_ in best]


def _class_table(runs: list[Run]) -> pa.Table:
    """(bytes, start, bins): the rank of the first member of the class, and the bins with the rank at which each ends."""
    sizes, starts, bins, rank = [], [], [], 0
    for size, members, bin_ in runs:
        if not sizes or sizes[-1] != size:
            sizes.append(size)
            starts.append(rank)
            bins.append([])
        rank += members
        bins[-1].append({"upto": rank, "bin": bin_})
    kind = pa.list_(pa.struct([("upto", pa.int64()), ("bin", pa.int32())]))
    return pa.table({"bytes": pa.array(sizes, pa.int64()), "start": pa.array(starts, pa.int64()), "bins": pa.array(bins, kind)})


def group_shards(groups: DataFrame, shards: int) -> DataFrame:
    """`groups` (digest, bytes, and more) with the `shard` of each."""
    classes = groups.groupBy("bytes").count().toArrow()
    runs = pack_classes(list(zip(classes["bytes"].to_pylist(), classes["count"].to_pylist())), shards)
    # The place in the sorted table: the partition, and the row in it.
    placed = settle(groups.orderBy(F.desc("bytes"), "digest").withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a task of the sort
    offsets = placed.groupBy(part.alias("part")).count().select(
        "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    ranked = placed.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn(
        "rank", F.col("offset") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)))
    own = groups.sparkSession.createDataFrame(_class_table(runs), "bytes long, start long, bins array<struct<upto:long,bin:int>>")
    chosen = F.filter("bins", lambda b: b["upto"] > F.col("rank"))[0]["bin"]
    return settle(ranked.join(own, "bytes").select(*groups.columns, chosen.alias("shard")))


def shard(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document with `size`, `text_crc32`, `law` ('bytes'), `shard`, `slot` and `grown_shard` (null)."""
    kept = [c for c in docs.columns if c.lower() not in RESULT]
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 1
    wide = docs.select(*[F.col(c).alias(f"__row{i}") for i, c in enumerate(kept)], F.col(key).alias("__key"),
                       size.alias("size"), F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("crc"),
                       F.coalesce(F.sha2(F.col(text), 256), F.lit("null")).alias("digest"))
    groups = settle(wide.groupBy("digest").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")))
    total = groups.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"]
    dealt = group_shards(groups, shards)
    hot = dealt.where(F.col("rows") > total // HOT).select("digest", F.col("shard").alias("hot"))
    rest = dealt.where(F.col("rows") <= total // HOT).select(F.col("digest").alias("sought"), F.col("shard").alias("own"))
    cells = max(1, total // (shards * CELL_ROWS))
    rows = wide.join(F.broadcast(hot), "digest", "left").withColumn("cell", F.pmod(F.xxhash64("__key", "digest"), F.lit(cells)))
    # Rows of hot groups have their shard; they pass the second join spread by keys that match nothing.
    rows = rows.withColumn("sought", F.when(F.col("hot").isNull(), F.col("digest")).otherwise(F.hex(F.xxhash64("__key", "digest"))))
    rows = rows.join(rest, "sought", "left").withColumn("shard", F.coalesce("hot", "own"))
    counts = rows.groupBy("shard", "cell").count()
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(counts.select("shard", "cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset")))
    within = Window.partitionBy("shard", "cell").orderBy("__key", "digest")
    return (rows.join(offsets, ["shard", "cell"])
            .withColumn("slot", F.col("offset") + F.row_number().over(within) - 1)
            .select(*[F.col(f"__row{i}").alias(c) for i, c in enumerate(kept)], "size", F.col("crc").alias("text_crc32"),
                    F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
