"""Removal of repeated passages with a logarithmic family of suffix arrays.

Every byte covered by a 50-byte string that also starts in a document with a smaller id is removed. A `SuffixFamily` takes
documents in order of their ids, in batches: the suffixes of a batch (their first 50 bytes) are sorted, merge-scanned
against every level for matches, and what is new becomes a level; levels of equal size class merge, so a family of n
suffixes has about log n levels and each suffix is moved log n times.

One family for all suffixes would be one task, so suffixes are dealt out: each 50-byte string holds an anchor, the 16-byte
gram of lowest hash in it (rightmost among equals), which is the same wherever the string occurs. All suffixes with one
anchor go to one bucket, and each bucket has a family of its own. Three passes read the texts through one exchange:

1. Each part of the documents tells every bucket which anchors it has; the buckets tell back which are shared by two
   documents or more. Others cannot lie in a match.
2. Each part sends the text around its shared anchors, each distinct one once and for its smallest document; equal ones in
   later documents are removed at once. So a passage in a third of all documents is sent once by each part, no more.
3. The buckets' families tell which windows to remove; each part cuts its texts.

Exact copies of a text are found first by their digest: all but the first are removed whole (if they have 50 bytes).

Defined cases: a null text is empty; texts under 50 bytes neither lose nor remove anything; a row without id comes after
all others and removes nothing; rows with one id do not touch each other; ids are integers; an empty table gives an
empty result; input columns with the names of result columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kamienica.session import settle

RESULT = ("n_bytes", "n_removed", "n_spans", "kept")
LENGTH, GRAM = 50, 16
PLACES = LENGTH - GRAM + 1  # where the anchor of a string can begin
PART_BYTES = 2 << 20  # text in one part; raise it with the data, up to what a task can hold some twenty times
PIECE = 1 << 20  # bytes of one document hashed at a time
BATCH = 1 << 16  # suffixes in a batch of a family
POSITION = np.uint64((1 << 22) - 1)
LAST = (1 << 63) - 1


class SuffixFamily:
    """Sorted 50-byte prefixes of suffixes with the smallest document of each, in levels of growing size."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, suffixes: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Takes a batch in order of documents, none before those already held; says which suffixes a smaller document has."""
        order = np.argsort(suffixes, kind="stable")
        array, owner = suffixes[order], docs[order]
        first = np.ones(len(array), bool)
        first[1:] = array[1:] != array[:-1]
        lead, least = array[first], owner[first].copy()
        known = np.zeros(len(lead), bool)
        for keys, owners in self.levels:
            at = np.minimum(np.searchsorted(keys, lead), len(keys) - 1)
            hit = keys[at] == lead
            least[hit] = np.minimum(least[hit], owners[at[hit]])
            known |= hit
        repeated = np.empty(len(suffixes), bool)
        repeated[order] = owner > least[np.cumsum(first) - 1]
        self._push(lead[~known], least[~known])
        return repeated

    def _push(self, keys: np.ndarray, owners: np.ndarray) -> None:
        if not len(keys):
            return
        while self.levels and len(self.levels[-1][0]).bit_length() <= len(keys).bit_length():
            more, theirs = self.levels.pop()
            keys, owners = np.concatenate([more, keys]), np.concatenate([theirs, owners])
            order = np.argsort(keys, kind="stable")  # two sorted runs: a merge
            keys, owners = keys[order], owners[order]
        self.levels.append((keys, owners))


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the 16 bytes from each place on, by doubling widths."""
    hashes, width = raw.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 1
    while width < GRAM:
        right = hashes[width:] ^ (hashes[width:] >> np.uint64(29))
        hashes = hashes[:-width] * np.uint64(0xC2B2AE3D27D4EB4F + 2 * width) + right
        width *= 2
    hashes ^= hashes >> np.uint64(31)
    hashes *= np.uint64(0x9FB21C651E98DF25)
    hashes ^= hashes >> np.uint64(28)
    return hashes


def anchor_runs(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows that share an anchor: first window, number of windows, 48-bit anchor hash.

    `raw` holds pieces one after the other, shorter than 4 MB together; no window crosses one of their `ends`.
    """
    n = len(raw) - LENGTH + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = gram_hashes(raw)
    ranked = (hashes & ~POSITION) | (POSITION - np.arange(len(hashes), dtype=np.uint64))
    low, width = ranked, 1
    while width * 2 <= PLACES:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:n], low[PLACES - width:PLACES - width + n])
    inside = np.ones(n, bool)
    crossing = (ends[:, None] - np.arange(1, LENGTH)[None, :]).ravel()
    inside[crossing[(crossing >= 0) & (crossing < n)]] = False
    windows = np.flatnonzero(inside)
    if not len(windows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    low = low[windows]
    begins = np.ones(len(windows), bool)
    begins[1:] = (low[1:] != low[:-1]) | (windows[1:] != windows[:-1] + 1)
    begins = np.flatnonzero(begins)
    anchors = (POSITION - (low[begins] & POSITION)).astype(np.int64)
    return windows[begins], np.diff(np.append(begins, len(windows))), hashes[anchors] >> np.uint64(16)


def pieces(texts: Iterable[tuple[int, bytes]]):
    """Blocks (raw, ends, document of each piece, where the piece begins in it); long documents in overlapping pieces."""
    parts, owners, offsets, size = [], [], [], 0
    for i, text in texts:
        for start in range(0, max(len(text) - LENGTH + 1, 0), PIECE):
            part = text[start:start + PIECE + LENGTH - 1]
            if size and size + len(part) > PIECE:
                yield _block(parts, owners, offsets)
                parts, owners, offsets, size = [], [], [], 0
            parts.append(part)
            owners.append(i)
            offsets.append(start)
            size += len(part)
    if parts:
        yield _block(parts, owners, offsets)


def _block(parts, owners, offsets):
    return b"".join(parts), np.cumsum([len(p) for p in parts]), np.array(owners), np.array(offsets)


def _six(hashes: np.ndarray) -> bytes:
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def _longs(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


ANCHORS = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("part", T.IntegerType()),
                        T.StructField("once", T.BinaryType()), T.StructField("more", T.BinaryType())])
#: What a part is told: kind 0 shared anchors, 1 row ids of copies, 2 runs to remove as (row id, first byte, bytes).
TOLD = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("kind", T.IntegerType()),
                     T.StructField("data", T.BinaryType())])
#: kind 0: distinct texts around anchors (`heads`: smallest document, length, anchor) and where they are (`spots`: number
#: of the text, row id, first byte); kind 2 as above, passed on.
AROUND = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("part", T.IntegerType()),
                       T.StructField("kind", T.IntegerType()), T.StructField("heads", T.BinaryType()),
                       T.StructField("spots", T.BinaryType()), T.StructField("data", T.BinaryType())])


def _table(rows: list[tuple], schema: T.StructType) -> pa.Table:
    kinds = {T.IntegerType: pa.int32(), T.BinaryType: pa.binary()}
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.table({f.name: pa.array(c, kinds[type(f.dataType)]) for f, c in zip(schema, columns)})


def _told(right: pa.Table, kind: int) -> list[bytes]:
    return [d for k, d in zip(right.column("kind").to_pylist(), right.column("data").to_pylist()) if k == kind]


def _copies(right: pa.Table) -> set[int]:
    return set(_longs(b"".join(_told(right, 1))).tolist())


def _fresh_texts(left: pa.Table, right: pa.Table, text: str):
    """Row ids, documents, and (row number, bytes) of all texts that are not copies."""
    rids, docs = left.column("__rid").to_pylist(), left.column("__doc").to_pylist()
    copies = _copies(right)
    texts = ((i, t.as_buffer().to_pybytes()) for i, t in enumerate(left.column(text)) if t.is_valid and rids[i] not in copies)
    return rids, docs, texts


def _find_anchors(buckets: int, text: str):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        _, _, texts = _fresh_texts(left, right, text)
        hashes, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for raw, ends, who, _ in pieces(texts):
            first, _, anchor = anchor_runs(np.frombuffer(raw, np.uint8), ends)
            hashes.append(anchor)
            owners.append(who[np.searchsorted(ends, first, side="right")])
        hashes, owners = np.concatenate(hashes), np.concatenate(owners)
        order = np.lexsort((owners, hashes))
        hashes, owners = hashes[order], owners[order]
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        other = np.zeros(len(hashes), bool)
        other[1:] = ~new[1:] & (owners[1:] != owners[:-1])
        several = np.zeros(int(new.sum()), bool)
        several[(np.cumsum(new) - 1)[other]] = True
        hashes = hashes[new]
        bucket = (hashes % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        hashes, several, bucket = hashes[order], several[order], bucket[order]
        bounds = np.searchsorted(bucket, np.arange(buckets + 1))
        rows = [(b, key[0].as_py(), _six(hashes[x:y][~several[x:y]]), _six(hashes[x:y][several[x:y]]))
                for b, (x, y) in enumerate(zip(bounds, bounds[1:])) if y > x]
        return _table(rows, ANCHORS)
    return run


def _share_anchors(table: pa.Table) -> pa.Table:
    """One bucket: tells each part which of its anchors another document has; all are sorted once."""
    own = [_from_six(o + m) for o, m in zip(table.column("once").to_pylist(), table.column("more").to_pylist())]
    within = np.concatenate([np.repeat([False, True], [len(o) // 6, len(m) // 6])
                             for o, m in zip(table.column("once").to_pylist(), table.column("more").to_pylist())])
    hashes = np.concatenate(own)
    order = np.argsort(hashes)
    ranked = hashes[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    sizes = np.diff(np.append(first, len(ranked)))
    shared = np.empty(len(hashes), bool)
    shared[order] = np.repeat((sizes > 1) | np.logical_or.reduceat(within[order], first), sizes)
    ends = np.cumsum([len(o) for o in own])
    rows = [(part, 0, _six(mine[told])) for part, mine, told in zip(
        table.column("part").to_pylist(), own, np.split(shared, ends[:-1])) if told.any()]
    return _table(rows, TOLD)


def _send_around(buckets: int, text: str):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        shared = np.sort(_from_six(b"".join(_told(right, 0))))
        rids, docs, texts = _fresh_texts(left, right, text)
        order = sorted(range(len(docs)), key=docs.__getitem__)
        rank = {i: k for k, i in enumerate(order)}
        around: dict[bytes, list] = {}  # text -> [smallest document, anchor, spots]
        runs = []
        if len(shared):
            for raw, ends, who, offset in pieces(sorted(texts, key=lambda t: rank[t[0]])):
                first, n, anchor = anchor_runs(np.frombuffer(raw, np.uint8), ends)
                hit = shared[np.minimum(np.searchsorted(shared, anchor), len(shared) - 1)] == anchor
                first, n, anchor = first[hit], n[hit], anchor[hit]
                piece = np.searchsorted(ends, first, side="right")
                place = first - np.concatenate([[0], ends])[piece] + offset[piece]
                for a, size, h, i, at in zip(first.tolist(), (n + LENGTH - 1).tolist(), anchor.tolist(),
                                             who[piece].tolist(), place.tolist()):
                    held = around.setdefault(raw[a:a + size], [docs[i], h, []])
                    if held[0] == docs[i]:
                        held[2].append((rids[i], at))
                    else:
                        runs.append((rids[i], at, size))
        part = key[0].as_py()
        dealt: dict[int, list] = {}
        for data, held in around.items():
            dealt.setdefault(held[1] % buckets, []).append((data, held))
        rows = [(part % buckets, part, 2, None, None, np.array(runs, np.int64).tobytes())] if runs else []
        for bucket, items in dealt.items():
            heads = np.array([(held[0], len(data), held[1]) for data, held in items], np.int64)
            spots = np.array([(k, rid, at) for k, (_, held) in enumerate(items) for rid, at in held[2]], np.int64)
            rows.append((bucket, part, 0, heads.tobytes(), spots.tobytes(), b"".join(data for data, _ in items)))
        return _table(rows, AROUND)
    return run


def _match(table: pa.Table) -> pa.Table:
    """One bucket: the runs to remove, by part."""
    rows, texts = [], []  # texts: (document, anchor, bytes, part, spots)
    for part, kind, heads, spots, data in zip(*(table.column(c).to_pylist() for c in ("part", "kind", "heads", "spots", "data"))):
        if kind == 2:
            rows.append((part, 2, data))
            continue
        heads, spots = _longs(heads).reshape(-1, 3), _longs(spots).reshape(-1, 3)
        at = np.searchsorted(spots[:, 0], np.arange(len(heads) + 1))
        begin = 0
        for k, (doc, size, anchor) in enumerate(heads.tolist()):
            texts.append((doc, anchor, data[begin:begin + size], part, spots[at[k]:at[k + 1], 1:]))
            begin += size
    texts.sort(key=lambda t: t[0])
    distinct: dict[bytes, list] = {}  # text -> [smallest document, anchor, its entries]
    runs: dict[int, list] = {}
    for doc, anchor, data, part, spots in texts:
        held = distinct.setdefault(data, [doc, anchor, []])
        if held[0] == doc:
            held[2].append((part, spots))
        else:
            runs.setdefault(part, []).append(np.column_stack([spots, np.full(len(spots), len(data))]))
    kinds: dict[int, int] = {}
    for held in distinct.values():
        kinds[held[1]] = kinds.get(held[1], 0) + 1
    family, waiting, size = SuffixFamily(), [], 0
    unsure = [(data, held) for data, held in distinct.items() if kinds[held[1]] > 1]  # still in order of documents
    for i, (data, held) in enumerate(unsure):
        waiting.append((data, held))
        size += len(data) - LENGTH + 1
        if size >= BATCH or i == len(unsure) - 1:
            _scan(family, waiting, runs)
            waiting, size = [], 0
    rows += [(part, 2, np.concatenate(own).astype(np.int64).tobytes()) for part, own in runs.items()]
    return _table(rows, TOLD)


def _scan(family: SuffixFamily, texts: list, runs: dict[int, list]) -> None:
    raw = np.frombuffer(b"".join(data for data, _ in texts), np.uint8)
    sizes = np.array([len(data) for data, _ in texts])
    counts = sizes - LENGTH + 1
    first = np.repeat(np.cumsum(sizes) - sizes - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    windows = np.lib.stride_tricks.sliding_window_view(raw, LENGTH)[first]
    suffixes = np.ascontiguousarray(windows).view(f"S{LENGTH}").ravel()
    repeated = family.add(suffixes, np.repeat([held[0] for _, held in texts], counts))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    told = np.add.reduceat(repeated, bounds[:-1]) > 0
    for k in np.flatnonzero(told):
        mask = np.concatenate([[0], repeated[bounds[k]:bounds[k + 1]].view(np.int8), [0]])
        edges = np.flatnonzero(np.diff(mask))
        starts, lengths = edges[::2], edges[1::2] - edges[::2] + LENGTH - 1
        for part, spots in texts[k][1][2]:
            runs.setdefault(part, []).append(np.column_stack([
                np.repeat(spots[:, 0], len(starts)), (spots[:, 1][:, None] + starts[None, :]).ravel(),
                np.tile(lengths, len(spots))]))


def merge_runs(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of what the given ones cover; touching ones become one."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return list(zip(starts[at].tolist(), reach[np.append(at[1:], len(starts)) - 1].tolist()))


def _cut(text: str, columns: list[str]):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        copies = _copies(right)
        told = _longs(b"".join(_told(right, 2))).reshape(-1, 3)
        told = told[np.argsort(told[:, 0], kind="stable")]
        out = []
        for rid, value in zip(left.column("__rid").to_pylist(), left.column(text)):
            raw = value.as_buffer().to_pybytes() if value.is_valid else b""
            if rid in copies and len(raw) >= LENGTH:
                spans = [(0, len(raw))]
            else:
                x, y = np.searchsorted(told[:, 0], [rid, rid + 1]) if rid < LAST else (
                    np.searchsorted(told[:, 0], rid), len(told))
                spans = merge_runs(told[x:y, 1], told[x:y, 1] + told[x:y, 2])
            edges = [0, *[e for span in spans for e in span], len(raw)]
            kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
            out.append((len(raw), len(raw) - len(kept), len(spans), kept))
        values = list(zip(*out)) if out else [()] * 4
        table = left.select(columns)
        for name, kind, value in zip(RESULT, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), values):
            table = table.append_column(name, pa.array(value, kind))
        return table
    return run


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """Every row with `n_bytes`, `n_removed`, `n_spans` (maximal removed runs) and `kept` (the bytes left)."""
    names = [c for c in docs.columns if c.lower() not in RESULT]
    columns = [f"__row{i}" for i in range(len(names))]
    body = columns[[c.lower() for c in names].index(text.lower())]
    volume = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0)).alias("n"), F.count("*").alias("rows")).first()
    parts = max(1, -(-volume["n"] // part_bytes), -(-volume["rows"] // 20_000))
    buckets = max(1, parts // 4)
    rows = docs.select(*[F.col(n).alias(c) for n, c in zip(names, columns)],
                       F.xxhash64(F.col(key), F.col(text)).alias("__rid"),
                       F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("__doc"))
    rows = rows.withColumn("__part", F.pmod(F.xxhash64("__rid"), F.lit(parts)).cast("int"))

    digests = rows.where(F.octet_length(body) >= LENGTH).select("__part", "__rid", "__doc", F.md5(body).alias("digest"))
    digests = settle(digests)
    first = digests.groupBy("digest").agg(F.min("__doc").alias("first"), F.max("__doc").alias("last")).where("first < last")
    copies = settle(digests.join(first, "digest").where("__doc > first").groupBy("__part", F.pmod("__rid", F.lit(8)))
                    .agg(F.collect_set("__rid").alias("rids"))
                    .select(F.col("__part").alias("part"), F.lit(1).alias("kind"), F.col("rids")))
    copies = copies.mapInArrow(_pack_rids, TOLD)

    texts = rows.groupBy("__part")

    def with_texts(told: DataFrame, function, schema):
        return texts.cogroup(told.groupBy("part")).applyInArrow(function, schema)

    anchors = with_texts(copies, _find_anchors(buckets, body), ANCHORS)
    shared = anchors.groupBy("bucket").applyInArrow(_share_anchors, TOLD)
    around = with_texts(shared.unionAll(copies), _send_around(buckets, body), AROUND)
    runs = around.groupBy("bucket").applyInArrow(_match, TOLD)
    schema = T.StructType([rows.schema[c] for c in columns] + [
        T.StructField(n, T.BinaryType() if n == "kept" else T.LongType()) for n in RESULT])
    cut = with_texts(runs.unionAll(copies), _cut(body, columns), schema)
    return cut.select(*[F.col(c).alias(n) for n, c in zip(names, columns)], *RESULT)


def _pack_rids(batches):
    for batch in batches:
        data = [np.array(r, np.int64).tobytes() for r in batch.column("rids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("part").cast(pa.int32()), batch.column("kind").cast(pa.int32()),
                                          pa.array(data, pa.binary())], names=TOLD.names)


def dedup_text(docs: DataFrame, key: str = "doc_id", text: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """The documents with repeats cut out of the text; what a cut leaves of a broken character goes too. Columns stay.

    A document of which nothing is left goes; one that lost nothing stays, also an empty one.
    """
    own = {c: f"__in{i}" for i, c in enumerate(docs.columns)}
    place = {c.lower(): n for c, n in own.items()}
    body = place[text.lower()]
    cut = remove_repeats(docs.withColumnsRenamed(own), place[key.lower()], body, part_bytes)
    left = F.when(F.col("n_removed") == 0, F.col(body)).otherwise(_valid_utf8(F.col("kept")))
    return (cut.withColumn("__left", left).where((F.col("n_removed") == 0) | (F.length("__left") > 0))
            .select(*[(F.col("__left") if c.lower() == text.lower() else F.col(n)).alias(c) for c, n in own.items()]))


def _valid_utf8(raw):
    """Decoded with broken characters left out: they become U+FFFD, which is removed again."""
    return F.replace(F.make_valid_utf8(raw.cast("string")), F.lit("�"), F.lit(""))
