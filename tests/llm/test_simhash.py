import random
import re

import numpy as np
import xxhash

from kamienica.llm import simhash
from kamienica.llm.components import connected

from .fixtures import clashing, documents, frame, prose


def brute_print(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, most=3):
    """Root (smallest index) of each entry."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= most:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def check(spark, rows):
    got = simhash.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    prints = [brute_print(r[1]) for r in rows]
    roots = brute_components(prints)
    least = {}
    for r, root in zip(rows, roots):
        ids = [x for x in (least.get(root), r[0]) if x is not None]
        least[root] = min(ids) if ids else None
    wanted = sorted(((r[0], f"{p:016x}", least[root]) for r, p, root in zip(rows, prints, roots)), key=repr)
    assert sorted(((r["__key"], r["fingerprint"], r["component_id"]) for r in got), key=repr) == wanted
    return roots


def near_copies(rng, n, first=0):
    base, rows = prose(rng, 300).split(), []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = prose(rng, 1)
        rows.append((first + i, " ".join(words), "en", "a", 1))
    return rows


def test_components_against_all_pairs(spark):
    rng = random.Random(4)
    check(spark, documents() + near_copies(rng, 120, 1000) + near_copies(rng, 15, 2000))


def test_chains_of_random_bits(spark):
    """Fingerprints in chains, each three bits from the last: components reach far beyond the distance."""
    rng = random.Random(8)
    points = []
    for _ in range(30):
        at = rng.getrandbits(64)
        for _ in range(rng.randint(1, 40)):
            points.append(at)
            for b in rng.sample(range(64), 3):
                at ^= 1 << b
    points = sorted(set(points))
    signed = [int(np.uint64(p).astype(np.int64)) for p in points]
    table = spark.createDataFrame([(p,) for p in signed], "point long")
    roots = {r["node"]: r["root"] for r in connected(simhash.links(table)).collect()}
    found = {}
    for p, s in zip(points, signed):
        found.setdefault(roots.get(s, s), set()).add(p)
    wanted = {}
    for p, r in zip(points, brute_components(points)):
        wanted.setdefault(r, set()).add(p)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, wanted.values()))


def test_dense_cells_are_cut_without_losing_links(monkeypatch):
    monkeypatch.setattr(simhash, "DENSE", 20)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
    points = np.unique(base[rng.integers(0, 5, 300)] ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)))
    out = []
    simhash._forest(points, 3, out)
    edges = [(int(a), int(b)) for x, y in out for a, b in zip(x, y)]
    where = {int(p): i for i, p in enumerate(points)}
    root = list(range(len(points)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in edges:
        assert bin(a ^ b).count("1") <= 3
        root[find(where[a])] = find(where[b])
    groups = lambda roots: sorted(sorted(i for i in range(len(points)) if roots[i] == r) for r in set(roots))
    assert groups([find(i) for i in range(len(points))]) == groups(brute_components([int(p) for p in points]))


def test_embedding_is_a_lower_bound():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 1 << 63, (2, 2000), dtype=np.uint64)
    counts = lambda x: np.array([[bin(int(v) >> s & 3).count("1") for s in range(0, 64, 2)] for v in x])
    exact = np.abs(counts(a) - counts(b)).sum(axis=1)
    assert np.array_equal(simhash.manhattan(simhash.embedding(a), simhash.embedding(b)), exact)
    assert (exact <= np.bitwise_count(a ^ b)).all()


def test_one_of_each_group_stays_with_its_columns(spark):
    docs = clashing(frame(spark), ("fingerprint", "component_id", "point", "node"))
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    rows = documents()
    roots = brute_components([brute_print(r[1]) for r in rows])
    assert kept.count() == len(set(roots))
    assert simhash.drop_near_duplicates(frame(spark, [])).collect() == []


def test_unlike_texts_of_one_id_all_stay(spark):
    rng = random.Random(3)
    texts = [prose(rng, 80) for _ in range(4)]
    rows = [(7, texts[0], "en", "s", 1), (7, texts[1], "en", "s", 1), (7, texts[2], "en", "s", 1), (7, texts[2], "en", "s", 1),
            (None, texts[3], "en", "s", 1), (8, texts[0], "en", "s", 1), (None, "t" + texts[3], None, None, None), (9, None, "", "", 0)]
    kept = [(r["doc_id"], r["text"]) for r in simhash.drop_near_duplicates(frame(spark, rows)).collect()]
    assert sorted((k, t or "") for k, t in kept if k is not None) == sorted([(7, texts[0]), (7, texts[1]), (7, texts[2]), (9, "")])
    assert len([k for k, _ in kept if k is None]) == 1
