import random

import numpy as np
import pytest

from kamienica.llm import suffix_dedup

from .fixtures import PASSAGE, clashing, documents, frame, prose


def brute(rows, length=50):
    """(id, text) -> bytes, removed bytes, maximal removed runs, what is left."""
    order = lambda r: (r[0] is None, r[0] or 0)
    first, out = {}, []
    for r in sorted(rows, key=order):
        raw = (r[1] or "").encode()
        for i in range(len(raw) - length + 1):
            first.setdefault(raw[i:i + length], order(r))
    for r in rows:
        raw = (r[1] or "").encode()
        gone = np.zeros(len(raw) + 2, np.int8)
        for i in range(len(raw) - length + 1):
            if first[raw[i:i + length]] < order(r):
                gone[i + 1:i + 1 + length] = 1
        out.append((r[0], len(raw), int(gone.sum()), int((np.diff(gone) == 1).sum()),
                    bytes(b for b, g in zip(raw, gone[1:]) if not g)))
    return sorted(out, key=repr)


def found(docs, **conf):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
                   for r in suffix_dedup.remove_repeats(docs, **conf).collect()), key=repr)


@pytest.mark.parametrize("part_bytes", [1 << 21, 30_000])
def test_against_brute_force(spark, part_bytes):
    rng = random.Random(6)
    rows = [r for r in documents() if r[1] is None or len(r[1]) < 40_000]
    base = prose(rng, 200)
    rows += [(100 + i, base[:rng.randint(0, 600)] + prose(rng, rng.randint(0, 30)) + base[rng.randint(0, 900):], "en", "a", 1)
             for i in range(25)]
    rows += [(200 + i, prose(rng, 20) + " " + PASSAGE[i:] + PASSAGE[:40 + i] + prose(rng, 5), "en", "a", 1) for i in range(20)]
    rows += [(300 + i, "ab" * rng.randint(20, 60) + "a" * i, "en", "a", 1) for i in range(12)]
    rows += [(400, "x" * 49, "en", "a", 1), (401, "x" * 50, "en", "a", 1), (402, "x" * 50, "en", "a", 1), (403, "y" * 200, "en", "a", 1)]
    assert found(frame(spark, rows), part_bytes=part_bytes) == brute(rows)


def test_long_documents_in_pieces(spark, monkeypatch):
    rng = random.Random(7)
    long = prose(rng, 9000)
    rows = [(1, long, "en", "a", 1), (2, prose(rng, 40) + long[20_000:26_000] + prose(rng, 40), "en", "a", 1)]
    assert found(frame(spark, rows)) == brute(rows)


def test_pieces_cover_every_window_once(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    rng = random.Random(1)
    texts = [(i, prose(rng, rng.randint(0, 300)).encode()) for i in range(20)] + [(20, b"x" * 49), (21, b"y" * 50)]
    seen = set()
    for raw, ends, who, offset in suffix_dedup.pieces(texts):
        first, n, _ = suffix_dedup.anchor_runs(np.frombuffer(raw, np.uint8), ends)
        for a, k in zip(first, n):
            p = int(np.searchsorted(ends, a, side="right"))
            start = a - (ends[p - 1] if p else 0) + offset[p]
            for w in range(int(start), int(start + k)):
                assert (who[p], w) not in seen and raw[a + w - start:a + w - start + 50] == texts[who[p]][1][w:w + 50]
                seen.add((who[p], w))
    assert seen == {(i, w) for i, t in texts for w in range(len(t) - 49)}


def test_family_levels_stay_logarithmic():
    rng = np.random.default_rng(3)
    family, held = suffix_dedup.SuffixFamily(), {}
    for batch in range(120):
        words = rng.integers(0, 4000, 100)
        keys = np.array([b"%050d" % w for w in words], "S50")
        docs = np.full(100, batch)
        wanted = [held.get(k, batch) < batch for k in keys.tolist()]
        assert family.add(keys, docs).tolist() == wanted
        for k in keys.tolist():
            held.setdefault(k, batch)
        assert len(family.levels) <= 14
    assert sum(len(k) for k, _ in family.levels) == len(held)
    assert all((k[1:] > k[:-1]).all() for k, _ in family.levels)


def test_texts_without_repeats(spark):
    docs = clashing(frame(spark), ("n_bytes", "kept", "part", "bucket"))
    out = suffix_dedup.dedup_text(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    wanted = brute(documents())
    left = sorted((k[4].decode(errors="ignore") for k in wanted if not k[2] or k[4]))
    assert sorted(r["text"] or "" for r in rows) == left
    assert {r["kept"] for r in rows} == {"mine"}
    assert suffix_dedup.dedup_text(frame(spark, [])).collect() == []
