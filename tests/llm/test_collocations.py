import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kamienica.llm import collocations, words
from kamienica.llm.words import Hasher, Words, add_up
from tests.llm.fixtures import clashing, documents, frame


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def counted(rows):
    total, f = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text)):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            f.update((lang, tuple(w[i:i + m])) for m in range(1, 6) for i in range(len(w) - m + 1))
    return total, f


def brute(rows, least, cover=100, best=2000):
    total, f = counted(rows)
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    dropped = set()
    for (lang, long), a in candidates.items():
        for m in range(2, len(long)):
            for i in range(len(long) - m + 1):
                if 100 * a >= cover * candidates[lang, long[i:i + m]]:
                    dropped.add((lang, long[i:i + m]))
    found = {}
    for (lang, p), a in candidates.items():
        if (lang, p) not in dropped:
            cuts = [(1000 * a * total[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, rank, phrase.decode(), -a, left, right, total[lang], -score) for lang, phrases in found.items()
                  for rank, (score, a, phrase, left, right) in enumerate(sorted(phrases)[:best], 1))


def corpus(seed, n=300):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "ß😀", "漢字", "x" * 300]
    rows = []
    for i in range(n):
        text = ""
        for _ in range(rng.randint(0, 60)):
            text += rng.choice(["New York City ", "of the order of\t", "a  b ", rng.choice(vocabulary) + " ",
                                rng.choice(vocabulary) + rng.choice([". ", ", ", "\n", "\x0b", " \t ", "!? "])])
        rows.append((i, text, rng.choice(["en", "de", None, "und"]), "s", 1))
    return rows


@pytest.mark.parametrize("least, cover, best, part_mass, bits", [(20, 100, 2000, 10 ** 6, 1 << 28), (5, 100, 7, 500, 1 << 15),
                                                                 (3, 80, 2000, 300, 1 << 15)])
def test_equals_counting_everything(spark, least, cover, best, part_mass, bits):
    rows = corpus(least)
    df = clashing(frame(spark, rows), ["phrase", "a", "n", "rank", "hash"]).repartition(5)
    got = collocations.collocations(df, least, cover, best, part_mass=part_mass, most_bits=bits)
    assert sorted(map(tuple, got.collect())) == brute(rows, least, cover, best)


def test_small_blocks_and_sums(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BITS_EACH", 1)  # a filter that lets nearly everything through
    rows = corpus(1, 80)
    got = collocations.collocations(frame(spark, rows).repartition(9), 4, part_mass=100)
    assert sorted(map(tuple, got.collect())) == brute(rows, 4)


def test_fixture_and_awkward_tables(spark):
    rows = documents()
    got = collocations.collocations(frame(spark, rows), 10)
    assert sorted(map(tuple, got.collect())) == brute(rows, 10)
    assert collocations.collocations(frame(spark, [])).count() == 0
    nulls = [(None, None, None, None, None), (1, "", "en", None, 1), (1, " . ", "en", None, 1)]
    assert collocations.collocations(frame(spark, nulls), 1).count() == 0
    same = [(1, "a a a a a a", None, None, None)] * 3
    assert sorted(map(tuple, collocations.collocations(frame(spark, same), 2).collect())) == brute(same, 2)


def test_whole_counts(spark):
    rows = corpus(2, 100)
    total, f = counted(rows)
    counts = collocations.frequent(frame(spark, rows).repartition(4), 6, bucket_size=7).collect()
    got = {(r["lang"], r["phrase"]): r["n"] for r in counts}
    assert len(got) == len(counts)
    many = {(lang, " ".join(p)): n for (lang, p), n in f.items() if n >= 6}
    inner = {(lang, word) for lang, p in many for word in p.split() if " " in p}
    assert {k: n for k, n in got.items() if " " in k[1] or k in inner or not k[1]} == {
        **{k: n for k, n in many.items() if " " in k[1] or k in inner}, **{(lang, ""): n for lang, n in total.items()}}
    assert all(many[k] == n for k, n in got.items() if k[1])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60), max_size=80), max_size=8), st.integers(1, 12))
def test_no_frequent_item_is_lost(batches, least):
    truth = Counter(x for b in batches for x in b)
    mass = sum(truth.values())
    summary = collocations.MisraGries(mass // least)
    for batch in batches:
        keys, counts = add_up(np.array(batch, np.uint64), np.ones(len(batch), np.int64))
        summary.add(keys, counts)
        summary.settle()
    kept = dict(zip(summary.keys.tolist(), summary.counts.tolist()))
    assert len(kept) <= mass // least and summary.taken <= mass / (mass // least + 1)
    for item, n in truth.items():
        assert kept.get(item, 0) <= n <= kept.get(item, 0) + summary.taken
        assert n < least or (item in kept and kept[item] + summary.taken >= least)


def test_merged_halves_keep_the_guarantee():
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.integers(0, 5000, 40_000), np.repeat(np.arange(7000, 7020), 300)]).astype(np.uint64)
    rng.shuffle(values)
    whole = collocations.MisraGries(len(values) // 300)
    for part in np.array_split(values, 13):
        whole.add(*add_up(part, np.ones(len(part), np.int64)))
    whole.settle()
    assert set(range(7000, 7020)) <= set(whole.keys.tolist()) and whole.taken < 300


def test_words_and_hashes_do_not_depend_on_the_place(monkeypatch):
    texts = [t.encode() for _, t, *_ in documents() if t]
    blanks = words.BLANKS
    whole = Words(texts, (Hasher(1), Hasher(2)))
    found = [[] for _ in texts]
    for i in range(len(whole)):
        found[whole.doc[i]].append(whole.slice(i, i))
    assert found == [lowered(t.decode()).encode().split() for t in texts]
    assert all(whole.last[i] == (i + 1 == len(whole) or whole.doc[i + 1] != whole.doc[i]) for i in range(len(whole)))
    by_word = {}
    for i in range(len(whole)):
        assert by_word.setdefault(whole.slice(i, i), (whole.hash[0][i], whole.hash[1][i])) == (whole.hash[0][i], whole.hash[1][i])
    assert len({h for h, _ in by_word.values()}) == len(by_word)
    monkeypatch.setattr(words, "CHUNK", 700)
    again = Words(texts[::-1], (Hasher(1),), blanks)
    for i in range(len(again)):
        assert by_word[again.slice(i, i)][0] == again.hash[0][i]
    assert len(Words([], (Hasher(1),))) == len(Words([b"", b" \n "], (Hasher(1),))) == 0
