"""Phrases whose words keep together: frequent n-grams by Misra-Gries summaries, counted exactly, scored by their weakest cut.

Texts are lower-cased (A-Z) and split at punctuation and line ends into pieces, pieces at blanks and tabs into words. Every
n-gram within a piece counts, overlaps included, each language for itself. A phrase of 2 to 5 words with at least `least`
occurrences is a candidate; its score is the least of floor(1000 a n / (l r)) over its cuts into a first part and a rest.

Search. N-grams are 64-bit hashes, dealt by hash to parts. Each task sums a block of text and sends its sums along with the
mass (occurrences) it adds to each part. A part reads all masses first and then merges the sums into one Misra-Gries summary
whose capacity exceeds mass / `least`: what is taken off all counters is then less than `least`, so that every frequent
n-gram survives, whatever order sums come in. Counters that cannot reach `least`, even with all that was taken off, are left
out. Three rounds are made: words; pairs of surviving words; three to five words all of whose pairs survived. Survivors reach
the next round as a bitmap of bounded size: a false hit costs work, never a result. The third round also gathers the words of
surviving pairs, for only these are ever a part of a phrase.

Second pass. N-grams that survive (and all of whose parts do) are counted with their texts, exactly, by language and phrase;
within a task they are told apart by 128 bits of hashes, across tasks by their texts. A task sends what it counted packed in
one row a bucket of phrases, and buckets are added up one at a time.

What is held: sums of a block in a task, one summary of mass / `least` counters for each part and the bitmap of at most
MOST_BITS. Parts hold about PART_MASS occurrences; beyond MOST_PARTS of them, parts grow instead, as every block tells every
part its mass. No step gathers a language or a hot phrase in one task; the final ranks come from the
best of salted shares of a language.

Defined cases: a null text is empty; a null language is `und`; empty tables and tables without frequent phrases give an empty
result; repeated rows count each; further columns are ignored; very long texts and words are worked through in chunks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kamienica.llm.words import Hasher, Words, add_up, mix
from kamienica.session import settle

BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
LONGEST = 5
BLOCK = 2 << 20  # bytes of text handled at a time
SUMS = 1 << 20  # distinct n-grams a task sums up before it sends them
PART_MASS, MOST_PARTS = 1_000_000, 1 << 15  # occurrences a part is meant for, and how many parts there may be
BITS_EACH, LEAST_BITS, MOST_BITS = 64, 1 << 15, 1 << 28
BUCKET = 1 << 15  # bits in a row of the bitmap
BUCKET_SIZE = 10_000  # survivors in a bucket of the exact count
SALTS = 32
GRAM_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Bitmap:
    """Which hashes may be in a set; never wrong about those that are."""
    bits: int
    data: np.ndarray

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64(self.bits - 1)
        return (self.data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap_of(hashes: DataFrame, most_bits: int = MOST_BITS) -> Bitmap:
    """Built by Spark in rows of 4 KB; the driver gets at most `most_bits` / 8 bytes, whatever the number of hashes."""
    wanted = max(LEAST_BITS, min(most_bits, BITS_EACH * hashes.count()))
    bits = 1 << (wanted - 1).bit_length()
    at = F.col("hash").bitwiseAND(F.lit(bits - 1))
    rows = hashes.groupBy(F.shiftright(at, 15).alias("bucket")).agg(
        F.bitmap_construct_agg(at.bitwiseAND(F.lit(BUCKET - 1))).alias("bits")).collect()
    data = np.zeros(bits // 8, np.uint8)
    for row in rows:
        data[row["bucket"] * BUCKET // 8:(row["bucket"] + 1) * BUCKET // 8] = np.frombuffer(row["bits"], np.uint8)
    return Bitmap(bits, data)


def grams(words: Words, langs: np.ndarray, which: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of words, hash, whether it lies in one piece) of the n-grams that start at every word."""
    single = words.hash[which]
    lang = langs[words.doc]
    running, whole = single, np.ones(len(words), bool)
    for n in range(1, LONGEST + 1):
        if n > 1:
            running = mix(running[:-1] * GRAM_STEP + single[n - 1:]) if len(running) > 1 else running[:0]
            whole = whole[:len(running)] & ~words.last[n - 2:n - 2 + len(running)]
        yield n, mix(running ^ lang[:len(running)]), whole


def blocks(batches: Iterator[pa.RecordBatch], hashers: tuple[Hasher, ...]) -> Iterator[tuple[Words, np.ndarray, list[str]]]:
    """(words, language hash by text, language by text) of about BLOCK bytes of texts at a time."""
    texts, langs, size = [], [], 0

    def block():
        hashes = {lang: xxhash.xxh3_64_intdigest(lang) for lang in set(langs)}
        return Words(texts, hashers, BLANKS, BREAKS), np.array([hashes[lang] for lang in langs], np.uint64), langs

    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1)):
            texts.append(text.as_py())
            langs.append(lang.as_py())
            size += len(texts[-1])
            if size >= BLOCK:
                yield block()
                texts, langs, size = [], [], 0
    if texts:
        yield block()


def kept_grams(words: Words, langs: np.ndarray, wanted: tuple[int, int], known: Bitmap | None, upto: int):
    """(n, hash, whether counted) for n-grams of `wanted` lengths; n-grams of `upto` words or fewer must be `known`, as must be
    all shorter parts of longer ones."""
    parts = None
    for n, hashes, whole in grams(words, langs):
        if n > wanted[1]:
            return
        ok = whole if parts is None else whole & parts[:len(whole)] & parts[1:len(whole) + 1]
        if known is not None and n <= upto:
            at = np.flatnonzero(ok)
            ok = np.zeros(len(whole), bool)
            ok[at] = known.holds(hashes[at])
        parts = ok
        if n >= wanted[0]:
            yield n, hashes, ok


SUMMED = "part int, hash long, n long"


def words_of_pairs(words: Words, langs: np.ndarray, known: Bitmap) -> np.ndarray:
    """Hashes of the words in surviving pairs."""
    (_, single, _), (_, _, pair) = kept_grams(words, langs, (1, 2), known, 2)
    inside = np.zeros(len(words), bool)
    inside[:-1] |= pair
    inside[1:] |= pair
    return np.unique(single[inside])


def _sums(wanted: tuple[int, int], known, upto: int, parts: int, with_words: bool) -> Callable:
    """Sums by hash of what each block holds; a row without hash tells the mass that goes to a part. Negative parts get the
    words of surviving pairs."""
    def flush(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        part = (keys % np.uint64(parts)).astype(np.int32)
        masses = np.bincount(part, counts, minlength=parts).astype(np.int64)
        some = np.flatnonzero(masses).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.nulls(len(some), pa.int64()), pa.array(masses[some])],
                                         names=["part", "hash", "n"])
        for a in range(0, len(keys), 1 << 17):
            cut = slice(a, a + (1 << 17))
            yield pa.RecordBatch.from_arrays([pa.array(part[cut]), pa.array(keys[cut].view(np.int64)), pa.array(counts[cut])],
                                             names=["part", "hash", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers = (Hasher(1),)
        bitmap = known.value if known is not None else None
        keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        needed = np.empty(0, np.uint64)
        for words, lang_hash, _ in blocks(batches, hashers):
            if with_words and len(words):
                needed = np.union1d(needed, words_of_pairs(words, lang_hash, bitmap))
                if len(needed) >= SUMS:
                    yield needed_rows(needed)
                    needed = needed[:0]
            found = [h[ok] for _, h, ok in kept_grams(words, lang_hash, wanted, bitmap, upto)]
            new = np.concatenate([np.empty(0, np.uint64), *found])
            new, sums = add_up(new, np.ones(len(new), np.int64))
            keys, counts = add_up(np.concatenate([keys, new]), np.concatenate([counts, sums]))
            if len(keys) >= SUMS:
                yield from flush(keys, counts)
                keys, counts = keys[:0], counts[:0]
        if len(keys):
            yield from flush(keys, counts)
        if len(needed):
            yield needed_rows(needed)

    def needed_rows(needed: np.ndarray) -> pa.RecordBatch:
        part = -1 - (needed % np.uint64(parts)).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(part), pa.array(needed.view(np.int64)),
                                           pa.array(np.zeros(len(needed), np.int64))], names=["part", "hash", "n"])
    return run


class MisraGries:
    """At most `capacity` counters. A count is too low by `taken` at most, and `taken` <= mass / (capacity + 1)."""

    def __init__(self, capacity: int):
        self.capacity, self.taken, self.waiting, self.size = capacity, 0, [], 0
        self.keys, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Sums are gathered and merged when there are as many as counters."""
        self.waiting.append((keys, counts))
        self.size += len(keys)
        if self.size >= max(self.capacity, 1 << 16):
            self.settle()

    def settle(self) -> None:
        new_keys, new_counts = zip((self.keys, self.counts), *self.waiting)
        keys, counts = add_up(np.concatenate(new_keys), np.concatenate(new_counts))
        if len(keys) > self.capacity:
            least = len(keys) - self.capacity - 1
            off = int(np.partition(counts, least)[least])  # the greatest count beyond the capacity
            self.taken += off
            keys, counts = keys[counts > off], counts[counts > off] - off
        self.keys, self.counts, self.waiting, self.size = keys, counts, [], 0


def _survivors(least: int) -> Callable:
    """(hash, most): what may have `least` occurrences and how many at most; a row without hash has the mass of a part. Rows
    come by part, masses first. Words of pairs pass with most = 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, summary, needed = None, 0, None, np.empty(0, np.uint64)

        def close() -> pa.RecordBatch:
            keys, most = np.empty(0, np.uint64), np.empty(0, np.int64)
            if summary is not None:
                summary.settle()
                keys, most = summary.keys, summary.counts + summary.taken
            may = most >= least
            if part < 0:
                keys, most, may = needed, np.zeros(len(needed), np.int64), np.ones(len(needed), bool)
            return pa.RecordBatch.from_arrays(
                [pa.array([*keys[may].view(np.int64).tolist(), None], pa.int64()), pa.array([*most[may].tolist(), mass], pa.int64())],
                names=["hash", "most"])

        for batch in batches:
            parts = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1), len(parts)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if parts[a] != part:
                    if part is not None:
                        yield close()
                    part, mass, summary, needed = parts[a], 0, None, needed[:0]
                rows = batch.slice(a, b - a)
                if part < 0:
                    needed = np.union1d(needed, rows.column(1).to_numpy().view(np.uint64))
                    continue
                heads = rows.column(1).null_count  # masses come first
                mass += int(rows.column(2).to_numpy()[:heads].sum())
                if heads < b - a:
                    summary = summary or MisraGries(mass // least)
                    rows = rows.slice(heads)
                    summary.add(rows.column(1).to_numpy().view(np.uint64), rows.column(2).to_numpy())
        if part is not None:
            yield close()
    return run


def survivors(texts: DataFrame, wanted: tuple[int, int], known: Bitmap | None, upto: int, mass: int, least: int,
              part_mass: int = PART_MASS, with_words: bool = False) -> tuple[DataFrame, DataFrame, int]:
    """(hash) of all n-grams of `wanted` lengths that may be frequent, (hash) of the words of surviving pairs, both of one
    written table, and the mass. The given `mass` is an estimate that only sets the number of parts."""
    shared = texts.sparkSession.sparkContext.broadcast(known) if known is not None else None  # MOST_BITS at most
    parts = max(1, min(MOST_PARTS, -(-mass // part_mass)))
    sums = texts.mapInArrow(_sums(wanted, shared, upto, parts, with_words), SUMMED)
    dealt = sums.repartition(parts, "part").sortWithinPartitions("part", F.col("hash").isNotNull())
    found = settle(dealt.mapInArrow(_survivors(least), "hash long, most long"))
    total = found.where("hash IS NULL").agg(F.sum("most")).first()[0] or 0
    named = found.where("hash IS NOT NULL")
    return named.where("most > 0").select("hash"), named.where("most = 0").select("hash"), total


PACKED = "bucket int, langs array<string>, phrases array<binary>, lengths array<int>, counts array<long>"
EXACT = "lang string, phrase binary, words int, n long"


def _exact(known, buckets: int) -> Callable:
    """Counts of surviving n-grams by language and text, one row a bucket; a length of 0 has the number of all words."""
    kinds = [pa.int32(), pa.list_(pa.string()), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers = (Hasher(1), Hasher(2))
        held: dict[tuple[str, bytes, int], int] = {}

        def flush() -> pa.RecordBatch:
            packed: dict[int, list[tuple]] = {}
            for (lang, phrase, n), count in held.items():
                packed.setdefault(xxhash.xxh3_64_intdigest(phrase) % buckets, []).append((lang, phrase, n, count))
            held.clear()
            columns = [list(packed), *([list(column) for column in columns]
                                       for columns in zip(*(zip(*rows) for rows in packed.values())))]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds)],
                                              names=["bucket", "langs", "phrases", "lengths", "counts"])

        for words, lang_hash, langs in blocks(batches, hashers):
            for lang, n in zip(langs, np.bincount(words.doc, minlength=len(langs)).tolist()):
                held[lang, b"", 0] = held.get((lang, b"", 0), 0) + n
            second = {n: h for n, h, _ in grams(words, lang_hash, 1)}
            for n, hashes, ok in kept_grams(words, lang_hash, (1, LONGEST), known.value, LONGEST):
                at = np.flatnonzero(ok)
                if not len(at):
                    continue
                at = at[np.lexsort((second[n][at], hashes[at]))]
                a, b = hashes[at], second[n][at]
                first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
                sums = np.diff(first, append=len(at))
                for i, count in zip(at[first].tolist(), sums.tolist()):
                    key = langs[words.doc[i]], words.slice(i, i + n - 1), n
                    held[key] = held.get(key, 0) + count
            if len(held) >= SUMS // 4:
                yield flush()
        if held:
            yield flush()
    return run


def _added_up(least: int) -> Callable:
    """Sums of the counts; rows come by bucket, and what is held is one bucket's phrases."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, {}

        def close() -> pa.RecordBatch:
            rows = [(*key, n) for key, n in held.items() if n >= least or key[2] == 0]
            values = list(zip(*rows)) if rows else [()] * 4
            kinds = [pa.string(), pa.binary(), pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)],
                                              names=["lang", "phrase", "words", "n"])

        for batch in batches:
            for i in range(len(batch)):
                own, *lists = (column[i].as_py() for column in batch.columns)
                if own != bucket:
                    if held:
                        yield close()
                    bucket, held = own, {}
                for *key, n in zip(*lists):
                    held[tuple(key)] = held.get(tuple(key), 0) + n
        if held:
            yield close()
    return run


def frequent(docs: DataFrame, least: int = 100, text: str = "text", lang: str = "lang",
             part_mass: int = PART_MASS, most_bits: int = MOST_BITS, bucket_size: int = BUCKET_SIZE) -> DataFrame:
    """(lang, phrase, words, n), written: every n-gram of 2 to 5 words with `least` occurrences or more, every word of one, and
    for words = 0 the number of all words of a language."""
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
                        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    single, _, mass = survivors(texts, (1, 1), None, 0, size // 5, least, part_mass)
    pairs, _, mass = survivors(texts, (2, 2), bitmap_of(single, most_bits), 1, mass, least, part_mass)
    longer, single, _ = survivors(texts, (3, LONGEST), bitmap_of(single.unionAll(pairs), most_bits), 2, mass, least, part_mass,
                                  with_words=True)
    every = settle(single.unionAll(pairs).unionAll(longer))
    known = docs.sparkSession.sparkContext.broadcast(bitmap_of(every, most_bits))
    buckets = max(1, -(-every.count() // bucket_size))
    packed = texts.mapInArrow(_exact(known, buckets), PACKED).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return settle(packed.mapInArrow(_added_up(least), EXACT).withColumn("phrase", F.col("phrase").cast("string")))


def collocations(docs: DataFrame, least: int = 100, cover: int = 100, best: int = 2000, text: str = "text",
                 lang: str = "lang", part_mass: int = PART_MASS, most_bits: int = MOST_BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `best` phrases of each language.

    A candidate inside a longer one that has `cover` percent of its occurrences is left out. Whatever lies inside a longer
    phrase lies inside one with one word more, which has at least as many occurrences, so only these are looked up.
    """
    counts = frequent(docs, least, text, lang, part_mass, most_bits)
    candidates = counts.where("words >= 2").select("lang", "phrase", "words", F.col("n").alias("a"),
                                                   F.split("phrase", " ").alias("w"))
    inner = candidates.where("words >= 3").select(
        "lang", "a", F.explode(F.array(F.expr("array_join(slice(w, 1, words - 1), ' ')"),
                                       F.expr("array_join(slice(w, 2, words - 1), ' ')"))).alias("phrase"))
    longest = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    free = candidates.join(longest, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("a")))
    cuts = free.select("lang", "phrase", "words", "a", "w", F.explode(F.expr("sequence(1, words - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("first"),
        F.expr("array_join(slice(w, k + 1, words - k), ' ')").alias("rest"))
    parts = counts.where("words BETWEEN 1 AND 4")
    total = counts.where("words = 0").select("lang", F.col("n").alias("all_words"))
    scored = (cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
              .join(parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
              .join(total, "lang").withColumn("score", F.expr(
                  "(1000BD * CAST(a AS DECIMAL(17,0)) * CAST(all_words AS DECIMAL(17,0)))"
                  " div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))")))
    weakest = scored.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.first("all_words").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    flat = weakest.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
                          F.col("cut.score").alias("score"))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    few = flat.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= best)
    return (few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .where(F.col("rank") <= best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


QUERY_SQL = r"""
WITH p AS (SELECT lang, regexp_extract_all(unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
    FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                          'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS a
    FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p), (SELECT unnest(range(1, 6)) AS m)
    WHERE i + m - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w FROM g WHERE m >= 2),
s AS (SELECT x.lang, x.phrase, x.a, x.w, x.m FROM c x WHERE NOT EXISTS (SELECT 1 FROM c y WHERE y.lang = x.lang AND y.m > x.m
    AND contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' ') AND 100 * y.a >= 100 * x.a)),
k AS (SELECT s.lang, s.phrase, s.a, l.a AS l, r.a AS r, n, cut,
        (1000::HUGEINT * s.a * n // (l.a::HUGEINT * r.a))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, m)) AS cut FROM s) s JOIN n USING (lang)
    JOIN g l ON l.lang = s.lang AND l.phrase = array_to_string(s.w[1:cut], ' ')
    JOIN g r ON r.lang = s.lang AND r.phrase = array_to_string(s.w[cut + 1:], ' ')
    QUALIFY row_number() OVER (PARTITION BY s.lang, s.phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM k QUALIFY rank <= 2000
"""
