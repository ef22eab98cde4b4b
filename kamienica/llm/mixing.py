"""Mixing sources to target weights by Pareto order sampling; DataFrame functions only.

A source whose target is f times its words takes floor(f) whole copies of every document for certain. The rest is a
fixed-size sample: document i has the remaining inclusion probability p, draws u from a hash of its id, and is ranked by
its odds u / (1 - u) divided by the inclusion odds p / (1 - p); the lowest ranks are taken while their words fit into
what is left of the target, and then the one later document that brings the sum nearest to it.

The order is never sorted as a whole. Ranks are cut into buckets on a logarithmic scale, words are summed by source and
bucket before anything moves, the bucket that holds the cut is cut again into finer ones, and only the rows of one such
fine bucket per source are put in order. Any source may hold any share of the rows.

Defined cases: a null text has size 0, null is a source of its own (last in order), rows without an id draw from their
text, rows equal in id, source and size share one decision, an empty table gives an empty result, and input columns
with the names of result columns are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kamienica.session import settle

WORD = r"[^\x20\x09-\x0D]+"
RESULT = ("size", "source_size", "target", "copies", "taken")
COARSE, FINE = 64, 4096  # buckets for one unit of the logarithm of a rank, and parts of such a bucket


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def uniform(key: Column, seed: int) -> Column:
    """52 bits of a digest of the key, strictly between 0 and 1."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}|"), key)), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(2 ** 52)


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Target words of each source from (source, source_size, ...): `share` of all words by weight, none above `most` times
    its size, what is above going to the others by weight.

    Sources get the weights in turn, by code point, null last. The common level is found in closed form: sources in
    order of most * size / weight are full until the level of what is left for the rest is no longer above them. One
    row a source; the table of sources is the only thing ever put in one task.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                         ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    filled = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    table = (sizes.withColumn("weight", cycle).withColumn("cap", F.col("source_size") * float(most))
             .withColumn("full_at", F.col("cap") / F.col("weight"))
             .withColumn("all_words", F.sum("source_size").over(Window.partitionBy()) * float(share))
             .withColumn("before", F.coalesce(F.sum("cap").over(filled.rowsBetween(Window.unboundedPreceding, -1)),
                                              F.lit(0.0)))
             .withColumn("rest", F.sum("weight").over(filled.rowsBetween(0, Window.unboundedFollowing)))
             .withColumn("level", (F.col("all_words") - F.col("before")) / F.col("rest")))
    open_level = F.min(F.when(F.col("full_at") >= F.col("level"), F.struct("full_at", "level"))).over(
        Window.partitionBy())
    return (table.withColumn("open", open_level)
            .withColumn("target", F.when(F.col("open").isNull(), F.col("cap")).otherwise(
                F.least("cap", F.col("open.level") * F.col("weight"))))
            .select(*sizes.columns, "target"))


def _rank_buckets(rank: Column) -> tuple[Column, Column]:
    scaled = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), F.log(rank))) * COARSE
    coarse = F.floor(scaled)
    return coarse.cast("long"), F.floor((scaled - coarse) * FINE).cast("long")


def _cut(words: DataFrame, bucket: str, given: list[str]) -> DataFrame:
    """The first bucket of each source in which the running sum of words exceeds what is left, and what is left there.

    `words` has (source_key, bucket, words) summed up, and the columns `given`, of which `left` is the words to take.
    """
    run = Window.partitionBy("source_key").orderBy(bucket)
    return (words.withColumn("upto", F.sum("words").over(run.rowsBetween(Window.unboundedPreceding, 0)))
            .where(F.col("upto") > F.col("left"))
            .groupBy("source_key", *[c for c in given if c != "left"])
            .agg(F.min(F.struct(F.col(bucket), (F.col("left") - F.col("upto") + F.col("words")).alias("left")))
                 .alias("cut"))
            .select("source_key", *[c for c in given if c != "left"], F.col(f"cut.{bucket}").alias(bucket),
                    F.col("cut.left").alias("left")))


def mix(docs: DataFrame, weights: Sequence[float] = (3.0, 1.0, 2.0), share: float = 1.5, most: int = 2, seed: int = 7,
        key: str = "doc_id", text: str = "text", source: str = "source", preference: Column | None = None) -> DataFrame:
    """Every document with `size`, `source_size`, `target` (its source's), `copies` and `taken` (copies times size).

    `preference` (positive, default 1) makes a document's expected copies proportional to it within its source.
    """
    kept = [c for c in docs.columns if c.lower() not in RESULT]
    source_key = F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n"))
    tie = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("t"), F.md5(F.col(text))), F.lit(""))
    own = F.lit(1.0) if preference is None else F.coalesce(preference.cast("double"), F.lit(1.0))
    wide = docs.select(*[F.col(c).alias(f"__row{i}") for i, c in enumerate(kept)], source_key.alias("source_key"),
                       F.col(source).cast("string").alias("source"), tie.alias("tie"),
                       word_count(F.col(text)).alias("size"), own.alias("own"), uniform(tie, seed).alias("u"))
    slim = settle(wide.select("source_key", "source", "tie", "size", "own", "u"))

    totals = slim.groupBy("source_key", "source").agg(F.sum("size").alias("source_size"),
                                                      F.sum(F.col("size") * F.col("own")).alias("own_size"))
    plan = settle(source_targets(totals, weights, share, most).drop("source"))

    def ranked(rows: DataFrame) -> DataFrame:
        """Adds certain copies and the rank; the rank is null where nothing is left to chance."""
        expected = F.when(F.col("own_size") > 0, F.col("own") * F.col("target") / F.col("own_size")).otherwise(0.0)
        expected = F.least(expected, F.lit(float(most)))
        return (rows.withColumn("whole", F.floor(expected)).withColumn("p", expected - F.floor(expected))
                .withColumn("rank", F.when(F.col("p") > 0, (F.col("u") / (1 - F.col("u")))
                                           / (F.col("p") / (1 - F.col("p")))))
                .withColumn("coarse", _rank_buckets(F.col("rank"))[0])
                .withColumn("fine", _rank_buckets(F.col("rank"))[1]))

    rows = ranked(slim.join(plan, "source_key"))
    left = (rows.groupBy("source_key", "target").agg(F.sum(F.col("whole") * F.col("size")).alias("sure"))
            .select("source_key", (F.col("target") - F.col("sure")).alias("left")))
    chance = rows.where(F.col("rank").isNotNull())
    coarse = _cut(chance.groupBy("source_key", "coarse").agg(F.sum("size").alias("words")).join(left, "source_key"),
                  "coarse", ["left"])
    fine = settle(_cut(chance.join(coarse, ["source_key", "coarse"]).groupBy("source_key", "coarse", "left", "fine")
                       .agg(F.sum("size").alias("words")), "fine", ["coarse", "left"]))
    run = Window.partitionBy("source_key").orderBy("rank", "tie", "size").rangeBetween(Window.unboundedPreceding, 0)
    at_cut = chance.join(fine, ["source_key", "coarse", "fine"]).withColumn("upto", F.sum("size").over(run))
    inside = at_cut.groupBy("source_key").agg(
        F.max(F.when(F.col("upto") <= F.col("left"), F.struct("rank", "tie", "size"))).alias("last"),
        (F.max("left") - F.coalesce(F.max(F.when(F.col("upto") <= F.col("left"), F.col("upto"))), F.lit(0))).alias("gap"))
    cuts = settle(fine.join(inside, "source_key").select("source_key", F.struct("coarse", "fine").alias("cut_bucket"),
                                                         "last", "gap"))
    bucket, place = F.struct("coarse", "fine"), F.struct("rank", "tie", "size")
    before_cut = (bucket < F.col("cut_bucket")) | ((bucket == F.col("cut_bucket"))
                                                   & F.coalesce(place <= F.col("last"), F.lit(False)))
    later = chance.join(cuts, "source_key").where(~before_cut)
    miss = F.abs(F.col("gap") - F.col("size"))
    closing = (later.where(miss < F.col("gap")).groupBy("source_key")
               .agg(F.min(F.struct(miss.alias("miss"), "rank", "tie", "size")).alias("c"))
               .select("source_key", F.struct("c.rank", "c.tie", "c.size").alias("closing_place")))
    decided = settle(plan.join(cuts, "source_key", "left").join(closing, "source_key", "left"))

    out = ranked(wide.join(decided, "source_key"))
    sampled = F.col("rank").isNotNull() & (F.col("cut_bucket").isNull() | before_cut
                                           | F.coalesce(place == F.col("closing_place"), F.lit(False)))
    copies = (F.col("whole") + F.coalesce(sampled, F.lit(False)).cast("int")).cast("int")
    return out.select(*[F.col(f"__row{i}").alias(c) for i, c in enumerate(kept)], "size", "source_size", "target",
                      copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))


QUERY_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce(doc_id::VARCHAR, 't' || md5(text), '') AS tie FROM documents),
u AS (SELECT *, ((('0x' || substr(md5('7|' || tie), 1, 13))::BIGINT)::DOUBLE + 0.5) / {float(2 ** 52)} AS u FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM u GROUP BY source),
w AS (SELECT *, (CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0
      ELSE 2.0 END)::DOUBLE AS weight, source_size * 2.0::DOUBLE AS cap FROM s),
f AS (SELECT *, cap / weight AS full_at, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS all_words FROM w),
l AS (SELECT *, (all_words - coalesce(sum(cap) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING
      AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED
      FOLLOWING) AS level FROM f),
o AS (SELECT min({{'full_at': full_at, 'level': level}}) AS o FROM l WHERE full_at >= level),
t AS (SELECT source, source_size, CASE WHEN o.o IS NULL THEN cap ELSE least(cap, o.o.level * weight) END AS target
      FROM l, o),
e AS (SELECT u.*, t.source_size, t.target,
      least(CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END, 2.0::DOUBLE) AS expected
      FROM u JOIN t ON u.source IS NOT DISTINCT FROM t.source),
r AS (SELECT *, floor(expected) AS whole, expected - floor(expected) AS p FROM e),
q AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS rank,
      target - sum(floor(expected) * size) OVER (PARTITION BY source) AS todo FROM r),
c AS (SELECT *, sum(CASE WHEN rank IS NOT NULL THEN size END) OVER (PARTITION BY source
      ORDER BY rank NULLS LAST, tie, size RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM q),
k AS (SELECT *, rank IS NOT NULL AND upto <= todo AS inside FROM c),
g AS (SELECT *, todo - coalesce(max(CASE WHEN inside THEN upto END) OVER (PARTITION BY source), 0) AS gap FROM k),
z AS (SELECT source, min({{'miss': abs(gap - size), 'rank': rank, 'tie': tie, 'size': size}}) AS z FROM g
      WHERE rank IS NOT NULL AND NOT inside AND abs(gap - size) < gap GROUP BY source)
SELECT g.doc_id, g.size, g.source_size, g.target, ((g.whole + CASE WHEN g.inside OR (z.z IS NOT NULL AND g.rank = z.z.rank
       AND g.tie = z.z.tie AND g.size = z.z.size) THEN 1 ELSE 0 END) * g.size)::BIGINT AS taken
FROM g LEFT JOIN z ON g.source IS NOT DISTINCT FROM z.source
"""
