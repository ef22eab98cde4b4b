"""URL filter: fixed rules first, then logistic regression on hashed character n-grams of host and path.

Main path in DataFrame functions and Spark ML only. The n-grams are overlapping matches of one pattern, marked with the
part they come from and hashed into a fixed number of features, 1 if the n-gram occurs and 0 if not. The labelled table is a
parameter; `url_labels` has one with hosts of its own.

Defined cases: a null url, or one without `://`, has an empty host and path and no features, so the model's intercept
decides; a url is judged whole, whatever its length; with no labelled rows, or labels of one kind only, every url that no
rule fits gets that kind (allow if there are none); repeated rows are judged alike; input columns with the names of
result columns are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT = ("host", "path", "rule", "verdict", "block_probability")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """`place` is a host, or parent domain, and the start of a path, as in `example.com/en/`."""
    verdict: str
    place: str

    def fits(self, host: Column, path: Column) -> Column:
        domain, slash, start = self.place.partition("/")
        return ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(slash + start))


RULES = (Rule("allow", "com/"), Rule("block", "example.com/en/"), Rule("allow", "www.example.com/en/"),
         Rule("block", "net/es/"), Rule("block", "net/fr/"))


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def first_rule(host: Column, path: Column, rules: Sequence[Rule], value) -> Column:
    """`value(rule)` of the longest rule that fits, else null."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.place)):
        chosen = F.when(rule.fits(host, path), F.lit(value(rule))).otherwise(chosen)
    return chosen


def grams(host: Column, path: Column, widths: Sequence[int] = (3, 4)) -> Column:
    def of(part: Column, mark: str, width: int) -> Column:
        edged = F.concat(F.lit("^"), part, F.lit("$"))
        found = F.regexp_extract_all(edged, F.lit(rf"(?s)(?=(.{{{width}}}))"), F.lit(1))
        return F.transform(found, lambda g: F.concat(F.lit(mark), g))
    return F.when((host == "") & (path == ""), F.array().cast("array<string>")).otherwise(
        F.concat(*[of(part, mark, w) for part, mark in ((host, "h:"), (path, "p:")) for w in widths]))


def with_parts(urls: DataFrame, url: str) -> DataFrame:
    host, path = host_of(F.col(url)), path_of(F.col(url))
    return urls.withColumns({"__host": host, "__path": path}).withColumn("__grams", grams(F.col("__host"), F.col("__path")))


def train(labelled: DataFrame, url: str = "url", label: str = "blocked", features: int = 1 << 14) -> PipelineModel | None:
    """A model of P(blocked) from (url, blocked 0/1); None unless both labels occur. The labelled table is small."""
    rows = with_parts(labelled.where(F.col(label).isNotNull()), url).select("__grams", F.col(label).cast("double").alias("y"))
    if rows.select("y").distinct().limit(2).count() < 2:
        return None
    return Pipeline(stages=[HashingTF(numFeatures=features, binary=True, inputCol="__grams", outputCol="__x"),
                            LogisticRegression(featuresCol="__x", labelCol="y", probabilityCol="__p", rawPredictionCol="__raw",
                                               predictionCol="__y", regParam=1e-3, maxIter=40, aggregationDepth=2)]).fit(rows)


def judge(pages: DataFrame, model: PipelineModel | None, rules: Sequence[Rule] = RULES, url: str = "url",
          otherwise: str = "allow") -> DataFrame:
    """Every row with `host`, `path`, `rule`, `verdict` and `block_probability` (the model's, else null)."""
    kept = [c for c in pages.columns if c.lower() not in RESULT]
    rows = with_parts(pages.select(*[F.col(c).alias(f"__row{i}") for i, c in enumerate(kept)],
                                   F.col(url).alias("__url")), "__url")
    if model is None:
        rows = rows.withColumn("__chance", F.lit(None).cast("double"))
    else:
        rows = model.transform(rows).withColumn("__chance", vector_to_array("__p")[1])
    own = F.when(F.col("__chance").isNull(), F.lit(otherwise)).when(F.col("__chance") >= 0.5, F.lit("block")).otherwise(
        F.lit("allow"))
    host, path = F.col("__host"), F.col("__path")
    return rows.select(*[F.col(f"__row{i}").alias(c) for i, c in enumerate(kept)], host.alias("host"), path.alias("path"),
                       first_rule(host, path, rules, lambda r: r.place).alias("rule"),
                       F.coalesce(first_rule(host, path, rules, lambda r: r.verdict), own).alias("verdict"),
                       F.col("__chance").alias("block_probability"))
