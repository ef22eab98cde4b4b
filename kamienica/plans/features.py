"""From the cleansed table to train and test feature tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kamienica.functions import rules
from kamienica.operators import encode, neighbours, outliers, profile, scale, sparse
from kamienica.operators.cleanse import MAX_COLUMNS, quoted
from kamienica.session import settle


@dataclass(frozen=True)
class FeatureConfig:
    """What `build_features` does; a step is left out by its empty, None or False setting.

    `outlier_columns` None stands for `measured_columns`. `encoding` is "one-hot", "ordinal" or "sparse"; one-hot with more
    than `most_columns` categories is encoded as sparse. `vectors` names vector columns to be taken into the features.
    """

    key: str
    target: str = rules.TARGET_COLUMN
    least_values_per_column: int | None = None
    least_values_per_row: int | None = None
    impute: str | None = "knn"
    impute_on: Sequence[str] = (*rules.LOCATION_COLUMNS, rules.TARGET_COLUMN)
    neighbours: int = 5
    text_mode: str = "mean"
    numbers_as_codes: bool = False
    by_zscore: bool = True
    by_iqr: bool = False
    rounds: int = 1
    outlier_columns: Sequence[str] | None = None
    drop_correlated: bool = True
    correlation: float = 0.75
    standard_scale: bool = True
    power_transform: bool = False
    encoding: str = "one-hot"
    most_columns: int = MAX_COLUMNS
    vectors: Sequence[str] = ()
    pca: bool = False
    pca_variance: float = 0.95
    test_share: float = 0.2
    seed: int = 123


@dataclass(frozen=True)
class Features:
    """Tables with the key, the vector `features` and `label`; `columns` names the vector before PCA, and `dictionary` has the
    (source, token, code) of its last part if categories are encoded as sparse."""

    train: DataFrame
    test: DataFrame
    columns: list[str]
    variance: list[float] | None = None
    dictionary: DataFrame | None = None


def prepare_types(clean: DataFrame) -> DataFrame:
    """Drop rows without area or floor, drop unused columns, give numbers, dates and categories their types."""
    df = profile.drop_rows_missing(clean, rules.REQUIRED_COLUMNS)
    df = profile.drop_columns(df, rules.UNUSED_COLUMNS)
    kinds = {"liczba_pokoi": "unsigned", "ktore_pietro": "bigint", "ile_pieter": "bigint", "czynsz": "decimal comma",
             "rok_budowy": "bigint", "dostepne_od": "date", **dict.fromkeys(rules.CATEGORY_COLUMNS, "string"),
             **dict.fromkeys((*rules.LOCATION_COLUMNS, rules.TARGET_COLUMN), "double")}
    return profile.cast_columns(df, {c: kind for c, kind in kinds.items() if c in df.columns})


def impute_nulls(df: DataFrame, key: str, on: Sequence[str], columns: Sequence[str] | None = None, k: int = 5,
                 text_mode: str = "mean", numbers_as_codes: bool = False) -> DataFrame:
    """Fill every column with nulls from its nearest rows. The columns of `on` come first and then stay.

    The others do not depend on each other then: each is imputed into a narrow table (key, value), and all are joined to
    the table once. Text goes through first-seen codes and back; the averaged code is cut to a whole one. With
    `numbers_as_codes` numbers are coded the same way and keep the codes. A column without any value stays empty.
    """
    missing = set(profile.columns_with_nulls(df))
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    usable = {*profile.numeric_columns(df), *(c for c, kind in kinds.items() if kind in ("string", "date"))} - {key}
    wanted = [c for c in (columns if columns is not None else df.columns) if c in missing & usable]
    values = df.agg(F.lit(0), *[F.count(quoted(c)).alias(c) for c in wanted]).first().asDict()
    wanted = [c for c in wanted if values[c]]
    for column in [c for c in wanted if c in on]:
        df = settle(neighbours.knn_impute(df, key, column, [c for c in on if c != column], k))
    narrow: dict[str, DataFrame] = {}
    for column in [c for c in wanted if c not in on]:
        rows = df.select(quoted(key), quoted(column), *[quoted(c) for c in on])
        if kinds[column] in ("string", "date") or numbers_as_codes:
            dictionary = encode.first_seen_dictionary(rows.where(quoted(column).isNotNull()), column, key)
            coded = encode.encode(rows, column, dictionary)
            found = neighbours.knn_values(coded, key, column, on, k, mode=text_mode)
            found = found.withColumn("value", F.col("value").cast("bigint"))
            if kinds[column] in ("string", "date"):
                found = encode.decode(found, "value", dictionary)
            else:  # known values become codes as well
                found = found.unionByName(coded.where(quoted(column).isNotNull()).select(
                    quoted(key).alias("query"), quoted(column).alias("value")))
        else:
            found = neighbours.knn_values(rows, key, column, on, k)
        narrow[column] = found
    if not narrow:
        return df
    for i, found in enumerate(narrow.values()):
        df = df.join(found.withColumnsRenamed({"query": f"_query{i}", "value": f"_value{i}"}),
                     quoted(key) == F.col(f"_query{i}"), "left").drop(f"_query{i}")
    place = {c: f"_value{i}" for i, c in enumerate(narrow)}

    def filled(c: str) -> Column:
        if c not in place:
            return quoted(c)
        new = F.col(place[c])
        if numbers_as_codes and kinds[c] not in ("string", "date"):
            return new.alias(c)  # codes of all rows, the known ones included
        return F.coalesce(quoted(c), new).alias(c)

    return settle(df.select(*[filled(c) for c in kinds]))


def measured_columns(df: DataFrame, target: str) -> list[str]:
    """Numeric columns whose spread says something about outliers: fractions and the known measures, the target included.

    Counts, indicators, codes and ids are whole numbers and left out: a token that few rows have would put exactly those
    rows beyond any limit. So are columns without spread.
    """
    named = {*rules.MEASURE_COLUMNS, target}
    found = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and (
        f.name in named or isinstance(f.dataType, (T.FractionalType, T.DecimalType))
        and f.name not in rules.LOCATION_COLUMNS)]
    if not found:
        return []
    row = df.agg(*[(F.min(quoted(c)) < F.max(quoted(c))).alias(f"s{i}") for i, c in enumerate(found)]).first()
    return [c for i, c in enumerate(found) if row[i]]


def build_features(df: DataFrame, config: FeatureConfig) -> Features:
    """Thresholds, imputation, outliers, correlation, scaling, encoding, split and PCA, in this order."""
    if config.least_values_per_column is not None:
        df = profile.drop_sparse_columns(df, config.least_values_per_column)
    if config.least_values_per_row is not None:
        df = profile.drop_sparse_rows(df, config.least_values_per_row)
    if config.impute == "knn":
        df = impute_nulls(df, config.key, [c for c in config.impute_on if c in df.columns], None,
                          config.neighbours, config.text_mode, config.numbers_as_codes)
    numbers = [c for c in profile.numeric_columns(df) if c != config.key]
    if config.by_zscore or config.by_iqr:
        chosen = measured_columns(df, config.target) if config.outlier_columns is None else config.outlier_columns
        had_rows = not df.isEmpty()
        df = outliers.drop_outliers(df, chosen, config.rounds, config.by_iqr, config.by_zscore)
        if had_rows and df.isEmpty():
            raise ValueError(f"the outlier filters on {', '.join(chosen)} leave no row")
    if config.drop_correlated:
        surplus = outliers.correlated_columns(df, config.correlation, numbers)
        df = df.drop(*[c for c in surplus if c != config.target])
    numbers = [c for c in numbers if c in df.columns and c != config.target]
    texts = [c for c in profile.text_columns(df) if c != config.key]
    if config.standard_scale and numbers:
        df = scale.standard_scale(df, numbers)
    if config.power_transform and numbers:
        df = scale.power_transform(df, scale.fit_powers(df, numbers))
    wide, dictionary = list(config.vectors), None
    if texts and config.encoding in ("one-hot", "sparse"):
        df = settle(df)
        if config.encoding == "sparse" or encode.category_pairs(df, texts).count() > config.most_columns:
            dictionary = sparse.category_dictionary(df, texts)
            df = sparse.one_hot(df, config.key, texts, dictionary, "_categories")
            wide.append("_categories")
        else:
            df = encode.one_hot(df, encode.categories(df, texts, config.most_columns))
    elif texts and config.encoding == "ordinal":
        df = encode.multi_column_codes(df, texts)
    columns = [c for c in profile.numeric_columns(df) if c not in (config.key, config.target)]
    # Building the features may be many joins deep; models read this table many times.
    rows = settle(df.select(quoted(config.key), *[quoted(c).cast("double").alias(c) for c in columns],
                            *[quoted(c) for c in wide], quoted(config.target)))
    train, test = scale.hash_split(rows, config.key, config.test_share, config.seed)
    train = scale.assemble(train, [*columns, *wide], config.target, [config.key])
    test = scale.assemble(test, [*columns, *wide], config.target, [config.key])
    variance = None
    if config.pca:
        train, test, variance = scale.pca_to_variance(train, test, config.pca_variance)
    return Features(train, test, [*columns, *wide], variance, dictionary)


def add_missing_category(df: DataFrame, column: str) -> DataFrame:
    """A category of its own for rows that do not say."""
    return df.withColumn(column, F.coalesce(quoted(column), F.lit(rules.FILL_NONE)))
