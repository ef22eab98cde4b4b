"""The whole cleansing chain: raw listings to the cleansed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kamienica.functions import rules, text
from kamienica.operators import cleanse, sparse


def listing_vocabulary(raw: DataFrame) -> DataFrame:
    """Vocabulary of the five list columns, taken before any row is filtered out."""
    return cleanse.scan_vocabulary(cleanse.rename_folded(raw), rules.LIST_PLACEHOLDERS)


def clean_listings(raw: DataFrame, vocabulary: Sequence[tuple[str, str]], key: str = "ad_id",
                   keep_null_lists: bool = False, strip_thousands: bool = False,
                   accented_keywords: bool = False) -> DataFrame:
    """Cleansed listings. One stage over the raw table: filters reach the scan, nothing is shuffled.

    `key` is the natural key, kept as it is; an empty string leaves it out.
    """
    df = _cleansed(raw, key, strip_thousands, accented_keywords)
    return cleanse.multi_hot(df, list(rules.LIST_PLACEHOLDERS), vocabulary, keep_null_lists)


def clean_listings_wide(raw: DataFrame, dictionary: DataFrame, key: str = "ad_id", keep_null_lists: bool = False,
                        strip_thousands: bool = False, accented_keywords: bool = False, to: str = "tokens") -> DataFrame:
    """Cleansed listings with one sparse vector for all list columns, for vocabularies of any size.

    `dictionary` has (source, token, code): `sparse.token_dictionary` of `listing_vocabulary`, or a versioned one. `key` is
    needed and unique.
    """
    df = _cleansed(raw, key, strip_thousands, accented_keywords)
    return sparse.multi_hot(df, key, list(rules.LIST_PLACEHOLDERS), dictionary, to, keep_null_lists=keep_null_lists)


def _cleansed(raw: DataFrame, key: str, strip_thousands: bool, accented_keywords: bool) -> DataFrame:
    """All but the list columns, which are still text."""
    df = cleanse.rename_folded(raw)
    df = cleanse.drop_null_target(df, rules.TARGET_COLUMN)
    df = cleanse.keep_containing(df, "price_currency", rules.CURRENCY)
    df = df.select(*[F.col(key)] * bool(key), *[F.col(c).alias(c) for c in rules.LISTING_COLUMNS])
    df = cleanse.null_placeholders(df, rules.SCALAR_PLACEHOLDERS)
    keyword_rules = dict(rules.KEYWORD_RULES)
    if accented_keywords:
        keyword_rules["stan_wykonczenia"] = tuple(
            ((*words, value) if value not in words else words, value)
            for words, value in rules.CONDITION_KEYWORDS)
    df = cleanse.backfill_from_text(df, "opis", keyword_rules)
    return df.withColumns({
        "ktore_pietro": text.floor_number(F.col("pietro")),
        "ile_pieter": text.floors_in_building(F.col("pietro")),
        "powierzchnia": text.parse_number(F.col("powierzchnia"), rules.AREA_UNIT, strip_thousands, "float"),
        "liczba_pokoi": text.room_count(F.col("liczba_pokoi")),
        "czynsz": text.strip_unit(F.col("czynsz"), rules.RENT_UNIT),
    }).drop("pietro")
