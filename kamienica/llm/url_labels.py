"""A small labelled table of urls, built by rule from word lists: hosts of its own, some thousand rows, always the same.

A blocked host names one of the `UNWANTED` subjects, an allowed one a `HARMLESS` subject or only syllables. Both kinds have the
same side words, forms, subdomains, domains and paths, so that only the subject tells them apart. Split by host (`fold`) to
measure accuracy on hosts that a model has not seen; subjects occur in hosts of several folds.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Subjects of unwanted sites, subjects of others, side words, syllables frequent in English names.
UNWANTED = ("casino", "poker", "slots", "bets", "betting", "jackpot", "roulette", "lottery", "pills", "viagra", "steroids",
            "pharma", "adult", "porn", "xxx", "escort", "nude", "sex", "ads", "adserver", "popup", "spam", "phishing", "malware",
            "warez", "replica", "payday", "clickbait")
HARMLESS = ("garden", "school", "weather", "library", "museum", "recipes", "travel", "history", "science", "theatre", "music",
            "football", "hospital", "railway", "station", "council", "gallery", "kitchen", "bakery", "cycling", "nature", "forum",
            "notes", "letters", "market", "village", "physics", "methods", "nation", "education", "author", "health", "north",
            "path", "thesis", "address", "adventure", "beta", "better", "pilot")
SIDE = ("best", "cheap", "free", "win", "online", "track", "farm", "club", "world", "daily", "x", "shop")
SYLLABLES = ("the", "th", "tion", "ing", "and", "er", "re", "in", "an", "ble", "es", "ed", "sh", "wh", "ly", "ther")
DOMAINS = ("site.test", "web.test", "pages.test")
BEFORE = ("", "www.", "m.", "blog.")
LANGUAGES = ("en", "de", "fr", "es")
ENDS = ("", "/", "#top", "?page=2&ref=x", "?utm_source=feed")
FOLDS = 5


def hosts() -> Iterator[tuple[str, int]]:
    """(host name without domain, 1 if blocked)."""
    for blocked, subjects in ((1, UNWANTED), (0, HARMLESS)):
        for i, subject in enumerate(subjects):
            for j, side in enumerate(SIDE):
                glue = "" if (i + j) % 3 == 0 else "-"
                yield (subject + glue + side if (i + j) % 2 else side + glue + subject), blocked
            yield subject, blocked
    for first in SYLLABLES:
        for second in SYLLABLES:
            yield first + second, 0
            yield "th" + first + second, 0


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, blocked, fold) for two urls a host."""
    rows = []
    for name, blocked in dict(hosts()).items():
        draw = zlib.crc32(name.encode())
        host = f"{BEFORE[draw % 4]}{name}.{DOMAINS[draw // 4 % 3]}"
        for part in (draw // 12, draw // 7919):
            url = f"{'https' if part % 2 else 'http'}://{host}/{LANGUAGES[part // 2 % 4]}/{part % 997}{ENDS[part // 8 % 5]}"
            rows.append({"url": url, "blocked": blocked, "fold": draw // 16 % FOLDS})
    # As one constant that Spark takes apart itself, so that no Python process has part in it.
    table = F.from_json(F.lit(json.dumps(rows)), "array<struct<url:string,blocked:int,fold:int>>")
    return spark.range(1).select(F.inline(table))
