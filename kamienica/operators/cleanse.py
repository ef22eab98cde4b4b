"""Cleansing operators: placeholders, keyword backfill, list columns to count columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kamienica.functions import keywords, text
from kamienica.functions.rules import LIST_SEPARATOR

# Spark's own default for the number of pivot columns.
MAX_COLUMNS = 10_000
MOST_SEARCHES = 200  # keywords searched one by one
RUNS = "array<struct<token: string, n: bigint>>"


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def surrogate_key(df: DataFrame, parts: Sequence[str], name: str = "id") -> DataFrame:
    """A key derived from the row's own natural key: the same row always gets the same key."""
    joined = F.concat_ws("\u0001", *[F.coalesce(quoted(p).cast("string"), F.lit("\u0000")) for p in parts])
    return df.withColumn(name, F.md5(joined))


def rename_folded(df: DataFrame) -> DataFrame:
    return df.toDF(*text.safe_names(df.columns))


def null_placeholders(df: DataFrame, placeholders: Mapping[str, str]) -> DataFrame:
    """Null wherever a column holds its placeholder word."""
    return df.withColumns({c: F.nullif(quoted(c), F.lit(word)) for c, word in placeholders.items()})


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    return df.where(quoted(target).isNotNull())


def keep_containing(df: DataFrame, column: str, part: str) -> DataFrame:
    """Rows whose text contains `part`; null never does."""
    return df.where(F.contains(quoted(column), F.lit(part)))


def backfill_from_text(df: DataFrame, text_column: str, rules: Mapping[str, Iterable[tuple[Iterable[str], str]]],
                       most_searches: int = MOST_SEARCHES) -> DataFrame:
    """Fill nulls from the first keyword rule that matches another column's text.

    A few keywords are searched one by one without leaving the JVM; from `most_searches` on, one automaton reads each text
    once for the rules of all columns.
    """
    rules = {column: [(tuple(words), value) for words, value in own] for column, own in rules.items()}
    if sum(len(words) for own in rules.values() for words, _ in own) <= most_searches:
        return df.withColumns({column: F.coalesce(quoted(column), text.keyword_value(quoted(text_column), own))
                               for column, own in rules.items()})
    found = df.withColumn("_found", keywords.keyword_values(quoted(text_column), rules))
    place = {column: f"v{i}" for i, column in enumerate(rules)}
    return found.select(*[F.coalesce(quoted(c), F.col("_found")[place[c]]).alias(c) if c in place else quoted(c)
                          for c in df.columns])


def tokens_long(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (),
                separator: str = LIST_SEPARATOR) -> DataFrame:
    """One row per list entry: `keep` columns, `source`, `token`. A null list gives no row."""
    def entries_of(column: str) -> Column:
        entries = F.coalesce(text.tokens(quoted(column), separator), F.array().cast("array<string>"))
        return F.transform(entries, lambda t: F.struct(F.lit(column).alias("source"), t.alias("token")))

    entries = F.flatten(F.array(*[entries_of(c) for c in columns]))
    return df.select(*[quoted(k) for k in keep], F.explode(entries).alias("_entry")).select(
        *[quoted(k) for k in keep], "_entry.source", "_entry.token")


def scan_vocabulary(df: DataFrame, placeholders: Mapping[str, str | None],
                    separator: str = LIST_SEPARATOR) -> DataFrame:
    """Distinct (source, token) of several list columns in one scan, placeholders left out.

    Duplicates are removed before the shuffle, so what moves is the vocabulary, not the tokens.
    """
    columns = list(placeholders)
    words = tokens_long(df, columns, separator=separator)
    wanted = F.lit(True)
    for column, word in placeholders.items():
        if word is not None:
            wanted = wanted & ~((F.col("source") == column) & (F.col("token") == word))
    return words.where(wanted).distinct()


def collect_vocabulary(vocabulary: DataFrame, limit: int = MAX_COLUMNS) -> list[tuple[str, str]]:
    """The vocabulary as sorted pairs, refusing one too wide to be columns."""
    rows = vocabulary.select("source", "token").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} distinct tokens; see operators.sparse for encodings of any width")
    return sorted((r["source"], r["token"]) for r in rows)


def multi_hot(df: DataFrame, columns: Sequence[str], vocabulary: Sequence[tuple[str, str]],
              keep_null_lists: bool = False, binary: bool = False,
              separator: str = LIST_SEPARATOR) -> DataFrame:
    """Replace list columns by one count column per vocabulary token.

    Every list is counted once, inside its own row, and the columns look into these counts, so there is no shuffle and no
    join. Rows with a null list are dropped, as an inner join with the counts would, unless `keep_null_lists` is set (counts
    are then 0).
    """
    if not keep_null_lists:
        present = F.lit(True)
        for column in columns:
            present = present & quoted(column).isNotNull()
        df = df.where(present)
    order = {c: n for n, c in enumerate(columns)}
    pairs = sorted(vocabulary, key=lambda pair: (order[pair[0]], pair[1]))
    kept = [c for c in df.columns if c not in order]
    names = text.safe_names(kept + [t for _, t in pairs], [None] * len(kept) + [c for c, _ in pairs])
    maps = {c: f"_counts{n}" for c, n in order.items()}
    counted = df.select(*[quoted(c) for c in kept], *[
        F.map_from_entries(runs_in_row(quoted(c), separator)).alias(m) for c, m in maps.items()])
    counts = []
    for (column, token), name in zip(pairs, names[len(kept):]):
        hits = F.col(maps[column])[F.lit(token)]
        if binary:
            hits = (hits > 0).cast("bigint")
        counts.append(F.coalesce(hits, F.lit(0)).cast("bigint").alias(name))
    return counted.select(*[quoted(c) for c in kept], *counts)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once a row; inside lambdas Spark would compute the expression for every element."""
    return F.transform(F.array(value), body)[0]


def runs_in_row(column: Column, separator: str = LIST_SEPARATOR) -> Column:
    """A list's distinct tokens in order with how often each occurs, as (token, n); null for a null list. The entries are
    sorted, so that even a long list is gone through once."""
    def runs(entries: Column) -> Column:
        first = F.filter(F.sequence(F.lit(1), F.size(entries)), lambda i: (i == 1) | (
            F.get(entries, i - 1) != F.get(entries, i - 2)))
        return _let(first, lambda at: F.transform(at, lambda i, j: F.struct(
            F.get(entries, i - 1).alias("token"),
            (F.coalesce(F.get(at, j + 1), F.size(entries) + 1) - i).cast("bigint").alias("n"))))

    return F.when(column.isNotNull(), _let(F.sort_array(text.tokens(column, separator)), runs))


def token_counts(df: DataFrame, key: str, columns: Sequence[str],
                 separator: str = LIST_SEPARATOR) -> DataFrame:
    """Token counts in long form, for vocabularies of any width: key, source, token, n.

    `key` identifies a row; its tokens are counted inside the row, so nothing is shuffled.
    """
    def counts_of(column: str) -> Column:
        return F.transform(F.coalesce(runs_in_row(quoted(column), separator), F.array().cast(RUNS)),
                           lambda r: F.struct(F.lit(column).alias("source"), r["token"].alias("token"), r["n"].alias("n")))

    counts = F.flatten(F.array(*[counts_of(c) for c in columns]))
    return df.select(quoted(key), F.inline(counts))
