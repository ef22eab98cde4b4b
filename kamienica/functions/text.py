"""Column expressions for messy text. All of them are built-in Spark functions, so they stay in codegen."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from kamienica.functions import rules

# Latin-1 letters, Latin Extended-A with the f-hook and the Romanian comma letters, Greek, Cyrillic,
# Georgian, Greek Extended.
_FOLDED_RANGES = (
    (0x00C0, 0x0192), (0x0218, 0x021B), (0x0386, 0x03CE), (0x0401, 0x0451), (0x10D0, 0x10F0),
    (0x1F00, 0x1FFF),
)


def _folded(letter: str) -> str | None:
    """The single ASCII letter that stands for `letter`, or None if it is left alone."""
    if letter in rules.LATIN_EXTRAS:
        return rules.LATIN_EXTRAS[letter]
    # Й and й keep their own entry: decomposition would strip the breve, which gives the same letter.
    base = unicodedata.normalize("NFD", letter)[0]
    if base.isascii():
        return base if base.isalpha() else None
    for alphabet in (rules.GREEK, rules.GEORGIAN):
        if base in alphabet:
            return alphabet[base]
        if base.lower() in alphabet:
            return alphabet[base.lower()].upper()
    return rules.CYRILLIC.get(base.lower())


def accent_table() -> dict[str, str]:
    """Accented and non-Latin letters to ASCII letters, plus the three separators that become `_`."""
    letters = (chr(point) for low, high in _FOLDED_RANGES for point in range(low, high + 1))
    table = {letter: _folded(letter) for letter in letters}
    return {**{k: v for k, v in table.items() if v}, **rules.NAME_SEPARATORS}


ACCENTS = accent_table()
ACCENTS_FROM, ACCENTS_TO = "".join(ACCENTS), "".join(ACCENTS.values())


def fold_accents(col: Column) -> Column:
    """ASCII form of a text column; empty text becomes null."""
    return F.nullif(F.translate(col, ACCENTS_FROM, ACCENTS_TO), F.lit(""))


def fold_name(name: str) -> str:
    """ASCII form of a column name."""
    return name.translate(str.maketrans(ACCENTS))


def safe_names(names: Sequence[str], sources: Sequence[str | None] | None = None) -> list[str]:
    """Folded, unique column names, in the given order.

    Spark matches names without regard to case, so that is how clashes are found. A name that is taken or
    empty gets its source column in front, then a number.
    """
    taken: set[str] = set()
    result = []
    for name, source in zip(names, sources or [None] * len(names)):
        folded = fold_name(name)
        wanted = folded
        if not wanted or wanted.lower() in taken:
            wanted = f"{source}_{folded}" if source else f"{folded}_"
        candidate, n = wanted, 2
        while candidate.lower() in taken:
            candidate, n = f"{wanted}_{n}", n + 1
        taken.add(candidate.lower())
        result.append(candidate)
    return result


def parse_int(col: Column) -> Column:
    """Whole number once blanks are removed, null for anything else."""
    return F.replace(col, F.lit(" "), F.lit("")).try_cast("int")


def parse_number(
    col: Column, unit: str | None = None, strip_thousands: bool = False, kind: str = "double"
) -> Column:
    """Number with a decimal comma and an optional unit; null if it still is no number.

    A blank between thousands makes the text unreadable unless `strip_thousands` is set.
    """
    text = F.replace(col, F.lit(","), F.lit("."))
    if unit:
        text = F.replace(text, F.lit(unit), F.lit(""))
    if strip_thousands:
        text = F.replace(text, F.lit(" "), F.lit(""))
    return text.try_cast(kind)


def map_words(col: Column, words: Mapping[str, str | None]) -> Column:
    """Whole-value replacement; a word mapped to None becomes null, other values stay."""
    case = None
    by_result: dict[str | None, list[str]] = {}
    for word, result in words.items():
        by_result.setdefault(result, []).append(word)
    for result, same in by_result.items():
        case = (F if case is None else case).when(col.isin(same), F.lit(result).cast("string"))
    return col if case is None else case.otherwise(col)


def split_part(col: Column, separator: str, index: int, whole_if_absent: bool = False) -> Column:
    """Part `index` of a separated text; without the separator null, or the whole text."""
    part = F.get(F.split(col, separator), index)
    return F.when(F.contains(col, F.lit(separator)), part).otherwise(col if whole_if_absent else F.lit(None))


def floor_number(col: Column) -> Column:
    """`3/10` -> 3, `parter/4` -> 0, `Poddasze` -> 15; `> 10/15` -> null."""
    return parse_int(map_words(split_part(col, "/", 0, whole_if_absent=True), rules.FLOOR_WORDS))


def floors_in_building(col: Column) -> Column:
    """`3/10` -> `10` (text); null without a slash."""
    return split_part(col, "/", 1)


def room_count(col: Column) -> Column:
    """Blanks removed and the open-ended word replaced; stays text."""
    text = F.replace(col, F.lit(" "), F.lit(""))
    for word, number in rules.ROOM_WORDS.items():
        text = F.replace(text, F.lit(word), F.lit(number))
    return text


def strip_unit(col: Column, unit: str) -> Column:
    return F.replace(col, F.lit(unit), F.lit(""))


def keyword_value(text: Column, keyword_rules: Iterable[tuple[Iterable[str], str]]) -> Column:
    """The value of the first rule one of whose keywords occurs in `text`, else null."""
    case = None
    for keywords, value in keyword_rules:
        hit = F.lit(False)
        for n, keyword in enumerate(keywords):
            found = F.contains(text, F.lit(keyword))
            hit = found if n == 0 else hit | found
        case = (F if case is None else case).when(hit, F.lit(value))
    return F.lit(None).cast("string") if case is None else case


def tokens(col: Column, separator: str = rules.LIST_SEPARATOR) -> Column:
    """The entries of a separated list; `separator` is literal text."""
    return F.split(col, f"\\Q{separator}\\E")
