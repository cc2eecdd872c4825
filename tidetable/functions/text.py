"""Text cleaning used when statistics arrive as text."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(maxsize=1)
def plain_forms() -> tuple[dict[str, str], dict[str, str]]:
    """Characters whose compatibility decomposition keeps one ASCII character, and those that keep several."""
    one, several = {}, {}
    for code in (*range(0x80, 0xD800), *range(0xE000, 0x110000)):
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if ord(c) < 0x80)
        if plain:
            (one if len(plain) == 1 else several)[chr(code)] = plain
    return one, several


@lru_cache(maxsize=1)
def _spelled_blocks() -> tuple[str, str, str]:
    """A look-up table of the characters that several stand for: blocks of 256, their place, and a class of all of them.

    Both tables are texts with a separator, since Spark folds the split of a literal into one array.
    """
    several = plain_forms()[1]
    blocks = sorted({ord(c) >> 8 for c in several})
    places = ["-1"] * (blocks[-1] + 1)
    cells = []
    for n, block in enumerate(blocks):
        places[block] = str(n * 256)
        cells += [several.get(chr(block * 256 + i), "") for i in range(256)]
    return "\x01".join(places), "\x01".join(cells), "[" + "".join(f"\\x{{{ord(c):X}}}" for c in several) + "]"


def _c(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def zero_pad(value: str | Column, width: int) -> Column:
    """Left-pad with zeros; longer text is kept whole."""
    c = _c(value)
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, "0"))


def fold_accents(value: str | Column) -> Column:
    """Replace characters by the ASCII part of their compatibility decomposition; what has none is dropped.

    Combining marks are dropped as well, so decomposed text folds like composed text.
    """
    one, _ = plain_forms()
    places, cells, marks = _spelled_blocks()
    folded = F.translate(_c(value), "".join(one), "".join(one.values()))

    def spell(c: Column) -> Column:
        code = F.ascii(c)  # of the whole character, not of its first byte
        place = F.coalesce(F.get(F.split(F.lit(places), "\x01"), F.shiftright(code, 8)).cast("int"), F.lit(-1))
        plain = F.when(place >= 0, F.get(F.split(F.lit(cells), "\x01"), place + F.pmod(code, F.lit(256))))
        return F.when(F.coalesce(plain, F.lit("")) != "", plain).otherwise(c)

    # ligatures, fractions and signs are rare: their characters are looked up only where one occurs
    spelled = F.array_join(F.transform(F.split(folded, ""), spell), "")
    folded = F.when(folded.rlike(marks), spelled).otherwise(folded)
    return F.regexp_replace(folded, r"[^\x00-\x7F]", "")


def normalized_name(value: str | Column) -> Column:
    return F.lower(F.trim(fold_accents(value)))


def same_name(value: str | Column, other: str) -> Column:
    """Equality that ignores case and accents, using Spark's collation."""
    return F.collate(_c(value), "UNICODE_CI_AI") == F.lit(other)


def strip_footnotes(value: str | Column) -> Column:
    """Drop one or two trailing footnote numbers from a label."""
    return F.regexp_replace(_c(value), r"\s+\d+(\s+\d+)?$", "")


def contains_any_case(value: str | Column, part: str) -> Column:
    """Case-insensitive containment; NULL counts as no match."""
    escaped = part.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return F.coalesce(_c(value).ilike(f"%{escaped}%"), F.lit(False))


def period_parts(value: str | Column) -> Column:
    """Pieces of a dashed period such as ``2016-01``."""
    return F.split(_c(value), "-")


def unit_label(unit: str | Column, per_unit: Column | None = None) -> Column:
    """``Pricing per ...`` caption; ``per_unit`` marks series sold by the piece."""
    c = _c(unit)
    label = F.when(F.lower(c) == "kg", F.lit("Pricing per kg")).otherwise(
        F.concat(F.lit("Pricing per "), c)
    )
    if per_unit is None:
        return label
    return F.when(per_unit, F.lit("Pricing per unit")).otherwise(label)
