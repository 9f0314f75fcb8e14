"""Ordered codes looked for in a text with one scan of it."""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ANY = "_"


def _piece(char: str) -> str:
    return "." if char == ANY else re.escape(char)


def _branches(codes: Sequence[str]) -> str:
    """A pattern for the first of ``codes`` that fits at a place, branched by what they have in common.

    Where all codes go on with a letter, only those of the text's letter can fit, so they are told
    apart by it and stay in their order. Where one ends or goes on with any character, they are not.
    """
    if len(codes) == 1:
        return "".join(map(_piece, codes[0]))
    if any(not code for code in codes) or (len({code[0] for code in codes}) > 1 and any(code[0] == ANY for code in codes)):
        return "(?:" + "|".join("".join(map(_piece, code)) for code in codes) + ")"
    letters = sorted(range(len(codes)), key=lambda k: (codes[k][0], k))
    parts = []
    for letter, group in groupby(letters, key=lambda k: codes[k][0]):
        parts.append(_piece(letter) + _branches([codes[k][1:] for k in group]))
    return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"


def scan_pattern(codes: Sequence[str]) -> str:
    """Pattern whose first group is, at each place of a text, the first of ``codes`` that stands there."""
    return f"(?s)(?=({_branches(codes)}))"


def first_code(text: Column, codes: Sequence[str]) -> Column:
    """Position in ``codes`` of the first one that occurs anywhere in ``text``, or NULL.

    In any case; ``_`` in a code is any one character. The text is scanned once, whatever the number of
    codes: a look-ahead at each place finds the first code that stands there, overlapping ones too, and
    what it found is looked up. Only where ``_`` stands for a letter that codes use is it compared anew.
    """
    codes = [code.lower() for code in codes]
    fits = [re.compile("".join(map(_piece, code)), re.S) for code in codes]
    # Characters that no code names fit a code only where it takes any, so they are all alike.
    named = "".join(sorted(set("".join(codes)) - {ANY}))
    place = {code: next(k for k, fit in enumerate(fits) if fit.fullmatch(code)) for code in codes}
    known = F.create_map(*[F.lit(x) for pair in place.items() for x in pair])

    def number(found: Column) -> Column:
        plain = F.regexp_replace(found, f"[^{re.escape(named)}]", ANY) if named else F.repeat(F.lit(ANY), F.length(found))
        compared = [F.when(found.rlike(f"(?s)^{fit.pattern}\\z"), F.lit(k)) for k, fit in enumerate(fits)]
        return F.coalesce(F.try_element_at(known, plain), *compared)

    every = F.regexp_extract_all(F.lower(text), F.lit(scan_pattern(codes)), F.lit(1))
    return F.array_min(F.transform(every, number))


def owner_of_first(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """What belongs to the first code, in the order of ``rules``, that occurs in ``text``."""
    owners = F.array(*[F.lit(owner) for _, owner in rules])
    return F.get(owners, first_code(text, [code for code, _ in rules]))


def with_owner(rows: DataFrame, text: str, rules: Sequence[tuple[str, str]], name: str) -> DataFrame:
    """``rows`` with ``owner_of_first`` of a column of short texts, found once for each different text.

    Remarks are mostly made of codes, so there are few of them and Spark broadcasts what was found; where
    there are many, a frequent one is split over tasks by rows. A NULL text has no owner.
    """
    different = rows.select(F.col(text).alias("_text")).where(F.col("_text").isNotNull()).distinct()
    owned = different.select("_text", owner_of_first(F.col("_text"), rules).alias(name))
    return rows.join(owned, F.col(text) == F.col("_text"), "left").drop("_text")
