"""Phrases, captions of verdicts and evenly spaced picks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framewright.functions.rounding import round_exact

#: A phrase's noun ends before the first of these words.
JOINERS = ("with", "in", "wearing", "on", "at", "holding", "and", "that", "which", "having", "carrying", "next", "near", "behind", "beside")
#: What separates words: the white space characters of Unicode, commas counting as spaces.
_SPACE = r"[\s\x1c-\x1f\x85\xa0  -     　]"


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{_SPACE}+|{_SPACE}+$", "")


def subject_noun(phrase: Column) -> Column:
    """The words before the first joiner (any case, full stops ignored); the trimmed phrase if that leaves nothing; never null."""
    whole = F.coalesce(phrase, F.lit(""))
    words = F.filter(F.split(F.regexp_replace(whole, ",", " "), f"{_SPACE}+"), lambda w: w != "")
    is_joiner = F.transform(words, lambda w: F.regexp_replace(F.lower(w), r"^\.+|\.+$", "").isin(*JOINERS))
    first = F.array_position(is_joiner, True)
    kept = F.when(first == 0, words).otherwise(F.slice(words, F.lit(1), F.greatest(first.cast("int") - 1, F.lit(0))))
    return F.when(F.size(kept) > 0, F.array_join(kept, " ")).otherwise(_strip(whole))


def three_decimals(x: Column) -> Column:
    """A score for people: three decimals of its binary value, halves to even, or - if there is none.

    Java's own format rounds the shortest decimal half up, so it only serves for nan, inf and
    from 2^63 on, where there is no fraction and it fills digits past the shortest with zeros.
    """
    x = x.cast("double")
    size = F.abs(x)
    whole = F.floor(size)
    thousandths = F.floor(F.rint(round_exact(size - whole.cast("double"), 3) * 1000.0))
    # the text of a double also has the sign of -0.0
    sign = F.when(x.cast("string").startswith("-"), "-").otherwise("")
    exact = F.format_string("%s%d.%03d", sign, whole + F.floor(thousandths / 1000), thousandths % 1000)
    other = F.replace(F.lower(F.format_string("%.3f", x)), F.lit("infinity"), F.lit("inf"))
    return F.when(x.isNull(), "-").when(size < 2.0**63, exact).otherwise(other)


def strip_indices(total: Column, seed: Column, count: int = 8) -> Column:
    """`count` evenly spaced frames and the seed's, sorted; all frames if there are no more than that."""
    spaced = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.rint(i * (total - 1) / F.lit(count - 1)).cast("int"))
    with_seed = F.when((seed >= 0) & (seed < total), F.array(seed)).otherwise(F.array().cast("array<int>"))
    few = F.when(total > 0, F.sequence(F.lit(0), F.greatest(total - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return F.when(total <= count, few).otherwise(F.array_sort(F.array_distinct(F.concat(spaced, F.coalesce(with_seed, F.array().cast("array<int>"))))))
