"""Name cleaning, clock and season texts."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Spelling rules applied one after the other, first row first.
COMMON_SPELLING = [
    ("ņ", "n"),
    ("ģ", "g"),
    ("[čć]|Ä\x87|Ä\x8d", "c"),
    ("[šŠ]|Å\xa1", "s"),
    ("[žŽ]|Å\xbe", "z"),
    ("[đĐ]|Ä\x91", "d"),
    ("[şŞ]", "s"),
    ("[üÜ]", "u"),
    ("[öÖ]", "o"),
    ("[çÇ]", "c"),
    ("[ğĞ]", "g"),
    ("[ıİ]", "i"),
    ("[àáâãäåÀÁÂÃÄÅ]", "a"),
    ("[èéêëÈÉÊË]", "e"),
]
# Mojibake rules; the two feeds apply them before or after the common block.
MOJIBAKE_SPELLING = [("Å", "S"), ("Ã¼", "u")]
# Letters outside the rules are dropped, then a generation suffix.
NOT_PLAIN = r"[^\x00-\x7F]"
SUFFIX = r"\s+(III|II|IV|V|II)\z"

NAME_PROFILES = {
    "box_score": MOJIBAKE_SPELLING + COMMON_SPELLING,
    "injury": COMMON_SPELLING + MOJIBAKE_SPELLING,
}

# Characters after which a new word starts; an apostrophe does not start one.
_WORD_BREAKS = r"""\s\[\]\(\)\{\}/|\\<>!?@"^#$&~_,.:;*%+\-"""


def title_case(text: Column) -> Column:
    """Upper-case the first letter of each word, lower-case the rest; words also break on - and dots."""
    pieces = F.regexp_extract_all(text, F.lit(f"[{_WORD_BREAKS}]|[^{_WORD_BREAKS}]+"), F.lit(0))
    capitalized = F.transform(
        pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 2**30)))
    )
    return F.array_join(capitalized, "")


def compile_spelling(rules: list[tuple[str, str]]) -> tuple[str, str, str]:
    """(dropped, letters, replacements) that do in one pass what ordered spelling rules do one by one.

    Each rule replaces single characters or pairs of them, all outside ASCII, by ASCII. A rule for
    a pair holds only if none before it takes one of its characters; then the pair's second character
    stands for the whole. ``dropped`` is an alternation of all that goes: the first characters of pairs,
    second ones without their first, and whatever no rule knows. What is left is translated letter by letter.
    """
    singles: dict[str, str] = {}
    pairs: dict[str, str] = {}
    for pattern, replacement in rules:
        # Alternatives are literals or classes of single characters.
        for whole in re.findall(r"\[[^\]]*\]|[^|]+", pattern):
            for unit in whole[1:-1] if whole.startswith("[") else [whole]:
                if len(unit) == 1:
                    singles.setdefault(unit, replacement)
                elif not any(c in singles for c in unit):
                    pairs.setdefault(unit, replacement)
    seconds = {pair[1]: replacement for pair, replacement in pairs.items()}
    if len(seconds) < len(pairs) or seconds.keys() & {*singles, *(pair[0] for pair in pairs)}:
        raise ValueError("pairs share a character, so that one pass can't tell them apart")
    known = "".join([*singles, *seconds, *dict.fromkeys(pair[0] for pair in pairs)])
    dropped = [part for first, second in pairs for part in (f"{first}(?={second})", f"(?<!{first}){second}")]
    # A first character without its second one goes as well, unless a rule knows it.
    dropped += [first for first in dict.fromkeys(pair[0] for pair in pairs) if first not in singles]
    letters = {**singles, **seconds}
    return "|".join([*dropped, rf"[^\x00-\x7F{known}]"]), "".join(letters), "".join(letters.values())


def normalize_name(text: Column | str, profile: str) -> Column:
    """Plain-letter, suffix-free, title-cased player name; the profile fixes the rule order.

    Every spelling rule needs a character outside ASCII, so plain names skip them all; others are
    read once to drop characters and once to translate them, however many rules there are.
    """
    name = F.col(text) if isinstance(text, str) else text
    dropped, letters, replacements = compile_spelling(NAME_PROFILES[profile])
    spelled = F.translate(F.regexp_replace(name, dropped, ""), letters, replacements)
    plain = F.when(name.rlike(NOT_PLAIN), spelled).otherwise(name)
    return title_case(F.regexp_replace(plain, SUFFIX, ""))


def match_key(name: Column | str) -> Column:
    """Lower-case letters and blanks only, for comparing names of two feeds."""
    column = F.col(name) if isinstance(name, str) else name
    return F.lower(F.regexp_replace(column, "[^a-zA-Z ]", ""))


def clock_to_minutes(clock: Column | str) -> Column:
    """``MM:SS`` or a plain number as decimal minutes; null and blank give 0."""
    text = F.col(clock) if isinstance(clock, str) else clock
    minutes = F.split_part(text, F.lit(":"), F.lit(1)).try_cast("double")
    seconds = F.split_part(text, F.lit(":"), F.lit(2)).try_cast("double")
    return (
        F.when(text.isNull() | (text == ""), F.lit(0.0))
        .when(text.contains(":"), minutes + seconds / 60.0)
        .otherwise(text.try_cast("double"))
    )


def season_end_year(season: Column | str) -> Column:
    """``2025-26`` as 2026."""
    text = F.col(season) if isinstance(season, str) else season
    return F.split_part(text, F.lit("-"), F.lit(1)).cast("bigint") + F.lit(1)
