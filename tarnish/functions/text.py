"""Text expressions. All stay inside the JVM; none needs a Python worker."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space for trimming and for
# the special-character class (Unicode white space plus the ASCII separators).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Characters the special-character injector draws from.
SPECIAL_CHARACTERS = ("!", "?", ".", "@", "#", "$", "*", "&", "%")

NOT_ALPHANUMERIC = f"[^a-zA-Z0-9{WHITESPACE}]"
DIGIT_RUN = r"\p{Nd}+"


def strip(c: Column) -> Column:
    """Trim every kind of white space; SQL ``trim`` alone removes spaces only."""
    return F.btrim(c, F.lit(WHITESPACE))


def collapse(c: Column) -> Column:
    """Runs of spaces become one space."""
    return F.regexp_replace(c, " {2,}", " ")


def remove_special(c: Column) -> Column:
    return F.regexp_replace(c, NOT_ALPHANUMERIC, "")


def remove_numbers(c: Column) -> Column:
    return F.regexp_replace(c, DIGIT_RUN, "")


def title(c: Column) -> Column:
    """Upper-case each letter that does not follow a letter, lower-case the rest.

    ``initcap`` starts words at spaces only ("Follow-up"); this also starts one
    after punctuation ("Follow-Up").
    """
    chars = F.split(c, "")
    before = F.concat(F.array(F.lit("")), chars)
    cased = F.zip_with(
        chars,
        F.slice(before, 1, F.greatest(F.size(chars), F.lit(1))),
        lambda ch, prev: F.when(F.upper(prev) == F.lower(prev), F.initcap(ch)).otherwise(F.lower(ch)),
    )
    return F.array_join(cased, "")


def mixed_case(c: Column, coins: Column) -> Column:
    """Each character in upper or lower case by its own coin (a hex digit)."""
    chars = F.split(c, "")
    flips = F.slice(coins, 1, F.greatest(F.size(chars), F.lit(1)))
    mixed = F.zip_with(
        chars, flips, lambda ch, coin: F.when(coin >= F.lit("8"), F.upper(ch)).otherwise(F.lower(ch))
    )
    return F.array_join(mixed, "")


TEXT_STEPS = {
    "strip": strip,
    "collapse": collapse,
    "lower": F.lower,
    "upper": F.upper,
    "remove_special": remove_special,
    "remove_numbers": remove_numbers,
}
