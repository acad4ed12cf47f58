"""Hebrew numerals and page addresses as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters by value, fixed.
ONES = "אבגדהוזחט"
TENS = "יכלמנסעפצ"
HUNDREDS = "קרשת"
FINALS = {"ך": "כ", "ם": "מ", "ן": "נ", "ף": "פ", "ץ": "צ"}
#: Fifteen and sixteen are written as nine and six, nine and seven.
IRREGULAR = {"טו": 15, "טז": 16}


#: A hundred below 400, a ten, a one, at least one of them; fifteen and sixteen as above.
CANONICAL = f"^(?=.)[{HUNDREDS[:3]}]?(?:{'|'.join(IRREGULAR)}|(?!{TENS[0]}[{ONES[4:6]}])[{TENS}]?[{ONES}]?)$"


def spelled(n: int) -> str:
    """The usual spelling of 1 to 399."""
    hundreds = HUNDREDS[n // 100 - 1] if n >= 100 else ""
    rest = n % 100
    irregular = {v: k for k, v in IRREGULAR.items()}.get(rest)
    return hundreds + (irregular or (TENS[rest // 10 - 1] if rest >= 10 else "") + (ONES[rest % 10 - 1] if rest % 10 else ""))


def letter_values() -> dict[str, int]:
    out = {c: k + 1 for k, c in enumerate(ONES)} | {c: 10 * (k + 1) for k, c in enumerate(TENS)} | {c: 100 * (k + 1) for k, c in enumerate(HUNDREDS)}
    return out | {final: out[c] for final, c in FINALS.items()}


def _letters(token: Column) -> Column:
    return F.regexp_replace(token, "[\"'׳״]", "")


def numeral(token: Column) -> Column:
    """Value of 1 to 3 letters that don't ascend, null for anything else."""
    table = F.create_map(*[x for c, v in letter_values().items() for x in (F.lit(c), F.lit(v))])

    def value(values: Column) -> Column:
        descends = F.forall(F.sequence(F.lit(1), F.greatest(F.size(values) - 1, F.lit(1))), lambda k: F.coalesce(F.get(values, k - 1) >= F.get(values, k), F.lit(True)))
        whole = F.size(values).between(1, 3) & F.forall(values, lambda v: v.isNotNull())
        return F.when(whole & descends, F.aggregate(values, F.lit(0), lambda a, v: a + v))

    # the values are named once, by a lambda, or each use would read the letters again
    values = F.transform(F.array_remove(F.split(_letters(token), ""), ""), lambda c: F.element_at(table, c))
    return F.get(F.transform(F.array(values), lambda v: value(v)), 0)


def is_canonical_numeral(token: Column) -> Column:
    """Whether it is spelled just as its value, below 400, usually is."""
    return F.coalesce(_letters(token).rlike(CANONICAL), F.lit(False))


def amud(daf: Column, side: Column) -> Column:
    """Section number of a leaf's side a or b."""
    return F.when(side == "a", 2 * daf - 1).when(side == "b", 2 * daf)


def daf_of(section: Column) -> Column:
    return F.floor((section + 1) / 2).cast("int")


def side_of(section: Column) -> Column:
    return F.when(section % 2 == 1, "a").otherwise("b")


#: Words that point upwards and downwards, fixed.
ABOVE = ("לעיל", "supra", "above")
BELOW = ("לקמן", "להלן", "infra", "below")


def relative_side(text: Column) -> Column:
    """above or below, by the one kind of pointing word in the text; null where there is none or both."""
    up = F.greatest(*[F.contains(text, F.lit(w)) for w in ABOVE])
    down = F.greatest(*[F.contains(text, F.lit(w)) for w in BELOW])
    return F.when(up & ~down, "above").when(down & ~up, "below")


def on_stated_side(direction: Column, own: Column, target: Column) -> Column:
    """Whether a target lies where its pointing word says; the own place is on neither side."""
    return F.when(direction == "above", target < own).when(direction == "below", target > own).otherwise(F.lit(True))
