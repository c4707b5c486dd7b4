"""Column helpers that read or write the text fields of a feature."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ionsift.functions.nulls import ifelse, is_true

# Patterns of the input format.
PLAIN_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
SCORE_IN_ANNOTATION = r"overall=(.*),"
HALOGEN_OR_PHOSPHORUS = r"([FP]|Br|Cl)[0-9]"
HAS_CAPITAL = r"[A-Z]"


def to_number(text: Column) -> Column:
    """Text to double; only plain decimal notation counts, so ``2D`` is not a number."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(PLAIN_NUMBER), trimmed.try_cast("double"))


def number_text(value: Column) -> Column:
    """Number as text with at most 15 significant digits and no trailing zeros."""
    digits = F.format_string("%.15g", value)
    trimmed = F.regexp_replace(digits, r"(\.[0-9]*?)0+($|e)", "$1$2")
    return F.when(value.isNotNull(), F.regexp_replace(trimmed, r"\.($|e)", "$1"))


def annotation_score(annotation: Column) -> Column:
    """The number between ``overall=`` and the last comma; anything else there is NULL."""
    return to_number(F.regexp_extract(annotation, SCORE_IN_ANNOTATION, 1))


def before(text: Column, pattern: str) -> Column:
    """What stands before the first match of a pattern."""
    return F.get(F.split(text, pattern, 2), F.lit(0))


def halogen(compound: Column) -> Column:
    """Formula names an element that scores poorly; a missing name says no."""
    return is_true(compound.rlike(HALOGEN_OR_PHOSPHORUS))


def named(compound: Column) -> Column:
    """The compound has a real name (a capital letter), not a mass label."""
    return is_true(compound.rlike(HAS_CAPITAL))


def rough_name(compound: Column) -> Column:
    """Cluster name: the first word before ``@``; a leading number is rounded to 0.1.

    Digit-led words that are not numbers have no cluster name (NULL).
    """
    word = before(before(compound, "@"), r"\s")
    numeric = word.rlike("^[0-9]")
    rounded = F.bround(to_number(word), 1)
    # A number that rounds to 0 counts as "no number" and keeps its text.
    return F.when(numeric & (rounded != 0), number_text(rounded)).when(
        ~is_true(numeric) | (rounded == 0), word
    )


def rep_digits(rep: Column) -> Column:
    """Leading digits of a replicate label, empty text when there are none."""
    return F.regexp_extract(rep, "^[0-9]*", 0)


def mass_label(mass: Column, rt: Column) -> Column:
    """Name of an unidentified feature."""
    return F.concat(
        F.coalesce(number_text(mass), F.lit("NA")), F.lit("@"), F.coalesce(number_text(rt), F.lit("NA"))
    )


def compound_label(compound: Column, low: Column, weak: Column, mass: Column, rt: Column) -> Column:
    """Keep an accepted name, else the mass label, NULL where acceptance is unknown."""
    return ifelse(~low | (low & weak), compound, mass_label(mass, rt))


def column_name(header: str) -> str:
    """Header text to a usable column name: odd characters to ``_``, no leading digit."""
    clean = re.sub(r"[^0-9A-Za-z_]", "_", header)
    return f"X{clean}" if not re.match(r"[A-Za-z]", clean) else clean


def unique_names(names: list[str]) -> list[str]:
    """Names that differ, even in lower case: a name that stands again gets the first free ``_2``, ``_3`` and so on.

    The first of equal names keeps its own, names that stand once are never changed, and an empty name becomes ``X``.
    """
    names = [n or "X" for n in names]
    seen = {n.lower() for n in names}
    taken: set[str] = set()
    out = []
    for name in names:
        new, k = name, 2
        while new.lower() in taken or (new != name and new.lower() in seen):
            new, k = f"{name}_{k}", k + 1
        taken.add(new.lower())
        out.append(new)
    return out
