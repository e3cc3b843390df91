"""Text cleaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every Unicode space separator (general category Zs).
SPACE_SEPARATORS = (
    "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
)
# Words that stay in lower case inside a Portuguese place name.
NAME_PARTICLES = ("de", "da", "do", "das", "dos", "e")
# Fixed value: the blanks a run is squeezed from (vertical tab is not one).
BLANK_RUN = r"[ \t\n\f\r]+"


def _by_script(text: Column, plain: Column, exact: Column) -> Column:
    """The plain, much cheaper functions where the text is ASCII.

    Texts are matched once per cleaned value, so cleaning steps are combined
    below rather than nested.
    """
    return F.when(F.octet_length(text) == F.length(text), plain).otherwise(exact)


def _separators_off(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_SEPARATORS))


def _exact_lower(text: Column) -> Column:
    """Character by character: no word-final sigma, no combining dot."""
    return F.lower(F.translate(text, "İΣ", "iσ"))


def _exact_upper(text: Column) -> Column:
    """A sharp s becomes the capital one, not two letters."""
    return F.upper(F.translate(text, "ß", "ẞ"))


def strip(text: Column) -> Column:
    """Remove outer space separators; tabs and line breaks stay."""
    return _by_script(text, F.trim(text), _separators_off(text))


def squeeze(text: Column) -> Column:
    """One blank for every run of blanks, none at the ends."""
    return strip(F.regexp_replace(text, BLANK_RUN, " "))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def normal_lower(text: Column) -> Column:
    return _by_script(text, F.lower(F.trim(text)), _exact_lower(_separators_off(text)))


def normal_upper(text: Column) -> Column:
    return _by_script(text, F.upper(F.trim(text)), _exact_upper(_separators_off(text)))


def token_or(text: Column, default: str) -> Column:
    """Lower-case token, with ``default`` for NULL and blank."""
    return F.coalesce(blank_to_null(normal_lower(text)), F.lit(default))


def drop_leading_words(text: Column, *words: str) -> Column:
    """Remove the given words, in any case, from the start of the text."""
    pattern = "".join(rf"{word}[ \t\n\f\r]+" for word in words)
    return F.regexp_replace(text, rf"(?i)^[ \t\n\f\r]*{pattern}", "")


def proper_name(text: Column, particles: Sequence[str] = NAME_PARTICLES) -> Column:
    """Squeezed text with every word capitalised except the particles."""
    return _by_script(text, _ascii_names(text, particles), _exact_names(text, particles))


def _ascii_names(text: Column, particles: Sequence[str]) -> Column:
    """All words capitalised, then the first letters of particles made small again."""
    shown = F.initcap(F.lower(F.trim(F.regexp_replace(text, BLANK_RUN, " "))))
    for first in sorted({p[0] for p in particles}):
        rests = "|".join(p[1:] for p in particles if p[0] == first)
        shown = F.regexp_replace(shown, f"(?<![^ ]){first.upper()}(?=(?:{rests})(?![^ ]))", first)
    return shown


def _exact_names(text: Column, particles: Sequence[str]) -> Column:
    words = F.split(normal_lower(F.regexp_replace(text, BLANK_RUN, " ")), " ")
    capitalised = F.transform(
        words,
        lambda w: F.when(w.isin(*particles), w).otherwise(
            F.concat(_exact_upper(F.substring(w, 1, 1)), F.substring(w, 2, 2**31 - 1))
        ),
    )
    return F.array_join(capitalised, " ")


def label_by_prefix(text: Column, labels: Mapping[str, str]) -> Column:
    """Label of the first prefix the normalised text starts with, else NULL."""
    token = normal_lower(text)
    label = F
    for prefix, value in labels.items():
        label = label.when(token.startswith(prefix), F.lit(value))
    return label
