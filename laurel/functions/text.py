"""Text expressions: accents, mojibake, tokens, replacement lists."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Mapping

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

# Executors get the UDF itself, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Letters that have no decomposition and are spelled out.
SPELLED_OUT = {
    "Đ": "D", "đ": "d", "Ł": "L", "ł": "l", "Ø": "O", "ø": "o", "Ŧ": "T", "ŧ": "t",
    "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss",
}

# First and last names as the award pages spell them → as the player list spells them.
FIRST_NAMES = {
    "Dražen": "Drazen", "Fat": "Lafayette", "J.R.": "JR", "Cliff": "Clifford", "Hot": "John", "Tiny": "Nate",
}
LAST_NAMES = {
    "Şengün": "Sengun", "Dragić": "Dragic", "Peković": "Pekovic", "Bogdanović": "Bogdanovic",
    "Vásquez": "Vasquez", "İlyasova": "Ilyasova", "Ginóbili": "Ginobili", "Türkoğlu": "Turkoglu",
    "Stojaković": "Stojakovic", "Petrović": "Petrovic", "Peace": "World Peace",
}
# Whole names whose first or last name is replaced.
FIRST_NAME_OF = {
    "Steve Smith": "Steven", "Billy Ray Bates": "Billyray", "Joe Barry Carroll": "Joe Barry",
    "Michael Ray Richardson": "Micheal Ray", "Cliff Robinson": "Clifford",
}
LAST_NAME_OF = {"Jimmy Butler": "Butler III"}

# Letters that a UTF-8 text shows when it was read as Latin-1.
MOJIBAKE_MARKS = "[ÃÂÄÅ]"

_SPELL = str.maketrans(SPELLED_OUT)


def _plain(text: str | None) -> str | None:
    if text is None or text.isascii():
        return text
    decomposed = unicodedata.normalize("NFKD", text.translate(_SPELL))
    return "".join(c for c in decomposed if unicodedata.category(c) != "Mn")


@F.pandas_udf(StringType())
def strip_accents(text: pd.Series) -> pd.Series:
    """Base letters of a text: special letters spelled out, NFKD, non-spacing marks dropped.

    Spark has no Unicode decomposition, so this is the one Arrow UDF of the text functions. Apply it
    to distinct values where a column repeats itself.
    """
    return text.map(_plain, na_action="ignore")


def stripped(text: Column) -> Column:
    """Text without surrounding white space."""
    return F.btrim(text, F.lit(" \t\n\r\f\v"))


def fix_mojibake(text: Column) -> Column:
    """Trimmed text; repaired when it is UTF-8 that was read as Latin-1, else unchanged.

    A lone `Ä` left at the end stands for a `ć` whose second byte was lost.
    """
    s = stripped(text)
    latin = s.rlike(MOJIBAKE_MARKS) & s.rlike("^[\\u0000-\\u00FF]*$")
    # Only Latin-1 text reaches the encoder, which refuses other characters.
    bytes_ = F.encode(F.when(latin, s), "ISO-8859-1")
    repaired = F.coalesce(F.try_validate_utf8(bytes_.cast("string")), s)
    return F.when(
        repaired.endswith("Ä"), F.concat(F.left(repaired, F.length(repaired) - 1), F.lit("ć"))
    ).otherwise(repaired)


def strip_or_null(text: Column) -> Column:
    """Text without surrounding blanks; NULL when nothing is left."""
    return F.nullif(stripped(text), F.lit(""))


def words(text: Column) -> Column:
    """Tokens between runs of white space."""
    return F.split(stripped(text), "\\s+")


def first_word(text: Column) -> Column:
    return F.element_at(words(text), 1)


def last_word(text: Column) -> Column:
    return F.element_at(words(text), -1)


def word_from_end(text: Column, n: int) -> Column:
    """n-th word counted from the end, NULL when there are fewer."""
    return F.try_element_at(words(text), F.lit(-n))


def replace_values(text: Column, mapping: Mapping[str, str]) -> Column:
    """Value of the mapping, or the text itself."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[text], text)


def listed_name(player: Column) -> Column:
    """Award-page name → name as the player list spells it (first and last name only)."""
    last = F.when(last_word(player) == "Jr.", word_from_end(player, 2)).otherwise(last_word(player))
    first_of = F.create_map(*[F.lit(x) for pair in FIRST_NAME_OF.items() for x in pair])[player]
    last_of = F.create_map(*[F.lit(x) for pair in LAST_NAME_OF.items() for x in pair])[player]
    first = replace_values(F.coalesce(first_of, first_word(player)), FIRST_NAMES)
    return F.concat_ws(" ", first, replace_values(F.coalesce(last_of, last), LAST_NAMES))
