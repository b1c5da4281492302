"""String functions on Columns: trimming, transliteration and the name normaliser.

Everything here is a composition of built-in expressions. One step on a column stays inside
whole-stage code generation; the functions that chain several steps in one expression bind values
to lambda variables, which Spark evaluates outside it. Over a whole table the staged form is
faster: ``add_computed`` with the same steps, as ``normalize_names`` does.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from listwright.functions._columns import ColumnOrName, as_column, chain

# The characters Unicode counts as white space, together with the
# four ASCII separators U+001C..U+001F.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: the characters a name may hold.
ALLOWED = "abcdefghijklmnopqrstuvwxyz0123456789_.- "

# Latin letters that have no canonical decomposition to one ASCII letter.
SINGLE_LETTERS = {
    "Ð": "D", "ð": "d", "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "ı": "i", "ĸ": "k",
    "Ł": "L", "ł": "l", "Ø": "O", "ø": "o", "Ŧ": "T", "ŧ": "t", "ƀ": "b", "ƒ": "f",
    "–": "-", "‐": "-", "‑": "-",
}
LETTER_GROUPS = {
    "ß": "ss", "ẞ": "SS", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Þ": "Th", "þ": "th",
    "Ĳ": "IJ", "ĳ": "ij", "Ŋ": "NG", "ŋ": "ng", "ŉ": "'n", "—": "--", "…": "...",
}

# Latin forms of Greek and Cyrillic letters; soft and hard signs are dropped.
GREEK = dict(zip("αβγδεζηικλμνξοπρςστυω", "abgdezeiklmnxoprsstuo")) | {
    "θ": "th", "φ": "ph", "χ": "kh", "ψ": "ps",
}
CYRILLIC = dict(zip("абвгдезийклмнопрстуфыэіґ", "abvgdeziiklmnoprstufyeig")) | {
    "ё": "io", "ж": "zh", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "",
    "ь": "", "ю": "iu", "я": "ia", "є": "ie", "ї": "yi", "ђ": "dj", "ј": "j", "љ": "lj",
    "њ": "nj", "ћ": "c", "џ": "dz", "ѕ": "dz", "ў": "u",
}
_SCRIPTS = GREEK | CYRILLIC
_SCRIPTS |= {k.upper(): v.capitalize() for k, v in _SCRIPTS.items() if k != "ς"}
# Accented letters of these scripts are reduced to their base.
_SCRIPT_BLOCKS = ((0x0370, 0x0530), (0x1F00, 0x2000))

# The blocks whose compatibility forms may stand for several letters: digraphs, fractions and
# roman numerals, ligatures.
_GROUP_BLOCKS = ((0x00BC, 0x00BF), (0x01C4, 0x01F4), (0x2150, 0x2180), (0xFB00, 0xFB07))
_COMBINING_MARKS = "".join(map(chr, range(0x0300, 0x0370)))


def _base(letter: str) -> str:
    """The compatibility form of a character without its marks."""
    parts = unicodedata.normalize("NFKD", letter)
    return "".join(p for p in parts if not unicodedata.combining(p)).replace("\u2044", "/")


def _plain_forms() -> dict[str, str]:
    """Characters whose compatibility form is one ASCII letter or digit, and spaces: accented,
    full-width, mathematical, raised and lowered forms."""
    pairs = {}
    for code in range(0x80, 0x20000):
        letter = chr(code)
        if unicodedata.category(letter) == "Zs":
            pairs[letter] = " "
        elif (base := _base(letter)) != letter and len(base) == 1 and base.isascii() and base.isalnum():
            pairs[letter] = base
    return pairs


def _group_forms() -> dict[str, str]:
    """Characters that stand for several ASCII ones, and letters of the other scripts."""
    groups = {
        chr(code): base
        for start, stop in _GROUP_BLOCKS
        for code in range(start, stop)
        if len(base := _base(chr(code))) > 1 and base.isascii()
    }
    for start, stop in _SCRIPT_BLOCKS:
        for letter in map(chr, range(start, stop)):
            latin = _SCRIPTS.get(letter, _SCRIPTS.get(_base(letter)))
            if latin is not None:
                groups[letter] = latin
    return groups


_GROUPS = _group_forms()
LETTERS = {
    **_plain_forms(), **{k: v for k, v in _GROUPS.items() if len(v) < 2}, **SINGLE_LETTERS,
}
RARE_GROUPS = {k: v for k, v in _GROUPS.items() if len(v) > 1 and k not in LETTER_GROUPS}


def trim_all(c: ColumnOrName) -> Column:
    """Trim every kind of Unicode white space from both ends."""
    return F.btrim(as_column(c), F.lit(WHITE_SPACE))


def lower(c: ColumnOrName) -> Column:
    return F.lower(as_column(c))


def is_ascii(c: ColumnOrName) -> Column:
    """True when the string holds one byte per character, which only ASCII does."""
    c = as_column(c)
    return F.octet_length(c) == F.char_length(c)


def to_ascii(c: ColumnOrName, extra: Mapping[str, str] | None = None) -> Column:
    """Transliterate Latin, Greek and Cyrillic letters and compatibility forms to ASCII.

    Characters outside the map stay as they are, combining marks are deleted.
    ``extra`` adds or replaces single characters, for other scripts.
    """
    return chain(
        c, lambda x: fold_letters(x, extra), lambda x: fold_groups(x, extra), fold_rare_groups
    )


def fold_letters(c: ColumnOrName, extra: Mapping[str, str] | None = None) -> Column:
    """The part of ``to_ascii`` that puts at most one character in the place of one.

    ASCII-only values skip it: that is decided per row by a byte count.
    """
    c = as_column(c)
    table = {**LETTERS, **(extra or {})}
    letters = {k: v for k, v in table.items() if len(v) == 1}
    deleted = "".join(k for k, v in table.items() if not v) + _COMBINING_MARKS
    folded = F.translate(c, "".join(letters) + deleted, "".join(letters.values()))
    return F.when(is_ascii(c), c).otherwise(folded)


def fold_groups(c: ColumnOrName, extra: Mapping[str, str] | None = None) -> Column:
    """The part of ``to_ascii`` that puts several characters in the place of one.

    After the single letters few values have anything left to do.
    """
    c = as_column(c)
    folded = c
    for letter, group in {**LETTER_GROUPS, **(extra or {})}.items():
        if len(group) > 1:
            folded = F.replace(folded, F.lit(letter), F.lit(group))
    return F.when(is_ascii(c), c).otherwise(folded)


def fold_rare_groups(c: ColumnOrName) -> Column:
    """The same for the groups of other scripts and of compatibility forms.

    They are too many to write out: so large a method would not be compiled. A loop over their
    table is evaluated for values that hold one of them, which are few.
    """
    c = as_column(c)
    some = F.regexp_like(c, F.lit("[" + "".join(RARE_GROUPS) + "]"))
    table = F.lit([part for pair in RARE_GROUPS.items() for part in pair])
    steps = F.sequence(F.lit(0), F.lit(2 * len(RARE_GROUPS) - 2), F.lit(2))
    folded = F.aggregate(
        steps, c, lambda text, i: F.replace(text, F.get(table, i), F.get(table, i + 1))
    )
    return F.when(is_ascii(c) | ~some, c).otherwise(folded)


def whitelist(c: ColumnOrName) -> Column:
    """Delete every character other than ``a-z 0-9 _ . -`` and the space.

    What is left when the allowed characters are deleted is what has to be deleted. For
    text this is several times faster than a regular expression.
    """
    c = as_column(c)
    unwanted = F.translate(c, ALLOWED, "")
    return F.call_function("translate", c, unwanted, F.lit(""))


def collapse(c: ColumnOrName) -> Column:
    """Turn each run of white space into one space and trim the ends."""
    return trim_all(F.regexp_replace(as_column(c), r"(?U)[\s\x1c-\x1f]+", " "))


def single_spaces(c: ColumnOrName) -> Column:
    """Collapse for values without other white space than spaces: rows without a double
    space are only trimmed."""
    c = as_column(c)
    single = F.when(F.contains(c, F.lit("  ")), F.regexp_replace(c, " {2,}", " "))
    return F.trim(single.otherwise(c))


def lower_or_empty(c: ColumnOrName) -> Column:
    """Lower-case form; null becomes the empty string."""
    return lower(F.coalesce(as_column(c), F.lit("")))


# The name normaliser, step by step. White space at the ends needs no trim of its own:
# what the whitelist leaves of it are spaces.
NAME_STEPS = (
    lower_or_empty, fold_letters, fold_groups, fold_rare_groups, whitelist, single_spaces,
)
# The local part of an email, whose inner spaces are not collapsed.
LOCAL_PART_STEPS = (fold_letters, fold_groups, fold_rare_groups, whitelist)
# The same without repair, for names that are kept or dropped as they are.
STRICT_STEPS = (trim_all, lower, fold_letters, fold_groups, fold_rare_groups)


def normalize_name(c: ColumnOrName) -> Column:
    """Plain form of a name: lower-case, transliterated, whitelisted, collapsed, trimmed."""
    return chain(c, *NAME_STEPS)


def local_part_name(c: ColumnOrName) -> Column:
    """Plain form of the local part of an email; inner spaces are not collapsed."""
    return chain(c, *LOCAL_PART_STEPS)


def strip_commas(c: ColumnOrName) -> Column:
    """Strip commas from the end."""
    return F.rtrim(as_column(c), F.lit(","))
