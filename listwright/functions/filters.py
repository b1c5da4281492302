"""Predicates and kinds of lines, and the parts of an email-shaped value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwright.functions._columns import ColumnOrName, as_column, chain
from listwright.functions.text import local_part_name, lower, trim_all

# The strict form of a name, and the columns that hold names in
# order of preference.
STRICT_NAME = r"^[a-z0-9_.-]{1,32}$"
NAME_COLUMNS = (
    "nick", "nickname", "username", "user", "name", "pseudo", "handle", "forename",
    "firstname", "first_name", "surname", "lastname", "last_name", "fullname",
    "full_name", "display_name", "displayname",
)

EMAIL, NAME, TOKEN = "email", "name", "token"
KINDS = (EMAIL, NAME, TOKEN)


def is_strict_name(c: ColumnOrName) -> Column:
    return F.rlike(as_column(c), F.lit(STRICT_NAME))


def is_email(c: ColumnOrName) -> Column:
    """Something on both sides of the first ``@``."""
    c = as_column(c)
    at = F.instr(c, "@")
    return (at > 1) & (at < F.length(c))


def email_parts(c: ColumnOrName) -> Column:
    """Struct of the trimmed lower-case email, its plain local part and its domain.

    The value is split at the first ``@``; null when it is no email or nothing is left of
    the local part.
    """
    return chain(c, trim_all, lower, _split)


def _split(email: ColumnOrName) -> Column:
    def parts(v: Column) -> Column:
        found = F.struct(v["email"], v["name"].alias("local_part"), domain(v["email"]).alias("domain"))
        return F.when(is_email(v["email"]) & (v["name"] != ""), found)

    name = local_part_name(local_part(email))
    return chain(F.struct(as_column(email).alias("email"), name.alias("name")), parts)


def local_part(email: ColumnOrName) -> Column:
    """What stands before the first ``@``."""
    return F.substring_index(as_column(email), "@", 1)


def domain(email: ColumnOrName) -> Column:
    """What stands after the first ``@``."""
    email = as_column(email)
    return F.substring(email, F.instr(email, "@") + 1, F.length(email))


def looks_like_email(c: ColumnOrName) -> Column:
    """Loose test for a line that holds an email."""
    c = as_column(c)
    return F.contains(c, F.lit("@")) & F.contains(c, F.lit("."))


def looks_like_name(c: ColumnOrName) -> Column:
    c = as_column(c)
    return ~F.contains(c, F.lit("@")) & (trim_all(c) != "")


def looks_like_token(c: ColumnOrName) -> Column:
    """One word of more than six characters without ``@``."""
    c = as_column(c)
    bare = ~F.contains(c, F.lit("@")) & ~F.contains(c, F.lit(" "))
    return bare & (F.length(trim_all(c)) > 6)


def kinds(c: ColumnOrName) -> Column:
    """Array of every kind a line belongs to. Kinds overlap: a token is a name as well."""
    return F.array_compact(
        F.array(
            F.when(looks_like_email(c), F.lit(EMAIL)),
            F.when(looks_like_name(c), F.lit(NAME)),
            F.when(looks_like_token(c), F.lit(TOKEN)),
        )
    )


def pick_name_column(df: DataFrame, candidates: tuple[str, ...] = NAME_COLUMNS) -> str:
    """The first candidate among the columns, else the first column. Reads the schema only."""
    present = set(df.columns)
    return next((name for name in candidates if name in present), df.columns[0])
