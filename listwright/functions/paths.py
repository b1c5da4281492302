"""Parts, validity, repair and category of file names."""

from __future__ import annotations

import mimetypes

from pyspark.sql import Column
from pyspark.sql import functions as F

from listwright.functions._columns import ColumnOrName, as_column, chain
from listwright.functions.text import trim_all

# Characters a file name must not hold, and its length limits.
BAD_NAME_CHARACTERS = r'[<>:"/\\|?*]'
MAX_NAME_LENGTH = 255
KEPT_STEM_LENGTH = 250
UNNAMED = "unnamed_file"

# Extensions of each category.
CATEGORIES = {
    "text": ("txt", "csv", "tsv", "list"),
    "archives": ("zip", "tar", "gz", "tgz", "rar", "7z"),
    "images": ("jpg", "jpeg", "png", "gif", "bmp", "svg"),
    "structured": ("json", "xml", "yaml", "yml"),
    "documents": ("md", "rst", "html", "pdf", "doc", "docx"),
}
OTHER_CATEGORY = "others"

# Extensions of binary files.
BINARY_EXTENSIONS = (
    ".zip", ".rar", ".gz", ".tar", ".7z", ".exe", ".bin", ".dat", ".pdf", ".png",
    ".jpg", ".jpeg", ".gif", ".mp3", ".mp4", ".avi", ".mov", ".mkv", ".iso", ".dll",
    ".so", ".dylib", ".jar", ".class", ".pyc", ".pyd", ".obj", ".o", ".lib", ".a",
)
# Parts of media types that are text although their main type is not.
_TEXT_MIME_PARTS = ("xml", "javascript", "application/x-executable")

# Extensions of data files in reading order, and the default set of valid ones.
DATA_EXTENSIONS = (".csv", ".txt", ".json", ".parquet", ".tsv")
LINE_EXTENSIONS = ("", ".md")
VALID_EXTENSIONS = (".txt", ".csv", ".parquet", ".json", ".tsv")


def base_name(path: ColumnOrName) -> Column:
    return F.substring_index(as_column(path), "/", -1)


def extension(name: ColumnOrName) -> Column:
    """From the last dot on, lower-case; empty for ``.hidden`` and ``name.``."""
    return F.lower(_suffix(as_column(name)))


def _suffix(name: Column) -> Column:
    return F.regexp_extract(name, r"(?s)^.+?(\.[^.]+)$", 1)


def stem(name: ColumnOrName) -> Column:
    name = as_column(name)
    return F.substring(name, F.lit(1), F.length(name) - F.length(_suffix(name)))


def path_parts(path: ColumnOrName) -> Column:
    """Struct of base name, stem and lower-case extension."""
    name = base_name(path)
    return F.struct(name.alias("name"), stem(name).alias("stem"), extension(name).alias("ext"))


def name_valid(name: ColumnOrName) -> Column:
    name = as_column(name)
    return (
        (F.length(name) <= MAX_NAME_LENGTH)
        & ~F.rlike(name, F.lit(BAD_NAME_CHARACTERS))
        & ~F.rlike(name, F.lit(r"^ |[ .]$"))
    )


def replace_bad_characters(name: ColumnOrName) -> Column:
    return F.regexp_replace(as_column(name), BAD_NAME_CHARACTERS, "_")


def fit_length(name: ColumnOrName) -> Column:
    """Cut a name that is too long, but keep its extension."""
    name = as_column(name)
    # Leading dots do not start an extension.
    ext = F.regexp_extract(name, r"(?s)^\.*[^.].*?(\.[^.]*)$", 1)
    bare = F.length(name) - F.length(ext)
    cut = F.when(ext == "", F.substring(name, 1, MAX_NAME_LENGTH)).otherwise(
        F.concat(F.substring(name, F.lit(1), F.least(bare, F.lit(KEPT_STEM_LENGTH))), ext)
    )
    return F.when(F.length(name) > MAX_NAME_LENGTH, cut).otherwise(name)


def strip_ends(name: ColumnOrName) -> Column:
    stripped = F.rtrim(trim_all(name), F.lit("."))
    return F.coalesce(F.nullif(stripped, F.lit("")), F.lit(UNNAMED))


REPAIR_STEPS = (replace_bad_characters, fit_length, strip_ends)


def name_repair(name: ColumnOrName) -> Column:
    """Valid form of a name: bad characters to ``_``, cut, stripped, never empty."""
    return chain(name, *REPAIR_STEPS)


def file_category(ext: ColumnOrName) -> Column:
    """Category of a lower-case extension, with or without its dot."""
    bare = F.ltrim(as_column(ext), F.lit("."))
    category = None
    for label, members in CATEGORIES.items():
        hit = bare.isin(*members)
        category = F.when(hit, label) if category is None else category.when(hit, label)
    return category.otherwise(OTHER_CATEGORY)


def is_data_file(name: ColumnOrName, extensions: tuple[str, ...] = VALID_EXTENSIONS) -> Column:
    """Extension among the valid ones and no leading dot."""
    name = as_column(name)
    return extension(name).isin(*extensions) & ~F.startswith(name, F.lit("."))


def _binary_by_type() -> list[str]:
    """Extensions whose registered media type is neither text, JSON, XML nor script."""
    known = mimetypes.MimeTypes(filenames=()).types_map[True]
    return sorted(
        ext
        for ext, kind in known.items()
        if not kind.startswith("text/")
        and kind != "application/json"
        and not any(part in kind for part in _TEXT_MIME_PARTS)
    )


def is_binary_extension(ext: ColumnOrName) -> Column:
    """Binary by extension alone: a known binary one, or one with a binary media type."""
    return as_column(ext).isin(*sorted({*BINARY_EXTENSIONS, *_binary_by_type()}))


def is_binary_content(content: ColumnOrName, probe: int = 1024) -> Column:
    """A zero byte or invalid UTF-8 among the first bytes.

    A character cut by the probe's end is not invalid: up to three bytes are left out.
    """
    content = as_column(content)
    head = F.substring(content, 1, probe)
    cut = F.length(content) > probe
    readable = F.is_valid_utf8(head.cast("string"))
    for dropped in (1, 2, 3):
        shorter = F.substring(content, 1, probe - dropped)
        readable = readable | (cut & F.is_valid_utf8(shorter.cast("string")))
    return F.contains(head, F.lit(bytearray(b"\x00"))) | ~readable


def chunk_name(number: ColumnOrName, prefix: str = "chunk") -> Column:
    """``chunk_001.txt`` for 1."""
    return F.format_string(prefix + "_%03d.txt", as_column(number))
