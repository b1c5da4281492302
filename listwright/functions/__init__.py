"""Column functions: text, filters and kinds, file names."""

from listwright.functions.filters import (
    KINDS,
    NAME_COLUMNS,
    domain,
    email_parts,
    is_email,
    is_strict_name,
    kinds,
    local_part,
    looks_like_email,
    looks_like_name,
    looks_like_token,
    pick_name_column,
)
from listwright.functions.paths import (
    REPAIR_STEPS,
    base_name,
    chunk_name,
    extension,
    file_category,
    is_binary_content,
    is_binary_extension,
    is_data_file,
    name_repair,
    name_valid,
    path_parts,
    stem,
)
from listwright.functions.text import (
    LOCAL_PART_STEPS,
    NAME_STEPS,
    STRICT_STEPS,
    collapse,
    fold_groups,
    fold_letters,
    is_ascii,
    local_part_name,
    lower,
    normalize_name,
    strip_commas,
    to_ascii,
    trim_all,
    whitelist,
)

__all__ = [
    "KINDS",
    "LOCAL_PART_STEPS",
    "NAME_COLUMNS",
    "NAME_STEPS",
    "REPAIR_STEPS",
    "STRICT_STEPS",
    "base_name",
    "chunk_name",
    "collapse",
    "domain",
    "email_parts",
    "extension",
    "file_category",
    "fold_groups",
    "fold_letters",
    "is_ascii",
    "is_binary_content",
    "is_binary_extension",
    "is_data_file",
    "is_email",
    "is_strict_name",
    "kinds",
    "local_part",
    "local_part_name",
    "looks_like_email",
    "looks_like_name",
    "looks_like_token",
    "lower",
    "name_repair",
    "name_valid",
    "normalize_name",
    "path_parts",
    "pick_name_column",
    "stem",
    "strip_commas",
    "to_ascii",
    "trim_all",
    "whitelist",
]
