"""The file manifest: which files there are, of what kind, and whether they can be used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listwright.functions import is_binary_content, is_binary_extension, is_data_file, path_parts
from listwright.functions._columns import ColumnOrName, as_column
from listwright.functions.paths import DATA_EXTENSIONS, LINE_EXTENSIONS, VALID_EXTENSIONS
from listwright.sources.listing import list_files, with_first_bytes

# Files of this size and above are judged by their name alone, and the bytes of
# the others that are looked at.
PROBED_BYTES = 5 * 1024 * 1024
PROBE = 1024


def scan_manifest(spark: SparkSession, root: str, source: str | None = None) -> DataFrame:
    """Every file below ``root``, or only those of one source:
    ``(source, path, name, stem, ext, depth, length, modificationTime)``.

    The source is the first folder below the root, the depth counts folders below it.
    File contents are not read. Empty files are listed, and so are hidden ones, which no scan reads:
    see ``is_hidden``.
    """
    files = list_files(spark, f"{root.rstrip('/')}/{source}" if source else root)
    inner = _below(F.col("path"), root)
    return manifest_of(
        files, "path", F.substring_index(inner, "/", 1), F.size(F.split(inner, "/")) - 2
    )


def manifest_of(
    df: DataFrame, path: ColumnOrName, source: ColumnOrName, depth: ColumnOrName
) -> DataFrame:
    """Add the manifest columns to a table of paths."""
    extra = [c for c in df.columns if c not in ("path", "source", "depth")]
    return df.select(
        as_column(source).alias("source"),
        as_column(path).alias("path"),
        path_parts(path).alias("_parts"),
        as_column(depth).cast("int").alias("depth"),
        *extra,
    ).select("source", "path", "_parts.*", "depth", *extra)


def _below(path: Column, root: str) -> Column:
    """The path relative to the root, whatever the form of the scheme."""
    bare_root = "/" + root.split(":", 1)[-1].strip("/") + "/"
    bare = F.regexp_replace(path, r"^[a-zA-Z0-9+.-]+:/+", "/")
    return F.substring(bare, F.lit(len(bare_root) + 1), F.length(bare))


def extension_rank(ext: ColumnOrName) -> Column:
    """Reading order of an extension, null when it is not a data file's."""
    rank = F.array_position(F.lit(list(DATA_EXTENSIONS)), as_column(ext))
    return F.nullif(rank, F.lit(0)).cast("int")


def find_data_files(manifest: DataFrame) -> DataFrame:
    """Files to read per source, with ``ext_rank``; reading order is ``(ext_rank, path)``.

    A source without any data file offers all files of its top folder.
    """
    ranked = manifest.withColumn("ext_rank", extension_rank("ext"))
    found = ranked.groupBy("source").agg(F.bool_or(F.col("ext_rank").isNotNull()).alias("_any"))
    usable = F.col("ext_rank").isNotNull() | (~F.col("_any") & (F.col("depth") == 0))
    return ranked.join(found, "source").where(usable).drop("_any")


def manifest_valid(
    manifest: DataFrame, extensions: tuple[str, ...] = VALID_EXTENSIONS
) -> DataFrame:
    """Add ``valid``: a data file by its extension that is not hidden."""
    return manifest.withColumn("valid", is_data_file("name", extensions))


def has_valid_data(
    manifest: DataFrame, registry: DataFrame, extensions: tuple[str, ...] = VALID_EXTENSIONS
) -> DataFrame:
    """Per registered source, whether it has any valid data file: ``(slug, has_data)``."""
    found = (
        manifest_valid(manifest, extensions)
        .groupBy(F.col("source").alias("slug"))
        .agg(F.bool_or("valid").alias("_found"))
    )
    return (
        registry.select("slug")
        .join(found, "slug", "left")
        .select("slug", F.coalesce("_found", F.lit(False)).alias("has_data"))
    )


def binary_flags(
    spark: SparkSession,
    root: str,
    below: int | None = PROBED_BYTES,
    probe: int | None = PROBE,
) -> DataFrame:
    """``(path, is_binary, by_name, by_content)`` of every file below ``root``.

    Files of ``below`` bytes and more are not opened; their ``by_content`` is null, so that the
    caller sees which test decided. ``below=None`` opens all files, ``probe=None`` looks at
    whole files. Of other files only the first ``probe`` bytes and one more are read.
    """
    files = list_files(spark, root)
    by_name = is_binary_extension(path_parts("path")["ext"])
    by_content = is_binary_content("head", probe or (1 << 31) - 8)
    opened = files if below is None else files.where(F.col("length") < below)
    heads = with_first_bytes(opened.select("path"), probe + 1 if probe else None)
    flags = heads.select("path", by_name.alias("by_name"), by_content.alias("by_content"))
    if below is not None:
        large = files.where(F.col("length") >= below)
        unopened = F.lit(None).cast("boolean").alias("by_content")
        flags = flags.unionByName(large.select("path", by_name.alias("by_name"), unopened))
    decided = F.col("by_name") | F.coalesce("by_content", F.lit(False))
    return flags.select("path", decided.alias("is_binary"), "by_name", "by_content")


def validate_files(expected: DataFrame, manifest: DataFrame) -> DataFrame:
    """Check expected paths against the manifest: ``(path, valid)``.

    A file is valid when it is listed, a folder when a listed file lies anywhere below it.
    """
    listed = F.transform(
        F.sequence(F.lit(1), F.size(F.split("path", "/"))),
        lambda depth: F.call_function("substring_index", "path", F.lit("/"), depth),
    )
    known = (
        manifest.select(F.explode(listed).alias("path"))
        .where(F.col("path") != "")
        .distinct()
        .withColumn("_known", F.lit(True))
    )
    wanted = expected.select(F.rtrim("path", F.lit("/")).alias("path")).distinct()
    return wanted.join(known, "path", "left").select(
        "path", F.coalesce("_known", F.lit(False)).alias("valid")
    )


def validation_summary(validated: DataFrame, expected_count: int = 0) -> DataFrame:
    """One row: valid and invalid files, and whether the expected number was reached
    (always when it is 0)."""
    n_valid = F.count_if("valid")
    reached = F.lit(True) if expected_count == 0 else n_valid == expected_count
    return validated.agg(
        n_valid.alias("n_valid"),
        F.count_if(~F.col("valid")).alias("n_invalid"),
        reached.alias("as_expected"),
    )


def is_readable_extension(ext: ColumnOrName) -> Column:
    """There is a reader for this extension."""
    return as_column(ext).isin(*DATA_EXTENSIONS, *LINE_EXTENSIONS)
