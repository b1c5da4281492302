"""Scans of CSV, TSV, JSON and Parquet files into line tables, and the quarantine."""

from __future__ import annotations

import fnmatch
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listwright.functions import pick_name_column
from listwright.functions.filters import NAME_COLUMNS
from listwright.functions._columns import ColumnOrName, as_column
from listwright.sources.lines import FILE_PLACE, scan_lines, scan_raw_lines, to_text
from listwright.sources.listing import (
    is_hidden,
    list_files,
    plain_path,
    scanned_forms,
    with_first_bytes,
    with_footers,
)
from listwright.sources.manifest import (
    extension_rank,
    find_data_files,
    is_readable_extension,
    scan_manifest,
)
from listwright.sources.records import scan_cells
from listwright.storage import stored

SOURCE_PLACE = ("ext_rank", *FILE_PLACE)
QUARANTINE_COLUMNS = ("source", "file", "line_no", "phase", "reason", "raw")
SURPLUS = "surplus_field"
BROKEN = "broken_record"
RAW = "raw_record"
# The first key of a JSON file is looked for in this many bytes.
_KEY_BYTES = 65_536


def scan_delimited(
    spark: SparkSession,
    paths: str | list[str],
    source: str,
    sep: str = ",",
    header: bool = True,
    column: str | None = None,
    strict: bool = False,
    same_header: bool = True,
    multi_line: bool = False,
    **globs: str | bool,
) -> DataFrame:
    """Name column of CSV or TSV files: ``(source, file, block, line_no, original)``.

    All cells are read as text. Missing cells are null. A row with too many cells is left
    out; with ``strict`` the whole file that holds it is. See ``quarantine_delimited``.
    All files have the header of the first one; with ``same_header=False`` a pass over the text
    looks for the header of each file.
    ``multi_line`` is for quoted cells that hold line breaks: see ``records``. Each file then has a
    header of its own, whatever ``same_header``.
    """
    if multi_line:
        rows = scan_cells(spark, paths, source, sep, header, column, **globs)
        good = rows.where("NOT surplus").drop("surplus", "raw")
        bad_files = rows.where("surplus").select("file").distinct()
        return good.join(bad_files, "file", "left_anti").select(good.columns) if strict else good
    options = {"header": header}
    scans = []
    for table in _delimited_tables(spark, paths, sep, header and not same_header, options, globs):
        chosen = column or pick_name_column(table.drop(SURPLUS, RAW))
        bad = F.col(SURPLUS).isNotNull().alias("_bad")
        scans.append(_placed(table, _quoted(chosen), source, bad))
    rows = _union(scans)
    good = rows.where(~F.col("_bad")).drop("_bad")
    if not strict:
        return good
    bad_files = rows.where("_bad").select("file").distinct()
    return good.join(bad_files, "file", "left_anti").select(good.columns)


def quarantine_delimited(
    spark: SparkSession,
    paths: str | list[str],
    source: str,
    sep: str = ",",
    header: bool = True,
    same_header: bool = True,
    multi_line: bool = False,
    strict: bool = False,
    **globs: str | bool,
) -> DataFrame:
    """The rows with too many cells, as quarantine rows; with ``strict`` also, once, each file
    that such a row keeps from being read."""
    if multi_line:
        rows = scan_cells(spark, paths, source, sep, header, **globs).where("surplus")
        rows = rows.withColumn("original", F.col("raw"))
    else:
        options, scans = {"header": header}, []
        tables = _delimited_tables(spark, paths, sep, header and not same_header, options, globs)
        for table in tables:
            cells = [_quoted(c) for c in table.columns if c != RAW]
            raw = F.coalesce(F.col(RAW), F.concat_ws(sep, *cells))
            scans.append(_placed(table.where(F.col(SURPLUS).isNotNull()), raw, source))
        rows = _union(scans)
    found = rows.select(*_quarantine_row("line_no", "read", "too many fields", "original"))
    if not strict:
        return found
    none = F.lit(None).cast("long").alias("line_no")
    dropped = rows.select("source", "file", none, F.col("file").alias("original")).distinct()
    return found.unionByName(
        dropped.select(*_quarantine_row("line_no", "read", "file left out", "original"))
    )


def _delimited_tables(
    spark: SparkSession,
    paths: str | list[str],
    sep: str,
    look_for_headers: bool,
    read_options: dict[str, bool],
    globs: dict,
) -> list[DataFrame]:
    """One table per distinct header. A surplus column catches the first cell too many."""
    options = {"sep": sep, "escape": '"', **read_options, **_glob_options(globs)}
    if look_for_headers:
        groups = _header_groups(spark, paths, globs)
    else:
        groups = [paths]
    tables = []
    for group in groups:
        read = options if group is paths else {**options, "recursiveFileLookup": False}
        names = [n.lstrip("\ufeff") for n in spark.read.options(**read).csv(group).columns]
        fields = [T.StructField(n, T.StringType()) for n in [*names, SURPLUS, RAW]]
        reader = spark.read.options(**read).schema(T.StructType(fields))
        tables.append(reader.option("columnNameOfCorruptRecord", RAW).csv(group))
    return tables


def _header_groups(
    spark: SparkSession, paths: str | list[str], globs: dict
) -> list[str | list[str]]:
    """Paths grouped by header line, found in one distributed pass; the driver sees one
    entry per file only when the headers differ."""
    lines = scan_raw_lines(spark, paths, "", **globs).where(F.col("block") == 0)
    if len(lines.inputFiles()) == 1:
        return [paths]
    heads = lines.groupBy("file").agg(F.min_by("value", "line_no").alias("head"))
    if heads.select("head").distinct().limit(2).count() < 2:
        return [paths]
    groups: dict[str, list[str]] = {}
    for row in heads.orderBy("file").toLocalIterator():
        groups.setdefault(row["head"], []).append(row["file"])
    return list(groups.values())


def scan_json(
    spark: SparkSession,
    paths: str | list[str],
    source: str,
    column: str | None = None,
    multi_line: bool = True,
    same_schema: bool = True,
    **globs: str | bool,
) -> DataFrame:
    """Name column of JSON files, one document per file by default, else one per line.

    Unless ``same_schema``, each file has a name column of its own: see ``_by_file``.
    """
    table = _json_table(spark, paths, multi_line, globs)
    if BROKEN in table.columns:
        whole = [_quoted(c) for c in table.columns if c != BROKEN]
        table = table.where(F.col(BROKEN).isNull()).select(*whole, "_metadata")
    if column is None and not same_schema and len(table.columns) > 1:
        firsts = _first_json_keys(spark, [paths] if isinstance(paths, str) else paths)
        return _by_file(table, source, F.monotonically_increasing_id(), firsts)
    chosen = column or pick_name_column(table)
    if column is None and len(table.columns) > 1 and chosen == table.columns[0]:
        chosen = _first_json_key(spark, paths, globs) or chosen
    return _placed(table, to_text(table, _quoted(chosen)), source)


def quarantine_json(
    spark: SparkSession,
    paths: str | list[str],
    source: str,
    multi_line: bool = True,
    **globs: str | bool,
) -> DataFrame:
    """Documents, or lines, that are no JSON, as quarantine rows. ``scan_json`` leaves them out."""
    table = _json_table(spark, paths, multi_line, globs)
    if BROKEN in table.columns:
        # Spark wants a query of broken records to name other columns as well; they are null there.
        others = [_quoted(c).isNull() for c in table.columns if c != BROKEN]
        table = table.where(F.col(BROKEN).isNotNull() & reduce(and_, others))
        rows = _placed(table, BROKEN, source)
    else:
        rows = _placed(table, F.lit(None).cast("string"), source).where("false")
    return rows.select(*_quarantine_row("line_no", "read", "no JSON", "original"))


def _json_table(
    spark: SparkSession, paths: str | list[str], multi_line: bool, globs: dict[str, str | bool]
) -> DataFrame:
    options = {"multiLine": multi_line, "primitivesAsString": True, **_glob_options(globs)}
    options["columnNameOfCorruptRecord"] = BROKEN
    table = spark.read.options(**options).json(paths)
    if table.columns == [BROKEN]:
        reader = spark.read.options(**options).schema(f"name string, {BROKEN} string")
        table = reader.json(paths)
    return table


def _first_json_key(
    spark: SparkSession, paths: str | list[str], globs: dict[str, str | bool]
) -> str | None:
    """First key of one file: the schema Spark infers is in alphabetical order. Files are opened
    until one has a line with a key; no other text is read."""
    text = spark.read.options(**_glob_options(globs)).text(paths)
    key = F.regexp_extract("value", r'^[\s\[]*\{?\s*"([^"\\]*)"\s*:', 1)
    row = text.select(key.alias("key")).where("key <> ''").first()
    return row["key"] if row else None


def scan_parquet(
    spark: SparkSession,
    paths: str | list[str],
    source: str,
    column: str | None = None,
    same_schema: bool = True,
    skip_unreadable: bool = False,
    **globs: str | bool,
) -> DataFrame:
    """Name column of Parquet files; only that column is read.

    Unless ``same_schema``, each file has a name column of its own, by its own columns in their
    order, which a pass over all footers tells. With ``skip_unreadable`` that pass also finds files
    without a readable footer, which are passed over; ``unreadable_parquet`` lists them. Any other
    read error ends the scan.
    """
    names = [paths] if isinstance(paths, str) else paths
    if skip_unreadable or not same_schema:
        return _parquet_by_file(spark, names, source, column, skip_unreadable, globs)
    table = spark.read.options(**_glob_options(globs)).parquet(*names)
    chosen = column or pick_name_column(table)
    return table.select(*_parquet_place(source), to_text(table, _quoted(chosen)).alias("original"))


def _parquet_place(source: str) -> list[Column]:
    return [
        F.lit(source).alias("source"),
        F.col("_metadata.file_path").alias("file"),
        F.lit(0).cast("long").alias("block"),
        F.col("_metadata.row_index").alias("line_no"),
    ]


def _parquet_by_file(
    spark: SparkSession,
    names: list[str],
    source: str,
    column: str | None,
    skip_unreadable: bool,
    globs: dict[str, str | bool],
) -> DataFrame:
    listed = _union([list_files(spark, name) for name in names]).select("path")
    name = F.regexp_extract("path", r"[^/]*$", 0)
    listed = listed.withColumn("name", name).where(~is_hidden())
    if globs.get("pattern"):
        listed = listed.where(F.col("name").rlike(fnmatch.translate(globs["pattern"])))
    footers = stored(with_footers(listed), "footers")
    usual = (F.when(F.array_contains("columns", c), F.lit(c)) for c in NAME_COLUMNS)
    pick = F.lit(column) if column else F.coalesce(*usual, F.get("columns", F.lit(0)))
    picks = footers.where("columns IS NOT NULL").select(_listed_path().alias("_path"), pick.alias("_pick"))
    options = {"mergeSchema": True, **_glob_options(globs)}
    schema = spark.read.options(**options, ignoreCorruptFiles=skip_unreadable).parquet(*names).schema
    table = spark.read.options(**options, ignoreCorruptFiles=False).schema(schema).parquet(*names)
    if skip_unreadable:
        # Spark leaves these out of the listing and never opens them; there is one entry per broken
        # file only.
        broken = footers.where("columns IS NULL").select("path").collect()
        lost = [form for row in broken for form in scanned_forms(row["path"])]
        table = table.where(~F.col("_metadata.file_path").isin(lost)) if lost else table
    # One entry per different name of a name column; no other column is read.
    used = sorted(r["_pick"] for r in picks.select("_pick").distinct().collect())
    texts = [to_text(table, _quoted(c)).alias(f"_{i}") for i, c in enumerate(used)]
    rows = table.select(*_parquet_place(source), *texts)
    if len(used) == 1:
        return rows.withColumnRenamed("_0", "original")
    rows = rows.withColumn("_path", plain_path(F.col("file"))).join(picks, "_path")
    values = [F.when(F.col("_pick") == c, F.col(f"_{i}")) for i, c in enumerate(used)]
    original = F.coalesce(*values) if values else F.lit(None).cast("string")
    return rows.select("source", *FILE_PLACE, original.alias("original"))


def _listed_path() -> Column:
    return F.regexp_replace("path", r"^([a-zA-Z0-9+.-]+):/+", "$1:/")


def unreadable_parquet(manifest: DataFrame) -> DataFrame:
    """Parquet files of a manifest without a readable footer, as quarantine rows; nothing but
    footers is read."""
    tables = manifest.where((F.col("ext") == ".parquet") & ~is_hidden()).select("source", "path", "name")
    return with_footers(tables).where("columns IS NULL").select(
        "source",
        F.col("path").alias("file"),
        F.lit(None).cast("long").alias("line_no"),
        F.lit("read").alias("phase"),
        F.lit("no readable footer").alias("reason"),
        F.col("name").alias("raw"),
    )


def quarantine_parquet(manifest: DataFrame, scanned: DataFrame) -> DataFrame:
    """Parquet files of a manifest that no scanned row comes from: broken or without rows.

    ``scanned`` is a scan with ``skip_unreadable`` of the same files.
    """
    tables = manifest.where((F.col("ext") == ".parquet") & ~is_hidden())
    tables = tables.withColumn("_plain", _listed_path())
    read = scanned.select(plain_path(F.col("file")).alias("_plain")).distinct()
    unread = tables.join(read, "_plain", "left_anti")
    return unread.select(
        "source",
        F.col("path").alias("file"),
        F.lit(None).cast("long").alias("line_no"),
        F.lit("read").alias("phase"),
        F.lit("no readable row").alias("reason"),
        F.col("name").alias("raw"),
    )


def _by_file(table: DataFrame, source: str, row_no: Column, firsts: DataFrame) -> DataFrame:
    """Lines of files with different columns: of each file the first usual name column with any
    value, else its own first column, which ``firsts`` names by path."""
    names = [c for c in NAME_COLUMNS if c in table.columns]
    n_usual = len(names)
    names += [c for c in table.columns if c not in names]
    rows = table.select(
        F.lit(source).alias("source"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        row_no.alias("line_no"),
        *(to_text(table, _quoted(c)).alias(f"_{i}") for i, c in enumerate(names)),
    )
    none = F.lit(None).cast("int")
    used = [F.when(F.bool_or(F.col(f"_{i}").isNotNull()), i) for i in range(len(names))]
    picked = rows.groupBy("file").agg(
        F.coalesce(*used[:n_usual], none).alias("_usual"), F.coalesce(*used, none).alias("_any")
    )
    own = F.nullif(F.array_position(F.lit(names), F.col("_first")), F.lit(0)) - 1
    picked = picked.withColumn("_path", plain_path(F.col("file"))).join(firsts, "_path", "left")
    picked = picked.select("file", F.coalesce("_usual", own.cast("int"), "_any").alias("_pick"))
    values = [F.when(F.col("_pick") == i, F.col(f"_{i}")) for i in range(len(names))]
    return rows.join(picked, "file").select(
        "source", *FILE_PLACE, F.coalesce(*values).alias("original")
    )


def _first_json_keys(spark: SparkSession, names: list[str]) -> DataFrame:
    """``(_path, _first)``: the first key of each JSON file, from the beginning of the file."""
    listed = _union([list_files(spark, name) for name in names]).select("path")
    json = listed.where(F.lower("path").endswith(".json"))
    heads = with_first_bytes(json, _KEY_BYTES)
    text = F.make_valid_utf8(F.col("head").cast("string"))
    key = F.regexp_extract(text, r'^\ufeff?[\s\[]*\{\s*"([^"\\]*)"\s*:', 1)
    return heads.select(_listed_path().alias("_path"), key.alias("_first"))


def scan_email_tables(spark: SparkSession, folder: str) -> DataFrame:
    """``(email, local_part, domain)`` of the Parquet files of a folder.

    Files without ``email`` or ``local_part`` add nothing; ``domain`` may be missing.
    """
    table = spark.read.option("mergeSchema", True).parquet(folder)
    text = [
        (F.col(name).cast("string") if name in table.columns else F.lit(None).cast("string"))
        .alias(name)
        for name in ("email", "local_part", "domain")
    ]
    return table.select(*text).where("email is not null and local_part is not null")


def scan_source(
    spark: SparkSession, root: str, slug: str, multi_line: bool = True
) -> DataFrame:
    """All data files of one source: ``(source, ext_rank, file, block, line_no, original)``.

    ``root`` holds one folder per source. Files are taken in the order CSV, text, JSON,
    Parquet, TSV, then by path. A source without such files has the plain-text and Markdown
    files of its top folder read as lines. The case of an extension does not matter, and files
    of one format may have different columns. ``multi_line`` is that of the CSV scan.
    """
    folder = f"{root.rstrip('/')}/{slug}"
    found = find_data_files(scan_manifest(spark, root, slug).where(~is_hidden()))
    present = {row["ext"]: row["listed"] for row in _formats(found).collect()}
    readers = {
        ".csv": lambda **g: scan_delimited(
            spark, folder, slug, same_header=False, multi_line=multi_line, **g
        ),
        ".txt": lambda **g: scan_lines(spark, folder, slug, **g),
        ".json": lambda **g: scan_json(spark, folder, slug, same_schema=False, **g),
        ".parquet": lambda **g: scan_parquet(
            spark, folder, slug, same_schema=False, skip_unreadable=True, **g
        ),
        ".tsv": lambda **g: scan_delimited(
            spark, folder, slug, sep="\t", strict=True, same_header=False, multi_line=multi_line, **g
        ),
    }
    scans = [
        readers[ext](pattern=_any_case(ext), recursive=True).withColumn("ext_rank", extension_rank(F.lit(ext)))
        for ext in readers
        if present.get(ext)
    ]
    if not scans and present:
        plain = scan_lines(spark, folder, slug, pattern="{*.md,*}")
        names = F.regexp_extract("file", r"[^/]*$", 0)
        lines = plain.where(~F.contains(names, F.lit(".")) | F.endswith(names, F.lit(".md")))
        scans = [lines.withColumn("ext_rank", F.lit(0))]
    if not scans:
        raise ValueError(f"no data files for source {slug} below {root}")
    return _union(scans).select("source", *SOURCE_PLACE, "original")


def _any_case(ext: str) -> str:
    return "*" + "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in ext)


def _formats(found: DataFrame) -> DataFrame:
    return found.groupBy("ext").agg(F.bool_or(F.col("ext_rank").isNotNull()).alias("listed"))


def quarantine_manifest(manifest: DataFrame) -> DataFrame:
    """Files no reader takes, as quarantine rows: of other formats, or hidden."""
    hidden = is_readable_extension("ext") & is_hidden()
    reason = F.when(hidden, "hidden file").otherwise("unsupported format")
    return manifest.where(~is_readable_extension("ext") | hidden).select(
        "source",
        F.col("path").alias("file"),
        F.lit(None).cast("long").alias("line_no"),
        F.lit("read").alias("phase"),
        reason.alias("reason"),
        F.col("name").alias("raw"),
    )


def quarantine_lines(
    lines: DataFrame, rejected: Column, phase: str, reason: str, raw: str = "original"
) -> DataFrame:
    """The lines a stage drops, as quarantine rows."""
    return lines.where(rejected).select(*_quarantine_row("line_no", phase, reason, raw))


def _quarantine_row(line_no: str, phase: str, reason: str, raw: str) -> list[Column]:
    return [
        F.col("source"),
        F.col("file").cast("string").alias("file"),
        F.col(line_no).cast("long").alias("line_no"),
        F.lit(phase).alias("phase"),
        F.lit(reason).alias("reason"),
        F.col(raw).alias("raw"),
    ]


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _placed(table: DataFrame, value: ColumnOrName, source: str, *extra: Column) -> DataFrame:
    return table.select(
        F.lit(source).alias("source"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_no"),
        as_column(value).alias("original"),
        *extra,
    )


def _glob_options(globs: dict[str, str | bool]) -> dict[str, str | bool]:
    options: dict[str, str | bool] = {"recursiveFileLookup": bool(globs.get("recursive"))}
    if globs.get("pattern"):
        options["pathGlobFilter"] = globs["pattern"]
    return options


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole
