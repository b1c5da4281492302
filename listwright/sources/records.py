"""Delimited text whose quoted cells hold line breaks, each file read by many tasks.

Whether a line begins inside a quoted cell depends on all lines before it. A line maps the two states
it may begin in, outside and inside of quotes, to the state it ends in; so does a split of a file, as
the composition of its lines. One pass over the text finds the splits' maps, a window over one row per
split says how each begins, and a second pass puts its lines together. A record that runs over a
split's end is put together from the lines at the edges of the splits it touches.

Lines end with ``\\n`` or ``\\r\\n``. A quote opens a cell at its start only, and two quotes within a
quoted cell are one; a quote anywhere else is text. Blank lines between records are skipped. A cell
that nothing closes ends with the last line of its file.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listwright.functions.filters import NAME_COLUMNS
from listwright.sources.lines import readable
from listwright.storage import stored

# One row per split is broadcast up to this many splits; more are joined by a shuffle.
BROADCAST_SPLITS = 200_000
_END = "\x01end"


def _text_lines(spark: SparkSession, paths: str | list[str], globs: dict) -> DataFrame:
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", bool(globs.get("recursive")))
    if globs.get("pattern"):
        reader = reader.option("pathGlobFilter", globs["pattern"])
    return reader.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_no"),
        readable("value").alias("value"),
    )


def _ends_inside(line: Column, sep: str) -> Column:
    """Whether a line that begins outside of quotes ends inside of them."""
    mark = "\\" + sep if sep != "\t" else "\t"
    single = F.replace(line, F.lit('""'), F.lit(""))
    # Whole quoted cells go first; what they leave decides most lines.
    rest = F.regexp_replace(single, rf'(^|{mark})"[^"]*"(?={mark}|\r?$)', "$1")
    pieces = F.split(single, '"')

    def step(inside: Column, i: Column) -> Column:
        before = F.get(pieces, i - 1)
        opens = F.endswith(before, F.lit(sep)) | ((i == 1) & (before == ""))
        return ~inside & opens

    walked = F.aggregate(F.sequence(F.lit(1), F.size(pieces) - 1), F.lit(False), step)
    return (
        F.when(~F.contains(line, F.lit('"')), False)
        .when(~F.contains(rest, F.lit('"')), False)
        .when(F.regexp_like(rest, F.lit(rf'^(?:[^"]*{mark})?"[^"]*$')), True)
        .otherwise(walked)
    )


def _with_maps(lines: DataFrame, sep: str) -> DataFrame:
    """Add ``from_out`` and ``from_in``: whether a line ends inside of quotes, by how it begins."""
    single = F.replace("value", F.lit('""'), F.lit(""))
    after = F.concat(F.lit("x"), F.substring(single, F.instr(single, '"') + 1, F.length(single)))
    from_in = F.when(F.contains(single, F.lit('"')), _ends_inside(after, sep)).otherwise(True)
    return lines.withColumn("from_out", _ends_inside(F.col("value"), sep)).withColumn(
        "from_in", F.when(F.contains("value", F.lit('"')), from_in).otherwise(True)
    )


def _states(from_out: np.ndarray, from_in: np.ndarray, start: bool) -> np.ndarray:
    """Before each line and after the last: whether inside of quotes."""
    flips = from_out & ~from_in
    turns = np.concatenate([[0], np.cumsum(flips)])
    fixed = np.concatenate([[False], from_out == from_in])
    last = np.maximum.accumulate(np.where(fixed, np.arange(len(fixed)), 0))
    known = np.where(last > 0, np.concatenate([[start], from_out])[last], start)
    return known ^ ((turns - turns[last]) % 2).astype(bool)


_SPLIT = (
    "file string, block bigint, ends_out boolean, ends_in boolean, head_last bigint, "
    "tail_out bigint, tail_in bigint, header string"
)
_SPLIT_KINDS = (
    pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
)


def _split_rows(batches) -> Iterator[pa.RecordBatch]:
    """One row per split: its map, the lines at its edges, and the first record of a file."""
    names = [c.split(" ")[0] for c in _SPLIT.split(", ")]
    place, held = None, []

    def summary() -> pa.RecordBatch:
        line_no, out, in_ = (np.concatenate(c) for c in list(zip(*held))[:3])
        states = [_states(out, in_, start) for start in (False, True)]
        outside = np.flatnonzero(~states[1][1:])
        head = int(line_no[outside[0]]) if len(outside) else None
        tails = [
            int(line_no[np.flatnonzero(~s[:-1])[-1]]) if s[-1] and not s[:-1].all() else None
            for s in states
        ]
        header = _first_record(states[0], [v for *_, v in held]) if place[1] == 0 else None
        row = (*place, bool(states[0][-1]), bool(states[1][-1]), head, *tails, header)
        arrays = [pa.array([v], t) for v, t in zip(row, _SPLIT_KINDS)]
        return pa.RecordBatch.from_arrays(arrays, names)

    for batch in batches:
        blocks = batch.column(1).to_numpy()
        files = batch.column(0).dictionary_encode()
        codes = files.indices.to_numpy()
        cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(codes) != 0)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(blocks)]):
            here = (files.dictionary[int(codes[start])].as_py(), int(blocks[start]))
            if here != place and held:
                yield summary()
                held = []
            place = here
            part = batch.slice(start, end - start)
            held.append((
                part.column(2).to_numpy(), part.column(3).to_numpy(False),
                part.column(4).to_numpy(False), part.column(5),
            ))
    if held:
        yield summary()


def _first_record(states: np.ndarray, values: list[pa.Array]) -> str | None:
    """The first record that is no blank line, or null if it runs over the end."""
    lines: list[str] = []
    at = 0
    for column in values:
        for value in column:
            lines.append(value.as_py())
            at += 1
            if not states[at]:
                record = "\n".join(lines).removesuffix("\r")
                if record.removeprefix("\ufeff"):
                    return record.removeprefix("\ufeff")
                lines = []
    return None


def _whole_records(batches) -> Iterator[pa.RecordBatch]:
    """The records that begin and end in their split."""
    split, held, inside, body = None, [], False, False
    for batch in batches:
        of = batch.column(0).to_numpy()
        cuts = np.flatnonzero(np.diff(of)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(of)]):
            part = batch.slice(start, end - start)
            if of[start] != split:
                # What is held is a record that goes on in the next split.
                split, held = of[start], []
                inside = part.column(5)[0].as_py()
                skip, body = inside, not part.column(6)[0].as_py()
            states = _states(part.column(3).to_numpy(False), part.column(4).to_numpy(False), inside)
            inside = bool(states[-1])
            held.append((part.column(1), part.column(2)))
            ends = np.flatnonzero(~states[1:]) + 1
            if len(ends) == 0:
                continue
            line_no, values = (pa.concat_arrays(c) for c in zip(*held))
            before = len(values) - len(part)
            bounds = np.concatenate([[0], ends + before]).astype(np.int32)
            held = [(line_no.slice(bounds[-1]), values.slice(bounds[-1]))]
            lists = pa.ListArray.from_arrays(pa.array(bounds), values.slice(0, bounds[-1]))
            records = pc.binary_join(lists, "\n")
            numbers = line_no.take(pa.array(bounds[:-1]))
            if skip:
                records, numbers, skip = records.slice(1), numbers.slice(1), False
            if not body:
                # The first record of a file that is no blank line names its columns.
                filled = pc.not_equal(pc.utf8_trim(records, "\ufeff\r"), "")
                first = pc.index(filled, True).as_py()
                body = first >= 0
                start_at = first + 1 if body else len(records)
                records, numbers = records.slice(start_at), numbers.slice(start_at)
            if len(records):
                places = pa.array(np.full(len(records), split))
                yield pa.RecordBatch.from_arrays(
                    [places, numbers, records], ["split", "line_no", "record"]
                )


def _splits(lines: DataFrame) -> DataFrame:
    """Per split: its number, whether it begins inside of quotes, the lines at its edges, and the
    split with the beginning of the record that it begins in."""
    first = F.when(F.col("block") == 0, F.col("value"))
    maps = lines.select("file", "block", "line_no", "from_out", "from_in", first.alias("value"))
    splits = stored(maps.mapInArrow(_split_rows, _SPLIT), "csv-splits")
    in_file = Window.partitionBy("file").orderBy("block")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("ends_out") == F.col("ends_in")
    flips = F.coalesce(F.sum(F.when(~fixed & F.col("ends_out"), 1).otherwise(0)).over(earlier), F.lit(0))
    last = F.last(F.when(fixed, F.struct("ends_out", "to_here")), ignorenulls=True).over(earlier)
    own = F.when(~fixed & F.col("ends_out"), 1).otherwise(0)
    splits = splits.withColumn("to_here", flips + own)
    since = F.coalesce(last["ends_out"].cast("int"), F.lit(0)) + flips - F.coalesce(last["to_here"], F.lit(0))
    splits = splits.withColumn("inside", since % 2 == 1)
    tail = F.when(F.col("inside"), F.col("tail_in")).otherwise(F.col("tail_out"))
    splits = splits.withColumn("tail", tail)
    opened = F.last(F.when(F.col("tail").isNotNull(), F.col("block")), ignorenulls=True).over(earlier)
    header = F.max("header").over(Window.partitionBy("file"))
    return splits.select(
        "file", "block", "inside", "head_last", "tail", opened.alias("opened"), header.alias("header"),
        F.monotonically_increasing_id().alias("split"),
    )


def scan_records(
    spark: SparkSession, paths: str | list[str], sep: str = ",", header: bool = True, **globs: str | bool
) -> tuple[DataFrame, DataFrame]:
    """Records ``(split, line_no, record)``, and the splits of the files with their ``header``.

    With ``header`` the first record of each file is its header and no row. A file whose first record
    is longer than a split has no header.
    """
    lines = _with_maps(_text_lines(spark, paths, globs), sep)
    splits = stored(_splits(lines), "csv-splits")
    first = (F.lit(header) & (F.col("block") == 0)).alias("first")
    few = splits.count() <= BROADCAST_SPLITS

    def with_split(*columns: str | Column) -> DataFrame:
        side = splits.select("file", "block", "split", *columns)
        return lines.join(F.broadcast(side) if few else side, ["file", "block"])

    ordered = with_split("inside", first).select(
        "split", "line_no", "value", "from_out", "from_in", "inside", "first"
    )
    if not few:
        ordered = ordered.repartition("split").sortWithinPartitions("split", "line_no")
    whole = ordered.mapInArrow(_whole_records, "split bigint, line_no bigint, record string")

    head = F.col("inside") & (F.col("head_last").isNull() | (F.col("line_no") <= F.col("head_last")))
    tail = F.col("tail").isNotNull() & (F.col("line_no") >= F.col("tail"))
    edges = with_split("inside", "head_last", "tail", "opened").where(head | tail)
    begun = F.when(head, F.col("opened")).otherwise(F.col("block"))
    parts = F.array_sort(F.collect_list(F.struct("block", "line_no", "value")))
    cut = edges.groupBy("file", begun.alias("begun")).agg(parts.alias("parts"))
    cut = cut.join(
        splits.select("file", F.col("block").alias("begun"), "split"), ["file", "begun"]
    ).select(
        "split", F.col("parts")[0]["line_no"].alias("line_no"),
        F.array_join(F.col("parts")["value"], "\n").alias("record"),
    )
    return whole.unionByName(cut), splits


def scan_cells(
    spark: SparkSession,
    paths: str | list[str],
    source: str,
    sep: str = ",",
    header: bool = True,
    column: str | None = None,
    **globs: str | bool,
) -> DataFrame:
    """``(source, file, block, line_no, original, surplus, raw)`` of all records of the files.

    ``original`` is the cell of the name column, which each file has by its own header; without a
    header it is the first one. ``surplus`` tells whether there are more cells than the header has.
    """
    records, splits = scan_records(spark, paths, sep, header, **globs)
    widest = splits.agg(F.max(F.size(F.split("header", "\\" + sep if sep != "\t" else sep)))).first()[0]
    width = max(widest or 1, 1) + 1
    names = [f"c{i}" for i in range(width)]
    options = {"sep": sep, "escape": '"'}
    schema = ", ".join(f"{name} string" for name in names)
    ended = F.concat("header", F.lit(sep), F.lit(_END))
    heads = F.array(*(F.from_csv(ended, schema, options)[name] for name in names))
    place = lambda name: F.nullif(F.array_position("heads", F.lit(name)), F.lit(0))
    none = F.raise_error(F.concat(F.lit("no header, or no such column: "), "file"))
    if not header:
        chosen = F.lit(1)
    elif column:
        chosen = place(column)
    else:
        chosen = F.coalesce(*map(place, NAME_COLUMNS), F.lit(1))
    sides = splits.withColumn("heads", heads).select(
        "file", "block", "split", (place(_END) - 1).alias("cells"), (chosen - 1).alias("chosen")
    )
    record = F.regexp_replace("record", "\r$", "")
    record = F.when(F.col("block") == 0, F.regexp_replace(record, "^\ufeff", "")).otherwise(record)
    rows = records.join(sides, "split").withColumn("raw", record).where("raw <> ''")
    cell = F.from_csv("raw", schema, options)
    rows = rows.withColumn("cell", cell)
    picked = [F.when(F.col("chosen") == i, F.col("cell")[name]) for i, name in enumerate(names)]
    over = [F.col("cell")[name].isNotNull() & (F.col("cells") <= i) for i, name in enumerate(names)]
    return rows.select(
        F.lit(source).alias("source"), "file", "block", "line_no",
        F.when(F.col("chosen").isNull() | F.col("cells").isNull(), none)
        .otherwise(F.coalesce(*picked)).alias("original"),
        reduce(or_, over).alias("surplus"), "raw",
    )
