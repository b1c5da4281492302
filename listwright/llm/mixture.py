"""Mixing sources to target weights: blocks of equal size, apportioned by highest quotients.

The words of a source, its documents in a seeded order, are cut into blocks of ``block_words``. The
mix takes as many blocks as all sources have words for. They are dealt to the sources by Sainte-Laguë:
the next block goes where ``target / (2 * blocks so far + 1)`` is highest. Neighbouring blocks of a
source form a shard, and the blocks of a source are dealt to its shards in the same way, by the
blocks they hold. So each shard has a whole number of blocks to give: each of its blocks as often as
that number allows, and the rest once more, by the lowest seeded hashes.

Targets share the words of all sources by weight. A target stops at ``most_copies`` times the words
of its source, and what is above is shared among the others, until no target is above.

Only DataFrame functions are used. Texts are read once; what moves is a row of numbers per document.
Shards hold about as many blocks as there are shards, so neither side outgrows a task, and documents
are placed within a source by buckets of about a shard each, so a source may hold most of the rows.
Highest quotients need no list of all quotients: two bounds of the divisor leave about three
candidates a source, or a shard.

A null text has no words; a null source is a source of its own, the last one. Documents without words
take nothing. Rows are mixed one by one: equal ones stand next to each other and are taken as their
blocks are. An empty table gives an empty mix. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listwright.storage import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
BLOCK_WORDS = 64
SEED = "mix"
# One row per source goes through one task and is broadcast; more sources than this are an error.
MOST_SOURCES = 1_000_000


def _number(text: Column) -> Column:
    """A number below 2^40 from the MD5 of a text."""
    return F.conv(F.substring(F.md5(text), 1, 10), 16, 10).cast("long")


def _earlier(column: str, window: Window) -> Column:
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(before), F.lit(0))


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_copies: int = MOST_COPIES
) -> DataFrame:
    """Per source of ``sizes(source, size)``: its number in order, ``source_size`` and ``target``.

    A source is at its limit when the share it would get of what the sources before it, in the order
    of limit per weight, leave over is not below the limit.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    every = by_name.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    too_many = F.raise_error(F.lit(f"there are more than {MOST_SOURCES} sources"))
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("number", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(
            F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int")))
        .withColumn("limit", F.col("source_size") * most_copies)
        .withColumn("total", F.when(
            F.count("*").over(every) <= MOST_SOURCES, F.sum("source_size").over(every)
        ).otherwise(too_many))
    )
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "number")
    left = F.col("total") - _earlier("limit", by_limit)
    weight_left = F.sum("weight").over(every) - _earlier("weight", by_limit)
    sources = sources.withColumn("full", left / weight_left * F.col("weight") >= F.col("limit"))
    rest = F.col("total") - F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0)).over(every)
    weight_rest = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(every)
    share = F.try_divide(rest, weight_rest) * F.col("weight")
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(share)
    return sources.withColumn("target", target).select(
        "source", "number", "source_size", "total", "target"
    )


def apportioned(
    claims: DataFrame, seats: str, weight: str, order: str, group: tuple[str, ...] = ()
) -> DataFrame:
    """Add ``quota``: of the ``seats`` of its group, those of each claim by highest quotients.

    Equal quotients go by ``order``. With weights ``w`` of sum W and S claims in a group, rounding
    ``w * (seats - S / 2) / W`` gives no more than all seats, and ``w * (seats + S / 2) / W`` no
    fewer. A claim's seats lie between, and only these quotients are ranked.
    """
    whole = Window.partitionBy(*group)
    claims = claims.withColumn("_sum", F.sum(F.col(weight).cast("double")).over(whole))
    half = F.count(F.when(F.col(weight) > 0, 1)).over(whole) / 2

    def rounded(of: Column) -> Column:
        part = F.try_divide(F.col(weight) * F.greatest(of, F.lit(0.0)), F.col("_sum"))
        return F.floor(F.coalesce(part, F.lit(0.0)) + 0.5)

    low = F.greatest(rounded(F.col(seats) - half) - 1, F.lit(0))
    claims = claims.withColumn("_low", low).withColumn("_high", rounded(F.col(seats) + half) + 1)
    claims = claims.withColumn("_open", F.col(seats) - F.sum("_low").over(whole))
    offers = F.when(F.col(weight) > 0, F.sequence("_low", F.col("_high") - 1))
    bids = claims.select(*group, order, weight, "_open", F.explode(offers).alias("_n"))
    ranking = whole.orderBy(F.desc(F.col(weight) / (2 * F.col("_n") + 1)), order)
    won = (
        bids.withColumn("_rank", F.row_number().over(ranking))
        .where("_rank <= _open")
        .groupBy(*group, order)
        .agg(F.count("*").alias("_won"))
    )
    quota = F.col("_low") + F.coalesce("_won", F.lit(0))
    return claims.join(won, [*group, order], "left").withColumn("quota", quota).drop(
        "_sum", "_low", "_high", "_open", "_won"
    )


def _shards(sources: DataFrame, most_copies: int, seed: str) -> DataFrame:
    """Per shard: its first block, ``copies`` of each block, and the hash up to which one more."""
    first = F.col("shard") * F.col("per_shard")
    shards = sources.where("n_shards > 0").select(
        "number", "name", "per_shard", F.col("quota").alias("of_source"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_shards") - 1)).alias("shard"),
        "n_blocks",
    ).withColumn("blocks", F.least("per_shard", F.col("n_blocks") - first))
    shards = apportioned(shards, "of_source", "blocks", "shard", ("number",))
    hashes = F.transform(
        F.sequence(first, first + F.col("blocks") - 1),
        lambda b: _block_hash(F.col("name"), b, first, seed),
    )
    extra = (F.col("quota") % F.col("blocks")).cast("int")
    last = F.when(extra > 0, F.element_at(F.array_sort(hashes), F.greatest(extra, F.lit(1))))
    return shards.select(
        "number", "shard", first.alias("first_block"),
        (first + F.col("blocks")).alias("end_block"),
        F.floor(F.col("quota") / F.col("blocks")).alias("copies"),
        F.coalesce(last, F.lit(-1)).alias("last_hash"),
    )


def _block_hash(name: Column, block: Column, first: Column, seed: str) -> Column:
    """A seeded number that no other block of a shard has (a shard has below 2^22 blocks)."""
    text = F.concat(F.lit(f"{seed}|"), name, F.lit("|"), block.cast("string"))
    return _number(text) * (1 << 22) + (block - first)


def mixed(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most_copies: int = MOST_COPIES,
    block_words: int = BLOCK_WORDS,
    seed: str = SEED,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """Per document: key, ``size``, ``source_size``, ``target`` and ``spans``.

    ``spans`` are runs of its words, from ``start`` to before ``end``, each in the mix ``copies``
    times; runs without copies are left out.
    """
    rows = docs.select(
        F.col(key).alias("key"), F.col(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        _number(F.concat_ws("|", F.lit(seed), F.col(key).cast("string"),
                            F.md5(F.coalesce(F.col(text), F.lit(""))))).alias("hash"),
    )
    rows = stored(rows, "mixture-sizes")
    sources = source_targets(rows, weights, most_copies)
    sources = sources.withColumn("n_blocks", F.ceil(F.col("source_size") / block_words))
    per_shard = F.ceil(F.sqrt(F.sum("n_blocks").over(Window.partitionBy())))
    seats = F.floor(F.col("total") / block_words + 0.5)
    sources = sources.select(
        "*", seats.alias("seats"), per_shard.alias("per_shard"),
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("name"),
        F.coalesce(F.ceil(F.try_divide("n_blocks", per_shard)), F.lit(0)).alias("n_shards"),
    )
    sources = apportioned(sources, "seats", "target", "number")
    # A target is within this limit, so only what was rounded up is cut.
    limit = F.col("n_blocks") * most_copies
    sources = stored(sources.withColumn("quota", F.least("quota", limit)), "mixture-sources")
    shards = _shards(sources, most_copies, seed)

    bounded = F.broadcast(sources)  # at most MOST_SOURCES rows, see source_targets
    placed = rows.join(bounded, rows["source"].eqNullSafe(sources["source"])).select(
        "key", "size", "hash", "number", "name", "source_size", "target", "per_shard",
        F.pmod("hash", F.greatest("n_shards", F.lit(1))).alias("bucket"),
    )
    buckets = placed.groupBy("number", "bucket").agg(F.sum("size").alias("words"))
    in_source = Window.partitionBy("number").orderBy("bucket")
    starts = buckets.select("number", "bucket", _earlier("words", in_source).alias("start"))
    in_bucket = Window.partitionBy("number", "bucket").orderBy("hash", "key", "size")
    placed = (
        placed.withColumn("row", F.row_number().over(in_bucket))
        .withColumn("at", _earlier("size", in_bucket))
        .join(starts, ["number", "bucket"])
        .withColumn("at", F.col("at") + F.col("start"))
    )

    per = F.col("per_shard") * block_words
    covered = F.sequence(
        F.floor(F.col("at") / per), F.floor((F.col("at") + F.col("size") - 1) / per)
    )
    parts = placed.withColumn("shard", F.explode_outer(F.when(F.col("size") > 0, covered)))
    parts = parts.join(shards, ["number", "shard"], "left")
    end = F.col("at") + F.col("size")
    low = F.greatest("first_block", F.floor(F.col("at") / block_words))
    high = F.least(F.col("end_block") - 1, F.floor((end - 1) / block_words))

    def span(block: Column) -> Column:
        hashed = _block_hash(F.col("name"), block, F.col("first_block"), seed)
        return F.struct(
            (F.greatest(F.col("at"), block * block_words) - F.col("at")).alias("start"),
            (F.least(end, (block + 1) * block_words) - F.col("at")).alias("end"),
            (F.col("copies") + (hashed <= F.col("last_hash")).cast("long")).alias("copies"),
        )

    spans = F.filter(F.transform(F.sequence(low, high), span), lambda s: s["copies"] > 0)
    whole = ("number", "bucket", "row", "key", "size", "source_size", "target")
    gathered = F.array_sort(F.flatten(F.collect_list("spans")))
    return (
        parts.withColumn("spans", spans)
        .groupBy(*whole)
        .agg(gathered.alias("spans"))
        .select(F.col("key").alias(key), "size", "source_size", "target", "spans")
    )


def words_taken(spans: Column) -> Column:
    """The words of all copies of a document's spans."""
    one = lambda s: (s["end"] - s["start"]) * s["copies"]
    return F.aggregate(spans, F.lit(0).cast("long"), lambda sum_, s: sum_ + one(s))


def mixed_texts(mix: DataFrame, docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, start, copy, text)``: the words of each span, once per copy, joined by spaces.

    The keys of ``docs`` must be unique.
    """
    runs = mix.select(key, F.explode("spans").alias("span"))
    words = F.regexp_extract_all(F.col(text), F.lit(f"({WORD})"), 1)
    start, end = F.col("span.start").cast("int"), F.col("span.end").cast("int")
    texts = docs.select(key, words.alias("_words")).join(runs, key)
    return texts.select(
        key, "span.start", F.explode(F.sequence(F.lit(1), F.col("span.copies"))).alias("copy"),
        F.array_join(F.slice("_words", start + 1, end - start), " ").alias("text"),
    )
