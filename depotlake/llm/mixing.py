"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

Within a source the rows stand in an order of size class, then a hash. Each has the source's rate
(target by size) as its expected copies; their prefix sum plus one random offset crosses integers,
and a row is emitted once for each integer that its own step crosses. Because the order runs
through the size classes, every class is taken at the rate, so the words come near the target.

No source is summed in one task: rows are dealt to blocks (a piece of the hash range of one size
class of one source), of a bounded number of rows each, and only block counts are summed across.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depotlake.llm.tables import WORD, Scratch, text_of

WEIGHTS = (1, 2, 3)
#: No source grows beyond this multiple of itself.
MOST = 3
#: Expected copies are multiples of 2**-STEP_BITS, so that prefix sums are exact integers.
STEP_BITS = 20
#: Rows of a block at most, but for rows of one hash.
BLOCK_ROWS = 100_000
HASH_BITS = 32


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _first_digits(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def size_class(size: Column) -> Column:
    """Number of binary digits of size, and its five first ones: classes about 4 % wide."""
    digits = F.length(F.bin(size))
    return (digits * 32 + F.call_function("shiftright", size, F.greatest(digits - 5, F.lit(0)))).cast("int")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target: from one row for each source with its size.

    Sources by code point, nulls last, weigh weights in turn and share the sum of all sizes. A
    target stops at most times the source's size; the others share what is left by weight, until
    none is above. In order of size by weight, the sources that stop come first, so running sums
    find the share at which the rest stay below. The rows here are sources, not documents.
    """
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(w) for w in weights])
    weighed = sizes.withColumn("weight", F.get(cycle, F.pmod(place, F.lit(len(weights)))).cast("long"))
    by_room = Window.orderBy((F.col("source_size").cast("double") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    after = by_room.rowsBetween(0, Window.unboundedFollowing)
    summed = weighed.select(
        "source",
        "source_size",
        "weight",
        F.sum("source_size").over(everything).alias("all_sizes"),
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("stopped"),
        F.sum("weight").over(after).alias("weights_left"),
    )
    rest = F.col("all_sizes") - most * F.col("stopped")
    over = rest * F.col("weight") > most * F.col("source_size") * F.col("weights_left")
    marked = summed.withColumn("over", over)
    # the share of the first source that stays below holds for all after it
    share = marked.select("*", F.min(F.when(~F.col("over"), F.struct(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source", rest.alias("rest"), "weights_left"))).over(everything).alias("share"))
    free = F.col("weight").cast("double") * F.col("share.rest").cast("double") / F.col("share.weights_left").cast("double")
    return share.select(
        "source",
        "source_size",
        F.when(F.col("over"), (most * F.col("source_size")).cast("double")).otherwise(free).alias("target"),
    )


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: str = "mix", block_rows: int = BLOCK_ROWS, carry: bool = True) -> DataFrame:
    """For each row of docs: doc_id, size, source_size, target, copies, taken; with carry, also row, all its columns.

    size counts words, null texts have 0. Null sources are one source. A source without words has
    the target 0 and is not taken. Rows with null or repeated doc_id are rows of their own; rows
    equal in doc_id, source and size may swap places. The same table gives the same copies in any
    partitioning. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    sized = _sized(docs, seed)
    sizes = scratch.put(sized, "sizes")
    plan = _plan(sizes, weights, most, seed, block_rows)
    rows = _dealt(_sized(docs, seed, F.struct("*").alias("row")) if carry else sizes, plan)
    counts = _dealt(sizes, plan).groupBy("block").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("block.source_key", "block.class").orderBy("block.piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("block", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("piece_start"))
    number = F.row_number().over(Window.partitionBy("block").orderBy("hash", "doc_id", "size"))
    placed = rows.withColumn("number", number.cast("long")).join(starts, "block")
    end = F.col("offset") + (F.col("class_start") + F.col("piece_start") + F.col("number")) * F.col("rate")
    crossed = F.call_function("shiftright", end, F.lit(STEP_BITS)) - F.call_function("shiftright", end - F.col("rate"), F.lit(STEP_BITS))
    shown = ["row"] * carry + ["doc_id", "size", "source_size", "target"]
    return placed.select(*shown, crossed.cast("long").alias("copies")).withColumn("taken", F.col("copies") * F.col("size"))


def _source_key() -> Column:
    """The source as a key without null."""
    return F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))


def _sized(docs: DataFrame, seed: str, *more: Column) -> DataFrame:
    name = F.coalesce(docs["doc_id"].cast("string"), F.md5(text_of(docs)))
    narrow = docs.select(
        *more,
        docs["doc_id"].alias("doc_id"),
        docs["source"].alias("source"),
        word_count(text_of(docs)).alias("size"),
        _first_digits(F.concat(name, F.lit(f"/{seed}")), HASH_BITS // 4).alias("hash"),
    )
    return narrow.withColumn("class", size_class(F.col("size"))).withColumn("source_key", _source_key())


def _plan(sizes: DataFrame, weights: Sequence[int], most: int, seed: str, block_rows: int) -> DataFrame:
    """For each size class of each source: rate, offset, number of pieces, rows of the classes before it."""
    partitions = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    classes = sizes.groupBy("source_key", "source", "class").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("words"))
    targets = source_targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    targets = targets.select(_source_key().alias("source_key"), "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * (1 << STEP_BITS))).otherwise(0)
    in_source = Window.partitionBy("source_key").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    # at most block_rows, and at most a quarter of an even share of a task; the order is the same for any number
    most_rows = F.greatest(F.lit(1.0), F.least(F.lit(float(block_rows)), F.sum("rows").over(Window.partitionBy()) / (4 * partitions)))
    return classes.join(targets, "source_key").select(
        F.col("source_key").alias("of_source"),
        F.col("class").alias("of_class"),
        "source_size",
        "target",
        rate.cast("long").alias("rate"),
        _first_digits(F.concat(F.col("source_key"), F.lit(f"/{seed}")), STEP_BITS // 4).alias("offset"),
        F.ceil(F.col("rows") / most_rows).cast("long").alias("pieces"),
        F.coalesce(F.sum("rows").over(in_source), F.lit(0)).alias("class_start"),
    )


def _dealt(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """rows with the plan of their class (Spark broadcasts it only where it is small) and their block.

    A block is a piece of the hash range of a class. As one struct it is dealt anew, also where the
    join has dealt the rows by class.
    """
    of_class = (F.col("source_key") == F.col("of_source")) & (F.col("class") == F.col("of_class"))
    piece = F.call_function("shiftright", F.col("hash") * F.col("pieces"), F.lit(HASH_BITS))
    return rows.join(plan, of_class).withColumn("block", F.struct("source_key", "class", piece.cast("long").alias("piece")))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """docs with each row as often as the mix takes it, all columns."""
    mixed = mix_sources(docs, **options).where("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")
