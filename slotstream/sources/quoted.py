"""CSV records with line breaks inside quotes, read in splits.

Whether a line starts a record depends on the quotes before it, back to the start of the file. Each
line is read as a function of two states, outside and inside a quoted field; functions are chained
within a block of the file, blocks within the file, and so each line learns its state from one row
per block. Lines that are whole records are parsed as they are; only the lines of longer records
meet, by record.

A quote opens a field only at its start and a doubled quote inside is a character, as in Spark's own
reader. Lines end in LF or CRLF. Empty lines outside quotes are no records. A file that ends inside
quotes gives its last record as far as it goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotstream.session import materialise

BLOCK = ["_file", "_block"]
# a chain of functions: `fixed`, the state whatever came before (NULL if that matters), and whether
# that state, or else the one before, is turned round
CHAIN = ["fixed", "turned"]


def _end_state(line: Column, inside: bool) -> Column:
    """Whether `line` ends inside quotes if it starts `inside` or outside them."""
    # doubled quotes change no state, so that each quote left opens, closes or is a character
    pieces = F.split(F.replace(line, F.lit('""'), F.lit("")), '"', -1)
    start = F.struct(F.lit(inside).alias("open"), F.lit("").alias("before"), F.lit(0).alias("n"))

    def step(state: Column, piece: Column) -> Column:
        # the quote stands between the piece before and this one; the first piece has none
        opens = state["before"].endswith(",") | ((state["n"] == 1) & (state["before"] == ""))
        now = F.when(state["n"] == 0, state["open"]).otherwise(~state["open"] & opens)
        return F.struct(now.alias("open"), piece.alias("before"), (state["n"] + 1).alias("n"))

    walked = F.aggregate(pieces, start, step)["open"]
    return F.when(F.contains(line, F.lit('"')), walked).otherwise(F.lit(inside))


def _chained(rows: DataFrame, within: list[str], order: str) -> DataFrame:
    """Adds `fixed_before` and `turned_before`: the chain of the rows before in `order`."""
    window = W.partitionBy(*within).orderBy(order)
    before = window.rowsBetween(W.unboundedPreceding, -1)
    turns = rows.withColumn("_turns", F.sum(F.col("turned").cast("long")).over(window))
    # at a fixed row: its state, and the turns up to it
    fixed = F.when(
        F.col("fixed").isNotNull(),
        F.struct((F.col("fixed") != F.col("turned")).alias("state"), F.col("_turns").alias("turns")),
    )
    return (
        turns.withColumns(
            {
                "_last": F.last(fixed, ignorenulls=True).over(before),
                "_so_far": F.coalesce(F.lag("_turns").over(window), F.lit(0)),
            }
        )
        .withColumns(
            {
                "fixed_before": F.col("_last.state"),
                "turned_before": (F.col("_so_far") - F.coalesce("_last.turns", F.lit(0))) % 2 == 1,
            }
        )
        .drop("_turns", "_last", "_so_far")
    )


def _then(fixed: Column, turned: Column) -> tuple[Column, Column]:
    """The chain of what came before, `fixed` and `turned`, and this row."""
    own = F.col("fixed").isNotNull()
    return (
        F.when(own, F.col("fixed")).otherwise(fixed),
        F.when(own, F.col("turned")).otherwise(turned != F.col("turned")),
    )


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with `BLOCK`, `_line` and `starts`, whether the line starts outside quotes."""
    out, inside = _end_state(F.col("value"), False), _end_state(F.col("value"), True)
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_line"),
        )
        .withColumns({"_out": out, "_in": inside})
        .withColumns(
            {
                "fixed": F.when(F.col("_out") == F.col("_in"), F.col("_out")),
                "turned": F.col("_out") & ~F.col("_in"),
            }
        )
        .drop("_out", "_in")
    )
    fixed, turned = _then(F.col("fixed_before"), F.col("turned_before"))
    known = materialise(
        _chained(lines, BLOCK, "_line").withColumns({"fixed_after": fixed, "turned_after": turned})
    )
    blocks = known.groupBy(*BLOCK).agg(
        F.max_by(F.struct("fixed_after", "turned_after"), "_line").alias("last"),
        F.min("_line").alias("first_line"),
    )
    blocks = blocks.select(
        *BLOCK,
        "first_line",
        F.col("last.fixed_after").alias("fixed"),
        F.col("last.turned_after").alias("turned"),
    )
    # a file starts outside quotes
    state = F.coalesce("fixed_before", F.lit(False)) != F.col("turned_before")
    opened = _chained(blocks, ["_file"], "_block").select(
        *BLOCK, "first_line", state.alias("block_inside")
    )
    here = F.coalesce("fixed_before", "block_inside") != F.col("turned_before")
    return known.join(opened, BLOCK).select(
        "value",
        *BLOCK,
        "_line",
        (~here).alias("starts"),
        # a line that ends outside quotes is the last of its record
        (F.coalesce("fixed_after", "block_inside") == F.col("turned_after")).alias("ends"),
        ((F.col("_block") == 0) & (F.col("_line") == F.col("first_line"))).alias("first"),
    )


def records(spark: SparkSession, path: str) -> DataFrame:
    """`record` (its text), where its first line stood, and `first`: whether it is its file's first."""
    lines = materialise(numbered_lines(spark, path))
    whole = lines.filter(F.col("starts") & F.col("ends")).select(
        F.col("value").alias("record"), *BLOCK, "_line", "first"
    )
    long = lines.filter(~(F.col("starts") & F.col("ends")))
    # number of the record among the long ones of the block; 0: it began in a block before
    number = F.sum(F.col("starts").cast("long")).over(W.partitionBy(*BLOCK).orderBy("_line"))
    parts = long.withColumn("_number", number)
    # the last long record of the blocks before, for lines that go on with it
    ends = parts.groupBy(*BLOCK).agg(F.max("_number").alias("last"))
    held = F.when(F.col("last") > 0, F.struct(F.col("_block"), F.col("last")))
    before = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    earlier = ends.select(*BLOCK, F.last(held, ignorenulls=True).over(before).alias("held"))
    within = parts.filter(F.col("_number") > 0).withColumns(
        {"_in_block": F.col("_block"), "_in_number": F.col("_number")}
    )
    going_on = (
        parts.filter(F.col("_number") == 0)
        .join(earlier, BLOCK)
        .withColumns({"_in_block": F.col("held._block"), "_in_number": F.col("held.last")})
        .drop("held")
    )
    joined = (
        within.unionByName(going_on)
        .groupBy("_file", "_in_block", "_in_number")
        .agg(
            F.sort_array(F.collect_list(F.struct("_block", "_line", "value"))).alias("lines"),
            F.bool_or("first").alias("first"),
        )
        .select(
            F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("record"),
            "_file",
            F.col("_in_block").alias("_block"),
            F.col("lines")[0]["_line"].alias("_line"),
            "first",
        )
    )
    text = F.col("record")
    cut = F.when(text.endswith("\r"), F.left(text, F.length(text) - 1)).otherwise(text)
    return whole.unionByName(joined).withColumn("record", cut).filter(F.col("record") != "")


def table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The columns of `schema`, all of them strings, and `_file`, `_block` and `_line`.

    Every file's first record must be the header that `schema` names; otherwise the read fails."""
    # one column more than the header has, so that a longer header is seen
    wide = ", ".join([*[f"c{i} string" for i in range(len(schema))], "more string"])
    options = {"escape": '"', "multiLine": "true"}
    parsed = records(spark, path).withColumn("row", F.from_csv("record", wide, options))
    told = F.array(*[F.lit(f.name.lstrip("\ufeff").strip().lower()) for f in schema])
    found = F.array(
        *[
            F.lower(F.trim(F.replace(F.col(f"row.c{i}"), F.lit("\ufeff"), F.lit(""))))
            for i in range(len(schema))
        ]
    )
    wrong = F.coalesce(found != told, F.lit(True)) | F.col("row.more").isNotNull()
    message = F.concat(F.lit("other header than the first file: "), F.col("_file"))
    checked = (
        F.when(~F.col("first"), F.lit(True)).when(wrong, F.raise_error(message)).otherwise(F.lit(False))
    )
    return parsed.filter(checked).select(
        *[F.col(f"row.c{i}").alias(f.name) for i, f in enumerate(schema)], "_file", "_block", "_line"
    )
