"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted; adjacent turns of one role are
merged into one block by functions of the array; blocks are concatenated. A block is

    <|role:ROLE|>text<|next|>text<|end|>

Inside roles and texts every backslash is doubled, `<|` becomes `<\\|` and `|>` becomes `|\\>`, so
marks cannot be forged and the formatted string can be read back exactly. The loss mask is an array
of spans, in code points and in bytes, over the escaped texts of the assistant. No array or string
grows turn by turn, so the work grows with the turns, not with their square.

Defined cases: NULL text and NULL role are empty; NULL turns come first; turns of equal number
are ordered by role and text, and repeated rows are turns of their own. Rows with a NULL
conversation form one conversation. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotstream.llm.tables import read

# fixed values: the marks of the template
OPEN, CLOSE, NEXT, END = "<|role:", "|>", "<|next|>", "<|end|>"
LEARNED = "assistant"
# turns whose sizes are added up at a time
BLOCK = 64
# in this order; read back, a pair of backslashes comes first
ESCAPES = [("\\", "\\\\"), ("<|", "<\\|"), ("|>", "|\\>")]


def escape(text: Column) -> Column:
    for found, put in ESCAPES:
        text = F.replace(text, F.lit(found), F.lit(put))
    return text


def unescape(text: Column) -> Column:
    # a lone backslash stands only in an escaped mark, so pairs are set apart first
    apart = F.split(text, r"\\\\", -1)

    def marks(part: Column) -> Column:
        for found, put in ESCAPES[1:]:
            part = F.replace(part, F.lit(put), F.lit(found))
        return part

    return F.array_join(F.transform(apart, marks), "\\")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, which is computed once however often and wherever `body` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sums_before(sizes: Column) -> Column:
    """For each number of an array the sum of those before it.

    Sums of blocks are added up first, so that no array grows number by number."""

    def total(numbers: Column) -> Column:
        return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)

    def before_blocks(sizes: Column) -> Column:
        last = F.floor((F.size(sizes) - 1) / BLOCK).cast("int")
        blocks = F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda b: total(F.slice(sizes, b * BLOCK + 1, F.lit(BLOCK))),
        )
        nothing = F.array(F.lit(0).cast("long"))
        return F.aggregate(blocks, nothing, lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))

    def places(sizes: Column, blocks: Column) -> Column:
        def place(size: Column, i: Column) -> Column:
            block = F.floor(i / BLOCK).cast("int")
            return F.get(blocks, block) + total(F.slice(sizes, block * BLOCK + 1, i % BLOCK))

        return F.transform(sizes, place)

    return let(sizes, lambda s: let(before_blocks(s), lambda b: places(s, b)))


def pieces_of(turns: Column) -> Column:
    """Of each turn the mark before its text, the text, both escaped, and whether it is learned."""

    def piece(turn: Column, i: Column) -> Column:
        # indices below 0 give NULL, so the first turn is no continuation
        same = F.get(turns, i - 1)["role"].eqNullSafe(turn["role"])
        opened = F.concat(F.lit(OPEN), escape(turn["role"]), F.lit(CLOSE))
        head = F.when(same, F.lit(NEXT)).when(i == 0, opened).otherwise(F.concat(F.lit(END), opened))
        return F.struct(
            head.alias("head"),
            escape(turn["text"]).alias("text"),
            (turn["role"] == F.lit(LEARNED)).alias("learned"),
        )

    return F.transform(turns, piece)


def spans_of(pieces: Column, measure: Callable[[Column], Column]) -> Column:
    """Where the learned texts lie, in what `measure` counts."""

    def spans(before: Column) -> Column:
        def span(p: Column, i: Column) -> Column:
            start = F.get(before, i) + measure(p["head"])
            return F.when(
                p["learned"],
                F.struct(start.alias("start"), measure(p["text"]).cast("long").alias("length")),
            )

        return F.filter(F.transform(pieces, span), lambda s: s.isNotNull())

    sizes = F.transform(pieces, lambda p: (measure(p["head"]) + measure(p["text"])).cast("long"))
    return let(sums_before(sizes), spans)


def formatted(rows: DataFrame) -> DataFrame:
    """`conv_id` and `formatted` of every conversation, and the spans (start, length) of its loss
    mask, `loss_spans` in code points and `loss_bytes` in UTF-8 bytes."""
    turns = F.sort_array(
        F.collect_list(
            F.struct(
                F.col("turn"),
                F.coalesce("role", F.lit("")).alias("role"),
                F.coalesce("text", F.lit("")).alias("text"),
            )
        )
    )

    def made(pieces: Column) -> Column:
        parts = F.transform(pieces, lambda p: F.concat(p["head"], p["text"]))
        return F.struct(
            F.concat(F.array_join(parts, ""), F.lit(END)).alias("formatted"),
            spans_of(pieces, F.length).alias("loss_spans"),
            spans_of(pieces, F.octet_length).alias("loss_bytes"),
        )

    return (
        rows.groupBy("conv_id")
        .agg(turns.alias("turns"))
        .select("conv_id", let(F.col("turns"), lambda t: let(pieces_of(t), made)).alias("made"))
        .select("conv_id", "made.formatted", "made.loss_spans", "made.loss_bytes")
    )


def turns_of(text: Column) -> Column:
    """The turns (role, text) read back from a formatted string."""
    blocks = F.filter(F.split(text, r"<\|end\|>", -1), lambda x: x != "")

    def turns(block: Column) -> Column:
        # what stands before the first `|>` is the role: the texts' own come later
        role = F.regexp_extract(block, r"(?s)^<\|role:(.*?)\|>", 1)
        body = F.regexp_replace(block, r"(?s)^<\|role:.*?\|>", "")
        return F.transform(
            F.split(body, r"<\|next\|>", -1),
            lambda x: F.struct(unescape(role).alias("role"), unescape(x).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns))


def digest(chats: DataFrame) -> DataFrame:
    """What the contract asks for, all of it read back from `formatted` and its loss mask."""
    back = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    # by bytes: a code point is found only by counting from the start
    masked = let(
        F.col("formatted").cast("binary"),
        lambda data: F.transform(
            "loss_bytes",
            lambda s: unescape(
                F.substring(data, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string")
            ),
        ),
    )
    return (
        chats.withColumn("turns", turns_of(F.col("formatted")))
        .withColumn("loss", F.array_join(masked, ""))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(back, "").cast("binary"), 256).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
    )


PROBE = "</s>[INST] ok [/INST]"


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)],
        "conv_id long, turn long, role string, text string",
    )
    return digest(formatted(rows.unionByName(probe)))


OP4_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
    replace(replace(replace(role, '\', '\\'), '<|', '<\|'), '|>', '|\>') AS safe_role,
    replace(replace(replace(text, '\', '\\'), '<|', '<\|'), '|>', '|\>') AS safe_text
  FROM rows
), grouped AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)
      AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
      FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(length(safe_text) + CASE WHEN before = role THEN 8
      ELSE 9 + length(safe_role) + 7 END) AS formatted_chars
  FROM marked GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars
FROM grouped
"""
