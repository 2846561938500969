"""Change envelopes to typed rows, in batch or on a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotstream.functions import status, wire
from slotstream.sources.registry import TableConfig

CORRUPT = "_corrupt_record"
IMAGES = ("column", "row")
# message coordinates that give versions of one key a total order
POSITION = (("partition", "source_partition", "int"), ("offset", "source_offset", "long"))


def envelope(row: T.StructType) -> T.StructType:
    """Schema of a change message around a row schema."""
    payload = (
        T.StructType()
        .add("before", row)
        .add("after", row)
        .add("op", T.StringType())
        .add("ts_ms", T.LongType())
    )
    return T.StructType().add("payload", payload)


def _parse(raw: DataFrame, cfg: TableConfig, *, corrupt: bool = False) -> DataFrame:
    """One `message` struct per row, NULL where the value is NULL.

    The parsed struct passes through a one-row explode. A plain column would be merged into
    every filter above it, and each message would be parsed once per filter again.
    """
    schema = envelope(cfg.row_schema)
    options = {}
    if corrupt:
        schema = schema.add(CORRUPT, T.StringType())
        options = {"columnNameOfCorruptRecord": CORRUPT}
    position = [
        (F.col(name) if name in raw.columns else F.lit(None)).cast(kind).alias(alias)
        for name, alias, kind in POSITION
    ]
    text = raw.select(F.col("value").cast("string").alias("value"), *position)
    parsed = F.from_json("value", schema, options)
    kept = ["value"] if corrupt else []
    return text.select(
        *kept, *[alias for _, alias, _ in POSITION], F.explode(F.array(parsed)).alias("message")
    )


def _image(payload: Column, name: str, image: str) -> Column:
    """A column of the changed row.

    `column` takes the after value and, where that is NULL, the before value. `row` takes
    the before image of deletes and the after image otherwise, so NULLs set by an update stay.
    """
    after, before = payload["after"][name], payload["before"][name]
    if image == "column":
        return F.coalesce(after, before)
    if image == "row":
        return F.when(payload["op"] == "d", before).otherwise(after)
    raise ValueError(f"image must be one of {IMAGES}, not {image!r}")


def _typed(value: Column, kind: str, precision: str) -> Column:
    if kind == "days":
        return wire.days_to_date(value)
    if kind == "micros":
        return wire.micros_to_ts(value, precision)
    return value


# kinds that hold less than the 64 bits on the wire, and what they hold
LIMITS = {
    "int": (-(1 << 31), (1 << 31) - 1),
    "days": (wire.MIN_DAY, wire.MAX_DAY),
    "micros": (wire.MIN_SECOND * 1_000_000, (wire.MAX_SECOND + 1) * 1_000_000 - 1),
}


def _bad_number(payload: Column, cfg: TableConfig, image: str) -> Column:
    """Whether a column of the changed row has a number that its staging type cannot hold."""
    found = F.lit(False)
    for name, kind in cfg.fields:
        if kind in LIMITS:
            low, high = LIMITS[kind]
            value = _image(payload, name, image)
            found = found | F.coalesce(~value.between(F.lit(low), F.lit(high)), F.lit(False))
    time = payload["ts_ms"]
    held = time.between(F.lit(wire.MIN_SECOND * 1000), F.lit((wire.MAX_SECOND + 1) * 1000 - 1))
    return found | F.coalesce(~held, F.lit(False))


def decode(
    raw: DataFrame,
    cfg: TableConfig,
    *,
    ingested_at: Column | None = None,
    precision: str = "second",
    image: str = "column",
    keep_null_keys: bool = False,
) -> DataFrame:
    """Typed rows of one table from raw messages.

    Output: the table's columns, `op, is_deleted, cdc_ts, dw_ingested_at`, and the message
    position (NULL where the source has none). Messages without value, without payload or
    without key, or with a number their column cannot hold, are left out; `rejected` returns them.
    """
    payload = F.col("message.payload")
    fields = [_typed(_image(payload, n, image), k, precision).alias(n) for n, k in cfg.fields]
    rows = (
        _parse(raw, cfg)
        .filter(payload.isNotNull() & ~_bad_number(payload, cfg, image))
        .select(
            *fields,
            payload["op"].alias("op"),
            status.flag(payload["op"] == "d").alias("is_deleted"),
            wire.millis_to_ts(payload["ts_ms"], precision).alias("cdc_ts"),
            (F.current_timestamp() if ingested_at is None else ingested_at).alias("dw_ingested_at"),
            *[alias for _, alias, _ in POSITION],
        )
    )
    return rows if keep_null_keys else rows.filter(F.col(cfg.pk).isNotNull())


def rejected(raw: DataFrame, cfg: TableConfig, *, image: str = "column") -> DataFrame:
    """The messages `decode` leaves out, each with the reason."""
    payload = F.col("message.payload")
    reason = (
        F.when(F.col("value").isNull(), F.lit("no_value"))
        .when(payload.isNull() & F.col(f"message.{CORRUPT}").isNotNull(), F.lit("unparsable"))
        .when(payload.isNull(), F.lit("no_payload"))
        .when(_image(payload, cfg.pk, image).isNull(), F.lit("null_key"))
        .when(_bad_number(payload, cfg, image), F.lit("bad_number"))
    )
    aliases = [alias for _, alias, _ in POSITION]
    judged = _parse(raw, cfg, corrupt=True).select("value", reason.alias("reason"), *aliases)
    return judged.filter(F.col("reason").isNotNull())


def decode_time_of_day(df: DataFrame, columns: list[str]) -> DataFrame:
    """Clock columns sent as microseconds since midnight as `HH:mm`."""
    return df.withColumns({name: wire.time_of_day(F.col(name)) for name in columns})


def encode(df: DataFrame, cfg: TableConfig, *, op: Column, ts_ms: Column) -> Column:
    """The envelope text of a change whose row columns are already in wire types.

    A delete carries the row in `before`, any other change in `after`.
    """
    row = F.struct(*[F.col(n) for n in cfg.columns])
    empty = F.lit(None).cast(cfg.row_schema)
    payload = F.struct(
        F.when(op == "d", row).otherwise(empty).alias("before"),
        F.when(op == "d", empty).otherwise(row).alias("after"),
        op.alias("op"),
        ts_ms.alias("ts_ms"),
    )
    return F.to_json(F.struct(payload.alias("payload")))
