"""Decoding of the three wire formats and the bad-record policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline.functions.grid import grid_area
from smogline.params import Grid

FAILFAST = "FAILFAST"
SKIP = "SKIP"

# Field positions in the text formats.
WIRE_A = {"id": 1, "lon": 2, "lat": 3, "humidity": 4, "tempC": 5, "pm2": 6}
WIRE_C = {"id": 0, "ts": 2, "pm2": 5}

# Field names of the JSON format.
WIRE_B_INT = ("lon", "lat", "humidity")
WIRE_B_DOUBLE = ("temperature", "pm2")

_CORRUPT = "_corrupt"


# One match per comma-separated piece; the group is the text between its first
# and second colon.
_PIECES = r"(?:^|,)[^:,]*:?([^:,]*)[^,]*"


def _settled(decoded: DataFrame, passed: list[str]) -> DataFrame:
    """The same rows, with what was decoded behind a generator.

    A filter on ``ok`` would be pushed through the projections below and decode
    every message a second time; it is not pushed through a generator. Columns that
    are only passed on stay outside of it, so a range of time reaches the scan, and
    messages outside of the range are not decoded.
    """
    own = [name for name in decoded.columns if name not in passed]
    row = F.explode(F.array(F.struct(*own))).alias("_row")
    return decoded.select(*passed, row).select(*passed, "_row.*")


def _with_texts(df: DataFrame) -> DataFrame:
    """Add ``_text``: the value text of every piece of ``value``."""
    return df.withColumn("_text", F.regexp_extract_all("value", F.lit(_PIECES), F.lit(1)))


def _value(position: int) -> Column:
    return F.get("_text", F.lit(position))


def _has_value(position: int) -> Column:
    """Is there anything but colons behind the first colon of a piece?"""
    piece = F.split_part("value", F.lit(","), F.lit(position + 1))
    return F.when(_value(position) != "", True).otherwise(piece.rlike("(?s):.*[^:]"))


def _whole_number(text: Column) -> Column:
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("int"))


def apply_policy(df: DataFrame, ok: str, mode: str) -> DataFrame:
    """Keep the good rows (``SKIP``) or stop the job at the first bad one (``FAILFAST``)."""
    if mode == SKIP:
        return df.filter(F.col(ok)).drop(ok)
    if mode == FAILFAST:
        check = F.when(F.col(ok), True).otherwise(
            F.raise_error(F.concat(F.lit("bad record: "), F.coalesce("value", F.lit("null")))).cast("boolean")
        )
        return df.filter(check).drop(ok)
    raise ValueError(f"unknown bad-record mode {mode}")


def mark_positional(
    df: DataFrame, grid: Grid = Grid(), strip_quotes: bool = False, climate: bool = True
) -> DataFrame:
    """Decode wire A by position and flag each row with ``ok``; nothing is dropped.

    Field names do not matter. Quotes in the id are part of the id unless
    ``strip_quotes`` is set. ``climate=False`` skips temperature and humidity,
    as the map job does.
    """
    text = {name: F.translate(_value(position), " ", "") for name, position in WIRE_A.items()}
    text["pm2"] = F.translate(_value(WIRE_A["pm2"]), " }", "")
    if strip_quotes:
        text["id"] = F.translate(text["id"], '"', "")
    numbers = ["pm2"] + (["tempC", "humidity"] if climate else [])

    texts = _with_texts(df).select(
        *df.columns,
        _has_value(WIRE_A["id"]).alias("_has_id"),
        *[text[name].alias(name) for name in ("id", "lat", "lon", *numbers)],
    )
    parsed = texts.withColumns(
        {
            "_lat": _whole_number(F.col("lat")),
            "_lon": _whole_number(F.col("lon")),
            **{name: F.col(name).try_cast("double") for name in numbers},
        }
    )
    ok = F.col("_has_id") & F.col("_lat").isNotNull() & F.col("_lon").isNotNull()
    for name in numbers:
        ok = ok & F.col(name).isNotNull()
    return _settled(parsed.select(
        *df.columns,
        "id",
        "pm2",
        F.when(ok, grid_area(F.col("_lat"), F.col("_lon"), grid)).alias("area"),
        "lat",
        "lon",
        *numbers[1:],
        F.coalesce(ok, F.lit(False)).alias("ok"),
    ), df.columns)


def decode_positional(
    df: DataFrame,
    grid: Grid = Grid(),
    mode: str = FAILFAST,
    strip_quotes: bool = False,
    climate: bool = True,
) -> DataFrame:
    """Wire A text in ``value`` to readings; further columns (ts, seq) pass through."""
    marked = mark_positional(df, grid, strip_quotes, climate)
    return apply_policy(marked, "ok", mode).drop("value")


def mark_json(df: DataFrame) -> DataFrame:
    """Decode wire B by field name and flag each row with ``ok``.

    All fields are read as text first: a quoted number is as good as a bare
    one, a missing or null number is 0, a missing text is null, and a whole
    number may be written ``50.0`` but not ``50.5``.
    """
    names = ("sensorId", "lon", "lat", "temperature", "humidity", "pm2", "measurement")
    schema = ", ".join(f"{name} STRING" for name in names) + f", {_CORRUPT} STRING"
    record = F.from_json(
        "value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    )
    parsed = df.withColumn("_r", record)

    def number(name: str) -> Column:
        return F.col(f"_r.{name}").try_cast("double")

    def whole(name: str) -> Column:
        return number(name).try_cast("int")

    ok = F.col("value").isNotNull() & F.col(f"_r.{_CORRUPT}").isNull() & F.col("_r").isNotNull()
    for name in WIRE_B_DOUBLE + WIRE_B_INT:
        ok = ok & (F.col(f"_r.{name}").isNull() | number(name).isNotNull())
    for name in WIRE_B_INT:
        ok = ok & (
            F.col(f"_r.{name}").isNull()
            | F.coalesce(whole(name).cast("double") == number(name), F.lit(False))
        )
    return _settled(parsed.select(
        *df.columns,
        F.col("_r.sensorId").alias("sensorId"),
        *[F.coalesce(whole(name), F.lit(0)).alias(name) for name in ("lon", "lat")],
        F.coalesce(number("temperature"), F.lit(0.0)).alias("temperature"),
        F.coalesce(whole("humidity"), F.lit(0)).alias("humidity"),
        F.coalesce(number("pm2"), F.lit(0.0)).alias("pm2"),
        F.col("_r.measurement").alias("measurement"),
        F.coalesce(ok, F.lit(False)).alias("ok"),
    ), df.columns)


def decode_json(df: DataFrame, mode: str = FAILFAST) -> DataFrame:
    """Wire B JSON in ``value`` to observations; further columns (key, ts, seq) pass through."""
    return apply_policy(mark_json(df), "ok", mode).drop("value")


def mark_store(df: DataFrame) -> DataFrame:
    """Decode wire C: three pieces of text, untouched, and the ``ok`` flag."""
    ok = F.lit(True)
    for position in WIRE_C.values():
        ok = ok & _has_value(position)
    return _settled(_with_texts(df).select(
        *df.columns,
        *[_value(position).alias(name) for name, position in WIRE_C.items()],
        F.coalesce(ok, F.lit(False)).alias("ok"),
    ), df.columns)


def decode_store(df: DataFrame, mode: str = FAILFAST) -> DataFrame:
    return apply_policy(mark_store(df), "ok", mode).drop("value")


def quarantine(marked: DataFrame, *keep: str) -> DataFrame:
    """The bad rows of a marked frame: the text as it arrived and the columns to keep with it."""
    return marked.filter(~F.col("ok")).select("value", *keep)
