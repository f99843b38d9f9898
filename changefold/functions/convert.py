"""Wire-type conversions.

All of these are built-in expressions, so they stay inside whole-stage
codegen.  None depends on the session time zone: epoch days and epoch
milliseconds name a calendar day and an instant, not a local time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_days_to_date(c: Column) -> Column:
    """Days since 1970-01-01 -> DATE (no detour through a local timestamp)."""
    return F.date_from_unix_date(c.cast("int"))


def date_to_epoch_days(c: Column) -> Column:
    return F.unix_date(c.cast("date"))


def epoch_ms_to_timestamp(c: Column) -> Column:
    return F.timestamp_millis(c.cast("long"))


def timestamp_to_epoch_ms(c: Column) -> Column:
    return F.unix_millis(c.cast("timestamp"))


def ntz_to_epoch_ms(c: Column) -> Column:
    """TIMESTAMP_NTZ -> epoch ms, read as UTC wall time, whatever the session
    zone.  The NTZ fields are reassembled as a UTC instant (``timestamp_diff``
    would first cast both sides to session-zone timestamps)."""
    ntz = c.cast("timestamp_ntz")
    instant = F.make_timestamp(F.year(ntz), F.month(ntz), F.dayofmonth(ntz), F.hour(ntz), F.minute(ntz),
                               F.extract(F.lit("SECOND"), ntz), F.lit("UTC"))
    return F.floor(F.unix_micros(instant) / F.lit(1000)).cast("long")


def topic_table(topic: Column) -> Column:
    """``<server>.<schema>.<table>`` -> ``<table>``."""
    return F.element_at(F.split(topic, r"\."), -1)


def wire_decimal(c: Column, precision: int = 10, scale: int = 2) -> Column:
    """A decimal sent either as text (``"12.34"``) or as the connector's
    variable-scale form ``{"scale": s, "value": <base64 big-endian two's
    complement unscaled integer>}`` (read as its JSON text).  Anything else
    gives null instead of failing the batch."""
    text = F.trim(c.cast("string"))
    target = f"decimal({precision},{scale})"
    wire_scale = F.get_json_object(text, "$.scale").try_cast("int")
    h = F.hex(F.try_to_binary(F.get_json_object(text, "$.value"), F.lit("base64")))
    # Sign-extend the big-endian two's complement bytes to 128 bits; the upper
    # half is signed (negative target base of ``conv``), the lower is not.
    negative = F.conv(F.substring(h, 1, 1), 16, 10).try_cast("int") >= 8
    padded = F.when(negative, F.lpad(h, 32, "F")).otherwise(F.lpad(h, 32, "0"))
    upper = F.conv(F.substring(padded, 1, 16), 16, -10).try_cast("decimal(20,0)")
    lower = F.conv(F.substring(padded, 17, 16), 16, 10).try_cast("decimal(20,0)")
    unscaled = F.try_add(F.try_multiply(upper, F.lit(str(1 << 64)).cast("decimal(20,0)")), lower)
    # The point is set in the digits, so the only rounding is that of the text form.
    digits = F.lpad(F.abs(unscaled).cast("string"), F.greatest(F.length(F.abs(unscaled).cast("string")), wire_scale + 1), F.lit("0"))
    whole = F.length(digits) - wire_scale
    shifted = F.concat(F.when(unscaled < 0, F.lit("-")).otherwise(F.lit("")), F.substring(digits, F.lit(1), whole), F.lit("."), F.substring(digits, whole + 1, wire_scale))
    readable = F.length(h).between(2, 32) & wire_scale.between(0, 37)
    from_obj = F.when(readable, shifted.try_cast(target))
    return F.when(text.startswith("{"), from_obj).otherwise(text.try_cast(target))


def decimal_to_wire_object(c: Column, scale: int = 2) -> Column:
    """Encode a decimal the way the connector's ``precise`` mode does:
    JSON object text with the scale and the base64 two's-complement bytes of
    the unscaled value (minimal length, sign bit respected)."""
    unscaled = F.round(c * F.pow(F.lit(10), F.lit(scale))).cast("long")
    h = F.hex(unscaled)  # negative longs come out as 16 hex digits (two's complement)
    h = F.when(unscaled < 0, F.regexp_replace(h, "^(FF)+(?=[89A-F])", "")).otherwise(h)  # minimal length, sign kept
    h = F.when(F.length(h) % 2 == 1, F.concat(F.lit("0"), h)).otherwise(h)
    h = F.when((unscaled >= 0) & (F.conv(F.substring(h, 1, 1), 16, 10).cast("int") >= 8),
               F.concat(F.lit("00"), h)).otherwise(h)
    return F.to_json(F.struct(F.lit(scale).alias("scale"), F.base64(F.unhex(h)).alias("value")))
