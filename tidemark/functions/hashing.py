"""Row hashes over a column list, in text that does not depend on the session."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_MARK = "\x00"


def canonical(column: Column, dtype: T.DataType, time_digits: int = 6) -> Column:
    """One text per value: decimals with their full scale, times with six digits, or more
    (zeros) where the rows of another system were hashed so.

    Doubles are refused, since the same number prints differently elsewhere and
    sums of doubles depend on their order: cast them to a decimal first.
    """
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        raise TypeError("cast floating-point columns to a decimal before hashing")
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        raise TypeError(f"cannot hash a column of type {dtype.simpleString()}")
    if isinstance(dtype, T.TimestampNTZType):
        return _digits(column.cast("string"), time_digits)
    if isinstance(dtype, T.TimestampType):
        # Instants are written in UTC, whatever zone the session shows them in.
        seconds = (F.unix_micros(column).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        utc = epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
        return _digits(utc.cast("string"), time_digits)
    if isinstance(dtype, T.BinaryType):
        return F.hex(column)
    if isinstance(dtype, T.StringType):
        return column
    return column.cast("string")


def row_hash(df: DataFrame, columns: Sequence[str], bits: int = 512, nulls: str = "skip",
             style: str = "hex", sep: str = "~", time_digits: int = 6,
             encoding: str = "UTF-8") -> Column:
    """SHA-2 over the named columns of ``df``, in the given order.

    nulls="skip" leaves NULLs out, so a value moving between two neighbouring
    nullable columns keeps the hash; nulls="mark" tells those rows apart.
    style="0x" writes upper-case hex after 0x instead of bare lower-case hex.
    ``time_digits`` (6 or more) and ``encoding`` (such as "UTF-16LE") give the hashes of a
    system that writes its times and its text so.
    """
    if time_digits < 6:
        raise ValueError("times need six digits")
    if nulls not in ("skip", "mark") or style not in ("hex", "0x"):
        raise ValueError(f"unknown option: nulls={nulls!r}, style={style!r}")
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    missing = [c for c in columns if c.lower() not in types]
    if missing:
        raise ValueError(f"no such columns to hash: {', '.join(missing)}")
    parts = []
    for name in columns:
        try:
            part = canonical(F.col(f"`{name}`"), types[name.lower()], time_digits)
        except TypeError as problem:
            raise TypeError(f"column {name}: {problem}") from None
        parts.append(F.coalesce(part, F.lit(NULL_MARK)) if nulls == "mark" else part)
    text = F.concat_ws(sep, *parts)
    digest = F.sha2(text if encoding.upper() == "UTF-8" else F.encode(text, encoding), bits)
    return F.concat(F.lit("0x"), F.upper(digest)) if style == "0x" else digest


def _digits(text: Column, digits: int) -> Column:
    # Text of a time is trimmed to the digits it needs: fill up the fraction again.
    return F.concat(F.substring(text, 1, 19), F.lit("."),
                    F.rpad(F.substring(text, 21, 6), digits, "0"))
