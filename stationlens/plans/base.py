"""How a registered query is presented and how its check SQL is put together."""

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlens.plans import adapters as A

DIGITS = 6


def rounded(c, digits: int):
    """``F.round`` of a double, to the last bit, without decimal arithmetic where no tie is near.

    The nearest whole multiple of the last digit is exact as a quotient of two whole numbers. Up
    to 1e11 multiples the product is off by less than 1e-4, so only values within 1e-3 of a tie
    could go to the other side; those, larger and infinite ones and NaN take ``F.round``.
    """
    unit = F.lit(float(10 ** digits))
    many = c * unit
    sure = (F.abs(many) < 1e11) & (F.abs(many - F.rint(many)) < 0.499)
    return F.when(sure, F.rint(many) / unit).otherwise(F.round(c, digits))


def present(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Rounded doubles, 64-bit integers and ISO text for dates, so that both engines print alike."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            r = rounded(c.cast("double"), digits)
            c = F.when(r == 0, F.lit(0.0)).otherwise(r)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.LongType, T.DecimalType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        out.append(c.alias(f.name))
    return df.select(*out)


def check_sql(body: str, d: str = "", i: str = "", t: str = "", dates: str = "", digits: int = DIGITS, ctes: dict = None) -> str:
    """Check SQL from ``body`` plus the common table expressions it names.

    ``d``, ``i``, ``t`` and ``dates`` list double, integer, timestamp and date columns.
    """
    swaps = [f"CASE WHEN round(CAST({c} AS DOUBLE), {digits}) = 0 THEN 0.0::DOUBLE ELSE round(CAST({c} AS DOUBLE), {digits}) END AS {c}" for c in d.split()]
    swaps += [f"CAST({c} AS BIGINT) AS {c}" for c in i.split()]
    swaps += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in t.split()]
    swaps += [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates.split()]
    replace = f" REPLACE ({', '.join(swaps)})" if swaps else ""
    known = {**A.CTES, **(ctes or {})}
    wanted, text = [], body
    for name in reversed(list(known)):
        if re.search(rf"\b{name}\b", text):
            wanted.append(name)
            text += "\n" + known[name]
    with_clause = ",\n".join(f"{n} AS ({known[n]})" for n in reversed(wanted))
    return (f"WITH RECURSIVE {with_clause}\n" if with_clause else "") + f"SELECT *{replace} FROM ({body}) AS q"
