"""Column → Column helpers. Exact where the result is rounded: integers, never rounded doubles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str


def _col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def kda_ratio(kills: ColumnLike, assists: ColumnLike, deaths: ColumnLike) -> Column:
    """Unrounded (kills + assists) / deaths; NULL when there were no deaths."""
    return (_col(kills) + _col(assists)).cast("double") / F.nullif(_col(deaths), F.lit(0)).cast("double")


def rounded_div(part: ColumnLike, whole: ColumnLike) -> Column:
    """part / whole as a whole number, rounded half away from zero; NULL when whole is 0."""
    part, whole = _col(part).cast("long"), F.nullif(_col(whole).cast("long"), F.lit(0).cast("long"))
    size = F.call_function("div", F.abs(part) * 2 + F.abs(whole), F.abs(whole) * 2)
    return F.when((part < 0) != (whole < 0), -size).otherwise(size)


def kda_hundredths(kills: ColumnLike, assists: ColumnLike, deaths: ColumnLike) -> Column:
    """KDA in hundredths, rounded: missing counts taken as 0, NULL when there were no deaths."""
    counts = [F.coalesce(_col(c), F.lit(0)) for c in (kills, assists, deaths)]
    return rounded_div((counts[0] + counts[1]).cast("long") * 100, counts[2])


def kda(kills: ColumnLike, assists: ColumnLike, deaths: ColumnLike) -> Column:
    """KDA rounded to 2 places, missing counts taken as 0, NULL when there were no deaths."""
    return kda_hundredths(kills, assists, deaths).cast("double") / 100


def ratio_pct(part: ColumnLike, whole: ColumnLike) -> Column:
    """100 * part / whole rounded to 2 places; NULL when whole is 0."""
    return rounded_div(_col(part).cast("long") * 10000, whole).cast("double") / 100


def streakcount(history: ColumnLike) -> Column:
    """Length of the run of 1s that ends a comma separated list; NULL and blank give 0."""
    text = F.trim(_col(history))
    marks = F.split(text, r"\s*,\s*").cast("array<int>")
    run = F.aggregate(marks, F.lit(0), lambda n, mark: F.when(mark == 1, n + 1).otherwise(F.lit(0)))
    return F.when(text.isNull() | (text == ""), F.lit(0)).otherwise(run)


def register_sql_functions(spark: SparkSession) -> None:
    """Offer ``streakcount`` to SQL text as a temporary function."""
    spark.sql(
        r"""
        CREATE OR REPLACE TEMPORARY FUNCTION streakcount(a STRING) RETURNS INT RETURN
          CASE WHEN a IS NULL OR trim(a) = '' THEN 0
               ELSE aggregate(cast(split(trim(a), '\\s*,\\s*') AS array<int>), 0,
                              (n, mark) -> CASE WHEN mark = 1 THEN n + 1 ELSE 0 END) END
        """
    )


_UNITS = ((1, "kB"), (2, "MB"), (3, "GB"), (4, "TB"))


def _size_text(size: Column, units: Sequence[tuple[int, str]]) -> Column:
    text = F.concat(size.cast("string"), F.lit(" bytes"))
    for power, unit in units:
        # a unit is used from 10 of it less half of the unit below, where rounding first shows 10
        whole = 1024**power
        floor = 10 * 1024 if power == 1 else 10 * whole - 1024 ** (power - 1) // 2
        # without its remainder the size is a multiple, whose quotient is exact in doubles and in decimals
        shown = ((size - size % whole) / whole).cast("decimal(38,0)") + F.when(size % whole >= whole // 2, 1).otherwise(0)
        text = F.when(size >= floor, F.concat(shown.cast("string"), F.lit(f" {unit}"))).otherwise(text)
    return text


def size_pretty(n_bytes: ColumnLike) -> Column:
    """Readable size: plain bytes below 10 kB, then kB, MB, GB, TB rounded half up.

    Sizes that no long holds may be given as decimals, of up to 38 digits.
    """
    given = _col(n_bytes)
    size = given.try_cast("long")
    # what no long holds is terabytes, or negative
    return F.when(size.isNull(), _size_text(given.cast("decimal(38,0)"), _UNITS[-1:])).otherwise(_size_text(size, _UNITS))


def iso_timestamp(ts: ColumnLike) -> Column:
    """ISO 8601 text with microseconds."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def epoch_micros(df: DataFrame, column: str) -> Column:
    """Microseconds since 1970; a time without a zone is counted by its clock, whatever the session's zone."""
    if df.schema[column].dataType != T.TimestampNTZType():
        return F.unix_micros(F.col(column).cast("timestamp"))
    since = F.col(column) - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    days, hours, minutes, seconds = (F.extract(F.lit(unit), since) for unit in ("DAY", "HOUR", "MINUTE", "SECOND"))
    whole = (days.cast("long") * 24 + hours.cast("long")) * 60 + minutes.cast("long")
    return whole * 60_000_000 + (seconds * 1_000_000).cast("long")


def clean_text(text: ColumnLike) -> Column:
    """Text that any JSON or CSV reader accepts: bad byte runs replaced, lone surrogates dropped."""
    valid = F.make_valid_utf8(_col(text))
    return F.regexp_replace(valid, r"[\x{D800}-\x{DFFF}]", "")


def draw(seed: str, *key: ColumnLike) -> Column:
    """Uniform number in [0, 1) that depends on seed and key only.

    Unlike ``rand`` it does not depend on partitioning, so a retried task draws the same again.
    """
    digest = F.md5(F.concat_ws(":", F.lit(seed), *[_col(k).cast("string") for k in key]).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / float(16**13)


def draw_item(items: Sequence, seed: str, *key: ColumnLike) -> Column:
    """One element of a short list, chosen by ``draw``."""
    values = F.array(*[F.lit(item) for item in items])
    return F.element_at(values, (F.floor(draw(seed, *key) * len(items)) + 1).cast("int"))


def row_uuid(seed: str, *key: ColumnLike) -> Column:
    """An id in UUID form that depends on seed and key only."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), *[_col(k).cast("string") for k in key]).cast("binary"))
    bounds = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in bounds])
