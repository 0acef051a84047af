"""Column expressions; all of them stay inside the JVM."""

from .columns import (  # noqa: F401
    clean_text,
    draw,
    draw_item,
    epoch_micros,
    iso_timestamp,
    kda,
    kda_hundredths,
    kda_ratio,
    ratio_pct,
    register_sql_functions,
    rounded_div,
    row_uuid,
    size_pretty,
    streakcount,
)
