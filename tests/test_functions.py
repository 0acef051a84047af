from datetime import datetime, timezone

from pyspark.sql import functions as F

from matchboard.catalog import size_labels
from matchboard.functions import (
    clean_text,
    draw,
    draw_item,
    epoch_micros,
    iso_timestamp,
    kda,
    kda_ratio,
    ratio_pct,
    register_sql_functions,
    rounded_div,
    size_pretty,
    streakcount,
)
from matchboard.sources.fixtures import Tables


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_kda(spark):
    df = spark.createDataFrame(
        [(5, 0, 3), (5, 2, 3), (0, 0, 0), (None, 2, 1), (1, 3, 1)], "kills int, deaths int, assists int"
    ).coalesce(1)
    expected = [None, 4.0, None, 0.5, 0.67]
    assert values(df, kda("kills", "assists", "deaths")) == expected
    assert values(df, kda_ratio("kills", "assists", "deaths"))[:3] == [None, 4.0, None]


def test_ratio_rounds_half_up(spark):
    pairs = [(1, 8), (1, 3), (2, 3), (0, 5), (1, 0), (1, 800), (-1, 800), (None, 1)]
    df = spark.createDataFrame(pairs, "a long, b long").coalesce(1)
    assert values(df, ratio_pct("a", "b")) == [12.5, 33.33, 66.67, 0.0, None, 0.13, -0.13, None]
    assert values(df.limit(3), rounded_div("b", F.col("a") * 2)) == [4, 2, 1]


def test_streakcount(spark):
    texts = [None, "", "1, 0, 1, 1", "1,0", " 1 ", "   ", "0", "1 ,1 , 1", "2, 1"]
    df = spark.createDataFrame([(t,) for t in texts], "h string").coalesce(1)
    expected = [0, 0, 2, 0, 1, 0, 0, 3, 1]
    assert values(df, streakcount("h")) == expected
    register_sql_functions(spark)
    assert values(df, F.expr("streakcount(h)")) == expected


def test_size_pretty(spark):
    sizes = [0, 10239, 10240, 163840, 10485247, 10485248, 5 * 1024**3, 11 * 1024**4]
    df = spark.createDataFrame([(s,) for s in sizes], "n long").coalesce(1)
    assert values(df, size_pretty("n")) == [
        "0 bytes", "10239 bytes", "10 kB", "160 kB", "10239 kB", "10 MB", "5120 MB", "11 TB",
    ]


def size_text(n):
    for power, unit in ((4, "TB"), (3, "GB"), (2, "MB"), (1, "kB")):
        if n >= 10 * 1024**power - 1024 ** (power - 1) // 2 * (power > 1):
            return f"{(n + 1024**power // 2) // 1024**power} {unit}"
    return f"{n} bytes"


def test_size_pretty_is_exact_at_any_size(spark):
    edges = [10 * 1024**p - 1024 ** (p - 1) // 2 + d for p in (2, 3, 4) for d in (-1, 0, 1)]
    halves = [k * 1024**4 + 1024**4 // 2 + d for k in (11, 8_388_606, 10**9, 9 * 10**25) for d in (-1, 0)]
    sizes = [*edges, *halves, 2**63 - 1, 2**63, 10**38 - 1, -5, -(2**63), -(10**38) + 1]
    df = spark.createDataFrame([(str(s),) for s in sizes] + [(None,)], "n string").coalesce(1)
    assert values(df, size_pretty(F.col("n").cast("decimal(38,0)"))) == [*map(size_text, sizes), None]
    longs = df.where(F.col("n").try_cast("long").isNotNull())
    assert values(longs, size_pretty(F.col("n").cast("long"))) == [size_text(s) for s in sizes if -(2**63) <= s < 2**63]
    assert values(spark.sql("SELECT 10239.9D AS n"), size_pretty("n")) == ["10239 bytes"]


def test_size_labels_of_large_keys(spark):
    keys = [0, 21, 22, 2_097_151, 2_097_152, 8_999_999, 53_999_999, 4 * 10**12, -3, None, 21]
    orders = spark.createDataFrame([(k,) for k in keys], "o_orderkey long").coalesce(1)
    got = size_labels(Tables(spark, "", {"orders": orders})).collect()
    assert [tuple(r) for r in got] == [(k, None if k is None else size_text(k**3)) for k in keys]


def test_iso_timestamp(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2026-05-15 10:58:33.767569' AS t")
    assert values(df, iso_timestamp("t")) == ["2026-05-15T10:58:33.767569"]


def test_epoch_micros_by_the_clock(spark):
    texts = ["2024-03-10 01:59:59.999999", "2024-03-10 02:30:00", "2024-03-10 03:00:00", "1969-12-31 23:59:59.5"]
    df = spark.createDataFrame([(t,) for t in texts], "s string").coalesce(1)
    df = df.withColumn("t", F.col("s").cast("timestamp_ntz"))
    expected = [int(datetime.fromisoformat(t).replace(tzinfo=timezone.utc).timestamp() * 1e6 + 0.01) for t in texts]
    assert values(df, epoch_micros(df, "t"))[:3] == expected[:3]
    assert values(df, epoch_micros(df, "t"))[3] == -500_000
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:30 does not exist there
    try:
        assert values(df, epoch_micros(df, "t"))[:3] == expected[:3]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    zoned = df.select(F.lit(5).alias("n"), F.timestamp_micros(F.lit(7)).alias("t"))
    assert values(zoned, epoch_micros(zoned, "t")) == [7] * 4


def test_clean_text_repairs_bytes_and_keeps_all_else(spark):
    broken = spark.sql("SELECT cast(X'61FF62' AS string) AS t")
    assert values(broken, clean_text("t")) == ["a�b"]
    good = spark.createDataFrame([("zażółć 😀 漢字",), (None,)], "t string").coalesce(1)
    assert values(good, clean_text("t")) == ["zażółć 😀 漢字", None]


def test_draws_depend_on_key_only(spark):
    df = spark.range(2000)
    one = sorted(r[0] for r in df.repartition(7).select(draw("s", "id")).collect())
    two = sorted(r[0] for r in df.coalesce(1).select(draw("s", "id")).collect())
    assert one == two
    assert 0 <= one[0] and one[-1] < 1
    assert abs(sum(one) / len(one) - 0.5) < 0.03
    assert df.select(draw_item("abc", "t", "id").alias("v")).distinct().count() == 3
