from pyspark.sql import functions as F

from threadmill.functions import measures, rules

# Bounds under a thousand a year are thousands, each for itself; other periods are taken as written.
_THOUSANDS = [
    ((999.0, 1_000.0, "year"), (1_000.0, 999_000.0, False)),
    ((999.99, 1_000.01, "year"), (1_000.01, 999_990.0, False)),
    ((-1.0, 0.0, "year"), (-1_000.0, 0.0, False)),
    *(((41.0, 43.0, period), (41.0, 43.0, False)) for period in ("hour", "day", "month", "unstated", None)),
]
# Bounds in the wrong order change places in any period, after they have become thousands.
_ORDER = [
    ((300.0, 20_000.0, "year"), (20_000.0, 300_000.0, False)),
    ((9.0, 8.0, None), (8.0, 9.0, False)),
    ((70.0, 70.0, "day"), (70.0, 70.0, False)),
    ((None, 12.0, "hour"), (None, 12.0, False)),
    ((650.0, None, "year"), (650_000.0, None, False)),
]
# More than two millions a year are no salary; the bound goes, after the two are in order.
_CEILING = [
    ((2_000_000.0, 2_000_001.0, "year"), (2_000_000.0, None, True)),
    ((2_000_000.5, 1_999_999.0, "year"), (1_999_999.0, None, True)),
    ((4e6, 5e6, "year"), (None, None, True)),
    ((4e6, None, "year"), (None, None, True)),
    ((4e6, 5e6, "month"), (4e6, 5e6, False)),
    ((None, None, "year"), (None, None, False)),
]
SALARIES = _THOUSANDS + _ORDER + _CEILING


def test_salary(spark):
    rows = [(i, *s) for i, (s, _) in enumerate(SALARIES)]
    df = spark.createDataFrame(rows, "i int, lo double, hi double, period string")
    low, high, capped = rules.salary_bounds(F.col("lo"), F.col("hi"), F.col("period"))
    got = df.select("i", low.alias("a"), high.alias("b"), capped.alias("c")).orderBy("i").collect()
    assert [(r.a, r.b, r.c) for r in got] == [want for _, want in SALARIES]


def test_regions_with_own_rules(column):
    own = {
        "planet": ["earth", "any country"],
        "north": ["norway", "sweden", "nordic"],
        "nowhere": [],
        "hours": ["utc+", "shift"],
    }
    values = ["Nordic or any country", "based in NORWAY", "night shift, Sweden", "UTC+2 to UTC+4", "Peru", "nowhere", None, ""]
    want = ["planet", "north", "north", "hours", "other", "other", None, None]
    assert column(values, lambda v: rules.remote_region(F.col(v), own)) == want


def test_built_in_regions(column):
    values = ["CET", "remote, estonia", "campus only", "fully remote, us only", " ", "9-5 CET"]
    want = ["other", "timezone_bound", "us_only", "worldwide", "other", "timezone_bound"]
    assert column(values, lambda v: rules.remote_region(F.col(v))) == want


def test_measures(spark):
    df = spark.createDataFrame([(0, 0), (5, 10), (10, 10), (9, 10), (1, 0)], "n long, m long")
    got = df.select(
        measures.percent(F.col("n"), F.col("m")).alias("p"),
        measures.level_index(F.col("n"), F.col("m")).alias("l"),
        measures.level_glyph(F.col("n"), F.col("m")).alias("g"),
    ).collect()
    assert [r.p for r in got] == [0.0, 50.0, 100.0, 90.0, 0.0]
    assert [r.l for r in got] == [0, 3, 7, 6, 7]
    assert [r.g for r in got] == ["▁", "▄", "█", "▇", "█"]


def test_labels_and_years(column):
    assert column([None, "", "yes"], lambda v: measures.null_label(F.col(v))) == ["null", "null", "yes"]
    assert column([None, "2020-03", "unknown"], lambda v: measures.year_bucket(F.col(v))) == ["0000", "2020", "unkn"]
