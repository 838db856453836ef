import calendar

from pyspark.sql import functions as F

from threadmill.functions import titles

KINDS = [
    ("Ask HN: Who is hiring?", "hiring"),
    ("Ask HN: Who is hiring? - May 2014", "hiring"),
    ("Winter round: Who wants to be hired?", "seekers"),
    ("Freelancer - autumn", "freelancer"),
    ("Show: a list of who is hiring", "other"),
    (" Ask HN: Who is hiring?", "other"),
    ("ASK HN: WHO IS HIRING?", "other"),
    ("", "other"),
]
MONTHS = [
    *((f"jobs ({name} {1990 + n})", "1970-01", f"{1990 + n}-{n:02}") for n, name in enumerate(calendar.month_name) if n),
    ("jobs of 2013", "2013-02", "2013-02"),
    ("jobs of 2013", None, None),
    ("jobs (Frimaire 1799)", "1799-11", "1799-11"),
    ("x (JUNE 2011)", None, "2011-06"),
    ("x (März 2020) (June 2020)", "F", "F"),
    ("x (remote) (June 2020)", "F", "2020-06"),
]


def test_kinds(column):
    assert column([t for t, _ in KINDS], lambda v: titles.classify_kind(F.col(v))) == [k for _, k in KINDS]


def test_months(spark):
    rows = [(i, *m) for i, m in enumerate(MONTHS)]
    df = spark.createDataFrame(rows, "i int, t string, f string, want string")
    got = df.select("i", titles.parse_month(F.col("t"), F.col("f")).alias("m")).orderBy("i").collect()
    assert [r.m for r in got] == [m[2] for m in MONTHS]


def test_month_prefix(column):
    values = ["2020-05-01T00:00:00Z", "2020-05", "2020-0", "", None]
    assert column(values, lambda v: titles.month_prefix(F.col(v))) == ["2020-05", "2020-05", None, None, None]
