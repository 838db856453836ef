import json

from pyspark.sql import functions as F

from threadmill import fixed_values as V
from threadmill.sources import dims


def _one(df, raw, out):
    return {r[raw]: r[out] for r in df.select(raw, out).collect()}


def test_technologies(spark):
    table = dims.alias_frame(spark, {"golang": "go", "K8s": "kubernetes", "js": "javascript"})
    raw = ["golang", "Golang", "somethingNew", "k8s", " JS\t", "\xa0js\n", "  "]
    df = dims.with_tech(spark.createDataFrame([(r,) for r in raw], "tech_raw string"), table)
    assert _one(df, "tech_raw", "tech") == {
        "golang": "go", "Golang": "go", "somethingNew": "somethingnew", "k8s": "kubernetes",
        " JS\t": "javascript", "\xa0js\n": "javascript", "  ": "",
    }
    assert _one(df, "tech_raw", "aliased") == {r: int(r not in ("somethingNew", "  ")) for r in raw}


def test_canonical_name_without_entry_is_unmapped(spark):
    df = spark.createDataFrame([("spark",), ("apache-spark",)], "tech_raw string")
    got = dims.with_tech(df, dims.built_in_dimensions(spark).tech).collect()
    assert {(r.tech_raw, r.tech, r.aliased) for r in got} == {
        ("spark", "apache-spark", 1), ("apache-spark", "apache-spark", 0),
    }


def test_places(spark):
    rows = [
        ("sf", None), ("london", None), ("London", None), ("  ", None), (None, "USA"), ("Atlantis", "Narnia"),
        ("", " "), ("Berlin", ""), ("NYC ", "uk"), ("Berlin", " "), ("Atlantis", " "), ("Oslo", None),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, c string, k string")
    got = dims.with_place(df, dims.built_in_dimensions(spark), "c", "k").orderBy("i").collect()
    assert [(r.city, r.country) for r in got] == [
        ("San Francisco", "US"), ("london", None), ("London", "GB"), ("", None), (None, "US"),
        ("Atlantis", "Narnia"), (None, ""), ("Berlin", "DE"), ("New York", "GB"), ("Berlin", "DE"),
        ("Atlantis", None), ("Oslo", "NO"),
    ]


def test_currencies(spark):
    raw = ["$", "€", "USD", " cad$ ", "xyz", None, ""]
    df = spark.createDataFrame([(r,) for r in raw], "c string")
    got = _one(dims.with_currency(df, dims.built_in_dimensions(spark).currency, "c", "code"), "c", "code")
    assert got == {"$": "USD", "€": "EUR", "USD": "USD", " cad$ ": "CAD", "xyz": "XYZ", None: None, "": None}


def test_built_in_tables_are_broadcast_by_their_size(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("tech_raw"))
    plan = dims.with_tech(df, dims.built_in_dimensions(spark).tech)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_table_sizes():
    assert len(V.TECH_ALIASES) == 181 and len(set(V.TECH_ALIASES.values())) == 114
    assert (len(V.CITY_ALIASES), len(V.CITY_COUNTRIES)) == (30, 56)
    assert set(V.CITY_ALIASES.values()) <= set(V.CITY_COUNTRIES)
    assert (len(V.COUNTRY_ALIASES), len(V.CURRENCY_ALIASES)) == (43, 32)
    assert [len(p) for p in V.REMOTE_REGION_RULES.values()] == [11, 14, 8, 20]


def test_alias_file(spark, tmp_path):
    file = tmp_path / "aliases.yaml"
    file.write_text(
        "# names\naliases:\n  sf: San Francisco\n  \"new york, ny\": New York  # usual\n  SF: Frisco\n\n"
        "city_country:\n  Oslo: \"NO\"\n  San Francisco: US\n"
    )
    aliases = dims.read_aliases(spark, str(file), "aliases").collect()
    assert {(r.alias, r.canonical) for r in aliases} == {("sf", "Frisco"), ("new york, ny", "New York")}
    cities = dims.read_aliases(spark, str(file), "city_country", lower_keys=False).collect()
    assert {(r.alias, r.canonical) for r in cities} == {("Oslo", "NO"), ("San Francisco", "US")}


def test_flat_alias_file(spark, tmp_path):
    file = tmp_path / "tech.yaml"
    file.write_text('python: python\n"C#": csharp\nc/c++: c/c++\nci / cd: ci-cd\n"$": USD\nllm apis: llm-apis')
    got = dims.read_aliases(spark, str(file)).collect()
    assert {(r.alias, r.canonical) for r in got} == {
        ("python", "python"), ("c#", "csharp"), ("c/c++", "c/c++"), ("ci / cd", "ci-cd"), ("$", "USD"),
        ("llm apis", "llm-apis"),
    }


def test_price_file(spark, tmp_path):
    file = tmp_path / "prices.json"
    file.write_text(json.dumps({"m": {"input_per_1m": 0.5, "output_per_1m": 2}, "n": {}}))
    got = {r.model: (r.input_per_1m, r.output_per_1m) for r in dims.read_prices(spark, str(file)).collect()}
    assert got == {"m": (0.5, 2.0), "n": (0.0, 0.0)}
    assert dims.read_prices(spark, str(tmp_path / "missing.json")).count() == 0
    file.write_text("no json")
    assert dims.read_prices(spark, str(file)).count() == 0
