"""Job threads, posts, ledger and golden set derived from the test tables.

The test tables hold no job threads. Every document becomes one post, 20 documents
share a thread, and the thread with id 0 gets a third of all posts, as a hot key. All
values are integer arithmetic on the document id, written as SQL expressions that Spark
and DuckDB read alike: the queries build their input from them, and the comparison SQL
states the expected values with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import DOCUMENT
from .landed import thread_columns, thread_posts

RUN_TS = "2025-01-01T00:00:00+00:00"
BLOCK = "cast((doc_id - doc_id % 20) / 20 as bigint)"
DAY_ONE = "-01T00:00:00.000Z"


def choose(value: str, *options: str | None) -> str:
    """CASE over 0, 1, 2, ...; None stands for NULL."""
    arms = " ".join(f"when {i} then {o}" for i, o in enumerate(options) if o is not None)
    return f"(case {value} {arms} end)"


def quoted(*texts: str | None) -> list[str | None]:
    return [None if t is None else "'" + t + "'" for t in texts]


# --- threads: select lists, each over the one before, starting from (block, n) ---------

THREAD_STEPS = (
    ("block as id", "block % 96 as month_no", "n"),
    (
        "id",
        "n",
        "2017 + cast((month_no - month_no % 12) / 12 as bigint) as year",
        "month_no % 12 as month_of_year",
    ),
    (
        "id",
        "n",
        "cast(year as string) as year",
        "lpad(cast(month_of_year + 1 as string), 2, '0') as mm",
        "(case when id % 18 = 3 then 'Smarch' else "
        + choose(
            "month_of_year",
            *quoted(
                "January", "February", "March", "April", "May", "June",
                "July", "August", "September", "October", "November", "December",
            ),
        )
        + " end) as month_name",
    ),
    (
        "id",
        "(case id % 9 when 7 then 'Ask HN: Freelancer? Seeking freelancer?' "
        "when 5 then 'Ask HN: Who wants to be hired?' when 8 then 'Ask HN: Who was hired?' "
        "else 'Ask HN: Who is hiring?' end) || ' (' || month_name || ' ' || year || ')' as title",
        f"(case when id % 36 <> 21 then year || '-' || mm || '{DAY_ONE}' end) as created_at",
        "(case when id % 13 <> 6 then n end) as num_comments",
    ),
)
THREAD_FETCHED = f"(case id % 4 when 1 then null when 2 then '' else '{RUN_TS}' end)"

# --- posts: over documents --------------------------------------------------------------

THREAD_OF_POST = (
    "(case when doc_id % 61 = 7 then -1 when doc_id % 3 = 0 then 0 "
    f"when ({BLOCK} % 96) % 24 = 23 then {BLOCK} - 1 else {BLOCK} end)"
)
LINK = "'https://jobs.example.com/' || cast(doc_id as string)"
HTML_LINK = "'https:&#x2F;&#x2F;jobs.example.com&#x2F;' || cast(doc_id as string)"
RAW_HTML = (
    "(case when doc_id % 59 <> 0 then '<p>' || replace(text, chr(10), '</p><p>') || '</p>' || "
    f"(case when doc_id % 5 = 0 then '<p><a href=\"' || {HTML_LINK} || '\" rel=\"nofollow\">apply</a>' "
    "else '' end) end)"
)
POST_CREATED = "(case when doc_id % 45 <> 0 then '2024-01-01T00:00:' || lpad(cast(doc_id % 60 as string), 2, '0') || 'Z' end)"
LANDED_POST = (
    "doc_id as id",
    f"{THREAD_OF_POST} as thread_id",
    "'user' || cast(doc_id % 97 as string) as author",
    f"{POST_CREATED} as created_at",
    f"{RAW_HTML} as text",
    "(case when doc_id % 41 = 0 then true end) as deleted",
    "(case when doc_id % 53 = 0 then true end) as dead",
)

# --- ledger: over documents times v (0, 1), then d = doc_id + v ---------------------------

LEDGER_ROWS = "(v = 0 and doc_id % 5 <> 4) or (v = 1 and doc_id % 2 = 0)"
LEDGER_STEPS = (
    (
        "doc_id",
        "doc_id + v as d",
        "(case when doc_id % 67 = 5 then doc_id + 1000000000 else doc_id end) as post_id",
        "(case v when 0 then 'v1' else 'v2' end) as prompt_version",
        "1 as schema_version",
        choose("doc_id % 3", *quoted("gpt-4o-mini", "gpt-4.1-nano", "house-model")) + " as model",
        "(case when doc_id % 41 = 0 or doc_id % 53 = 0 or length(text) < 50 then 'skipped_empty' "
        "when doc_id % 37 = 0 then 'error' else 'ok' end) as status",
        "cast(length(text) as bigint) as chars",
    ),
    (
        "doc_id",
        "d",
        "post_id",
        "prompt_version",
        "schema_version",
        "model",
        "status",
        "(case when status <> 'ok' then 'empty' when doc_id % 29 = 0 then 'text' "
        "when doc_id % 31 = 0 then 'array' else 'document' end) as payload",
        "(case when status = 'ok' then cast((chars - chars % 4) / 4 as bigint) end) as input_tokens",
        "(case when status = 'ok' then 100 + doc_id % 50 end) as output_tokens",
        "(case when status = 'error' then 'failed call ' || cast(doc_id as string) end) as error",
        f"'{RUN_TS}' as created_at",
    ),
)

# --- documents: fields as expressions over d, and over a position i in a list -------------

COMPANY_MISSING = "d % 23 = 0"
WORKPLACE_MISSING = "d % 19 = 0"
SIGNALS_MISSING = "d % 17 = 0"
TECHNOLOGIES_MISSING = "d % 16 = 15"
SALARY_MISSING = "(d + i) % 6 = 5"
YES_NO = quoted("yes", "no", "unstated")
POST_FIELDS = {
    "post_type": choose(
        "d % 10", *quoted(*["job_posting"] * 7, None, "seeking_work", "meta_or_other")
    ),
    "visa_sponsorship": choose("d % 5", *YES_NO, None, "''"),
    "hiring_count_hint": "(case when d % 21 = 0 then 'several' end)",
}
COMPANY_FIELDS = {
    "name": "(case when d % 7 <> 0 then 'Company ' || cast(d % 37 as string) end)",
    "url": "'https://company.example.com/' || cast(d % 37 as string)",
    "description": "(case when d % 2 = 0 then 'Makes \"things\", & more' end)",
    "stage": "(case when d % 43 = 0 then 'series_z' else "
    + choose("d % 4", *quoted("seed", "series_a", "public", "unstated"))
    + " end)",
    "is_yc": choose("d % 3", *YES_NO),
}
WORKPLACE_FIELDS = {
    "policy": choose("d % 6", *quoted("onsite", "remote", "hybrid", "multiple_options", "unstated", "moon")),
    "remote_region_raw": choose(
        "d % 10",
        *quoted(
            "CET", "remote, estonia", "campus only", "Fully Remote, US only", "EU only",
            "must overlap PST", "", "APAC", None, "North America Only",
        ),
    ),
}
SIGNAL_FIELDS = {
    "company_builds_ai": choose("d % 3", *YES_NO),
    "ai_tools_in_workflow": choose("d % 4", *YES_NO, None),
    "ai_skills_required": choose("d % 5", *YES_NO, "'maybe'", None),
}
APPLICATION_FIELDS = {
    "url": "'https://jobs.example.com/' || cast(d as string)",
    "email": "(case when d % 4 = 0 then 'jobs@example.com' end)",
}
N_ROLES = "d % 4"
ROLE_FIELDS = {
    "title_raw": "(case when (d + i) % 47 <> 0 then 'Engineer ' || cast((d + i) % 6 as string) end)",
    "title_guess": choose("(d + i) % 6", *quoted("backend", "frontend", "data_engineer", None, "other", "wizard")),
    "seniority": choose("(d + i) % 4", *quoted("junior", "senior", "unstated", "guru")),
    "employment_type": choose("(d + i) % 3", *quoted("full_time", "contract", "unstated")),
}
SALARY_FIELDS = {
    "min": "cast((case when d % 9 <> 0 then 100 + (d * 7 + i * 13) % 300 end) as double)",
    "max": "cast((case when d % 11 = 0 then 3000000 when d % 7 = 0 then 50 "
    "else 150000 + (d * 11 % 50) * 1000 end) as double)",
    "currency_raw": choose("(d + i) % 7", *quoted("$", "eur", " CAD$ ", "xyz ", None, "", "₹")),
    "period": choose("(d + i) % 5", *quoted("hour", "year", "year", "year"), None),
    "equity": choose("(d + i) % 3", *YES_NO),
}
N_LOCATIONS = "d % 3"
PLACE = "(d + i * 5) % 8"
LOCATION_FIELDS = {
    "city": choose(PLACE, *quoted("sf", "NYC ", "london", "Berlin", None, "  ", "Oslo", "São Paulo")),
    "region": choose(PLACE, *quoted("CA", None, None, "BE", None, None, None, "SP")),
    "country_raw": choose(PLACE, *quoted(None, "usa", None, "", "Deutschland", "Narnia", None, " Brazil ")),
}
N_TECHNOLOGIES = "3"
TECHNOLOGY = (
    "(case when d % 3 = 0 and i = 0 then 'Python' else "
    + choose(
        "(d * 3 + i * i * 2 + i) % 12",
        *quoted("Python", " golang ", "K8s", "postgres", "React.js", "Zig"),
        "chr(9) || 'spark'",
        *quoted("cobol ", "C#", "node.js", "zig", "apache-spark"),
    )
    + " end)"
)


def _record(fields: dict[str, str], missing: str | None = None) -> str:
    record = "named_struct(" + ", ".join(f"'{n}', {e}" for n, e in fields.items()) + ")"
    return f"(case when not ({missing}) then {record} end)" if missing else record


def _list(length: str, element: str) -> str:
    return f"transform(slice(array(0, 1, 2), 1, cast({length} as int)), i -> {element})"


def document_json() -> str:
    """JSON text of the document with number ``d``, as a Spark SQL expression."""
    salary = _record(SALARY_FIELDS, SALARY_MISSING)
    company = COMPANY_FIELDS | {"industry_tags": "array('software', 'tag' || cast(d % 5 as string))"}
    fields = POST_FIELDS | {
        "company": _record(company, COMPANY_MISSING),
        "locations": _list(N_LOCATIONS, _record(LOCATION_FIELDS)),
        "workplace": _record(WORKPLACE_FIELDS, WORKPLACE_MISSING),
        "roles": _list(N_ROLES, _record(ROLE_FIELDS | {"salary": salary})),
        "technologies_raw": f"(case when not ({TECHNOLOGIES_MISSING}) then {_list(N_TECHNOLOGIES, TECHNOLOGY)} end)",
        "ai_signals": _record(SIGNAL_FIELDS, SIGNALS_MISSING),
        "application": _record(APPLICATION_FIELDS),
    }
    return f"to_json({_record(fields)})"


# --- Spark frames ---------------------------------------------------------------------------


class JobThreads:
    """The derived tables over one folder of test tables, as lazy frames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def listed_threads(self) -> DataFrame:
        """Threads as listed: id, title, created_at, num_comments."""
        blocks = self.table("documents").selectExpr(f"{BLOCK} as block")
        df = blocks.groupBy("block").agg(F.count("*").alias("n"))
        for step in THREAD_STEPS:
            df = df.selectExpr(*step)
        return df

    def landed_pages(self) -> DataFrame:
        """Payloads of the thread list: pages of up to 100 hits, as JSON text."""
        hit = F.struct(F.col("id").cast("string").alias("objectID"), "title", "created_at", "num_comments")
        pages = self.listed_threads().withColumn("page", F.floor(F.col("id") / 100))
        return pages.groupBy("page").agg(F.collect_list(hit).alias("hits")).select(
            F.to_json(F.struct("hits", F.lit(1).alias("nbPages"))).alias("value")
        )

    def landed_posts(self) -> DataFrame:
        return self.table("documents").selectExpr(*LANDED_POST)

    def landed_items(self) -> DataFrame:
        """Thread payloads as JSON text, with at most 50 children and maybe a null child each.

        A thread with more children comes in several payloads, so no list grows with it.
        """
        child = F.struct("id", "author", "created_at", "text", "deleted", "dead")
        grouped = (
            self.landed_posts()
            .withColumn("part", F.floor(F.col("id") / 50))
            .groupBy("thread_id", "part")
            .agg(F.collect_list(child).alias("children"))
        )
        gap = F.when(F.col("part") % 3 == 0, F.array(F.lit(None))).otherwise(F.array())
        items = grouped.withColumn("children", F.concat("children", gap))
        listed = self.listed_threads().withColumnRenamed("id", "thread_id")
        return items.join(listed, "thread_id").select(
            F.to_json(
                F.struct(F.col("thread_id").alias("id"), "title", "created_at", "num_comments", "children")
            ).alias("value")
        )

    def threads(self) -> DataFrame:
        listed = self.listed_threads().withColumn("created_at", F.coalesce("created_at", F.lit("")))
        return thread_columns(listed).withColumn("fetched_at", F.expr(THREAD_FETCHED))

    def posts(self) -> DataFrame:
        child = F.struct("id", "author", "created_at", "text", "deleted", "dead")
        items = self.landed_posts().select(F.col("thread_id").alias("id"), F.array(child).alias("children"))
        return thread_posts(items, RUN_TS)

    def ledger(self) -> DataFrame:
        rows = self.table("documents").select("doc_id", "text", F.explode(F.array(F.lit(0), F.lit(1))).alias("v"))
        df = rows.filter(LEDGER_ROWS)
        for step in LEDGER_STEPS:
            df = df.selectExpr(*step)
        raw_json = (
            "case payload when 'empty' then '{}' when 'text' then 'not json' when 'array' then '[]' "
            f"else {document_json()} end as raw_json"
        )
        return df.selectExpr(
            "post_id", "prompt_version", "schema_version", "model", raw_json,
            "input_tokens", "output_tokens", "status", "error", "created_at",
        )

    def golden(self) -> DataFrame:
        """One record per label; where quality is 0 the expected document is another one."""
        numbered = self.table("labels").selectExpr("doc_id as post_id", "doc_id as d", "doc_id + 1 - quality as d2")
        texts = numbered.selectExpr("post_id", f"{document_json()} as got", "d2 as d").selectExpr(
            "post_id", "got", f"{document_json()} as want"
        )
        return texts.select(
            "post_id",
            F.from_json("got", DOCUMENT).alias("llm_output"),
            F.from_json("want", DOCUMENT).alias("expected"),
        )
