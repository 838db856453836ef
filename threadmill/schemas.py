"""Table and document schemas."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from . import fixed_values as V

LONG, INT, TEXT, REAL, BOOL = LongType(), IntegerType(), StringType(), DoubleType(), BooleanType()


def struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


THREADS = struct(
    id=LONG, title=TEXT, kind=TEXT, month=TEXT, created_at=TEXT, num_comments=LONG, fetched_at=TEXT
)
POSTS = struct(
    id=LONG, thread_id=LONG, author=TEXT, created_at=TEXT, raw_html=TEXT,
    is_deleted=INT, is_dead=INT, fetched_at=TEXT,
)
LEDGER = struct(
    post_id=LONG, prompt_version=TEXT, schema_version=INT, model=TEXT, raw_json=TEXT,
    input_tokens=LONG, output_tokens=LONG, status=TEXT, error=TEXT, created_at=TEXT,
)
# Logs keep when a row landed: for posts the file (time, name, start), the place in it and in its document,
# for ledger rows the start of the batch in microseconds.
POSTS_LOG = StructType(
    [
        *POSTS.fields,
        StructField(
            "landed",
            struct(document=struct(file=struct(time=TimestampType(), path=TEXT, start=LONG), place=LONG), child=INT),
        ),
    ]
)
LEDGER_LOG = StructType([*LEDGER.fields, StructField("landed", LONG)])
DOCUMENT = struct(
    post_type=TEXT,
    company=struct(
        name=TEXT, url=TEXT, description=TEXT, stage=TEXT, is_yc=TEXT, industry_tags=ArrayType(TEXT)
    ),
    locations=ArrayType(struct(city=TEXT, region=TEXT, country_raw=TEXT)),
    workplace=struct(policy=TEXT, remote_region_raw=TEXT),
    visa_sponsorship=TEXT,
    roles=ArrayType(
        struct(
            title_raw=TEXT, title_guess=TEXT, seniority=TEXT, employment_type=TEXT,
            salary=struct(min=REAL, max=REAL, currency_raw=TEXT, period=TEXT, equity=TEXT),
        )
    ),
    technologies_raw=ArrayType(TEXT),
    ai_signals=struct(company_builds_ai=TEXT, ai_tools_in_workflow=TEXT, ai_skills_required=TEXT),
    application=struct(url=TEXT, email=TEXT),
    hiring_count_hint=TEXT,
)
GOLDEN = struct(post_id=LONG, month=TEXT, raw_html=TEXT, llm_output=DOCUMENT, expected=DOCUMENT)

# Landed payloads. Replies below the first level are left out of the schema, so the
# JSON reader skips them.
THREAD_PAGES = struct(
    hits=ArrayType(struct(objectID=TEXT, title=TEXT, created_at=TEXT, num_comments=LONG)), nbPages=INT
)
THREAD_ITEMS = struct(
    id=LONG, title=TEXT, created_at=TEXT, num_comments=LONG,
    children=ArrayType(
        struct(id=LONG, author=TEXT, created_at=TEXT, text=TEXT, deleted=BOOL, dead=BOOL)
    ),
)
PRICES = struct(model=TEXT, input_per_1m=REAL, output_per_1m=REAL)

# Closed domains: fields of the post, then fields of each role.
POST_DOMAINS = {
    "post_type": V.POST_TYPES,
    "company.stage": V.COMPANY_STAGES,
    "company.is_yc": V.YES_NO_UNSTATED,
    "workplace.policy": V.WORKPLACE_POLICIES,
    "visa_sponsorship": V.YES_NO_UNSTATED,
    "ai_signals.company_builds_ai": V.YES_NO_UNSTATED,
    "ai_signals.ai_tools_in_workflow": V.YES_NO_UNSTATED,
    "ai_signals.ai_skills_required": V.YES_NO_UNSTATED,
}
ROLE_DOMAINS = {
    "title_guess": V.TITLE_GUESSES,
    "seniority": V.SENIORITIES,
    "employment_type": V.EMPLOYMENT_TYPES,
    "salary.period": V.SALARY_PERIODS,
    "salary.equity": V.EQUITY_VALUES,
}
# Fields an answer must have, and what a missing field with a domain stands for if not "unstated".
REQUIRED = ("roles.title_raw",)
DEFAULTS = {"post_type": "job_posting", "roles.title_guess": "other"}
