"""From ledger rows to decoded documents, jobs, places, technologies, classifications."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import fixed_values as V
from ..functions.rules import remote_region, salary_bounds
from ..schemas import DOCUMENT, struct
from ..sources.dims import Dimensions, with_currency, with_place, with_tech
from .ordering import ID_RANGE, id_range, running_total_before

JOB_COLUMNS = (
    "post_id", "role_pos", "prompt_version", "company_name", "company_stage", "is_yc",
    "title_raw", "title_normalized", "seniority", "employment_type", "salary_min",
    "salary_max", "salary_currency", "salary_period", "salary_equity", "workplace_policy",
    "remote_region", "visa_sponsorship", "month",
)


def document_schema(fields: Sequence[str] | None = None) -> T.StructType:
    """The document, or only some of its top-level fields: the parser skips the rest."""
    return DOCUMENT if fields is None else T.StructType([DOCUMENT[f] for f in fields])


def decode(df: DataFrame, raw: str = "raw_json", fields: Sequence[str] | None = None) -> DataFrame:
    """Add ``doc``, the document in JSON column ``raw``, NULL where that is no JSON object.

    The text is parsed inside an outer object, so that anything after the document
    counts as an error too. A text that closes the outer object, or adds members to it, shows in
    the keys of that object: they must be the document and an end key, which the text cannot
    hold as it is a hash of it. A value of the wrong type inside a good document is a NULL and
    keeps the rest; only such rows and bad ones are parsed a second time.
    """
    wrapped = F.concat(F.lit('{"doc":'), F.col(raw), F.lit("}"))
    options = {"columnNameOfCorruptRecord": "_mismatch", "allowSingleQuotes": "false"}

    def read(text: Column, document: T.DataType) -> Column:
        return F.from_json(text, struct(doc=document, _mismatch=T.StringType()), options)

    end = F.concat(F.lit("end"), F.xxhash64(F.col(raw)).cast("string"))
    closed = F.concat(F.lit('{"doc":'), F.col(raw), F.lit(',"'), end, F.lit('":1}'))
    # The strict key scan knows no NaN; a text it does not take is parsed as the document is.
    keys = F.coalesce(F.json_object_keys(closed), F.map_keys(F.from_json(closed, "map<string,string>", options)))
    whole = F.coalesce(keys == F.array(F.lit("doc"), end), F.lit(False))
    parsed = df.withColumn("_parsed", read(wrapped, document_schema(fields)))
    # Any object is a map of texts, whatever its values are.
    any_object = read(F.col("_parsed._mismatch"), T.MapType(T.StringType(), T.StringType()))
    good = F.when(F.col("_parsed._mismatch").isNull(), F.col("_parsed.doc").isNotNull()).otherwise(
        any_object["_mismatch"].isNull() & any_object["doc"].isNotNull()
    )
    good = whole & good
    return (
        parsed.withColumn("doc", F.when(good, F.col("_parsed.doc")))
        .withColumn("has_mismatch", good & F.col("_parsed._mismatch").isNotNull())
        .drop("_parsed")
    )


def extracted_posts(
    ledger: DataFrame, posts: DataFrame, threads: DataFrame, version: str = "v1"
) -> DataFrame:
    """Good ledger rows of one version with the month of their thread.

    Rows without a post, and posts without a thread, drop out. The narrow join of posts
    and threads comes first; of the ledger's JSON there is one shuffle by post at most.
    """
    months = (
        posts.select(F.col("id").alias("post_id"), "thread_id")
        .join(threads.select(F.col("id").alias("thread_id"), "month"), "thread_id")
        .select("post_id", F.coalesce(F.nullif("month", F.lit("")), F.lit("unknown")).alias("month"))
    )
    return (
        ledger.filter((F.col("prompt_version") == version) & (F.col("status") == "ok"))
        .select("post_id", "prompt_version", "raw_json")
        .join(months, "post_id")
    )


def decodable(df: DataFrame, raw: str = "raw_json", fields: Sequence[str] | None = None) -> DataFrame:
    """The rows with a document, with ``doc`` in place of the JSON column.

    An array of nothing or one document is exploded rather than filtered, because a
    filter would be pushed below the parsing and parse every document again.
    """
    one = F.when(F.col("doc").isNotNull(), F.array("doc"))
    kept = [c for c in df.columns if c != raw]
    return decode(df, raw, fields).select(*kept, F.explode(one).alias("doc"))


def decoded_posts(extracted: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """One row per post with a document: post_id, prompt_version, month, doc.

    With the roles among the fields there is also ``n_jobs``, the number of jobs of the post.
    """
    decoded = decodable(extracted, fields=fields).select("post_id", "prompt_version", "month", "doc")
    if fields is not None and "roles" not in fields:
        return decoded
    return decoded.withColumn("n_jobs", n_jobs("doc.roles"))


def n_jobs(roles: str) -> Column:
    """A post without roles counts as one job."""
    return F.greatest(F.coalesce(F.size(roles), F.lit(0)), F.lit(1))


def with_first_job_id(decoded: DataFrame, width: int = ID_RANGE) -> DataFrame:
    """Add ``first_job_id``: dense ids from 1 in the order of post and role.

    The id of a job is ``first_job_id + role_pos``. Posts move once, to their id range;
    the pass that counts jobs per range reads two narrow columns.
    """
    ranged = running_total_before(
        decoded, "n_jobs", "_before", {"_range": id_range("post_id", width)}, [F.col("post_id")]
    )
    return ranged.withColumn("first_job_id", F.col("_before") + 1).drop("_before")


def _ids(decoded: DataFrame) -> list[Column]:
    carried = [F.col(c) for c in ("post_id", "prompt_version", "month")]
    return carried + ([F.col("first_job_id")] if "first_job_id" in decoded.columns else [])


def _with_job_id(df: DataFrame) -> DataFrame:
    if "first_job_id" not in df.columns:
        return df
    return df.withColumn("job_id", F.col("first_job_id") + F.col("role_pos")).drop("first_job_id")


def jobs(
    decoded: DataFrame,
    dims: Dimensions,
    region_rules: Mapping[str, Sequence[str]] = V.REMOTE_REGION_RULES,
    only_job_postings: bool = False,
) -> DataFrame:
    """One row per role; a post without roles gives one job with empty role fields."""
    if only_job_postings:
        decoded = decoded.filter(post_type() == "job_posting")
    roles = decoded.select(
        *_ids(decoded),
        F.col("doc.company.name").alias("company_name"),
        F.col("doc.company.stage").alias("company_stage"),
        F.col("doc.company.is_yc").alias("is_yc"),
        F.col("doc.workplace.policy").alias("workplace_policy"),
        remote_region(F.col("doc.workplace.remote_region_raw"), region_rules).alias("remote_region"),
        F.col("doc.visa_sponsorship").alias("visa_sponsorship"),
        F.posexplode_outer("doc.roles").alias("_pos", "role"),
    )
    salary = F.col("role.salary")
    low, high, capped = salary_bounds(salary["min"], salary["max"], salary["period"])
    rows = roles.select(
        *_ids(decoded),
        F.coalesce("_pos", F.lit(0)).alias("role_pos"),
        "company_name",
        "company_stage",
        "is_yc",
        F.col("role.title_raw").alias("title_raw"),
        F.col("role.title_guess").alias("title_normalized"),
        F.col("role.seniority").alias("seniority"),
        F.col("role.employment_type").alias("employment_type"),
        low.alias("salary_min"),
        high.alias("salary_max"),
        capped.alias("salary_capped"),
        salary["currency_raw"].alias("_currency_raw"),
        salary["period"].alias("salary_period"),
        salary["equity"].alias("salary_equity"),
        "workplace_policy",
        "remote_region",
        "visa_sponsorship",
    )
    rows = _with_job_id(with_currency(rows, dims.currency, "_currency_raw", "salary_currency"))
    ids = ["job_id"] if "job_id" in rows.columns else []
    return rows.select(*ids, *JOB_COLUMNS, "salary_capped")


def post_technologies(decoded: DataFrame, dims: Dimensions) -> DataFrame:
    """One row per technology named in a post, with the number of jobs it counts for."""
    named = decoded.select(
        *_ids(decoded), "n_jobs", F.explode("doc.technologies_raw").alias("tech_raw")
    )
    return with_tech(named.filter(F.col("tech_raw").isNotNull()), dims.tech)


def post_locations(decoded: DataFrame, dims: Dimensions) -> DataFrame:
    """One row per location of a post, with the number of jobs it counts for."""
    places = decoded.select(
        *_ids(decoded), "n_jobs", F.explode("doc.locations").alias("place")
    )
    places = places.filter(F.col("place").isNotNull()).select(
        *_ids(decoded),
        "n_jobs",
        F.col("place.city").alias("_city_raw"),
        F.col("place.region").alias("region"),
        F.col("place.country_raw").alias("_country_raw"),
    )
    return with_place(places, dims, "_city_raw", "_country_raw").drop("_city_raw", "_country_raw")


def per_job(post_rows: DataFrame) -> DataFrame:
    """Repeat rows of a post for each of its jobs."""
    positions = F.sequence(F.lit(0), F.col("n_jobs") - 1)
    return _with_job_id(post_rows.select("*", F.explode(positions).alias("role_pos")).drop("n_jobs"))


def job_technologies(decoded: DataFrame, dims: Dimensions) -> DataFrame:
    return per_job(post_technologies(decoded, dims))


def job_locations(decoded: DataFrame, dims: Dimensions) -> DataFrame:
    return per_job(post_locations(decoded, dims))


def post_type() -> Column:
    return F.coalesce("doc.post_type", F.lit("job_posting"))


def post_classification(decoded: DataFrame) -> DataFrame:
    signals = F.col("doc.ai_signals")
    return decoded.select(
        "post_id",
        "prompt_version",
        post_type().alias("post_type"),
        signals["company_builds_ai"].alias("ai_builds"),
        signals["ai_tools_in_workflow"].alias("ai_workflow"),
        signals["ai_skills_required"].alias("ai_skills"),
    )
