"""People per company: flatten nested results, rank by seniority, keep the best, remember queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.text import filled
from leadloom.operators.ingest import first_per_key
from leadloom.operators.qualify import band_titles, lead_title
from leadloom.operators.skew import spread_join
from leadloom.rules import DEFAULT_RULES, PEOPLE_PER_COMPANY, Rules

CANDIDATE = (
    "full_name", "title", "linkedin_url", "location", "about_snippet", "provider", "company_domain", "result_pos",
)


def _location(place: Column) -> Column:
    """Location given as an object (city, state, country) or as a plain text."""
    part = lambda name: filled(F.try_variant_get(place, f"$.{name}", "string"))
    joined = filled(F.concat_ws(", ", part("city"), part("state"), part("country")))
    is_object = F.schema_of_variant(place).startswith("OBJECT")
    return F.when(is_object, joined).otherwise(filled(F.try_variant_get(place, "$", "string")))


def flatten_people(items: DataFrame, provider: str = DEFAULT_RULES.provider) -> DataFrame:
    """Candidates from nested person/company results. ``items`` has ``person`` and ``company`` structs
    and ``result_pos``; other columns (such as the company key) are kept. E-mail and phone are never
    read."""
    person = lambda name: F.col(f"person.{name}")
    headline = filled(person("headline"))
    kept = [c for c in items.columns if c not in ("person", "company", "result_pos")]
    return items.select(
        *kept,
        F.coalesce(filled(person("full_name")),
                   F.concat_ws(" ", filled(person("first_name")), filled(person("last_name")))).alias("full_name"),
        F.coalesce(filled(person("current_job_title")), person("headline")).alias("title"),
        person("linkedin_url").alias("linkedin_url"),
        _location(person("location")).alias("location"),
        F.coalesce(headline, F.lit("")).alias("about_snippet"),
        F.lit(provider).alias("provider"),
        F.coalesce(filled(F.col("company.domain")), F.col("company.website")).alias("company_domain"),
        "result_pos",
    )


def seniority(title: Column, titles: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """Two points per leader word in the title, one per domain word in both the title and the band's
    titles (substring semantics)."""
    text = F.lower(F.coalesce(title, F.lit("")))
    band = F.lower(F.array_join(titles, " "))
    points = F.lit(0)
    for word in rules.rank_leader_words:
        points = points + F.when(text.contains(word), 2).otherwise(0)
    for word in rules.rank_domain_words:
        points = points + F.when(text.contains(word) & band.contains(word), 1).otherwise(0)
    return points


def top_people(people: DataFrame, limit: int = PEOPLE_PER_COMPANY, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The most senior people per company, ties in result order; at most ``people_per_company``.
    ``people`` carries ``employees`` of its company."""
    scored = people.withColumn("score", seniority(F.col("title"), band_titles(F.col("employees"), rules), rules))
    order = [F.col("score").desc(), F.col("result_pos")]
    return first_per_key(scored, ["company_key"], order, min(limit, rules.people_per_company))


def with_target(companies: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    return companies.withColumn("target_title", lead_title(F.col("employees"), rules))


def unqueried(companies: DataFrame, guard: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Companies whose (company, target title) was never queried, and those that were, whatever came
    of it. Companies outside every band have no target title and are in neither."""
    asked = guard.select("company_key", "target_title")
    keys = ["company_key", "target_title"]
    open_ = companies.filter(F.col("target_title").isNotNull())
    return open_.join(asked, keys, "left_anti"), open_.join(asked, keys, "left_semi")


def people_of(companies: DataFrame, people: DataFrame, rules: Rules = DEFAULT_RULES, few: bool = False) -> DataFrame:
    """Best people of each company, out of a people table with ``company_key``.

    The people table is the large side; a company with very many people is spread before it is
    ranked, and the ranking keeps two rows per task and company before its shuffle. Where the companies are known to be
    ``few``, they are broadcast and the people stay where they are."""
    facts = companies.select("company_key", "employees", "target_title")
    if few:
        found = people.join(F.broadcast(facts), "company_key")
    else:
        found = spread_join(people, facts, ["company_key"], [F.col("result_pos")], "inner")
    return top_people(found, rules=rules)


def query_outcomes(searched: DataFrame, candidates: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One guard row per searched company: hit with the number of people kept, or no candidate."""
    counts = candidates.groupBy("company_key").agg(F.count(F.lit(1)).cast("int").alias("n"))
    hit = F.col("n").isNotNull()
    return searched.select("company_key", "target_title").join(counts, "company_key", "left").select(
        "company_key", "target_title",
        F.when(hit, rules.cascade_level).alias("cascade_level"),
        F.when(hit, rules.provider).alias("provider"),
        F.coalesce("n", F.lit(0)).alias("result_count"),
        F.when(hit, "hit").otherwise("no_candidate").alias("outcome"),
    )
