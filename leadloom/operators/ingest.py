"""Raw feed records to typed postings: projection, first-per-id, recency, source selection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadloom.functions.instants import iso_instant
from leadloom.functions.keys import company_key
from leadloom.functions.text import filled, first_of
from leadloom.rules import (
    DEFAULT_RULES, DEFAULT_SOURCE_ROWS, DEFAULT_WINDOW, MAX_SOURCE_ROWS, RECENCY_DAYS, TIME_WINDOWS, Rules,
)

SEQ = "scrape_seq"


def _list(name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast("array<string>"))


def typed_jobs(feed: DataFrame) -> DataFrame:
    """One typed posting per raw record; records with neither id nor network id are dropped."""
    country = first_of(F.col("countries_derived"))
    countries = _list("countries_derived")
    organization = F.coalesce(F.col("organization"), F.lit(""))
    slug = F.col("linkedin_org_slug")
    columns = [
        F.coalesce(filled(F.col("id")), filled(F.col("linkedin_id"))).alias("id"),
        F.coalesce(F.col("title"), F.lit("")).alias("title"),
        organization.alias("organization"),
        slug.alias("organization_slug"),
        F.coalesce(filled(F.col("organization_url")), F.col("linkedin_org_url")).alias("organization_url"),
        F.col("url"),
        iso_instant(F.col("date_posted")).alias("date_posted"),
        F.col("description_text"),
        F.col("seniority"),
        _list("employment_type").alias("employment_type"),
        _list("locations_derived").alias("locations_derived"),
        first_of(F.col("cities_derived")).alias("city"),
        first_of(F.col("regions_derived")).alias("region"),
        country.alias("country"),
        F.when(F.size(countries) > 0, countries)
        .when(country != "", F.array(country))
        .otherwise(F.array().cast("array<string>")).alias("countries"),
        F.col("linkedin_id").alias("linkedin_job_id"),
        F.col("linkedin_org_employees"),
        F.col("linkedin_org_size"),
        F.col("linkedin_org_industry"),
        F.col("linkedin_org_headquarters"),
        _list("linkedin_org_specialties").alias("linkedin_org_specialties"),
        F.col("linkedin_org_description"),
        F.coalesce(F.col("linkedin_org_recruitment_agency_derived"), F.lit(False)).alias("is_recruitment_agency"),
        company_key(slug, organization).alias("company_key"),
        *([F.col("raw")] if "raw" in feed.columns else []),
        F.col(SEQ),
    ]
    return feed.select(*columns).filter(F.col("id").isNotNull())


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], keep: int = 1) -> DataFrame:
    """The first ``keep`` rows per key. The rank filter is pushed below the shuffle by Spark (window
    group limit), so a map task sends at most ``keep`` rows of a key however frequent it is."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= keep).drop("_rank")


def rows_at(df: DataFrame, winners: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a wide ``df`` at ``keys`` (which identify a row), for a thin table of winning keys.
    Since each key is a single row, no task gets more than its share. Adaptive execution hashes the
    thin side where all its partitions are small, so that the wide rows need no sort."""
    return df.join(winners.select(*keys), list(keys), "left_semi")


def first_postings(jobs: DataFrame) -> DataFrame:
    """One posting per id: the first in feed order. The order is settled on (id, position) alone with
    map-side combining; the texts follow only for the winners."""
    first = jobs.groupBy("id").agg(F.min(SEQ).alias(SEQ))
    return rows_at(jobs, first, ["id", SEQ])


def later_postings(jobs: DataFrame) -> DataFrame:
    """(id, position) of the postings that :func:`first_postings` leaves out: as a rule few, since most ids come once. Rows are compared
    by id and position together, so that a frequent id is spread over all tasks."""
    first = jobs.groupBy("id").agg(F.min(SEQ).alias(SEQ))
    return jobs.select("id", SEQ).filter(F.col(SEQ).isNotNull()).join(first, ["id", SEQ], "left_anti").distinct()


def without_later(jobs: DataFrame, later: DataFrame) -> DataFrame:
    """:func:`first_postings` for a table of :func:`later_postings` that is small enough to broadcast: the texts stay where they are."""
    return jobs.filter(F.col(SEQ).isNotNull()).join(F.broadcast(later), ["id", SEQ], "left_anti")


def recent(jobs: DataFrame, as_of: Column, days: int | None = RECENCY_DAYS, column: str = "date_posted") -> DataFrame:
    """Postings without a date or posted within ``days`` before ``as_of``; ``None`` keeps all."""
    if days is None:
        return jobs
    posted = F.col(column)
    return jobs.filter(posted.isNull() | (posted >= as_of - F.expr(f"INTERVAL {int(days)} DAYS")))


def select_source(
    jobs: DataFrame,
    as_of: Column,
    order: Sequence[Column | str],
    rules: Rules = DEFAULT_RULES,
    window: str = DEFAULT_WINDOW,
    rows: int = DEFAULT_SOURCE_ROWS,
) -> DataFrame:
    """Selection that a posting source applies itself: title phrases, locations, employment types,
    time window, no agencies, at most ``rows`` rows (5,000 is the ceiling). Ordering with a limit
    plans as a top-k per partition, not as a total sort."""
    if not 0 <= rows <= MAX_SOURCE_ROWS:
        raise ValueError(f"a source answers 0 to {MAX_SOURCE_ROWS} rows, not {rows}")
    title = F.lower(F.col("title"))
    named = reduce(lambda a, b: a | b, [title.contains(p.lower()) for p in rules.title_phrases])
    places = F.col("locations_derived")
    placed = F.exists(places, lambda p: reduce(lambda a, b: a | b, [p.contains(x) for x in rules.locations]))
    kinds = F.arrays_overlap(F.col("employment_type"), F.array(*map(F.lit, rules.employment_types)))
    within = F.col("date_posted") >= as_of - F.expr(f"INTERVAL {TIME_WINDOWS[window]}")
    return (
        jobs.filter(within & ~F.col("is_recruitment_agency") & kinds & named & placed)
        .orderBy(*order)
        .limit(rows)
    )
