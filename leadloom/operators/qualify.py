"""Company qualification: size bands, geography, rule verdicts, supplied replies, stored verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom import texts
from leadloom.functions.instants import iso_text
from leadloom.functions.replies import fit_reply, latest_replies
from leadloom.functions.text import fact_text, filled_in, hits
from leadloom.rules import DEFAULT_RULES, Rules

VERDICT = ("decision", "rationale", "confidence", "fit_score", "domain", "source")


# --- rule tables ---------------------------------------------------------------------------------
def band_table(spark: SparkSession, rules: Rules = DEFAULT_RULES) -> DataFrame:
    return spark.createDataFrame(
        [(low, high, label, list(titles)) for low, high, label, titles in rules.size_bands],
        "low int, high int, size_band string, titles array<string>",
    )


def region_table(spark: SparkSession, rules: Rules = DEFAULT_RULES) -> DataFrame:
    rows = [(country, region) for region, members in rules.regions.items() for country in members]
    return spark.createDataFrame(rows, "country_key string, eu_region string")


# --- lookups -------------------------------------------------------------------------------------
def _by_band(employees: Column, value, rules: Rules) -> Column:
    chain = None
    for low, high, label, titles in rules.size_bands:
        branch = (employees.between(low, high), value(label, titles))
        chain = F.when(*branch) if chain is None else chain.when(*branch)
    return chain


#: Rows that a band table may have.
MAX_BANDS = 1_000


def size_band(employees: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """Band label; null outside every band and for an unknown count."""
    return _by_band(employees, lambda label, titles: F.lit(label), rules)


def band_titles(employees: Column, rules: Rules = DEFAULT_RULES) -> Column:
    return _by_band(employees, lambda label, titles: F.array(*map(F.lit, titles)), rules)


def lead_title(employees: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """First title of the band: the one a people query is recorded under."""
    return _by_band(employees, lambda label, titles: F.lit(titles[0]), rules)


def join_bands(companies: DataFrame, bands: DataFrame, employees: str = "employees") -> DataFrame:
    """Band lookup as a range join against the band table: a handful of rows, broadcast after their count is
    checked."""
    if bands.limit(MAX_BANDS + 1).count() > MAX_BANDS:
        raise ValueError(f"a table of more than {MAX_BANDS} bands is no rule table; join it by ranges of its own")
    inside = F.col(employees).between(F.col("low"), F.col("high"))
    return companies.join(F.broadcast(bands), inside, "left").drop("low", "high")


def join_regions(companies: DataFrame, regions: DataFrame, country: str) -> DataFrame:
    """Region bucket of a country name; null outside all buckets. Whether the table is broadcast is left to its
    real size."""
    return companies.join(regions, F.lower(F.trim(F.col(country))) == F.col("country_key"), "left").drop("country_key")


def in_scope(countries: Column, rules: Rules = DEFAULT_RULES) -> Column:
    names = F.array(*map(F.lit, rules.in_scope_countries))
    return F.coalesce(F.arrays_overlap(F.transform(countries, lambda c: F.lower(F.trim(c))), names), F.lit(False))


def code_in_scope(code: Column, rules: Rules = DEFAULT_RULES) -> Column:
    return F.lower(F.trim(code)).isin(*rules.in_scope_codes)


# --- verdicts ------------------------------------------------------------------------------------
def _verdict(decision, rationale, confidence, score, source, domain=None) -> Column:
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(
        as_col(decision).cast("string").alias("decision"),
        as_col(rationale).cast("string").alias("rationale"),
        as_col(confidence).cast("string").alias("confidence"),
        as_col(score).cast("int").alias("fit_score"),
        as_col(domain).cast("string").alias("domain"),
        as_col(source).cast("string").alias("source"),
    )


def size_verdict(employees: Column, rules: Rules = DEFAULT_RULES) -> Column:
    low, high = rules.size_bands[0][0], rules.size_bands[-1][1]
    count = F.coalesce(employees.cast("string"), F.lit(texts.NO_COUNT))
    before, after = texts.OUTSIDE_BAND
    return _verdict("not_fit", F.concat(count, F.lit(f"{before}{low}-{high}{after}")), "high", 0, "rule")


def keyword_verdict(targets: Column, disqualifiers: Column, scope: Column, countries: Column) -> Column:
    """Verdict from keyword hits and geography. Disqualifiers count only where no target is hit."""
    on_target, off_target = F.size(targets) > 0, F.size(disqualifiers) > 0
    places = F.coalesce(F.nullif(F.array_join(countries, ", "), F.lit("")), F.lit(texts.NO_PLACES))
    first_three = F.array_join(F.slice(targets, 1, 3), ", ")

    def verdict(decision: str, why: Column, confidence: str, score) -> Column:
        return _verdict(decision, F.concat(F.lit(texts.OFFLINE_FIT), why), confidence, score, "offline_heuristic")

    return (
        F.when(off_target & ~on_target, verdict(
            "not_fit", filled_in(texts.DISQUALIFIED, F.array_join(disqualifiers, ", ")), "medium", 10))
        .when(on_target & scope, verdict(
            "fit", filled_in(texts.ON_TARGET, first_three, places), "medium", F.least(F.lit(90), 60 + 10 * F.size(targets))))
        .when(on_target, verdict("not_fit", F.lit(texts.OUT_OF_SCOPE), "low", 30))
        .otherwise(verdict("not_fit", F.lit(texts.NO_SIGNAL), "low", 20))
    )


def rule_verdict(rules: Rules = DEFAULT_RULES) -> Column:
    """Keyword verdict over the company columns. The fact text is built once per row and bound as a
    lambda variable, so long descriptions are lowered and scanned once."""
    facts = F.array(fact_text(F.col("industry"), F.col("description"), F.col("specialties")))
    found = F.transform(facts, lambda t: F.struct(
        hits(t, rules.target_keywords, rules.whole_words).alias("targets"),
        hits(t, rules.disqualifiers, rules.whole_words).alias("disqualifiers"),
    ))
    scope = in_scope(F.col("countries"), rules)
    judged = F.transform(found, lambda h: keyword_verdict(h["targets"], h["disqualifiers"], scope, F.col("countries")))
    return judged[0]


def evaluate(companies: DataFrame, rules: Rules = DEFAULT_RULES, replies: DataFrame | None = None) -> DataFrame:
    """Fresh verdicts, in this precedence: size rule, supplied reply, keyword rules.

    ``replies`` is (company_key, reply and, if known, replied_at); of several per company the latest counts. A reply that holds no JSON
    object falls to the keyword rules with low confidence. Adds ``size_band``, the verdict columns and
    ``odd_confidence`` (a reply named a confidence outside the domain)."""
    band = size_band(F.col("employees"), rules)
    none = F.lit(None)
    if replies is None:
        joined = companies.withColumn("r", none.cast("struct<ok: boolean>"))
        given, odd = rule_verdict(rules), F.lit(False)
    else:
        joined = companies.join(latest_replies(replies, "company_key"), "company_key", "left")
        joined = joined.withColumn("r", F.when(F.col("reply").isNotNull(), fit_reply(F.col("reply"))))
        reply = _verdict(F.col("r.decision"), F.col("r.rationale"), F.col("r.confidence"), F.col("r.fit_score"), "llm_web", F.col("r.domain"))
        given = F.when(F.col("r.ok"), reply).otherwise(rule_verdict(rules))
        odd = band.isNotNull() & F.coalesce(F.col("r.odd_confidence"), F.lit(False))
    judged = joined.withColumn("v", F.when(band.isNull(), size_verdict(F.col("employees"), rules)).otherwise(given))
    failed = band.isNotNull() & F.coalesce(~F.col("r.ok"), F.lit(False))
    verdict = [
        (F.when(failed, "low").otherwise(F.col("v.confidence")) if c == "confidence" else F.col(f"v.{c}")).alias(c) for c in VERDICT
    ]
    return judged.select(*companies.columns, band.alias("size_band"), *verdict, odd.alias("odd_confidence"))


def reuse_stored(companies: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Companies with a stored verdict (hydrated from it), and those still to evaluate.

    ``stored`` is the companies table; a row without ``checked_at`` counts as absent. Both sides have
    one row per key."""
    checked = stored.filter(F.col("checked_at").isNotNull()).select(
        F.col("linkedin_slug").alias("company_key"), "size_band", "decision", "rationale", "confidence",
        "fit_score", "domain", "checked_at",
    )
    cached = companies.join(checked, "company_key")
    fresh = companies.join(checked.select("company_key"), "company_key", "left_anti")
    return cached, fresh


def decide(
    companies: DataFrame,
    stored: DataFrame,
    as_of: Column,
    rules: Rules = DEFAULT_RULES,
    replies: DataFrame | None = None,
) -> DataFrame:
    """Verdict of every company, stored ones first; ``cached`` tells which were reused."""
    cached, fresh = reuse_stored(companies, stored)
    reused = cached.withColumn("source", F.lit("stored")).withColumn("odd_confidence", F.lit(False)).withColumn("cached", F.lit(True))
    judged = evaluate(fresh, rules, replies).withColumn("checked_at", as_of).withColumn("cached", F.lit(False))
    return judged.unionByName(reused)


# --- texts and audit rows ------------------------------------------------------------------------
def fit_question() -> Column:
    """Question text per company, for whoever answers it outside."""
    text = lambda c, missing: F.coalesce(F.nullif(c, F.lit("")), F.lit(missing))
    listed = lambda c: text(F.array_join(c, ", "), texts.UNKNOWN)
    return filled_in(
        texts.FIT_QUESTION,
        F.col("name"),
        text(F.col("industry"), texts.UNKNOWN),
        F.coalesce(F.nullif(F.col("employees"), F.lit(0)).cast("string"), F.lit(texts.UNKNOWN)),
        text(F.col("headquarters"), texts.UNKNOWN),
        listed(F.col("specialties")),
        text(F.col("description"), texts.NOT_AVAILABLE),
        listed(F.concat(F.col("cities"), F.col("countries"))),
    )


AUDIT_COLUMNS = (
    "company_name", "company_domain", "linkedin_slug", "employees", "size_band", "decision", "confidence",
    "fit_score", "rationale", "checked_at",
)


def audit_rows(decided: DataFrame) -> DataFrame:
    """Audit row per verdict, all text: missing values and a zero head-count are empty, a zero score
    stays."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return decided.select(
        F.col("name").alias("company_name"),
        text(F.col("domain")).alias("company_domain"),
        F.col("company_key").alias("linkedin_slug"),
        text(F.nullif(F.col("employees"), F.lit(0))).alias("employees"),
        text(F.col("size_band")).alias("size_band"),
        "decision",
        text(F.col("confidence")).alias("confidence"),
        text(F.col("fit_score")).alias("fit_score"),
        text(F.col("rationale")).alias("rationale"),
        iso_text(F.col("checked_at")).alias("checked_at"),
    )
