"""The registered queries: each operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.functions import text as tx
from leadloom.functions.distance import common_subsequence
from leadloom.functions.instants import epoch_micros, iso_instant
from leadloom.functions.keys import contact_key, row_id
from leadloom.functions.replies import fit_reply, person_reply
from leadloom.operators import checks, ingest, match, merge, people as ppl, qualify, report, rollup, validate
from leadloom.plans import bindings as b, funnel
from leadloom.rules import DEFAULT_RULES
from leadloom.session import measured_joins, spread_small, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EXACT_ONLY = replace(DEFAULT_RULES, min_fuzzy_len=1_000_000)
WORDS = ("eau", "tion", "institut", "clinic", "the", "cro", "hand", "src1", "ment")


def as_of() -> Column:
    """Fixed instant the queries run at."""
    return F.lit("1999-06-01 00:00:00+00:00").cast("timestamp")


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        measured_joins(spark)
        return fn(spark, sf)

    QUERIES[fn.__name__] = run
    return run


def joined(values, sep: str = "|") -> Column:
    return F.array_join(values, sep)


def or_empty(value) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(value.cast("string"), F.lit(""))


# --- text ----------------------------------------------------------------------------------------
@query
def q_fold_accents(spark, sf):
    folded = b.spread_table(spark, sf, "documents", "doc_id").select("doc_id", tx.person_norm(F.col("text")).alias("f"))
    return folded.select("doc_id", F.md5("f").alias("folded_md5"), F.length("f").cast("bigint").alias("folded_chars"))


@query
def q_norm_company(spark, sf):
    name = F.concat(F.col("p_name"), b.pick(b.NAME_FORMS, F.col("p_partkey")))
    return b.table(spark, sf, "part").select("p_partkey", tx.company_norm(name).alias("norm"))


def _page_address() -> Column:
    p, url = F.col("page_id"), F.col("url")
    text = p.cast("string")
    return (
        F.when(p % 7 == 0, url)
        .when(p % 7 == 1, F.concat(F.lit(" "), url, F.lit("/ ")))
        .when(p % 7 == 2, F.concat(F.lit("http://de.linkedin.com/fr/in/Person-"), text, F.lit("/?trk=x")))
        .when(p % 7 == 3, F.concat(F.lit("www.LinkedIn.com/in/Person-"), text, F.lit("//#top")))
        .when(p % 7 == 4, F.regexp_replace(url, "^https?://", ""))
        .when(p % 7 == 5, F.concat(F.lit("https://www.site"), text, F.lit(".co.uk/jobs")))
        .otherwise(F.upper(url))
    )


@query
def q_canonical_url(spark, sf):
    return b.table(spark, sf, "pages").select("page_id", tx.profile_url(_page_address()).alias("canonical"))


@query
def q_root_domain(spark, sf):
    return b.table(spark, sf, "pages").select("page_id", tx.site_label(_page_address()).alias("label"))


@query
def q_contact_key(spark, sf):
    """People from suppliers; pages give every other one an address and the rest a company domain."""
    s, p = b.table(spark, sf, "supplier"), b.table(spark, sf, "pages").select("page_id", "url")
    key = F.col("s_suppkey")
    paired = s.join(p, key == F.col("page_id"), "left")
    return paired.select(
        "s_suppkey",
        contact_key(F.when(key % 2 == 0, F.col("url")), b.person_name(key), F.when(key % 3 == 0, F.lit("")), F.col("url")).alias("dedup_key"),
    )


@query
def q_parse_ts(spark, sf):
    e, text = F.col("event_id"), F.translate(F.col("ts").cast("string"), " ", "T")
    form = (
        F.when(e % 6 == 0, text).when(e % 6 == 1, F.concat(text, F.lit("Z"))).when(e % 6 == 2, F.concat(text, F.lit("+02:00")))
        .when(e % 6 == 3, F.substring(text, 1, 10)).when(e % 6 == 4, F.substring(text, 1, 4)).otherwise(F.col("event_type"))
    )
    return b.spread_table(spark, sf, "events", "event_id").select("event_id", F.coalesce(epoch_micros(iso_instant(form)), F.lit(-1)).alias("micros"))


@query
def q_csv_list(spark, sf):
    text = F.concat(F.lit(" "), F.col("p_brand"), F.lit(", ,"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise(""), F.lit(",  "), F.col("p_name"), F.lit(","))
    text = F.when(F.col("p_size") % 5 == 0, " , ,").otherwise(text)
    items = tx.csv_list(text)
    return b.table(spark, sf, "part").select(
        "p_partkey", or_empty(joined(items)).alias("items"), F.coalesce(F.size(items), F.lit(-1)).cast("bigint").alias("n_items"),
        or_empty(tx.first_of(items)).alias("first_item"),
    )


@query
def q_keyword_hits(spark, sf):
    blob = tx.fact_text(F.col("source"), F.col("text"), F.array("lang", "source"))
    return b.spread_table(spark, sf, "documents", "doc_id").select(
        "doc_id", joined(tx.hits(blob, WORDS)).alias("hits"), joined(tx.hits(blob, DEFAULT_RULES.target_keywords)).alias("targets"),
    )


# --- ingest --------------------------------------------------------------------------------------
@query
def q_typed_jobs(spark, sf):
    return ingest.typed_jobs(b.feed(spark, sf)).select(
        "scrape_seq", "id", "title", "organization", or_empty("organization_slug").alias("organization_slug"), "organization_url",
        or_empty("url").alias("url"), F.coalesce(epoch_micros(F.col("date_posted")), F.lit(-1)).alias("posted_micros"),
        joined("employment_type").alias("employment_type"), joined("locations_derived").alias("locations_derived"),
        or_empty("city").alias("city"), or_empty("region").alias("region"), or_empty("country").alias("country"),
        joined("countries").alias("countries"), or_empty("linkedin_job_id").alias("linkedin_job_id"),
        F.coalesce("linkedin_org_employees", F.lit(-1)).cast("bigint").alias("employees"),
        joined("linkedin_org_specialties").alias("specialties"), F.col("is_recruitment_agency").cast("int").alias("agency"), "company_key",
        F.coalesce(F.length("description_text"), F.lit(-1)).cast("bigint").alias("description_chars"),
    )


@query
def q_dedup_first(spark, sf):
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    first = ingest.first_per_key(b.table(spark, sf, "lineitem"), ["l_orderkey"], order)
    return first.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query
def q_first_postings(spark, sf):
    jobs = ingest.first_postings(ingest.typed_jobs(b.feed(spark, sf)))
    return jobs.select("id", "scrape_seq", "company_key")


@query
def q_recency(spark, sf):
    """Events within eight days of a fixed instant; every fiftieth has no time and stays."""
    events = b.spread_table(spark, sf, "events", "event_id").withColumn("seen", F.when(F.col("event_id") % 50 != 0, F.col("ts")))
    now = F.lit("2024-01-25 12:00:00").cast("timestamp_ntz")
    return ingest.recent(events, now, column="seen").select("event_id", "user_id", "event_type")


@query
def q_select_source(spark, sf):
    jobs = ingest.typed_jobs(b.feed(spark, sf))
    picked = ingest.select_source(jobs, as_of(), [F.col("date_posted").desc(), "scrape_seq"], window="6m")
    return picked.select("scrape_seq", "id", "title", F.unix_micros("date_posted").alias("posted_micros"))


# --- roll-up and match ---------------------------------------------------------------------------
def _jobs(spark, sf) -> DataFrame:
    """Postings of the feed as a written table, for the queries that go over them several times.
    Description texts are left out: the roll-up reads those of the postings that it has chosen (``_full_jobs``)."""
    feed = ingest.typed_jobs(b.feed(spark, sf)).drop("description_text")
    return written(ingest.first_postings(feed.withColumn("linkedin_org_description", F.lit(None).cast("string"))), "jobs")


def _full_jobs(spark, sf):
    """Reads the postings at given feed positions with their texts."""
    return lambda at: ingest.typed_jobs(b.feed(spark, sf, at))


@query
def q_company_rollup(spark, sf):
    return rollup.rollup_companies(_jobs(spark, sf), _full_jobs(spark, sf)).select(
        "company_key", "name", "normalized_name", F.coalesce("employees", F.lit(-1)).cast("bigint").alias("employees"),
        or_empty("industry").alias("industry"), or_empty("headquarters").alias("headquarters"),
        F.coalesce(F.length("description"), F.lit(-1)).cast("bigint").alias("description_chars"), joined("specialties").alias("specialties"),
        joined("countries").alias("countries"), joined("cities").alias("cities"), F.col("any_agency").cast("int").alias("any_agency"),
        "n_jobs", "first_seq",
    )


def _part_names(spark, sf) -> DataFrame:
    """Part names with legal forms and typing errors; the slug of every fourth names another part."""
    p, name = F.col("p_partkey"), F.col("p_name")
    typo = (
        F.when(p % 5 == 1, F.concat(F.lit("x"), name)).when(p % 5 == 2, F.translate(name, "ie", "ee"))
        .when(p % 5 == 3, F.concat(F.substring(name, 1, 3), F.substring(name, 3, 100), F.lit("s"))).when(p % 5 == 4, F.upper(name)).otherwise(name)
    )
    slug = F.when(p % 4 == 0, F.translate(b.pick(("red-widget", "old-anvil", "no-such-part", "rod"), F.floor(p / 4)), " ", "-"))
    return b.spread_table(spark, sf, "part", "p_partkey").select(
        "p_partkey", F.concat(typo, b.pick(b.NAME_FORMS, p)).alias("name"), slug.alias("slug"),
        F.when(p % 9 == 0, "https://www.rod.co.uk/x").alias("site"),
    )


def _matched_parts(spark, sf, rules, inline: int = match.INLINE_CLIENTS) -> DataFrame:
    clients = match.client_table(spark, b.PART_CLIENTS)
    found = match.match_clients(
        _part_names(spark, sf), clients, F.col("name"), F.col("slug"), F.col("site"), rules, inline, key="p_partkey"
    )
    return found.select("p_partkey", or_empty("client_name").alias("client_name"), or_empty("match_method").alias("match_method"))


@query
def q_match_exact(spark, sf):
    return _matched_parts(spark, sf, EXACT_ONLY)


@query
def q_match_fuzzy(spark, sf):
    return _matched_parts(spark, sf, DEFAULT_RULES)


@query
def q_match_blocked(spark, sf):
    return _matched_parts(spark, sf, DEFAULT_RULES, inline=0)


def _long_names(spark, sf) -> DataFrame:
    p = F.col("p_partkey")
    name = F.concat_ws(" ", F.col("p_name"), F.lower("p_type"), b.pick(("works of", "trading house", "supply", "forge company works", "transmission"), p), F.lit("brand"))
    return b.spread_table(spark, sf, "part", "p_partkey").select("p_partkey", name.alias("name"))


@query
def q_match_ratio(spark, sf):
    """Long names, where similarity by ratio reaches further than two edits."""
    clients = match.client_table(spark, b.LONG_CLIENTS)
    found = match.match_clients(_long_names(spark, sf), clients, F.col("name"), key="p_partkey")
    return found.select("p_partkey", or_empty("client_name").alias("client_name"), or_empty("match_method").alias("match_method"))


@query
def q_subsequence(spark, sf):
    """Longest common subsequence of each part's name and its type and brand."""
    other = F.lower(F.concat_ws(" ", "p_type", "p_brand"))
    return b.spread_table(spark, sf, "part", "p_partkey").select("p_partkey", common_subsequence(F.col("p_name"), other).cast("bigint").alias("lcs"))


def _matched_companies(spark, sf, jobs: DataFrame, texts: bool = True) -> DataFrame:
    """Companies of the postings, with their clients; without ``texts`` their descriptions are null."""
    clients = match.client_table(spark, DEFAULT_RULES.clients)
    return match.match_clients(rollup.rollup_companies(jobs, _full_jobs(spark, sf) if texts else None), clients, F.col("name"), F.col("company_key"))


@query
def q_client_side_output(spark, sf):
    jobs = _jobs(spark, sf)
    found, _, _ = match.split_matched(_matched_companies(spark, sf, jobs, texts=False))
    rows = match.client_postings(jobs, found, as_of())
    return rows.withColumn("posted_at", F.coalesce(epoch_micros(F.col("posted_at")), F.lit(-1))).withColumn("detected_at", epoch_micros(F.col("detected_at")))


@query
def q_match_split(spark, sf):
    """Client, agency or to evaluate, per company of the feed."""
    matched = written(_matched_companies(spark, sf, _jobs(spark, sf), texts=False), "matched")
    found, agencies, rest = match.split_matched(matched)
    tag = lambda df, name: df.select("company_key", F.lit(name).alias("branch"), or_empty("client_name").alias("client_name"), or_empty("match_method").alias("match_method"))
    return tag(found, "client").unionByName(tag(agencies, "agency")).unionByName(tag(rest, "evaluate"))


# --- qualification -------------------------------------------------------------------------------
@query
def q_size_band(spark, sf):
    count = F.col("employees")
    return b.companies(spark, sf).select(
        "company_key", or_empty(qualify.size_band(count)).alias("size_band"), or_empty(qualify.lead_title(count)).alias("lead_title"),
        or_empty(joined(qualify.band_titles(count))).alias("titles"),
    )


@query
def q_band_range_join(spark, sf):
    banded = qualify.join_bands(b.companies(spark, sf).select("company_key", "employees"), qualify.band_table(spark))
    return banded.select("company_key", or_empty("size_band").alias("size_band"), or_empty(joined("titles")).alias("titles"))


@query
def q_region_bucket(spark, sf):
    c = b.customers(spark, sf).select("c_custkey", "country", b.pick(b.CODES, F.col("n_nationkey")).alias("code"))
    found = qualify.join_regions(c, qualify.region_table(spark), "country")
    return found.select(
        "c_custkey", or_empty("eu_region").alias("eu_region"), qualify.code_in_scope(F.col("code")).cast("int").alias("code_in_scope"),
        qualify.in_scope(F.array("country")).cast("int").alias("in_scope"),
    )


def _verdict_columns() -> list[Column]:
    return [
        F.col("company_key"), or_empty("size_band").alias("size_band"), F.col("decision"), F.col("rationale"), F.col("confidence"),
        F.coalesce("fit_score", F.lit(-1)).cast("bigint").alias("fit_score"), or_empty("domain").alias("domain"), F.col("source"),
    ]


@query
def q_fit_rules(spark, sf):
    return qualify.evaluate(b.companies(spark, sf)).select(*_verdict_columns())


def _fit_replies(spark, sf) -> DataFrame:
    e = F.col("event_id")
    return b.spread_table(spark, sf, "events", "event_id").select(
        F.concat(F.lit("org-"), e.cast("string")).alias("company_key"), b.reply_text(e, F.col("props")).alias("reply")
    )


@query
def q_fit_with_replies(spark, sf):
    judged = qualify.evaluate(b.companies(spark, sf), replies=_fit_replies(spark, sf))
    return judged.select(*_verdict_columns(), F.col("odd_confidence").cast("int").alias("odd_confidence"))


@query
def q_fit_reply(spark, sf):
    r = b.spread_table(spark, sf, "events", "event_id").select("event_id", fit_reply(b.reply_text(F.col("event_id"), F.col("props"))).alias("r"))
    return r.select(
        "event_id", F.col("r.ok").cast("int").alias("ok"), "r.decision", "r.rationale", "r.confidence",
        F.coalesce("r.fit_score", F.lit(-1)).cast("bigint").alias("fit_score"), or_empty("r.domain").alias("domain"),
    )


@query
def q_person_reply(spark, sf):
    """Reply where it holds an object, else the rule on the title."""
    e = F.col("event_id")
    rule = validate.person_rule(b.pick(b.PERSON_TITLES, e), F.when(e % 2 == 0, "50-200").otherwise("201-1000"))
    r = b.spread_table(spark, sf, "events", "event_id").select("event_id", person_reply(b.reply_text(e, F.col("props"))).alias("r"), rule.alias("own"))
    verdict = F.when(F.col("r.ok"), F.struct("r.decision", "r.reason")).otherwise(F.col("own"))
    return r.select("event_id", F.col("r.ok").cast("int").alias("replied"), verdict.alias("v")).select("event_id", "replied", "v.*")


def _stored_verdicts(spark, sf) -> DataFrame:
    """A third of the companies has a stored verdict; some of those were never checked."""
    k = F.col("first_seq")
    return b.companies(spark, sf).filter(k % 3 == 0).select(
        F.col("company_key").alias("linkedin_slug"), F.lit("old band").alias("size_band"),
        F.when(k % 2 == 0, "fit").otherwise("not_fit").alias("decision"), F.lit("stored").alias("rationale"), F.lit("high").alias("confidence"),
        (k % 101).cast("int").alias("fit_score"), F.when(k % 4 == 0, "stored.example").alias("domain"),
        F.when(k % 5 != 0, as_of()).alias("checked_at"),
    )


def _decided(spark, sf) -> DataFrame:
    return qualify.decide(b.companies(spark, sf), _stored_verdicts(spark, sf), F.lit("2024-02-01 00:00:00+00:00").cast("timestamp"))


@query
def q_verdict_cache(spark, sf):
    return _decided(spark, sf).select(*_verdict_columns(), F.col("cached").cast("int").alias("cached"), epoch_micros(F.col("checked_at")).alias("checked_micros"))


@query
def q_audit_rows(spark, sf):
    decided = _decided(spark, sf)
    return qualify.audit_rows(decided.withColumn("checked_at", F.when(F.col("cached"), F.col("checked_at")))).drop("checked_at")


@query
def q_fit_question(spark, sf):
    c = b.companies(spark, sf)
    text = qualify.fit_question()
    return c.select("company_key", F.md5(text).alias("text_md5"), F.length(text).cast("bigint").alias("text_chars"))


# --- people and pairs ----------------------------------------------------------------------------
def _targets(spark, sf) -> DataFrame:
    fit = qualify.evaluate(b.companies(spark, sf)).filter("decision = 'fit'")
    return written(ppl.with_target(fit), "targets")


def _guard(spark, sf) -> DataFrame:
    k = F.col("first_seq")
    return b.companies(spark, sf).filter(k % 4 == 0).select(
        "company_key", F.when(k % 8 == 0, qualify.lead_title(F.col("employees"))).otherwise("Another Title").alias("target_title")
    )


@query
def q_query_guard(spark, sf):
    fresh, asked = ppl.unqueried(_targets(spark, sf), _guard(spark, sf))
    tag = lambda df, name: df.select("company_key", "target_title", F.lit(name).alias("branch"))
    return tag(fresh, "search").unionByName(tag(asked, "skip"))


@query
def q_people_flatten(spark, sf):
    """Nested person/company results built from suppliers; the location is an object or a text."""
    s = F.col("s_suppkey")
    text = s.cast("string")
    place = (
        F.when(s % 3 == 0, F.to_json(F.struct(F.concat(F.lit("City "), text).alias("city"), F.lit("").alias("state"), F.col("n_name").alias("country"))))
        .when(s % 3 == 1, F.concat(F.lit('"'), F.col("n_name"), F.lit('"')))
    )
    person = F.struct(
        F.when(s % 2 == 0, b.person_name(s)).otherwise("").alias("full_name"), F.when(s % 5 != 0, F.col("s_name")).alias("first_name"),
        F.lit("Last").alias("last_name"), F.when(s % 4 == 0, b.pick(b.PERSON_TITLES, s)).alias("current_job_title"),
        F.when(s % 3 != 0, F.lit("A headline")).alias("headline"), b.person_url(s).alias("linkedin_url"),
        F.parse_json(place).alias("location"),
    )
    company = F.struct(F.when(s % 2 == 0, "").otherwise("a.example").alias("domain"), F.lit("w.example").alias("website"))
    nested = b.table(spark, sf, "supplier").join(b.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    flat = ppl.flatten_people(nested.select("s_suppkey", person.alias("person"), company.alias("company"), s.alias("result_pos")))
    return flat.select("s_suppkey", "full_name", *[or_empty(c).alias(c) for c in ("title", "linkedin_url", "location", "about_snippet", "company_domain")], "provider")


def _best(spark, sf) -> DataFrame:
    targets = _targets(spark, sf)
    best = ppl.people_of(targets, b.people(spark, sf))
    facts = targets.select("company_key", "first_seq", "size_band", "domain")
    return validate.with_memo(best.join(facts, "company_key"))


@query
def q_seniority_topk(spark, sf):
    return ppl.people_of(_targets(spark, sf), b.people(spark, sf)).select(
        "company_key", F.col("result_pos").cast("bigint").alias("result_pos"), "full_name", or_empty("title").alias("title"), F.col("score").cast("bigint").alias("score")
    )


@query
def q_query_outcomes(spark, sf):
    targets = _targets(spark, sf)
    # six people of seven were found under a key that no company has
    elsewhere = F.when(F.col("result_pos") % 7 == 0, F.col("company_key")).otherwise(F.concat(F.lit("other "), "company_key"))
    found = b.people(spark, sf).withColumn("company_key", elsewhere)
    return ppl.query_outcomes(targets, ppl.people_of(targets, found)).select(
        "company_key", "target_title", or_empty("cascade_level").alias("cascade_level"), or_empty("provider").alias("provider"),
        F.col("result_count").cast("bigint").alias("result_count"), "outcome",
    )


def _person_replies(pairs: DataFrame, spark, sf) -> DataFrame:
    """Replies for the pairs whose posting number is that of an event."""
    e = b.spread_table(spark, sf, "events", "event_id").select(F.col("event_id").alias("job_seq"), b.reply_text(F.col("event_id"), F.col("props")).alias("reply"))
    return pairs.select("memo", "job_id", "job_seq").distinct().join(e, "job_seq").drop("job_seq")


def _judged(spark, sf, replies: bool = False) -> DataFrame:
    pairs = validate.pair_up(_best(spark, sf), b.jobs_of_companies(spark, sf))
    if replies:
        pairs = written(pairs, "pairs")
    return validate.judge(pairs, replies=_person_replies(pairs, spark, sf) if replies else None)


@query
def q_pair_verdicts(spark, sf):
    return _judged(spark, sf).select("company_key", F.col("result_pos").cast("bigint").alias("result_pos"), "job_id", "decision", "reason")


@query
def q_pair_replies(spark, sf):
    return _judged(spark, sf, replies=True).select("company_key", F.col("result_pos").cast("bigint").alias("result_pos"), "job_id", "decision", "reason")


SETTLE_KEY = [
    "company_key", "result_pos", "first_seq", "full_name", "title", "linkedin_url", "location", "about_snippet",
    "provider", "company_domain", "domain", "size_band", "target_title", "score",
]


@query
def q_keep_drop(spark, sf):
    return validate.settle(_judged(spark, sf, replies=True), SETTLE_KEY).select(
        "company_key", F.col("result_pos").cast("bigint").alias("result_pos"), F.col("kept").cast("int").alias("kept"), "reason",
        "n_links", "n_pairs", "n_validations",
    )


@query
def q_bridge(spark, sf):
    """Contact to posting links after a run that met stored links: the passing pairs of the even
    postings were stored before."""
    links = validate.link_batch(_judged(spark, sf)).withColumn("linked_at", F.lit("new"))
    rows = written(links.select(row_id(F.col("dedup_key")).alias("contact_id"), "job_id", "linked_at"), "links")
    stored = rows.filter(F.substring("job_id", -1, 1).isin(*"02468")).withColumn("linked_at", F.lit("old"))
    return merge.keyed_merge(stored, rows, merge.CONTACT_JOBS).select("contact_id", "job_id", "linked_at", F.col("created").cast("int").alias("created"))


@query
def q_jobs_companies(spark, sf):
    """Postings with the verdict on their company."""
    verdicts = qualify.evaluate(b.companies(spark, sf)).select("company_key", "decision")
    return b.jobs_of_companies(spark, sf).join(verdicts, "company_key").groupBy("decision", "job_title").agg(F.count(F.lit(1)).alias("n_jobs"))


@query
def q_validation_question(spark, sf):
    best = _best(spark, sf)
    names = b.companies(spark, sf).select("company_key", F.col("name").alias("company_name"))
    docs = b.table(spark, sf, "documents").select(F.col("doc_id").alias("job_seq"), F.col("text").alias("description_text"))
    jobs = b.jobs_of_companies(spark, sf).select(F.col("id").alias("job_id"), "job_title")
    pairs = validate.pair_up(best, b.jobs_of_companies(spark, sf)).join(jobs, "job_id").join(names, "company_key").join(docs, "job_seq", "left")
    pairs = pairs.withColumn("locations_derived", F.when(F.col("job_seq") % 3 != 0, F.array(F.concat(F.lit("City "), F.col("job_seq").cast("string")))))
    text = validate.validation_question()
    return pairs.select("job_id", F.col("result_pos").cast("bigint").alias("result_pos"), F.md5(text).alias("text_md5"))


# --- keyed upserts -------------------------------------------------------------------------------
def _order_rows(spark, sf, version: str) -> DataFrame:
    """Posting rows in two versions: what is stored, and what a later feed says of them. Every column of the table
    holds a text that names the version, the column and the order."""
    o = F.col("o_orderkey")
    text = lambda c: F.concat(F.lit(f"{version} {c} "), o.cast("string"))
    rows = b.table(spark, sf, "orders").filter(o % 3 != 0 if version == "old" else (o % 5 != 0) | (o % 3 == 0))
    return rows.select(F.concat(F.lit("J"), o.cast("string")).alias("id"), *[text(c).alias(c) for c in merge.JOBS.columns if c != "id"])


@query
def q_upsert_jobs(spark, sf):
    merged = merge.keyed_merge(_order_rows(spark, sf, "old"), _order_rows(spark, sf, "new"), merge.JOBS)
    return merged.withColumn("created", F.col("created").cast("int"))


@query
def q_batch_counts(spark, sf):
    """New and already stored ids of a batch."""
    old, new = _order_rows(spark, sf, "old"), _order_rows(spark, sf, "new")
    return merge.batch_counts(merge.keyed_merge(old, new, merge.JOBS, only_touched=True))


@query
def q_new_ids(spark, sf):
    return merge.new_keys(_order_rows(spark, sf, "new"), _order_rows(spark, sf, "old"), ["id"])


def _company_versions(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Stored and new rows of companies; the new ones carry a domain only now and then."""
    rows = qualify.evaluate(b.companies(spark, sf)).select(
        F.col("company_key").alias("linkedin_slug"), row_id(F.col("company_key")).alias("id"), "name", "normalized_name", "industry",
        "headquarters", "employees", "size_band", "decision", "fit_score", "confidence", "rationale", F.col("first_seq").alias("k"),
    )
    stamp = lambda v: F.lit(v)
    old = rows.filter(F.col("k") % 3 != 0).withColumns({
        "name": F.concat(F.lit("old "), "name"), "normalized_name": F.lit("old norm"), "industry": F.lit("old industry"),
        "domain": F.when(F.col("k") % 2 == 0, "old.example"), "checked_at": stamp("old"), "updated_at": stamp("old"), "created_at": stamp("old"),
    })
    new = rows.filter((F.col("k") % 4 != 0) | (F.col("k") % 3 == 0)).withColumns({
        "domain": F.when(F.col("k") % 5 == 0, "new.example"), "checked_at": stamp("new"), "updated_at": stamp("new"), "created_at": stamp("new"),
    })
    return old, new


@query
def q_upsert_companies(spark, sf):
    merged = merge.keyed_merge(*_company_versions(spark, sf), merge.COMPANIES)
    return merged.select(
        "linkedin_slug", "id", "name", "normalized_name", or_empty("industry").alias("industry"), or_empty("domain").alias("domain"), "decision",
        F.coalesce("fit_score", F.lit(-1)).cast("bigint").alias("fit_score"), "checked_at", "updated_at", "created_at", F.col("created").cast("int").alias("created"),
    )


#: Columns of contacts that the batch below fills with their own name and the line they come from.
CONTACT_TEXTS = (
    "id", "normalized_full_name", "linkedin_url", "about_snippet", "provider", "cascade_level", "target_title", "found_at", "created_at",
    "validation_decision", "validated_at",
)


def _stored_contacts(spark, sf) -> DataFrame:
    """Contacts met before: every third supplier's person."""
    s = F.col("s_suppkey")
    key = contact_key(b.person_url(s), b.person_name(s), F.lit(""), F.lit("site.example"))
    others = [F.lit(f"stored {c}").alias(c) for c in merge.CONTACTS.columns if c != "dedup_key"]
    return b.table(spark, sf, "supplier").filter(s % 3 == 0).select(key.alias("dedup_key")).distinct().select("dedup_key", *others)


def _contact_batch(spark, sf) -> DataFrame:
    """One row per lineitem: a person named by the supplier, met at the companies of its orders."""
    s, o = F.col("l_suppkey"), F.col("l_orderkey")
    return spread_small(b.table(spark, sf, "lineitem"), "l_orderkey", "l_partkey").select(
        contact_key(b.person_url(s), b.person_name(s), F.lit(""), F.lit("site.example")).alias("dedup_key"),
        row_id(o.cast("string")).alias("company_id"), b.person_name(s).alias("full_name"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("title"), F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("validation_reason"),
        F.concat(F.lit("City "), (F.col("l_partkey") % 40).cast("string")).alias("location"),
        *[F.concat(F.lit(f"{c} "), o.cast("string"), F.lit("/"), F.col("l_linenumber").cast("string")).alias(c) for c in CONTACT_TEXTS],
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("pos"),
    )


@query
def q_upsert_contacts(spark, sf):
    """Many batch rows per key: the first sets the kept columns, the last the replaced ones."""
    merged = merge.keyed_merge(_stored_contacts(spark, sf), _contact_batch(spark, sf), merge.CONTACTS, F.col("pos"))
    return merged.withColumn("created", F.col("created").cast("int"))


@query
def q_upsert_queries(spark, sf):
    """Query guard rows: asked again, all but the id is replaced."""
    targets = _targets(spark, sf)
    rows = targets.select(
        row_id(F.col("company_key")).alias("company_id"), "target_title", row_id(F.col("company_key"), F.col("target_title")).alias("id"), F.col("first_seq").alias("k"),
        F.lit("company").alias("cascade_level"), F.lit("prospeo").alias("provider"), F.lit(2).alias("result_count"), F.lit("hit").alias("outcome"), F.lit("new").alias("queried_at"),
    )
    stored = rows.filter(F.col("k") % 2 == 0).withColumns({
        "id": F.lit("old id"), "outcome": F.lit("no_candidate"), "result_count": F.lit(0), "queried_at": F.lit("old"), "provider": F.lit(None).cast("string"),
    })
    merged = merge.keyed_merge(stored, rows.filter((F.col("k") % 3 != 0) | (F.col("k") % 2 != 0)), merge.QUERIES)
    return merged.select("company_id", "target_title", "id", or_empty("provider").alias("provider"), F.col("result_count").cast("bigint").alias("result_count"), "outcome", "queried_at", F.col("created").cast("int").alias("created"))


@query
def q_rerun_noop(spark, sf):
    """Applying a batch a second time changes no row."""
    old, new = _order_rows(spark, sf, "old"), _order_rows(spark, sf, "new")
    once = merge.keyed_merge(old, new, merge.JOBS).drop("created")
    twice = merge.keyed_merge(once, new, merge.JOBS)
    same = F.lit(True)
    pairs = once.alias("a").join(twice.alias("b"), F.col("a.id") == F.col("b.id"), "full_outer")
    for c in once.columns:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return pairs.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~same).alias("n_changed"), F.count_if(F.coalesce("created", F.lit(False))).alias("n_created")
    )


# --- checks and reports --------------------------------------------------------------------------
@query
def q_checks(spark, sf):
    orders, lines = b.table(spark, sf, "orders"), b.table(spark, sf, "lineitem")
    cust = b.table(spark, sf, "customer").filter(F.col("c_acctbal") > -500)
    dated = orders.withColumn("o_orderdate", F.when(F.col("o_orderkey") % 97 != 0, F.col("o_orderdate")))
    return checks.all_checks(
        checks.value_checks(dated, "orders", ["o_orderkey", "o_orderdate"], {"o_orderstatus": ("F", "O")}, {"o_totalprice": (1000, 400000)}),
        checks.unique_check(orders, "orders", ["o_orderkey"]),
        checks.unique_check(lines, "lineitem", ["l_orderkey", "l_linenumber"]),
        checks.reference_check(orders, cust, "orders", "o_custkey", "c_custkey"),
        checks.reference_check(lines, orders.filter(F.col("o_orderstatus") != "P"), "lineitem", "l_orderkey", "o_orderkey"),
    )


@query
def q_cascade(spark, sf):
    """Orders that survive when customers in debt are deleted."""
    kept = b.table(spark, sf, "customer").filter(F.col("c_acctbal") >= 0)
    return checks.cascade(b.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), kept, "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


@query
def q_table_totals(spark, sf):
    decided = _decided(spark, sf)
    links = written(validate.link_batch(_judged(spark, sf)), "links")
    return report.table_totals(b.jobs_of_companies(spark, sf), decided, links.select("dedup_key").distinct(), links)


@query
def q_funnel(spark, sf):
    """Counters of all stages over the feed, with verdicts, queries and contacts that earlier runs have stored."""
    jobs = _jobs(spark, sf)
    matched = written(_matched_companies(spark, sf, jobs), "matched")
    found, _, rest = match.split_matched(matched)
    client_rows = match.client_postings(jobs, found, as_of())
    decided = written(qualify.decide(rest, _stored_verdicts(spark, sf), as_of()), "verdicts")
    fit = ppl.with_target(decided.filter("decision = 'fit'")).withColumn("size_band", qualify.size_band(F.col("employees")))
    searched, skipped = ppl.unqueried(fit, _guard(spark, sf))
    searched = written(searched, "searched")
    best = written(ppl.people_of(searched, b.people(spark, sf)), "best")
    outcomes = ppl.query_outcomes(searched, best)
    pairs = validate.judge(validate.pair_up(funnel.candidate_rows(best, searched, DEFAULT_RULES), jobs))
    settled = written(validate.settle(pairs, SETTLE_KEY), "settled")
    batch = funnel.contact_rows(validate.contact_batch(settled, as_of()), as_of())
    kinds = {f.name: f.dataType for f in batch.schema.fields}
    stored = _stored_contacts(spark, sf).select("dedup_key", *[F.lit(None).cast(kinds[c]).alias(c) for c in merge.CONTACTS.columns if c != "dedup_key"])
    touched = written(merge.keyed_merge(stored, batch, merge.CONTACTS, F.col("batch_pos"), only_touched=True), "touched")
    return report.stack(
        report.counters(jobs, "scrape", {"jobs_scraped": F.count(F.lit(1))}),
        report.exclude_counters(matched, client_rows), report.fit_counters(decided),
        report.people_counters(outcomes, skipped), report.validate_counters(settled, touched),
    )


@query
def q_shortlist(spark, sf):
    """The flagship question: which companies that post jobs are no clients, fit by size, industry and
    place, and who are the two people to talk to there?"""
    jobs = _jobs(spark, sf)
    _, _, rest = match.split_matched(_matched_companies(spark, sf, jobs))
    fit = written(ppl.with_target(qualify.evaluate(rest).filter("decision = 'fit'")), "fit")
    best = ppl.people_of(fit, b.people(spark, sf))
    names = fit.select("company_key", "name", "size_band", "n_jobs", "fit_score")
    return best.join(names, "company_key").select(
        "company_key", "name", "size_band", "n_jobs", F.col("fit_score").cast("bigint").alias("fit_score"), "target_title", "full_name",
        or_empty("title").alias("title"), F.col("score").cast("bigint").alias("score"), F.col("result_pos").cast("bigint").alias("result_pos"),
    )
