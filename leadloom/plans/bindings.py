"""Inputs of the funnel operators, derived from the star-schema test tables.

postings = orders, companies = customers, people = suppliers (on the lineitems of a company's
orders), prose = documents, addresses = pages, replies = events. The literal lists below only give the
derived values their variety.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.rules import TITLE_PHRASES
from leadloom.session import spread_small, written

COUNTRIES = (
    "Germany", "Switzerland", "Netherlands", "Belgium", "Denmark", "Sweden", "Ireland", "France",
    "United Kingdom", "Spain", "Italy", "Austria", "Finland", "Norway", "United States", "Canada", "Japan",
    "India", "Brazil", "China", "Poland", "Greece", "Luxembourg", "Australia", " ICELAND ",
)
CODES = (
    "de", "ch", "nl", "be", "dk", "se", "ie", "fr", "GB", "es", "it", "at", "fi", " no ", "us", "ca", "jp",
    "in", "br", "cn", "pl", "gr", "lu", "au", "is",
)
POSTING_TITLES = (*TITLE_PHRASES, "Data Engineer", "Lab Technician", "Sales Manager")
NAME_FORMS = (
    " GmbH", " S.A.", "", ", Ltd.", " (Île-de-France) N.V.", " Müller Holding Group", " & Co. KG",
    " International AG", " A/S", "  plc", " Company, Inc.", " Élan Oy",
)
INDUSTRIES = {
    "HOUSEHOLD": "Biotechnology Research", "MACHINERY": "Medical Device Makers",
    "FURNITURE": "Staffing and Recruiting", "BUILDING": "Pharmaceutical Manufacturing",
    "AUTOMOBILE": "Car Parts",
}
PERSON_TITLES = (
    "Head of Talent Acquisition EU", "Senior Clinical Research Associate", "Director Regulatory Affairs",
    "VP Clinical Operations", "Talent Partner", "Recruiter", "Office Manager", "Global Medical Lead",
    "Principal Scientist", "HR Coordinator", "Chief People Officer", "International Sales Specialist",
    "Head of HR",
)
PART_CLIENTS = (
    "small ring GmbH", "Red Widget", "blue bolt", "hot gear AG", "old anvil", "large gizmo", "new rod", "Small Ring",
    "cold plate", "rod",
)
LONG_CLIENTS = (
    "small ring economy works of Brand", "red widget promo trading house Brand", "blue bolt standard supply Brand",
    "old anvil medium forge company works", "hot gear large transmission Brand",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table whose rows get costly expressions."""
    return spread_small(table(spark, sf_dir, name), key)


def pick(values, index: Column) -> Column:
    """Value of a literal list at a running number."""
    return F.element_at(F.array(*map(F.lit, values)), (index % len(values)).cast("int") + 1)


def industry_of(segment: Column) -> Column:
    chain = None
    for name, value in INDUSTRIES.items():
        chain = F.when(segment == name, value) if chain is None else chain.when(segment == name, value)
    return chain


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer with nation and region (25 and 5 rows, broadcast)."""
    nation = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    nation = nation.withColumn("country", pick(COUNTRIES, F.col("n_nationkey")))
    return table(spark, sf_dir, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))


def specialties_of(custkey: Column) -> Column:
    return (
        F.when(custkey % 3 == 0, F.array(F.lit("Oncology"), F.lit("Rare Disease")))
        .when(custkey % 3 == 1, F.array().cast("array<string>"))
    )


def feed(spark: SparkSession, sf_dir: str, at: DataFrame | None = None) -> DataFrame:
    """Raw postings with the gaps and duplicates that ingest has to handle; all of them, or those at the feed positions ``at`` (column
    ``scrape_seq``), for which alone texts are fetched then."""
    o, c = F.col("o_orderkey"), F.col("c_custkey")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    orders = spread_table(spark, sf_dir, "orders", "o_orderkey")
    if at is not None:
        orders = orders.join(at.select(F.col("scrape_seq").alias("o_orderkey")), "o_orderkey", "left_semi")
    base = (
        orders.drop("o_totalprice")
        .join(customers(spark, sf_dir), F.col("o_custkey") == c)
        .join(docs.select(F.col("doc_id").alias("o_doc"), F.col("text").alias("o_text")), o == F.col("o_doc"), "left")
        .join(docs.select(F.col("doc_id").alias("c_doc"), F.col("text").alias("c_text")), c == F.col("c_doc"), "left")
    )
    name = (
        F.when(c % 50 == 7, "Roché (Switzerland) AG").when(c % 50 == 8, "BioNTech SE").when(c % 50 == 9, "Novartix")
        .otherwise(F.concat(F.col("c_name"), pick(NAME_FORMS, c)))
    )
    slug = F.when(c % 50 == 11, "sanofi").when((c % 5 == 0) | (c % 50 == 8), F.lit(None)).when(c % 13 == 0, "").otherwise(
        F.concat(F.lit("Org-"), c.cast("string"))
    )
    stamp = F.concat(
        F.translate(F.col("o_orderdate").cast("string"), " ", "T"),
        F.when(o % 3 == 0, "").when(o % 3 == 1, "Z").otherwise("+02:00"),
    )
    country = F.col("country")
    second = pick(COUNTRIES, F.col("n_nationkey") + o)
    city = F.concat(F.lit("City "), (o % 40).cast("string"))
    return base.select(
        o.alias("scrape_seq"),
        F.when(o % 7 == 0, "").when(o % 11 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("J"), F.when(o % 20 == 19, o - 1).otherwise(o).cast("string"))).alias("id"),
        F.when(o % 77 != 0, F.concat(F.lit("L"), o.cast("string"))).alias("linkedin_id"),
        F.when(o % 31 != 0, pick(POSTING_TITLES, o)).alias("title"),
        name.alias("organization"),
        slug.alias("linkedin_org_slug"),
        F.when(o % 2 == 0, "").when(o % 3 == 0, F.concat(F.lit("https://org.example/"), c.cast("string"))).alias("organization_url"),
        F.concat(F.lit("https://www.linkedin.com/company/"), c.cast("string")).alias("linkedin_org_url"),
        F.when(o % 17 != 0, F.concat(F.lit("https://jobs.example/"), o.cast("string"))).alias("url"),
        F.when(o % 29 == 0, "not a date").otherwise(stamp).alias("date_posted"),
        F.col("o_text").alias("description_text"),
        F.col("o_orderpriority").alias("seniority"),
        F.when(F.col("o_orderstatus") == "F", F.array(F.lit("FULL_TIME")))
        .when(F.col("o_orderstatus") == "P", F.array(F.lit("PART_TIME"), F.lit("CONTRACTOR"))).alias("employment_type"),
        F.when(o % 19 != 0, F.array(F.concat_ws(", ", city, country))).alias("locations_derived"),
        F.array(city, F.lit("Elsewhere")).alias("cities_derived"),
        F.array("r_name").alias("regions_derived"),
        F.when(o % 9 == 0, F.lit(None)).when(o % 4 == 0, F.array(country, second)).otherwise(F.array(country)).alias("countries_derived"),
        F.when(o % 10 != 0, F.floor(F.abs("c_acctbal") / 4).cast("int") + (o % 3).cast("int")).alias("linkedin_org_employees"),
        F.lit(None).cast("string").alias("linkedin_org_size"),
        industry_of(F.col("c_mktsegment")).alias("linkedin_org_industry"),
        F.col("n_name").alias("linkedin_org_headquarters"),
        specialties_of(c).alias("linkedin_org_specialties"),
        F.col("c_text").alias("linkedin_org_description"),
        F.when(o % 5 != 0, (c % 40 == 3) & (o % 2 == 0)).alias("linkedin_org_recruitment_agency_derived"),
    )


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company rows in the shape of the roll-up, one per customer."""
    c = F.col("c_custkey")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return customers(spark, sf_dir).join(docs, c == F.col("doc_id"), "left").select(
        c.alias("first_seq"),
        F.concat(F.lit("org-"), c.cast("string")).alias("company_key"),
        F.concat(F.col("c_name"), pick(NAME_FORMS, c)).alias("name"),
        F.lower("c_name").alias("normalized_name"),
        F.when(c % 23 != 0, F.floor(F.abs("c_acctbal") / 4).cast("int")).alias("employees"),
        industry_of(F.col("c_mktsegment")).alias("industry"),
        F.when(c % 4 != 0, F.col("n_name")).alias("headquarters"),
        F.col("text").alias("description"),
        F.coalesce(specialties_of(c), F.array().cast("array<string>")).alias("specialties"),
        F.when(c % 6 == 0, F.array().cast("array<string>")).otherwise(F.array("country")).alias("countries"),
        F.array(F.concat(F.lit("City "), (c % 40).cast("string"))).alias("cities"),
    )


def jobs_of_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings with the key of :func:`companies`."""
    o = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("org-"), F.col("o_custkey").cast("string")).alias("company_key"),
        F.concat(F.lit("J"), o.cast("string")).alias("id"),
        o.alias("scrape_seq"),
        pick(POSTING_TITLES, o).alias("job_title"),
    )


def person_name(key: Column) -> Column:
    return F.concat(pick(("Élena  Rossi", "Sandra Müller", "Markus Frei", "Zoë  Ångström"), key), F.lit(" "), (key % 50).cast("string"))


def person_url(key: Column) -> Column:
    text = key.cast("string")
    return (
        F.when(key % 4 == 0, F.concat(F.lit("https://www.linkedin.com/in/Person-"), text, F.lit("/?trk=x")))
        .when(key % 4 == 1, F.concat(F.lit("http://de.linkedin.com/fr/in/person-"), text, F.lit("/")))
        .when(key % 4 == 2, F.lit(""))
    )


def people_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of companies and their people: the suppliers on the lineitems of a company's orders. The pairs are written once, as joins that
    spread frequent companies read them twice."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    pairs = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "l_suppkey").distinct()
    return written(pairs, "people-pairs")


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People of a company."""
    return people_rows(people_pairs(spark, sf_dir))


def people_rows(pairs: DataFrame) -> DataFrame:
    s = F.col("l_suppkey")
    return pairs.select(
        F.concat(F.lit("org-"), F.col("o_custkey").cast("string")).alias("company_key"),
        person_name(s).alias("full_name"),
        F.when(s % 17 != 0, pick(PERSON_TITLES, s)).alias("title"),
        person_url(s).alias("linkedin_url"),
        F.concat(F.lit("City "), (s % 40).cast("string")).alias("location"),
        F.lit("").alias("about_snippet"),
        F.lit("prospeo").alias("provider"),
        F.when(s % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("www.site"), (s % 9).cast("string"), F.lit(".co.uk"))).alias("company_domain"),
        s.cast("int").alias("result_pos"),
    )


def reply_text(key: Column, props: Column) -> Column:
    """Reply texts around the JSON of an event: fenced, wrapped in prose, odd, broken, missing."""
    k = F.regexp_extract(props, r"(\d+)", 1)
    return (
        F.when(key % 8 == 0, F.concat(F.lit('```json\n{"decision":"Fit ","fit_score":'), k, F.lit(',"confidence":"High","domain":" Site'), k, F.lit('.COM ","reason":" fine "}\n```')))
        .when(key % 8 == 1, F.concat(F.lit('Sure: {"decision":"YES","fit_score":"'), k, F.lit('","rationale":" looks right ","reason":"owns it"} - done')))
        .when(key % 8 == 2, F.lit('{"decision":"not_fit","fit_score":140,"confidence":"certain"}'))
        .when(key % 8 == 3, F.lit("no object here"))
        .when(key % 8 == 4, F.lit('{"decision":true,"fit_score":-5,"domain":null}'))
        .when(key % 8 == 5, F.lit('{"decision":"no","fit_score":"n/a","confidence":"low"}'))
        .when(key % 8 == 6, props)
    )
