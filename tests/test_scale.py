"""What large tables need: joins by measured sizes, and texts read for chosen rows only."""

from leadloom.operators import ingest, rollup
from leadloom.plans import bindings as b
from leadloom.session import measured_joins
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


def test_a_table_that_compresses_well_is_not_broadcast_by_its_file(spark, tmp_path):
    path = str(tmp_path / "texts")
    spark.range(4000).select("id", F.repeat(F.lit("the same words "), 1000).alias("text")).coalesce(1).write.parquet(path)
    texts = spark.read.parquet(path)  # 60 MB of texts in a file of some KB
    measured_joins(spark)
    joined = spark.range(0, 100_000, 5).join(texts, "id", "left")
    rows = joined.agg(F.count("text"), F.sum(F.length("text"))).first()
    assert tuple(rows) == (800, 800 * 15_000)
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
    joined.foreach(lambda r: None)
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()


def test_roll_up_reads_texts_of_chosen_postings_only(spark):
    typed = ingest.typed_jobs(b.feed(spark, SMALL))
    doubled = typed.unionByName(typed.where("scrape_seq % 3 = 0"))
    jobs = ingest.first_postings(doubled)
    thin = jobs.withColumn("linkedin_org_description", F.lit(None).cast("string"))
    asked = []

    def full(at):
        asked.append(at.count())
        return doubled.join(at, ingest.SEQ, "left_semi")

    rows = lambda df: sorted((str(r) for r in df.collect()))
    want = rows(rollup.rollup_companies(jobs))
    assert rows(rollup.rollup_companies(thin, full)) == want
    assert any("description='" in r for r in want)
    assert asked == [jobs.select("company_key").distinct().count()] and asked[0] < jobs.count()


def test_feed_at_positions_is_the_feed(spark):
    feed = b.feed(spark, SMALL)
    at = feed.where("scrape_seq % 7 = 0").select("scrape_seq")
    rows = lambda df: sorted((str(r) for r in df.collect()))
    assert rows(b.feed(spark, SMALL, at)) == rows(feed.where("scrape_seq % 7 = 0"))
