"""What a run puts on disk: texts are neither shuffled nor written again where few postings are repeats, and files are compressed."""

import glob
import json
import time

from leadloom import session
from leadloom.operators import ingest
from leadloom.plans import funnel, runs
from leadloom.sources.feed import JOB_FIELDS
from pyspark.sql import functions as F

TEXT = "a long text about the work "


def feed(spark):
    """Ids that come once, thrice or not at all, a record twice at one position, and one without a position."""
    rows = [(i, f"J{i % 40 if i % 3 else i}", f"{TEXT * 50}{i}") for i in range(100)]
    rows += [(7, "J7", f"{TEXT * 50}7"), (None, "J8", "no position"), (101, None, "no id")]
    made = spark.createDataFrame(rows, "scrape_seq long, id string, description_text string")
    return made.select("scrape_seq", *[F.col(c) if c in made.columns else F.lit(None).cast(t).alias(c) for c, t in JOB_FIELDS.items()])


def texts(df):
    return sorted((r["id"], r["scrape_seq"], r["description_text"]) for r in df.collect())


def test_first_postings_without_a_shuffle_of_texts(spark, monkeypatch):
    want = texts(ingest.first_postings(ingest.typed_jobs(feed(spark))))
    assert len(want) > 60
    few = funnel.ingest_jobs(feed(spark), F.lit(None).cast("timestamp"), None)
    assert texts(few) == want
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    assert texts(funnel.ingest_jobs(feed(spark), F.lit(None).cast("timestamp"), None)) == want


def test_lines_and_intermediates_are_compressed(spark, tmp_path):
    rows = spark.range(2000).select(F.concat(F.repeat(F.lit(TEXT), 40), F.col("id").cast("string")).alias("text"))
    path = runs._lines(rows, str(tmp_path / "lines"))
    assert {p.rsplit(".", 1)[1] for p in glob.glob(f"{path}/part-*")} == {"gz"}
    assert sorted(r[0] for r in spark.read.json(path).collect()) == sorted(r[0] for r in rows.collect())
    assert all(".zstd." in p for p in session.written(rows, "rows").inputFiles())


def test_a_first_run_joins_nothing_with_the_empty_tables(spark, tmp_path):
    from leadloom.operators import merge
    from leadloom.sources.tables import FunnelState

    stored = FunnelState(spark, str(tmp_path / "state")).current("contact_jobs")
    batch = spark.createDataFrame([("c", "j", None)], "contact_id string, job_id string, linked_at timestamp")
    merged = merge.keyed_merge(stored, batch, merge.CONTACT_JOBS, only_touched=True)
    assert [tuple(r) for r in merged.collect()] == [("c", "j", None, True)]
    assert "Join" not in merged._jdf.queryExecution().optimizedPlan().toString()


def test_people_are_joined_once(spark, tmp_path):
    from leadloom.plans import bindings as b

    for name, rows, schema in (
        ("lineitem", [(1, 5), (1, 5), (1, 6), (2, 5), (3, None), (None, 5)], "l_orderkey long, l_suppkey long"),
        ("orders", [(1, 10), (2, 10), (3, 11), (4, 12)], "o_orderkey long, o_custkey long"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    people = b.people(spark, str(tmp_path))
    assert not any("lineitem" in p for p in people.inputFiles())
    assert sorted((r["company_key"], r["result_pos"]) for r in people.where("result_pos is not null").collect()) == [("org-10", 5), ("org-10", 6)]
    assert people.count() == 3


def shuffle_files(spark):
    folder = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in folder for f in glob.glob(f"{d}/**/shuffle_*", recursive=True)}


def test_an_intermediate_leaves_no_shuffles(spark):
    before = shuffle_files(spark)
    df = spark.range(20_000).groupBy((F.col("id") % 5000).alias("k")).agg(F.collect_list("id").alias("ids"))
    table = session.written(df, "sums")
    until = time.time() + 20  # files are deleted in the background
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert shuffle_files(spark) <= before and table.count() == 5000
    assert session.written(df.where("k < 10"), "sums").count() == 10  # the frame can be used again
    with session.shuffles_freed(spark):
        pass
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def job(i, words, url="u"):
    return {"id": f"J{i}", "scrape_seq": i, "organization": f"Org {i % 3}", "title": "T", "url": url, "description_text": f"{words} {i}",
            "linkedin_org_description": f"about {words} {i}"}


def deliver(spark, state, rows, at, **more):
    from leadloom.sources import feed as feeds

    raw = spark.createDataFrame([(json.dumps(r),) for r in rows], "value string").select(F.parse_json("value").alias("raw"))
    typed = feeds.records(raw.select(F.try_variant_get("raw", "$.scrape_seq", "bigint").alias("scrape_seq"), "raw"))
    people = spark.createDataFrame([], "company_key string, full_name string, title string, linkedin_url string, location string, "
                                   "about_snippet string, provider string, company_domain string, result_pos int")  # fmt: skip
    return funnel.run_funnel(state, typed, people, at, recency_days=None, **more)


def stored_texts(df):
    word = F.try_variant_get("raw", "$.description_text", "string")
    rows = df.select("id", "description_text", word.alias("w"), "linkedin_org_description", "url").collect()
    return {r["id"]: tuple(r)[1:] for r in rows}


def test_texts_are_stored_apart_and_found_again(spark, tmp_path):
    from datetime import datetime, timezone

    from leadloom.sources.tables import FunnelState

    at = datetime(2026, 5, 21, tzinfo=timezone.utc)
    state = FunnelState(spark, str(tmp_path / "state"))
    text = lambda i, new, first, url: (f"{new} {i}", f"{new} {i}", f"about {first} {i}", url)
    deliver(spark, state, [job(i, "old") for i in range(4)], at)
    deliver(spark, state, [job(i, "new", "v") for i in range(2, 6)], at)
    want = {"J0": text(0, "old", "old", "u"), "J1": text(1, "old", "old", "u"), "J2": text(2, "new", "old", "u"), "J3": text(3, "new", "old", "u"),
            "J4": text(4, "new", "new", "v"), "J5": text(5, "new", "new", "v")}
    assert stored_texts(state.current("jobs")) == want
    assert len(state.history("jobs").collect()) == 8 and "born" not in state.history("jobs").columns
    in_buckets = spark.read.parquet(str(tmp_path / "state/jobs/run=2")).columns
    assert not {"description_text", "raw", "linkedin_org_description"} & set(in_buckets)
    short = state.current("jobs", columns=["id", "url"])
    assert "jobs-long" not in "".join(short.inputFiles()) and short.count() == 6
    state.compact()  # rows that hold their texts again, and a run on top of them
    assert stored_texts(state.current("jobs")) == want
    deliver(spark, state, [job(i, "last") for i in (0, 5, 6)], at)
    want |= {"J0": text(0, "last", "old", "u"), "J5": text(5, "last", "new", "v"), "J6": text(6, "last", "last", "u")}
    assert stored_texts(state.current("jobs")) == want


def test_merging_postings_shuffles_no_texts(spark, tmp_path):
    from leadloom.operators import merge
    from leadloom.sources.tables import FunnelState, short

    state = FunnelState(spark, str(tmp_path / "state"))
    jobs = ingest.typed_jobs(feed(spark)).where("scrape_seq between 30 and 60").withColumn("scraped_at", F.current_timestamp())
    jobs = session.written(jobs.withColumn("raw", F.parse_json(F.lit("{}"))), "batch")
    for run in (1, 2):
        merged = merge.keyed_merge(state.short_rows("jobs", jobs), jobs.withColumn("born", F.lit(run)), short("jobs"), only_touched=True)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "ReadSchema" in plan and not any(c in plan for c in ("description_text", "raw", "linkedin_org_description"))
        state.write("jobs", run, merged, long=jobs)
        state.commit(run)
    want = {r["id"]: r["description_text"] for r in jobs.collect()}
    assert {r["id"]: r["description_text"] for r in state.current("jobs").collect()} == want


def test_questions_keep_their_first_text(spark, tmp_path):
    from datetime import datetime, timezone

    from leadloom.sources.tables import FunnelState

    state = FunnelState(spark, str(tmp_path / "state"))
    rows = [job(i, "old") | {"linkedin_org_employees": 100} for i in range(3)]
    replies = spark.createDataFrame([("org 1", '{"decision":"fit","fit_score":80}')], "company_key string, reply string")
    for day, given in ((1, None), (2, replies)):
        deliver(spark, state, rows, datetime(2026, 5, day, tzinfo=timezone.utc), ask=True, fit_replies=given)
    asked = {r["company_key"]: r for r in state.current("questions").collect()}
    assert {k: r["state"] for k, r in asked.items()} == {"org 0": "open", "org 1": "replaced", "org 2": "open"}
    assert all(r["asked_at"].day == 1 and f"about old {k[-1]}" in r["question"] for k, r in asked.items())


def test_roll_up_sends_on_one_posting_of_a_company_and_task(spark, monkeypatch):
    from leadloom.operators import rollup

    typed = ingest.typed_jobs(feed(spark)).where("scrape_seq is not null").withColumn("linkedin_org_description", F.col("description_text"))
    jobs = typed.withColumn("company_key", F.concat(F.lit("c"), (F.col("scrape_seq") % 4).cast("string")))
    jobs = jobs.withColumn("linkedin_org_employees", F.when(F.col("scrape_seq") % 5 > 0, (F.col("scrape_seq") % 9).cast("int")))
    rows = lambda: sorted(str(r) for r in rollup.rollup_companies(jobs).collect())
    want = rows()
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    assert rows() == want and len(want) >= 4
    plan = rollup.rollup_companies(jobs)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_people_of_few_companies_stay_where_they_are(spark):
    from leadloom.operators import people as ppl

    rows = [(f"c{i % 5}" if i % 7 else None, f"P{i}", "Head of HR" if i % 3 else "Intern", None, "x", "", "prospeo", None, i) for i in range(60)]
    people = spark.createDataFrame(rows, "company_key string, full_name string, title string, linkedin_url string, location string, "
                                   "about_snippet string, provider string, company_domain string, result_pos int")  # fmt: skip
    companies = spark.createDataFrame([("c1", 100, "t"), ("c3", 300, "t"), ("c9", 60, "t")], "company_key string, employees int, target_title string")
    spread, stay = (ppl.people_of(companies, people, few=few) for few in (False, True))
    assert sorted(map(str, spread.collect())) == sorted(map(str, stay.select(*spread.columns).collect())) and stay.count() == 4
    assert stay._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_people_lines_shuffle_keys_only(spark, tmp_path):
    for name, rows, schema in (
        ("lineitem", [(i % 9, i) for i in range(40)], "l_orderkey long, l_suppkey long"),
        ("orders", [(i, 100 + i % 3) for i in range(9)], "o_orderkey long, o_custkey long"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    lines = spark.read.text(runs.people_lines(spark, str(tmp_path)))
    assert lines.count() == 40
    read = runs._people(spark, str(tmp_path))
    names = read.groupBy("company_key").agg(F.array_sort(F.collect_list(F.struct("result_pos", "location"))).alias("p")).collect()
    for r in names:
        key = int(r["company_key"][4:]) - 100
        assert [p["location"] for p in r["p"]] == [f"City {i}" for i in range(40) if i % 9 % 3 == key]
