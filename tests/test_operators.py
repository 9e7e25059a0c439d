import random

import pytest
from pyspark.sql import functions as F

from leadloom.functions.replies import latest_replies
from leadloom.operators import checks, ingest, merge, people, qualify, rollup, validate
from leadloom.sources import feed as feeds


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_person_rule_cases(spark):
    cases = [
        ("Director Regulatory Affairs", "201-1000", "yes"), ("Senior Clinical Research Associate", "201-1000", "no"),
        ("Head of Talent Acquisition EU", "50-200", "yes"), ("Head of Talent", "1001-2000", "yes"), ("Talent Partner", "50-200", "yes"),
        ("Talent Partner", "201-1000", "no"), ("International Sales", "50-200", "no"), (None, None, "no"), ("Clerk", "50-200", "no"),
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, t string, b string, want string")
    rows = df.withColumn("v", validate.person_rule(F.col("t"), F.col("b"))).collect()
    assert [r.v.decision for r in rows] == [r.want for r in rows]
    assert rows[7].v.reason == "[offline] '' does not indicate decision-maker authority."


def test_flat_people_results(spark, tmp_path):
    path = tmp_path / "people.json"
    path.write_text("""{"request": {"tool": "x"}, "results": [
      {"full_name": "Ana B", "title": "Head of Talent Acquisition EU", "linkedin_url": "u1", "email": "a@b.example"},
      {"full_name": "Ben C", "title": "Director Regulatory Affairs", "linkedin_url": "u2"},
      {"full_name": "Cem D", "title": "Senior Clinical Research Associate", "linkedin_url": "u3"}], "meta": {}}""")
    df = feeds.read_flat_people(spark, str(path))
    assert "email" not in df.columns
    got = df.select("full_name", validate.person_rule(F.col("title"), F.lit("201-1000")).alias("v")).collect()
    assert {r.full_name: r.v.decision for r in got} == {"Ana B": "yes", "Ben C": "yes", "Cem D": "no"}


def test_nested_people_locations(spark):
    df = spark.createDataFrame([("k", 0, "Full", None, '{"city":"A","state":"","country":"B"}'), ("k", 1, "", "First", '"Somewhere"'), ("k", 2, None, None, "{}"), ("k", 3, None, None, None)],
                               "company_key string, result_pos int, full string, first string, loc string")
    person = F.struct(F.col("full").alias("full_name"), F.col("first").alias("first_name"), F.lit("Last").alias("last_name"), F.lit("").alias("current_job_title"),
                      F.lit("Head line").alias("headline"), F.lit("u").alias("linkedin_url"), F.parse_json("loc").alias("location"))
    company = F.struct(F.lit("").alias("domain"), F.lit("w.example").alias("website"))
    rows = people.flatten_people(df.select("company_key", "result_pos", person.alias("person"), company.alias("company"))).orderBy("result_pos").collect()
    assert [r.full_name for r in rows] == ["Full", "First Last", "Last", "Last"]
    assert [r.location for r in rows] == ["A, B", "Somewhere", None, None]
    assert {(r.title, r.company_domain, r.provider) for r in rows} == {("Head line", "w.example", "prospeo")}


def test_top_people_ranks_and_is_stable(spark):
    titles = ["Office Manager", "Head of People", "VP Talent Acquisition", "Global Head of Talent", None, "Head of People"]
    df = spark.createDataFrame([("a", 100, i, t) for i, t in enumerate(titles)], "company_key string, employees int, result_pos int, title string")
    top = people.top_people(df)
    assert [(r.result_pos, r.score) for r in top.orderBy(F.desc("score"), "result_pos").collect()] == [(3, 5), (1, 3)]
    assert "WindowGroupLimit" in plan(top)


def test_hot_company_sends_few_rows_per_task(spark):
    """A key that holds most rows is cut before the shuffle."""
    df = spark.range(0, 20000, 1, 8).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    first = ingest.first_per_key(df, ["k"], ["v"], 2)
    text = plan(first)
    assert text.count("WindowGroupLimit") == 2
    got = {(r.k, r.v) for r in first.filter("k = 1").collect()}
    assert got == {(1, 1), (1, 2)}


def jobs(spark, rows):
    return spark.createDataFrame(rows, """company_key string, scrape_seq long, organization string, linkedin_org_employees int, linkedin_org_industry string,
        linkedin_org_headquarters string, linkedin_org_description string, linkedin_org_specialties array<string>, countries array<string>, city string,
        is_recruitment_agency boolean""")


def test_rollup_against_the_definition(spark):
    rng = random.Random(11)
    rows = []
    for i in range(400):
        key = "hot" if i % 3 == 0 else f"k{rng.randint(0, 20)}"
        rows.append((key, i, f"Org {i}", rng.choice([None, 0, 10, 20]), "ind", "hq", f"d{i}", ["s"], rng.sample(["A", "B", "C", "D", ""], rng.randint(0, 3)), rng.choice(["x", "y", "z", None, ""]), rng.random() < 0.02))
    want = {}
    for r in sorted(rows, key=lambda r: r[1]):
        want.setdefault(r[0], []).append(r)

    def expected(group):
        head = max(group, key=lambda r: r[3] or 0)
        countries = list(dict.fromkeys(c for r in group for c in r[8] if c))
        cities = list(dict.fromkeys(r[9] for r in group if r[9]))
        return head[2], head[3], head[6], countries, cities, any(r[10] for r in group), len(group), group[0][1]

    rng.shuffle(rows)
    got = {r.company_key: (r.name, r.employees, r.description, r.countries, r.cities, r.any_agency, r.n_jobs, r.first_seq)
           for r in rollup.rollup_companies(jobs(spark, rows)).collect()}
    assert got == {k: expected(g) for k, g in want.items()}


def test_merge_against_row_by_row_upserts(spark):
    rng = random.Random(13)
    spec = merge.Upsert(keys=("k",), replace=("r",), keep=("p",), fill=("f",))
    rows = lambda n, tag, base: [(rng.randint(0, 30), f"{tag}r{i}", f"{tag}p{i}", rng.choice([None, f"{tag}f{i}"]), base + i) for i in range(n)]
    stored = list({r[0]: r for r in rows(15, "s", 0)}.values())
    batch = rows(120, "b", 100)
    table = {k: [r, p, f, False] for k, r, p, f, _ in stored}
    for k, r, p, f, _ in batch:
        if k in table:
            table[k][0] = r
            table[k][2] = f if f is not None else table[k][2]
        else:
            table[k] = [r, p, f, True]
    schema = "k int, r string, p string, f string, pos int"
    rng.shuffle(batch)
    s, b = spark.createDataFrame(stored, schema), spark.createDataFrame(batch, schema)
    got = {x.k: [x.r, x.p, x.f, x.created] for x in merge.keyed_merge(s, b, spec, F.col("pos")).collect()}
    assert got == table
    touched = merge.keyed_merge(s, b, spec, F.col("pos"), only_touched=True)
    assert {x.k for x in touched.collect()} == {x[0] for x in batch}
    counts = merge.batch_counts(touched).first()
    assert (counts.n_new, counts.n_total) == (sum(v[3] for v in table.values()), len({x[0] for x in batch}))


def test_settle_reasons(spark):
    rows = [("a", 1, "no", "n1"), ("a", 2, "yes", "y2"), ("a", 3, "yes", "y3"), ("b", 2, "no", "n2"), ("b", 5, "no", "n5")]
    df = spark.createDataFrame(rows, "c string, job_seq int, decision string, reason string").withColumn("is_first", F.lit(True))
    got = {r.c: (r.kept, r.reason, r.n_links, r.n_pairs) for r in validate.settle(df, ["c"]).collect()}
    assert got == {"a": (True, "y2", 2, 3), "b": (False, "n5", 0, 2)}


def test_two_spellings_of_one_person_share_the_first_verdict(spark):
    rows = [("k", 0, 2, "Ana", "Head of HR", "same"), ("k", 1, 0, "Ana B", "Intern", "same"), ("k", 2, 0, "Cem", "Intern", "")]
    df = validate.with_memo(spark.createDataFrame(rows, "company_key string, result_pos int, score int, full_name string, title string, linkedin_url string").withColumn("size_band", F.lit("50-200")))
    got = {r.result_pos: (r.memo, r.judged_title, r.is_first) for r in df.collect()}
    assert got == {0: ("same", "Head of HR", True), 1: ("same", "Head of HR", False), 2: ("Cem", "Intern", True)}


def test_checks_count_violations(spark):
    df = spark.createDataFrame([(1, "fit", 50), (1, "odd", 101), (None, None, None)], "id int, decision string, score int")
    got = {r.check_name: r.violations for r in checks.all_checks(
        checks.value_checks(df, "t", ["id"], {"decision": ("fit", "not_fit")}, {"score": (0, 100)}), checks.unique_check(df, "t", ["id"]),
        checks.reference_check(df, spark.createDataFrame([(2,)], "pid int"), "t", "id", "pid")).collect()}
    assert got == {"not_null:id": 1, "domain:decision": 1, "range:score": 1, "unique:id": 1, "reference:id": 2}


def test_band_join_is_a_small_broadcast(spark):
    df = spark.createDataFrame([(n,) for n in (None, 0, 49, 50, 200, 201, 1000, 1001, 2000, 2001)], "employees int")
    joined = qualify.join_bands(df, qualify.band_table(spark)).select("employees", "size_band", qualify.size_band(F.col("employees")).alias("by_rule"))
    assert all(r.size_band == r.by_rule for r in joined.collect())
    assert [r.by_rule for r in joined.orderBy("employees").collect()] == [None, None, None, "50-200", "50-200", "201-1000", "201-1000", "1001-2000", "1001-2000", None]


def test_guard_keeps_companies_out_of_every_band_aside(spark):
    df = people.with_target(spark.createDataFrame([("a", 100), ("b", 100), ("c", 9000)], "company_key string, employees int"))
    guard = spark.createDataFrame([("a", "Head of Talent"), ("b", "Other")], "company_key string, target_title string")
    fresh, asked = people.unqueried(df, guard)
    assert [r.company_key for r in fresh.collect()] == ["b"] and [r.company_key for r in asked.collect()] == ["a"]


def test_disqualifier_hidden_by_a_target(spark):
    rows = [("Clinical oncology", ["Germany"], "fit"), ("Clinical oncology", ["Japan"], "not_fit"), ("Hospital", ["Germany"], "not_fit"), ("Cars", [" GERMANY "], "not_fit")]
    df = spark.createDataFrame([(i, r[0], "", [], r[1], 100, r[2]) for i, r in enumerate(rows)],
                               "i int, industry string, description string, specialties array<string>, countries array<string>, employees int, want string")
    got = qualify.evaluate(df).orderBy("i").collect()
    assert [r.decision for r in got] == [r.want for r in got]
    assert [(r.fit_score, r.confidence) for r in got] == [(70, "medium"), (30, "low"), (10, "medium"), (20, "low")]


def test_the_latest_reply_counts_and_none_multiplies(spark):
    replies = spark.createDataFrame(
        [("a", "old", 1), ("a", "new", 2), ("a", None, 3), ("b", "x", None), ("b", "x", None), ("c", None, 1)], "k string, reply string, replied_at int"
    )
    assert sorted(map(tuple, latest_replies(replies, "k").collect())) == [("a", "new"), ("b", "x"), ("c", None)]
    assert latest_replies(replies.drop("replied_at"), "k").where("k = 'a'").first().reply == "old"


def test_a_source_refuses_more_rows_than_it_answers(spark):
    with pytest.raises(ValueError, match="5000"):
        ingest.select_source(spark.createDataFrame([], "id string"), F.current_timestamp(), ["id"], rows=5001)


def test_a_band_table_has_a_bound(spark):
    bands = spark.range(qualify.MAX_BANDS + 1).selectExpr("id as low", "id as high", "'b' as band")
    with pytest.raises(ValueError, match="no rule table"):
        qualify.join_bands(spark.createDataFrame([(1,)], "employees int"), bands)
