import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from leadloom.operators import match, skew
from leadloom.rules import CLIENTS, DEFAULT_RULES
from tests.test_text import close, mutated


def run(spark, rows, clients=CLIENTS, inline=match.INLINE_CLIENTS, rules=DEFAULT_RULES):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "company_key long, name string, slug string, domain string")
    found = match.match_clients(df, match.client_table(spark, clients), F.col("name"), F.col("slug"), F.col("domain"), rules, inline)
    return [(r.client_name, r.match_method) for r in found.orderBy("company_key").collect()]


CASES = [
    (("BioNTech SE", None, None), ("biontech", "exact")), (("Bayer AG", None, None), ("bayer", "exact")),
    (("MorphoSys AG", None, None), ("morphosys", "exact")), (("Roche Diagnostics GmbH", "roche", None), ("roche", "slug")),
    (("ICON plc", "icon-plc", None), ("icon", "exact")), (("Idorsia Pharmaceuticals Ltd", None, None), (None, None)),
    (("argenx", None, None), (None, None)), (("Genmab", None, None), (None, None)), (("Tubulis GmbH", None, None), (None, None)),
    (("Ican Biotech", None, None), (None, None)), (("Baxter", None, None), ("bayer", "fuzzy")),
    (("Boehringer Ingelheim RCV", None, None), ("boehringer ingelheim", "fuzzy")), (("x", "y", "www.evotec.com"), ("evotec", "domain")),
    (("IQVIA Laboratories", None, None), (None, None)), (("Astra Zeneca", "novartis-x", None), ("astrazeneca", "fuzzy")),
]


@pytest.mark.parametrize("inline", [match.INLINE_CLIENTS, 0])
def test_literal_cases(spark, inline):
    assert run(spark, [c for c, _ in CASES], inline=inline) == [e for _, e in CASES]


def test_client_list_is_distinct_after_normalization(spark):
    assert match.distinct_clients(match.client_table(spark, CLIENTS)).count() == 16


def test_both_strategies_equal_brute_force(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefg ") for _ in range(rng.randint(3, 40))).strip() or "x" for _ in range(40)]
    rows = [(mutated(rng, rng.choice(base)), mutated(rng, rng.choice(base)) if i % 3 else None, None) for i in range(250)]
    squeezed = lambda s: " ".join(s.split())
    listed = list(dict.fromkeys(squeezed(b) for b in base))

    def expected(row):
        tries = [(squeezed(c), m) for c, m in zip(row[:2], ("exact", "slug")) if c and squeezed(c)]
        for cand, method in tries:
            if cand in listed:
                return cand, method
        for cand, _ in tries:
            for norm in listed:
                if len(cand) >= 5 and len(norm) >= 5 and close(cand, norm):
                    return norm, "fuzzy"
        return None, None

    want = [expected(r) for r in rows]
    assert run(spark, rows, base) == want
    assert run(spark, rows, base, inline=0) == want
    assert sum(m == "fuzzy" for _, m in want) > 50


def test_looser_rules_in_the_blocked_join(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdef") for _ in range(rng.randint(5, 18))) for _ in range(25)]
    rows = [(mutated(rng, rng.choice(base), 4), None, None) for _ in range(120)]
    loose = replace(DEFAULT_RULES, min_ratio=75, max_edits=1)
    assert run(spark, rows, base, rules=loose) == run(spark, rows, base, inline=0, rules=loose)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_join_and_splits_the_hot_key(spark, how):
    big = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).alias("k"), F.col("id").alias("v"))
    small = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    plain = big.join(small, "k", how)
    spread = skew.spread_join(big, small, ["k"], [F.col("v")], how, hot_rows=50, max_hot_keys=20)
    assert spread.columns == plain.columns
    assert sorted(map(tuple, spread.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    hot = {r.k: r._parts for r in skew.hot_keys(big, ["k"], 50, 20).collect()}
    assert hot == {7: 21}


def test_spread_join_refuses_joins_that_would_repeat_rows(spark):
    with pytest.raises(ValueError):
        skew.spread_join(spark.range(1), spark.range(1), ["id"], [F.col("id")], "full_outer")
