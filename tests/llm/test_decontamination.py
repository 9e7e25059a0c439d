import random
import re

from leadloom.llm.decontamination import drop_leaks, find_leaks
from leadloom.llm.licenses import alignment

from .data import no_docs, odd_docs, odd_rows, prose


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def test_copies_and_paraphrases_are_found_and_nothing_else(spark):
    draw = random.Random(4)
    items = [(i, prose(500 + i, 14 + i)) for i in range(40)] + [(90, None), (91, ""), (92, "short words three")]
    docs, want = [], set()
    for d in range(400):
        text = prose(d, 30 + d)
        if d % 5 == 0:
            i, item = items[d % 40]
            own = item.split()
            if d % 10 == 0:  # a copy, differently cased and punctuated
                held = ", ".join(own).upper()
            else:  # one word in nine replaced
                held = " ".join(draw.choice(["alpha", "beta"]) if k % 9 == 4 else w for k, w in enumerate(own))
            parts = text.split()
            at = draw.randrange(len(parts))
            text = " ".join([*parts[:at], held, *parts[at:]])
            want.add((d, i))
        if d == 7:
            text, want = text + " short words three", want | {(7, 92)}
        if d == 8:
            text = text + " short words or three"
        docs.append((d, text))
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = find_leaks(table, benchmark).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    assert got <= want and len(want - got) <= len(want) // 50
    for r in found:  # the window holds what is said to be shared
        own, held = set(words(dict(items)[r["item_id"]])), words(dict(docs)[r["doc_id"]])
        window = held[r["first_word"] : r["first_word"] + r["n_words"]]
        assert len(own & set(window)) >= 0.99 * r["lcs_share"] * len(own) - 1
    assert {r["kind"] for r in found} <= {"copy", "paraphrase"}
    kept = {r["doc_id"] for r in drop_leaks(table, benchmark).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in got}


def test_odd_rows_and_empty_tables(spark):
    benchmark = spark.createDataFrame([(1, prose(2, 60), 3), (None, "x", 3), (2, None, 3)], "item_id long, text string, doc_id int")
    found = sorted((r["doc_id"] or -1, r["item_id"]) for r in find_leaks(odd_docs(spark), benchmark).collect())
    assert found == [(-1, 1), (10, 1), (10, 1)]
    kept = drop_leaks(odd_docs(spark), benchmark)
    assert kept.columns == odd_docs(spark).columns and kept.count() == len(odd_rows()) - 2
    assert find_leaks(no_docs(spark), benchmark).count() == 0
    assert find_leaks(odd_docs(spark), benchmark.limit(0)).count() == 0


def test_paraphrases_of_60_to_80_percent_are_found_as_by_brute_force(spark):
    draw = random.Random(9)
    items = [(n, prose(700 + n, n)) for n in [*range(8, 60), 75, 100, 520]]
    docs, places = [], []
    for d in range(165):
        item = items[d % len(items)][1].split()
        body = len(item) - max(3, len(item) // 4)
        keep = -(-len(item) * draw.randrange(60, 80) // 100)
        gone = set(draw.sample(range(body), min(body, len(item) - keep)))
        held = [draw.choice(["alpha", "beta", "gamma"]) if k in gone else w for k, w in enumerate(item)]
        text = prose(d, 60 + d).split()
        at = draw.randrange(len(text))
        docs.append((d, " ".join([*text[:at], *held, *text[at:]])))
        places.append(at)
    found = find_leaks(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]): r for r in found.collect()}
    want = set()
    for d, text in docs:
        own = words(text)
        for n, item in items:
            asked = words(item)
            for at in range(max(1, len(own) - n + 1)) if n < 500 else [places[d]]:
                window = own[at : at + n]
                if sum(w in set(asked) for w in window) < 0.6 * n:
                    continue
                tail = asked[-max(3, n // 4) :]
                share, answer = (1 - len(alignment(a, window)[0]) / len(a) for a in (asked, tail))
                if share >= 0.8 or share >= 0.6 and answer >= 0.6:
                    want.add((d, n))
                    break
    assert len(want) >= 160 and want <= set(got)
    for (d, n), r in got.items():  # no more is claimed than the window holds
        window = words(docs[d][1])[r["first_word"] : r["first_word"] + r["n_words"]]
        assert abs(1 - len(alignment(words(dict(items)[n]), window)[0]) / n - r["lcs_share"]) < 1e-9 and r["lcs_share"] >= 0.6
