import re

from leadloom.llm.graph import components
from leadloom.llm.minhash import drop_near_duplicates, near_duplicates

from .data import no_docs, odd_docs, odd_rows, prose


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute_force(rows, percent):
    sets = [shingle_set(t) for _, t in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and 100 * common >= percent * len(sets[i] | sets[j]) and common:
                group[top(i)] = top(j)
    out = []
    for i, (key, _) in enumerate(rows):
        keys = [rows[j][0] for j in range(len(rows)) if top(j) == top(i) and rows[j][0] is not None]
        least = min(keys) if sets[i] and keys else key
        out.append((key, len(sets[i]), least, key is not None and key == least))
    return sorted(out, key=repr)


def test_equals_brute_force(spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    for g in range(6):
        words = prose(100 + g, 80 + 30 * g).split()
        for c in range(7):  # a chain: each copy differs from the one before in two words more
            changed = list(words)
            for k in range(c):
                changed[(k * 11) % len(words)] = f"new{k}"
            rows.append((1000 + 10 * g + c, " ".join(changed)))
    for percent in (80, 85):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        got = sorted((tuple(r) for r in near_duplicates(docs, percent=percent).collect()), key=repr)
        assert got == brute_force(rows, percent)


def test_large_group_without_a_common_member(spark):
    base = prose(9, 300).split()
    rows = [(i, " ".join(w if k % 60 != i % 60 else f"{w}{i}" for k, w in enumerate(base))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in near_duplicates(docs).collect()), key=repr) == brute_force(rows, 80)


def test_large_group_of_copies_that_mostly_do_not_link(spark):
    """Every copy changes two words of its own in a text of 120; pairs are a little less alike than asked, but for some."""
    base = prose(9, 120).split()
    rows = []
    for i in range(700):
        words = list(base)
        for k in (7 * i, 7 * i + 31 + i // 120) if i % 9 else (7 * i,):
            words[k % 120] = f"own{i}x{k}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((tuple(r) for r in near_duplicates(docs, percent=85).collect()), key=repr)
    assert got == brute_force(rows, 85) and 20 < len({r[2] for r in got}) < 700


def test_removal_goes_by_row(spark):
    a, b = prose(1, 40), prose(2, 40)
    rows = [(1, a), (2, a), (2, b), (3, b + " x"), (4, b), (4, b), (5, None), (5, None), (None, a), (2, b)]
    kept = drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([(1, a), (2, b), (5, None), (5, None), (None, a)], key=repr)


def test_removal_keeps_all_columns_and_one_of_each_group(spark):
    kept = drop_near_duplicates(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert [1, 2, 3, 4, 7, 9, 10, 12, 13] == sorted(i for i in ids if i is not None) and ids.count(None) == 2
    assert near_duplicates(no_docs(spark)).count() == 0 and drop_near_duplicates(no_docs(spark)).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(50, 60), (70, 60), (60, 70), (5, 5), (80, 81)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found == {**dict.fromkeys(range(1, 41), 0), 60: 50, 70: 50, 81: 80}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
