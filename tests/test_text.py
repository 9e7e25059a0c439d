import random
import re
import unicodedata
from datetime import datetime, timezone

from pyspark.sql import functions as F

from leadloom.functions import distance, instants, keys, replies, text


def one(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["out"] for r in df.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()]


def test_company_names(spark):
    cases = {
        "Roche (Switzerland)": "roche", "Roche Diagnostics GmbH": "roche diagnostics", "BioNTech SE": "biontech",
        "Galapagos NV": "galapagos", "InflaRx N.V.": "inflarx", "ICON plc": "icon",
        "Idorsia Pharmaceuticals Ltd": "idorsia pharmaceuticals",
        "Basilea Pharmaceutica International AG": "basilea pharmaceutica",
        "Merck & Co": "merck &", "Group Holding": "group", "Foo & Co. KG": "foo", "A/S": "a/s", "": "", None: "",
    }
    assert one(spark, cases, text.company_norm) == list(cases.values())


def test_suffix_stripping_equals_the_loop(spark):
    from leadloom.rules import LEGAL_SUFFIXES

    rng = random.Random(7)
    words = [*LEGAL_SUFFIXES, "alpha", "beta", "&", "kg"]
    names = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 6))) for _ in range(800)]

    def loop(name):
        again = True
        while again:
            again = False
            for suffix in sorted(LEGAL_SUFFIXES, key=len, reverse=True):
                if name.endswith(" " + suffix):
                    name, again = name[: -len(suffix) - 1], True
                    break
        return re.sub(r"\s+", " ", name).strip()

    assert one(spark, names, text.company_norm) == [loop(n) for n in names]


def test_person_names(spark):
    assert one(spark, ["Sandra  Müller", "Élena   Rossi", " a b\t", None], text.person_norm) == ["sandra muller", "elena rossi", "a b", ""]


def test_folding_covers_all_of_unicode(spark):
    points = [p for p in range(1, 0x110000) if not 0xD800 <= p <= 0xDFFF and unicodedata.category(chr(p)) != "Cn"]
    blocks = ["".join(map(chr, points[i:i + 64])) for i in range(0, len(points), 64)] + ["á ﬁn ™ 각 \U0001F642"]
    fold = lambda s: "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))
    assert one(spark, blocks, text.fold_accents) == [fold(b) for b in blocks]


def test_profile_urls(spark):
    canonical = "https://www.linkedin.com/in/sandra-mueller"
    cases = {
        "https://www.linkedin.com/in/Sandra-Mueller/?trk=x": canonical,
        "http://de.linkedin.com/in/sandra-mueller/": canonical,
        "www.linkedin.com/de/in/sandra-mueller#x": canonical,
        "  ": "https://", "": "", None: "",
        "http://notlinkedin.com/x": "https://www.linkedin.com/x",
        "www.x.example/go?u=http://y": "https://www.x.example/go",
        "https://x.example/a b/": "https://x.example/a b",
    }
    assert one(spark, cases, text.profile_url) == list(cases.values())


def test_site_labels(spark):
    cases = {
        "https://www.biontech.de/careers": "biontech", "roche.com": "roche", "mereo.co.uk": "mereo",
        "https://jobs.mereo.co.uk:443/x": "co", "localhost": "localhost", " WWW.A.example/x ": "a", "": "", None: "",
    }
    assert one(spark, cases, text.site_label) == list(cases.values())


def test_keyword_hits_are_substrings_in_list_order(spark):
    words = ["clinic", "cro", "intern"]
    assert one(spark, ["micro clinical", "international", ""], lambda v: text.hits(v, words)) == [["clinic", "cro"], ["intern"], []]
    assert one(spark, ["micro clinic", "a cro!"], lambda v: text.hits(v, words, whole_words=True)) == [["clinic"], ["cro"]]


def test_csv_list(spark):
    assert one(spark, [" a , ,b ", " , ", None], text.csv_list) == [["a", "b"], None, None]


def test_instants(spark):
    values = [
        "2026-05-21T13:55:58+00:00", "2026-05-21T13:55:58Z", "2026-05-21", "2026", "2026-05-21 13:55", "20260521T135558Z",
        "2026-05-21T13:55:58.123456+0200", "2026-05-21T13", "2026-05-21T13:55:58,5", "2026-13-01", "x", "", None, "20260521",
        "2026-05-21T25:00:00", "20260521T135558.25+01:30", "2026-05-21T13:55:58-05",
    ]

    def expected(v):
        try:
            d = datetime.fromisoformat(v.replace("Z", "+00:00")) if v else None
        except ValueError:
            d = None
        if d is None:
            return None
        d = d if d.tzinfo else d.replace(tzinfo=timezone.utc)
        return round((d - datetime(1970, 1, 1, tzinfo=timezone.utc)).total_seconds() * 1_000_000)

    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert one(spark, values, lambda v: instants.epoch_micros(instants.iso_instant(v))) == [expected(v) for v in values]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_contact_key_prefers_the_profile(spark):
    df = spark.createDataFrame([("http://de.linkedin.com/in/A/", "A", "x.com"), (None, "Zoë  Ä", "www.site.co.uk"), ("", "B", None)], "u string, n string, d string")
    got = [r[0] for r in df.select(keys.contact_key(F.col("u"), F.col("n"), F.col("d"), F.lit("own.example"))).collect()]
    assert got == ["https://www.linkedin.com/in/a", "zoe a|site", "b|own"]


def test_fit_replies(spark):
    values = [
        '```json\n{"decision":"FIT ","fit_score":140,"confidence":"High","domain":" A.com ","rationale":"ok"}\n```',
        'Sure! {"decision":"yes","fit_score":"n/a"} bye', '{"decision":true,"fit_score":93.9,"rationale":null,"confidence":"certain"}',
        "none", "[1]", '{"fit_score":"-3","domain":null}', '{"fit_score":"93.5","domain":0}', None, '"{\\"decision\\": \\"fit\\"}"',
    ]
    got = [tuple(r) for r in one(spark, values, replies.fit_reply)]
    none = "No rationale returned."
    failed = (False, "not_fit", none, "medium", None, None, False)
    assert got == [
        (True, "fit", "ok", "high", 100, "a.com", False), (True, "fit", none, "medium", None, None, False),
        (True, "fit", "None", "medium", 93, None, True), failed, failed, (True, "not_fit", none, "medium", 0, None, False),
        (True, "not_fit", none, "medium", None, None, False), failed, failed,
    ]


def test_person_replies(spark):
    got = one(spark, ['x {"decision":"Yes","reason":" owns it "} y', '{"decision":1}', "no"], replies.person_reply)
    assert [tuple(r) for r in got] == [(True, "yes", "owns it"), (True, "no", "No reason returned."), (False, "no", "No reason returned.")]


def _lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(max(new[-1], row[j], row[j - 1] + 1 if x == y else 0))
        row = new
    return row[-1]


def close(a, b, edits=2, ratio=90):
    total = len(a) + len(b)
    return _lev(a, b) <= edits or 200 * _lcs(a, b) >= ratio * total


def mutated(rng, text, most=6):
    chars = list(text)
    for _ in range(rng.randint(0, most)):
        roll = rng.random()
        if chars and roll < 0.33:
            chars.pop(rng.randrange(len(chars)))
        elif chars and roll < 0.66:
            chars[rng.randrange(len(chars))] = rng.choice("abc")
        else:
            chars.insert(rng.randint(0, len(chars)), rng.choice("abc"))
    return "".join(chars)


def test_distances_against_brute_force(spark):
    rng = random.Random(1)
    pairs = []
    for _ in range(1500):
        a = "".join(rng.choice("abcde ") for _ in range(rng.randint(0, 45)))
        pairs.append((a, mutated(rng, a)))
    a, b = F.col("a"), F.col("b")
    df = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", distance.common_subsequence(a, b).alias("lcs"), distance.is_close(a, b, 2, 90).alias("close"), distance.edits_within(a, b, 2).alias("near"))
    for r in df.collect():
        assert (r.lcs, r.close, r.near) == (_lcs(r.a, r.b), close(r.a, r.b), _lev(r.a, r.b) <= 2), (r.a, r.b)


def test_subsequence_over_limb_borders(spark):
    rng = random.Random(2)
    pairs = [(None, "a"), ("a", None), ("", ""), ("", "ab"), ("ab", "")]
    for n in (1, 61, 62, 63, 64, 123, 124, 125, 186, 187, 260):
        for letters in ("ab", "abcdefgh", "äß漢😀\n x"):
            draw = lambda size, more="": "".join(rng.choice(letters + more) for _ in range(size))
            pairs += [(draw(n), draw(n, "z")), (draw(n), draw(rng.randint(0, 250), "z")), (draw(n), "z" * 70)]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", distance.common_subsequence(F.col("a"), F.col("b")).alias("lcs"))
    for r in df.collect():
        assert r.lcs == (None if r.a is None or r.b is None else _lcs(r.a, r.b)), (r.a, r.b)


def test_long_texts_with_characters_that_fold_to_several(spark):
    long = "plain words " * 20_000 + "… ™ ﬁ 한국 é ½ " * 50
    want = "".join(c for c in unicodedata.normalize("NFKD", long) if not unicodedata.combining(c))
    assert one(spark, [long], text.fold_accents) == [want]
