"""The same questions as :mod:`leadloom.plans.queries`, in SQL for DuckDB.

Shared inputs are common table expressions; ``_with`` puts the ones a query names (and what those
name) in front of it.
"""

from __future__ import annotations

import re

from leadloom import rules as r
from leadloom.plans import bindings as b

ORACLES: dict[str, str] = {}
CTE: dict[str, str] = {}

AS_OF = "TIMESTAMP '1999-06-01 00:00:00'"


# --- text snippets -------------------------------------------------------------------------------
def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def lits(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


def pick(values, index: str) -> str:
    return f"({lits(values)})[CAST(({index}) % {len(values)} AS INT) + 1]"


def s(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def e(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), '')"


def join(x: str, sep: str = "|") -> str:
    return f"coalesce(array_to_string({x}, {lit(sep)}), '')"


def squeeze(x: str) -> str:
    return rf"trim(regexp_replace({x}, '[\s\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+', ' ', 'g'))"


def person_norm(x: str) -> str:
    return f"coalesce({squeeze(f'lower(strip_accents({x}))')}, '')"


SUFFIXES = "|".join(re.escape(w).replace("\\ ", " ").replace("\\&", "&") for w in sorted(r.LEGAL_SUFFIXES, key=len, reverse=True))


def company_norm(x: str) -> str:
    bare = rf"replace(replace(regexp_replace(lower(strip_accents({x})), '\([^)]*\)', ' ', 'g'), '.', ''), ',', ' ')"
    return f"coalesce(trim(regexp_replace({squeeze(bare)}, '(?: (?:{SUFFIXES}))+$', '')), '')"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


URL = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://([^/?#]*))?([^?#]*)"


def profile_url(x: str) -> str:
    full = f"(CASE WHEN contains({strip(x)}, '://') THEN {strip(x)} ELSE 'https://' || {strip(x)} END)"
    host = f"lower(regexp_extract({full}, '{URL}', 1))"
    host = f"(CASE WHEN {host} LIKE '%linkedin.com' THEN 'www.linkedin.com' ELSE {host} END)"
    path = f"lower(regexp_replace(regexp_extract({full}, '{URL}', 2), '/+$', ''))"
    path = f"regexp_replace({path}, '^/[a-z][a-z]/in/', '/in/')"
    return f"(CASE WHEN {x} IS NULL OR {x} = '' THEN '' ELSE 'https://' || {host} || {path} END)"


def site_label(x: str) -> str:
    t = f"lower({strip(x)})"
    body = f"(CASE WHEN contains({t}, '://') THEN regexp_extract({t}, '{URL}', 1) ELSE {t} END)"
    host = rf"regexp_replace(split_part({body}, '/', 1), '^www\.', '')"
    known = r"\.(?:" + "|".join(w.replace(".", r"\.") for w in r.TWO_PART_SUFFIXES) + ")$"
    return (
        f"(CASE WHEN {x} IS NULL OR {x} = '' THEN '' WHEN regexp_matches({host}, '{known}') "
        f"THEN string_split(regexp_replace({host}, '{known}', ''), '.')[-1] "
        f"WHEN contains({host}, '.') THEN string_split({host}, '.')[-2] ELSE {host} END)"
    )


def contact_key(url: str, name: str, own: str, company: str) -> str:
    domain = f"coalesce(nullif({own}, ''), nullif({company}, ''), '')"
    return f"(CASE WHEN {profile_url(url)} <> '' THEN {profile_url(url)} ELSE {person_norm(name)} || '|' || {site_label(domain)} END)"


def row_id(*keys: str) -> str:
    return "sha256(" + " || chr(31) || ".join(keys) + ")"


def hits(text: str, words) -> str:
    return f"list_filter({lits(words)}, lambda w: contains({text}, w))"


def has_any(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, {lit(w)})" for w in words) + ")"


def band(x: str) -> str:
    return "(CASE " + " ".join(f"WHEN {x} BETWEEN {lo} AND {hi} THEN {lit(lb)}" for lo, hi, lb, _ in r.SIZE_BANDS) + " END)"


def band_titles(x: str) -> str:
    return "(CASE " + " ".join(f"WHEN {x} BETWEEN {lo} AND {hi} THEN {lits(t)}" for lo, hi, _, t in r.SIZE_BANDS) + " END)"


def lead_title(x: str) -> str:
    return f"({band_titles(x)})[1]"


def in_scope(x: str) -> str:
    return f"coalesce(list_has_any(list_transform({x}, lambda c: lower(trim(c))), {lits(r.IN_SCOPE_COUNTRIES)}), false)"


def industry(x: str) -> str:
    return "(CASE " + " ".join(f"WHEN {x} = {lit(k)} THEN {lit(v)}" for k, v in b.INDUSTRIES.items()) + " END)"


def specialties(c: str) -> str:
    return f"(CASE WHEN {c} % 3 = 0 THEN ['Oncology', 'Rare Disease'] WHEN {c} % 3 = 1 THEN CAST([] AS VARCHAR[]) END)"


def person_name(k: str) -> str:
    return f"({pick(('Élena  Rossi', 'Sandra Müller', 'Markus Frei', 'Zoë  Ångström'), k)} || ' ' || {s(f'{k} % 50')})"


def person_url(k: str) -> str:
    return (
        f"(CASE WHEN {k} % 4 = 0 THEN 'https://www.linkedin.com/in/Person-' || {s(k)} || '/?trk=x' "
        f"WHEN {k} % 4 = 1 THEN 'http://de.linkedin.com/fr/in/person-' || {s(k)} || '/' WHEN {k} % 4 = 2 THEN '' END)"
    )


def reply_text(k: str, props: str) -> str:
    n = rf"regexp_extract({props}, '(\d+)', 1)"
    return f"""(CASE
      WHEN {k} % 8 = 0 THEN '```json' || chr(10) || '{{"decision":"Fit ","fit_score":' || {n} || ',"confidence":"High","domain":" Site' || {n} || '.COM ","reason":" fine "}}' || chr(10) || '```'
      WHEN {k} % 8 = 1 THEN 'Sure: {{"decision":"YES","fit_score":"' || {n} || '","rationale":" looks right ","reason":"owns it"}} - done'
      WHEN {k} % 8 = 2 THEN '{{"decision":"not_fit","fit_score":140,"confidence":"certain"}}'
      WHEN {k} % 8 = 3 THEN 'no object here'
      WHEN {k} % 8 = 4 THEN '{{"decision":true,"fit_score":-5,"domain":null}}'
      WHEN {k} % 8 = 5 THEN '{{"decision":"no","fit_score":"n/a","confidence":"low"}}'
      WHEN {k} % 8 = 6 THEN {props} END)"""


def span(x: str) -> str:
    """The JSON object of a reply, or null."""
    found = rf"nullif(regexp_extract({x}, '(?s)\{{.*\}}', 0), '')"
    return f"(CASE WHEN json_valid({found}) THEN {found} END)"


def field(obj: str, name: str) -> str:
    return f"json_extract_string({obj}, '$.{name}')"


def _with(sql: str) -> str:
    """Prefix the CTEs named in ``sql``, dependencies first."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in CTE:
            if name not in order and re.search(rf"\b{name}\b", text):
                need(CTE[name])
                if name not in order:
                    order.append(name)

    need(sql)
    if not order:
        return sql.strip()
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n].strip()})" for n in order) + "\n" + sql.strip()


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = _with(sql)


# --- inputs --------------------------------------------------------------------------------------
CTE["x_customers"] = f"""
SELECT c.*, n_name, r_name, {pick(b.COUNTRIES, 'n_nationkey')} AS country, n_nationkey
FROM customer c JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

CTE["x_feed"] = f"""
SELECT o AS scrape_seq,
  CASE WHEN o % 7 = 0 THEN '' WHEN o % 11 = 0 THEN NULL ELSE 'J' || {s('CASE WHEN o % 20 = 19 THEN o - 1 ELSE o END')} END AS id,
  CASE WHEN o % 77 <> 0 THEN 'L' || {s('o')} END AS linkedin_id,
  CASE WHEN o % 31 <> 0 THEN {pick(b.POSTING_TITLES, 'o')} END AS title,
  CASE WHEN c % 50 = 7 THEN 'Roché (Switzerland) AG' WHEN c % 50 = 8 THEN 'BioNTech SE' WHEN c % 50 = 9 THEN 'Novartix'
       ELSE c_name || {pick(b.NAME_FORMS, 'c')} END AS organization,
  CASE WHEN c % 50 = 11 THEN 'sanofi' WHEN c % 5 = 0 OR c % 50 = 8 THEN NULL WHEN c % 13 = 0 THEN '' ELSE 'Org-' || {s('c')} END AS linkedin_org_slug,
  CASE WHEN o % 2 = 0 THEN '' WHEN o % 3 = 0 THEN 'https://org.example/' || {s('c')} END AS organization_url,
  'https://www.linkedin.com/company/' || {s('c')} AS linkedin_org_url,
  CASE WHEN o % 17 <> 0 THEN 'https://jobs.example/' || {s('o')} END AS url,
  CASE WHEN o % 29 <> 0 THEN o_orderdate - (CASE WHEN o % 3 = 2 THEN INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END) END AS posted,
  d1.text AS description_text, o_orderstatus, c_mktsegment, n_name, r_name, country, n_nationkey, c, o,
  CASE WHEN o % 19 <> 0 THEN ['City ' || {s('o % 40')} || ', ' || country] END AS locations_derived,
  'City ' || {s('o % 40')} AS city,
  CASE WHEN o % 9 = 0 THEN NULL WHEN o % 4 = 0 THEN [country, {pick(b.COUNTRIES, 'n_nationkey + o')}] ELSE [country] END AS countries_derived,
  CASE WHEN o % 10 <> 0 THEN CAST(floor(abs(c_acctbal) / 4) AS INT) + CAST(o % 3 AS INT) END AS employees,
  d2.text AS org_description,
  coalesce(CASE WHEN o % 5 <> 0 THEN c % 40 = 3 AND o % 2 = 0 END, false) AS agency
FROM (SELECT *, o_orderkey AS o, c_custkey AS c FROM orders JOIN x_customers ON o_custkey = c_custkey)
LEFT JOIN documents d1 ON d1.doc_id = o LEFT JOIN documents d2 ON d2.doc_id = c
"""

CTE["x_typed"] = f"""
SELECT scrape_seq, coalesce(nullif(id, ''), linkedin_id) AS id, coalesce(title, '') AS title, organization, linkedin_org_slug AS slug,
  coalesce(nullif(organization_url, ''), linkedin_org_url) AS organization_url, url, posted, description_text,
  CASE o_orderstatus WHEN 'F' THEN ['FULL_TIME'] WHEN 'P' THEN ['PART_TIME', 'CONTRACTOR'] ELSE [] END AS employment_type,
  coalesce(locations_derived, []) AS locations_derived, city, r_name AS region, countries_derived[1] AS country,
  coalesce(countries_derived, []) AS countries, linkedin_id, employees, {industry('c_mktsegment')} AS industry, n_name AS headquarters,
  coalesce({specialties('c')}, []) AS specialties, org_description, agency,
  lower(coalesce(nullif(linkedin_org_slug, ''), {company_norm('organization')})) AS company_key
FROM x_feed WHERE coalesce(nullif(id, ''), linkedin_id) IS NOT NULL
"""

CTE["x_jobs"] = "SELECT * FROM x_typed QUALIFY row_number() OVER (PARTITION BY id ORDER BY scrape_seq) = 1"

CTE["x_places"] = """
SELECT company_key, list(country ORDER BY seen, pos) AS countries FROM (
  SELECT company_key, country, min(scrape_seq) AS seen, arg_min(pos, scrape_seq) AS pos
  FROM (SELECT company_key, scrape_seq, unnest(countries) AS country, unnest(range(len(countries))) AS pos FROM x_jobs)
  GROUP BY ALL) GROUP BY company_key
"""

CTE["x_cities"] = """
SELECT company_key, list(city ORDER BY seen) AS cities FROM (
  SELECT company_key, city, min(scrape_seq) AS seen FROM x_jobs GROUP BY ALL) GROUP BY company_key
"""

CTE["x_rollup"] = f"""
SELECT h.company_key, h.organization AS name, {company_norm('h.organization')} AS normalized_name, h.employees, h.industry, h.headquarters,
  h.org_description AS description, h.specialties, coalesce(p.countries, []) AS countries, coalesce(c.cities, []) AS cities,
  g.any_agency, g.n_jobs, g.first_seq
FROM (SELECT * FROM x_jobs QUALIFY row_number() OVER (PARTITION BY company_key ORDER BY coalesce(employees, 0) DESC, scrape_seq) = 1) h
JOIN (SELECT company_key, bool_or(agency) AS any_agency, count(*) AS n_jobs, min(scrape_seq) AS first_seq FROM x_jobs GROUP BY company_key) g USING (company_key)
LEFT JOIN x_places p USING (company_key) LEFT JOIN x_cities c USING (company_key)
"""


def matcher(source: str, key: str, candidates: str, clients, fuzzy: str | None) -> str:
    """First equal candidate, else the first close one. ``candidates`` is a list of structs."""
    listed = " UNION ALL ".join(f"SELECT {i} AS pos, {company_norm(lit(c))} AS norm" for i, c in enumerate(clients))
    tries = f"SELECT {key}, t.rank AS rank, t.method AS method, t.cand AS cand FROM (SELECT {key}, unnest({candidates}) AS t FROM {source})"
    close = f"""
      SELECT {key}, rank, pos, norm FROM tries, listed WHERE cand <> '' AND length(cand) >= 5 AND length(norm) >= 5 AND ({fuzzy})
      QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY rank, pos) = 1""" if fuzzy else f"SELECT {key}, 0 AS rank, 0 AS pos, '' AS norm FROM tries WHERE false"
    return f"""
      WITH listed AS (SELECT norm, min(pos) AS pos FROM ({listed}) WHERE norm <> '' GROUP BY norm),
      tries AS ({tries}),
      equal AS (SELECT {key}, method, cand FROM tries JOIN listed ON cand = norm WHERE cand <> '' QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY rank) = 1),
      close AS ({close})
      SELECT s.{key}, coalesce(equal.cand, close.norm) AS client_name,
        CASE WHEN equal.cand IS NOT NULL THEN equal.method WHEN close.norm IS NOT NULL THEN 'fuzzy' END AS match_method
      FROM (SELECT {key} FROM {source}) s LEFT JOIN equal USING ({key}) LEFT JOIN close USING ({key})"""


# Longest common subsequence by the recurrence over prefixes, one list row per character.
def lcs(a: str, c: str) -> str:
    chars_b = f"string_split({c}, '')"
    first = f"list_transform(range(length({c}) + 1), lambda z: 0)"
    row = (
        f"list_reduce(range(1, length({c}) + 1), lambda acc, j: list_append(acc, greatest(acc[-1], prev[j + 1], "
        f"CASE WHEN substr({c}, j, 1) = ch THEN prev[j] + 1 ELSE 0 END)), [0])"
    )
    return f"list_reduce(string_split({a}, ''), lambda prev, ch: {row}, {first})[-1]"


LEV = "levenshtein(cand, norm) <= 2"

CTE["x_matched"] = matcher(
    "x_rollup", "company_key",
    f"[{{'rank': 0, 'method': 'exact', 'cand': normalized_name}}, {{'rank': 1, 'method': 'slug', 'cand': {company_norm("replace(company_key, '-', ' ')")}}}]",
    r.CLIENTS, LEV,
)

CTE["x_corp"] = f"""
SELECT c_custkey AS first_seq, 'org-' || {s('c_custkey')} AS company_key, c_name || {pick(b.NAME_FORMS, 'c_custkey')} AS name,
  lower(c_name) AS normalized_name, CASE WHEN c_custkey % 23 <> 0 THEN CAST(floor(abs(c_acctbal) / 4) AS INT) END AS employees,
  {industry('c_mktsegment')} AS industry, CASE WHEN c_custkey % 4 <> 0 THEN n_name END AS headquarters, text AS description,
  coalesce({specialties('c_custkey')}, []) AS specialties, CASE WHEN c_custkey % 6 = 0 THEN CAST([] AS VARCHAR[]) ELSE [country] END AS countries,
  ['City ' || {s('c_custkey % 40')}] AS cities
FROM x_customers LEFT JOIN documents ON c_custkey = doc_id
"""

CTE["x_postings"] = f"""
SELECT 'org-' || {s('o_custkey')} AS company_key, 'J' || {s('o_orderkey')} AS job_id, o_orderkey AS job_seq, {pick(b.POSTING_TITLES, 'o_orderkey')} AS job_title
FROM orders
"""


def blob() -> str:
    return "lower(array_to_string(list_filter([nullif(industry, ''), nullif(description, ''), nullif(array_to_string(specialties, ' '), '')], lambda q: q IS NOT NULL), ' '))"


def evaluated(source: str) -> str:
    """Size rule and keyword rules over company rows."""
    tag = "[offline heuristic] "
    return f"""
    SELECT c.*, {band('employees')} AS size_band,
      CASE WHEN {band('employees')} IS NULL THEN 'not_fit' WHEN nt > 0 AND sc THEN 'fit' ELSE 'not_fit' END AS decision,
      CASE WHEN {band('employees')} IS NULL THEN coalesce({s('employees')}, 'None') || ' employees is outside the ICP 50-2000 band; dropped on size before website research.'
        WHEN nd > 0 AND nt = 0 THEN {lit(tag)} || 'LinkedIn signals a disqualified category (' || array_to_string(d, ', ') || ').'
        WHEN nt > 0 AND sc THEN {lit(tag)} || 'LinkedIn industry/specialties match ICP biotech/pharma signals (' || array_to_string(t[1:3], ', ') || '); hiring in-scope EU locations (' || coalesce(nullif(array_to_string(countries, ', '), ''), 'EU') || ').'
        WHEN nt > 0 THEN {lit(tag)} || 'Industry matches ICP but no in-scope EU/EEA/UK/CH/Norway hiring location was seen.'
        ELSE {lit(tag)} || 'LinkedIn metadata does not clearly match the ICP target industries.' END AS rationale,
      CASE WHEN {band('employees')} IS NULL THEN 'high' WHEN nd > 0 AND nt = 0 THEN 'medium' WHEN nt > 0 AND sc THEN 'medium' ELSE 'low' END AS confidence,
      CASE WHEN {band('employees')} IS NULL THEN 0 WHEN nd > 0 AND nt = 0 THEN 10 WHEN nt > 0 AND sc THEN least(90, 60 + 10 * nt) WHEN nt > 0 THEN 30 ELSE 20 END AS fit_score,
      CAST(NULL AS VARCHAR) AS domain, CASE WHEN {band('employees')} IS NULL THEN 'rule' ELSE 'offline_heuristic' END AS source
    FROM (SELECT *, len(t) AS nt, len(d) AS nd FROM (
      SELECT *, {hits('fact_text', r.TARGET_KEYWORDS)} AS t, {hits('fact_text', r.DISQUALIFIERS)} AS d, {in_scope('countries')} AS sc
      FROM (SELECT *, {blob()} AS fact_text FROM {source}))) c"""


CTE["x_judged"] = evaluated("x_corp")

VERDICT = f"company_key, {e('size_band')} AS size_band, decision, rationale, confidence, CAST(coalesce(fit_score, -1) AS BIGINT) AS fit_score, {e('domain')} AS domain, source"

CTE["x_stored"] = f"""
SELECT company_key, 'old band' AS size_band, CASE WHEN first_seq % 2 = 0 THEN 'fit' ELSE 'not_fit' END AS decision, 'stored' AS rationale, 'high' AS confidence,
  CAST(first_seq % 101 AS INT) AS fit_score, CASE WHEN first_seq % 4 = 0 THEN 'stored.example' END AS domain
FROM x_corp WHERE first_seq % 3 = 0 AND first_seq % 5 <> 0
"""

CTE["x_decided"] = f"""
SELECT j.company_key, j.name, j.employees, s.company_key IS NOT NULL AS cached,
  CASE WHEN s.company_key IS NULL THEN j.size_band ELSE s.size_band END AS size_band, coalesce(s.decision, j.decision) AS decision,
  coalesce(s.rationale, j.rationale) AS rationale, coalesce(s.confidence, j.confidence) AS confidence, coalesce(s.fit_score, j.fit_score) AS fit_score,
  s.domain AS domain, CASE WHEN s.company_key IS NULL THEN j.source ELSE 'stored' END AS source
FROM x_judged j LEFT JOIN x_stored s USING (company_key)
"""

CTE["x_targets"] = f"SELECT *, {lead_title('employees')} AS target_title FROM x_judged WHERE decision = 'fit'"

CTE["x_people"] = f"""
SELECT DISTINCT 'org-' || {s('o_custkey')} AS company_key, {person_name('l_suppkey')} AS full_name,
  CASE WHEN l_suppkey % 17 <> 0 THEN {pick(b.PERSON_TITLES, 'l_suppkey')} END AS title, {person_url('l_suppkey')} AS linkedin_url,
  'City ' || {s('l_suppkey % 40')} AS location, '' AS about_snippet,
  CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE 'www.site' || {s('l_suppkey % 9')} || '.co.uk' END AS company_domain, l_suppkey AS result_pos
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def score(title: str, titles: str) -> str:
    t, bt = f"lower(coalesce({title}, ''))", f"lower(array_to_string({titles}, ' '))"
    parts = [f"(CASE WHEN contains({t}, {lit(w)}) THEN 2 ELSE 0 END)" for w in r.RANK_LEADER_WORDS]
    parts += [f"(CASE WHEN contains({t}, {lit(w)}) AND contains({bt}, {lit(w)}) THEN 1 ELSE 0 END)" for w in r.RANK_DOMAIN_WORDS]
    return "(" + " + ".join(parts) + ")"


def best(people: str, targets: str) -> str:
    return f"""
    SELECT * FROM (SELECT p.*, t.first_seq, t.size_band, t.domain, t.target_title, {score('p.title', band_titles('t.employees'))} AS score
      FROM {people} p JOIN {targets} t USING (company_key))
    QUALIFY row_number() OVER (PARTITION BY company_key ORDER BY score DESC, result_pos) <= 2"""


def memo(source: str) -> str:
    return f"""
    SELECT *, first_value(title) OVER w AS judged_title, row_number() OVER w = 1 AS is_first
    FROM (SELECT *, coalesce(nullif(linkedin_url, ''), full_name) AS memo FROM {source})
    WINDOW w AS (PARTITION BY company_key, memo ORDER BY score DESC, result_pos)"""


CTE["x_best"] = best("x_people", "x_targets")
CTE["x_memo"] = memo("x_best")


def person_rule(title: str, size: str) -> str:
    g, t = f"coalesce({title}, '')", f"lower(coalesce({title}, ''))"
    leader, junior, talent = has_any(t, r.LEADER_WORDS), has_any(t, r.JUNIOR_WORDS), has_any(t, r.TALENT_WORDS)
    quoted = lambda tail: f"'[offline] ''' || {g} || {lit(chr(39) + ' ' + tail)}"
    return f"""(CASE WHEN {junior} AND NOT {leader} THEN {{'decision': 'no', 'reason': {quoted('is a peer/junior-level role, not the decision-maker for this requisition.')}}}
      WHEN {leader} THEN {{'decision': 'yes', 'reason': {quoted('is a function head/leader who plausibly owns this hiring decision.')}}}
      WHEN {talent} AND {size} = '50-200' THEN {{'decision': 'yes', 'reason': '[offline] Talent leader at a sub-200 company owns hiring end-to-end.'}}
      WHEN {talent} THEN {{'decision': 'no', 'reason': '[offline] Generic talent role is outranked by the functional head at this size.'}}
      ELSE {{'decision': 'no', 'reason': {quoted('does not indicate decision-maker authority.')}}} END)"""


def person_verdict(obj: str) -> str:
    yes = f"lower(trim(coalesce({field(obj, 'decision')}, ''))) IN ('yes', 'true')"
    return f"{{'decision': CASE WHEN {yes} THEN 'yes' ELSE 'no' END, 'reason': coalesce(nullif(trim({field(obj, 'reason')}), ''), 'No reason returned.')}}"


CTE["x_pairs"] = f"""
SELECT *, v.decision AS pair_decision, v.reason AS pair_reason
FROM (SELECT m.*, p.job_id, p.job_seq, {person_rule('m.judged_title', 'm.size_band')} AS v FROM x_memo m JOIN x_postings p USING (company_key))
"""

CTE["x_replied"] = f"""
SELECT * EXCLUDE (v), CASE WHEN obj IS NOT NULL THEN {person_verdict('obj')} ELSE v END AS v2
FROM (SELECT p.*, {span('reply')} AS obj FROM x_pairs p LEFT JOIN (SELECT event_id, {reply_text('event_id', 'props')} AS reply FROM events) e ON p.job_seq = e.event_id)
"""

CTE["x_links"] = f"""
SELECT DISTINCT {contact_key('linkedin_url', 'full_name', 'company_domain', 'domain')} AS dedup_key, job_id FROM x_pairs WHERE pair_decision = 'yes'
"""

# --- text ----------------------------------------------------------------------------------------
oracle("q_fold_accents", f"SELECT doc_id, md5(f) AS folded_md5, CAST(length(f) AS BIGINT) AS folded_chars FROM (SELECT doc_id, {person_norm('text')} AS f FROM documents)")
oracle("q_norm_company", f"SELECT p_partkey, {company_norm('p_name || ' + pick(b.NAME_FORMS, 'p_partkey'))} AS norm FROM part")

CTE["x_pages"] = f"""
SELECT page_id, CASE WHEN page_id % 7 = 0 THEN url WHEN page_id % 7 = 1 THEN ' ' || url || '/ ' WHEN page_id % 7 = 2 THEN 'http://de.linkedin.com/fr/in/Person-' || {s('page_id')} || '/?trk=x'
  WHEN page_id % 7 = 3 THEN 'www.LinkedIn.com/in/Person-' || {s('page_id')} || '//#top' WHEN page_id % 7 = 4 THEN regexp_replace(url, '^https?://', '')
  WHEN page_id % 7 = 5 THEN 'https://www.site' || {s('page_id')} || '.co.uk/jobs' ELSE upper(url) END AS address
FROM pages
"""
oracle("q_canonical_url", f"SELECT page_id, {profile_url('address')} AS canonical FROM x_pages")
oracle("q_root_domain", f"SELECT page_id, {site_label('address')} AS label FROM x_pages")
oracle("q_contact_key", f"""
SELECT s_suppkey, {contact_key('a', 'n', 'own', 'url')} AS dedup_key
FROM (SELECT s_suppkey, url, CASE WHEN s_suppkey % 2 = 0 THEN url END AS a, {person_name('s_suppkey')} AS n, CASE WHEN s_suppkey % 3 = 0 THEN '' END AS own
      FROM supplier LEFT JOIN pages ON s_suppkey = page_id)
""")
oracle("q_parse_ts", """
SELECT event_id, coalesce(epoch_us(CASE event_id % 6 WHEN 0 THEN ts WHEN 1 THEN ts WHEN 2 THEN ts - INTERVAL 2 HOUR WHEN 3 THEN date_trunc('day', ts) END), -1) AS micros FROM events
""")
oracle("q_csv_list", f"""
SELECT p_partkey, {join('i')} AS items, CAST(CASE WHEN len(i) > 0 THEN len(i) ELSE -1 END AS BIGINT) AS n_items, {e('i[1]')} AS first_item
FROM (SELECT p_partkey, list_filter(list_transform(string_split(t, ','), lambda q: trim(q)), lambda q: q <> '') AS i
      FROM (SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN ' , ,' ELSE ' ' || p_brand || ', ,' || CASE WHEN p_size % 2 = 0 THEN p_type ELSE '' END || ',  ' || p_name || ',' END AS t FROM part))
""")
WORDS = ("eau", "tion", "institut", "clinic", "the", "cro", "hand", "src1", "ment")
oracle("q_keyword_hits", f"""
SELECT doc_id, {join(hits('t', WORDS))} AS hits, {join(hits('t', r.TARGET_KEYWORDS))} AS targets
FROM (SELECT doc_id, lower(source || ' ' || text || ' ' || lang || ' ' || source) AS t FROM documents)
""")

# --- ingest --------------------------------------------------------------------------------------
oracle("q_typed_jobs", f"""
SELECT scrape_seq, id, title, organization, {e('slug')} AS organization_slug, organization_url, {e('url')} AS url, coalesce(epoch_us(posted), -1) AS posted_micros,
  {join('employment_type')} AS employment_type, {join('locations_derived')} AS locations_derived, {e('city')} AS city, {e('region')} AS region, {e('country')} AS country,
  {join('countries')} AS countries, {e('linkedin_id')} AS linkedin_job_id, CAST(coalesce(employees, -1) AS BIGINT) AS employees, {join('specialties')} AS specialties,
  CAST(agency AS INT) AS agency, company_key, CAST(coalesce(length(description_text), -1) AS BIGINT) AS description_chars
FROM x_typed
""")
oracle("q_dedup_first", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) = 1
""")
oracle("q_first_postings", "SELECT id, scrape_seq, company_key FROM x_jobs")
oracle("q_recency", "SELECT event_id, user_id, event_type FROM events WHERE event_id % 50 = 0 OR ts >= TIMESTAMP '2024-01-25 12:00:00' - INTERVAL 8 DAY")
oracle("q_select_source", f"""
SELECT scrape_seq, id, title, epoch_us(posted) AS posted_micros FROM x_typed
WHERE posted >= {AS_OF} - INTERVAL 6 MONTH AND NOT agency AND list_has_any(employment_type, {lits(r.EMPLOYMENT_TYPES)})
  AND {has_any('lower(title)', [t.lower() for t in r.TITLE_PHRASES])} AND len(list_filter(locations_derived, lambda l: {has_any('l', r.LOCATIONS)})) > 0
ORDER BY posted DESC, scrape_seq LIMIT 200
""")

# --- roll-up and match ---------------------------------------------------------------------------
oracle("q_company_rollup", f"""
SELECT company_key, name, normalized_name, CAST(coalesce(employees, -1) AS BIGINT) AS employees, {e('industry')} AS industry, {e('headquarters')} AS headquarters,
  CAST(coalesce(length(description), -1) AS BIGINT) AS description_chars, {join('specialties')} AS specialties, {join('countries')} AS countries, {join('cities')} AS cities,
  CAST(any_agency AS INT) AS any_agency, n_jobs, first_seq FROM x_rollup
""")
CTE["x_parts"] = f"""
SELECT p_partkey, (CASE p_partkey % 5 WHEN 1 THEN 'x' || p_name WHEN 2 THEN replace(p_name, 'i', 'e') WHEN 3 THEN substr(p_name, 1, 3) || substr(p_name, 3, 100) || 's'
    WHEN 4 THEN upper(p_name) ELSE p_name END) || {pick(b.NAME_FORMS, 'p_partkey')} AS name,
  CASE WHEN p_partkey % 4 = 0 THEN replace({pick(('red-widget', 'old-anvil', 'no-such-part', 'rod'), 'p_partkey // 4')}, ' ', '-') END AS slug,
  CASE WHEN p_partkey % 9 = 0 THEN 'https://www.rod.co.uk/x' END AS site
FROM part
"""
PART_TRIES = (
    f"[{{'rank': 0, 'method': 'exact', 'cand': {company_norm('name')}}}, {{'rank': 1, 'method': 'slug', 'cand': {company_norm("replace(slug, '-', ' ')")}}}, "
    f"{{'rank': 2, 'method': 'domain', 'cand': {site_label('site')}}}]"
)
CTE["x_parts_exact"] = matcher("x_parts", "p_partkey", PART_TRIES, b.PART_CLIENTS, None)
CTE["x_parts_fuzzy"] = matcher("x_parts", "p_partkey", PART_TRIES, b.PART_CLIENTS, LEV)
FOUND = f"p_partkey, {e('client_name')} AS client_name, {e('match_method')} AS match_method"
oracle("q_match_exact", f"SELECT {FOUND} FROM x_parts_exact")
oracle("q_match_fuzzy", f"SELECT {FOUND} FROM x_parts_fuzzy")
oracle("q_match_blocked", f"SELECT {FOUND} FROM x_parts_fuzzy")
CTE["x_long"] = f"""
SELECT p_partkey, p_name || ' ' || lower(p_type) || ' ' || {pick(('works of', 'trading house', 'supply', 'forge company works', 'transmission'), 'p_partkey')} || ' brand' AS name FROM part
"""
CLOSE_LONG = f"levenshtein(cand, norm) <= 2 OR (levenshtein(cand, norm) * 10 <= length(cand) + length(norm) AND 200 * {lcs('cand', 'norm')} >= 90 * (length(cand) + length(norm)))"
CTE["x_long_found"] = matcher("x_long", "p_partkey", f"[{{'rank': 0, 'method': 'exact', 'cand': {company_norm('name')}}}]", b.LONG_CLIENTS, CLOSE_LONG)
oracle("q_match_ratio", f"SELECT {FOUND} FROM x_long_found")
oracle("q_subsequence", f"SELECT p_partkey, CAST({lcs('p_name', 'other')} AS BIGINT) AS lcs FROM (SELECT p_partkey, p_name, lower(p_type || ' ' || p_brand) AS other FROM part)")
oracle("q_client_side_output", f"""
SELECT m.client_name, j.organization AS matched_company_name_raw, j.title AS scraped_job_title, {e('j.url')} AS scraped_job_url, coalesce(j.locations_derived[1], '') AS location,
  coalesce(epoch_us(j.posted), -1) AS posted_at, epoch_us({AS_OF}) AS detected_at
FROM x_jobs j JOIN x_matched m USING (company_key) WHERE m.client_name IS NOT NULL
""")
oracle("q_match_split", f"""
SELECT company_key, CASE WHEN client_name IS NOT NULL THEN 'client' WHEN any_agency THEN 'agency' ELSE 'evaluate' END AS branch, {e('client_name')} AS client_name, {e('match_method')} AS match_method
FROM x_matched JOIN x_rollup USING (company_key)
""")

# --- qualification -------------------------------------------------------------------------------
oracle("q_size_band", f"SELECT company_key, {e(band('employees'))} AS size_band, {e(lead_title('employees'))} AS lead_title, {join(band_titles('employees'))} AS titles FROM x_corp")
CTE["x_bands"] = "SELECT * FROM (VALUES " + ", ".join(f"({lo}, {hi}, {lit(lb)}, {lits(t)})" for lo, hi, lb, t in r.SIZE_BANDS) + ") v(low, high, size_band, titles)"
oracle("q_band_range_join", f"SELECT company_key, {e('size_band')} AS size_band, {join('titles')} AS titles FROM x_corp LEFT JOIN x_bands ON employees BETWEEN low AND high")
CTE["x_regions"] = "SELECT * FROM (VALUES " + ", ".join(f"({lit(c)}, {lit(g)})" for g, cs in r.REGIONS.items() for c in cs) + ") v(name, bucket)"
oracle("q_region_bucket", f"""
SELECT c_custkey, {e('bucket')} AS eu_region, CAST(lower(trim({pick(b.CODES, 'n_nationkey')})) IN ({', '.join(map(lit, r.IN_SCOPE_CODES))}) AS INT) AS code_in_scope,
  CAST(lower(trim(country)) IN ({', '.join(map(lit, r.IN_SCOPE_COUNTRIES))}) AS INT) AS in_scope
FROM x_customers LEFT JOIN x_regions ON lower(trim(country)) = name
""")
oracle("q_fit_rules", f"SELECT {VERDICT} FROM x_judged")

WORD = lambda f: f"lower(trim(coalesce({field('obj', f)}, '')))"
FIT = {
    "decision": f"CASE WHEN {WORD('decision')} IN ('fit', 'yes', 'true') THEN 'fit' ELSE 'not_fit' END",
    "rationale": f"coalesce(nullif(trim({field('obj', 'rationale')}), ''), 'No rationale returned.')",
    "confidence": f"CASE WHEN {WORD('confidence')} IN ('high', 'medium', 'low') THEN {WORD('confidence')} ELSE 'medium' END",
    "fit_score": f"CASE WHEN regexp_full_match({field('obj', 'fit_score')}, '-?[0-9]+') THEN greatest(0, least(100, CAST({field('obj', 'fit_score')} AS INT))) END",
    "domain": f"nullif({WORD('domain')}, '')",
}
CTE["x_replies"] = f"SELECT event_id, {span('t')} AS obj, t IS NOT NULL AS answered FROM (SELECT event_id, {reply_text('event_id', 'props')} AS t FROM events)"
CTE["x_fit_replies"] = "SELECT event_id, obj, obj IS NOT NULL AS ok, answered, " + ", ".join(f"{v} AS {k}" for k, v in FIT.items()) + \
    f", obj IS NOT NULL AND {WORD('confidence')} NOT IN ('', 'high', 'medium', 'low') AS odd FROM x_replies"
oracle("q_fit_reply", f"""
SELECT event_id, CAST(ok AS INT) AS ok, decision, rationale, confidence, CAST(coalesce(fit_score, -1) AS BIGINT) AS fit_score, {e('domain')} AS domain FROM x_fit_replies
""")
oracle("q_fit_with_replies", f"""
SELECT company_key, {e('j.size_band')} AS size_band,
  CASE WHEN u THEN f.decision ELSE j.decision END AS decision, CASE WHEN u THEN f.rationale ELSE j.rationale END AS rationale,
  CASE WHEN u THEN f.confidence WHEN j.size_band IS NOT NULL AND f.answered AND NOT f.ok THEN 'low' ELSE j.confidence END AS confidence,
  CAST(coalesce(CASE WHEN u THEN f.fit_score ELSE j.fit_score END, -1) AS BIGINT) AS fit_score, {e('CASE WHEN u THEN f.domain ELSE j.domain END')} AS domain,
  CASE WHEN u THEN 'llm_web' ELSE j.source END AS source, CAST(coalesce(j.size_band IS NOT NULL AND f.odd, false) AS INT) AS odd_confidence
FROM (SELECT *, size_band IS NOT NULL AS banded FROM x_judged) j LEFT JOIN x_fit_replies f ON j.first_seq = f.event_id
CROSS JOIN LATERAL (SELECT coalesce(j.banded AND f.ok, false) AS u)
""")
oracle("q_person_reply", f"""
SELECT event_id, CAST(obj IS NOT NULL AS INT) AS replied, v.decision AS decision, v.reason AS reason
FROM (SELECT event_id, obj, CASE WHEN obj IS NOT NULL THEN {person_verdict('obj')} ELSE {person_rule(pick(b.PERSON_TITLES, 'event_id'), "(CASE WHEN event_id % 2 = 0 THEN '50-200' ELSE '201-1000' END)")} END AS v FROM x_replies)
""")
oracle("q_verdict_cache", f"""
SELECT {VERDICT}, CAST(cached AS INT) AS cached, epoch_us(CASE WHEN cached THEN {AS_OF} ELSE TIMESTAMP '2024-02-01 00:00:00' END) AS checked_micros FROM x_decided
""")
oracle("q_audit_rows", f"""
SELECT name AS company_name, {e('domain')} AS company_domain, company_key AS linkedin_slug, {e('nullif(employees, 0)')} AS employees, {e('size_band')} AS size_band, decision,
  {e('confidence')} AS confidence, {e('fit_score')} AS fit_score, {e('rationale')} AS rationale FROM x_decided
""")
FIT_TEXT = f"""'Company: ' || name || chr(10) || 'LinkedIn industry: ' || coalesce(nullif(industry, ''), 'unknown') || chr(10) ||
  'Employees (LinkedIn, may be a LOCAL/subsidiary entity not the global group): ' || coalesce({s('nullif(employees, 0)')}, 'unknown') || chr(10) ||
  'Headquarters: ' || coalesce(nullif(headquarters, ''), 'unknown') || chr(10) || 'Specialties: ' || coalesce(nullif(array_to_string(specialties, ', '), ''), 'unknown') || chr(10) ||
  'LinkedIn description: ' || coalesce(nullif(description, ''), 'n/a') || chr(10) ||
  'Job locations seen in scrape: ' || coalesce(nullif(array_to_string(list_concat(cities, countries), ', '), ''), 'unknown') || chr(10) || chr(10) ||
  'Research this company''s website and decide ICP fit. Return the JSON object.'"""
oracle("q_fit_question", f"SELECT company_key, md5(t) AS text_md5, CAST(length(t) AS BIGINT) AS text_chars FROM (SELECT company_key, {FIT_TEXT} AS t FROM x_corp)")

# --- people and pairs ----------------------------------------------------------------------------
CTE["x_guard"] = f"SELECT company_key, CASE WHEN first_seq % 8 = 0 THEN {lead_title('employees')} ELSE 'Another Title' END AS target_title FROM x_corp WHERE first_seq % 4 = 0"
oracle("q_query_guard", """
SELECT company_key, target_title, CASE WHEN EXISTS (SELECT 1 FROM x_guard g WHERE g.company_key = t.company_key AND g.target_title = t.target_title) THEN 'skip' ELSE 'search' END AS branch
FROM x_targets t WHERE target_title IS NOT NULL
""")
S = "s_suppkey"
oracle("q_people_flatten", f"""
SELECT s_suppkey, coalesce(CASE WHEN {S} % 2 = 0 THEN {person_name(S)} END, array_to_string(list_filter([CASE WHEN {S} % 5 <> 0 THEN s_name END, 'Last'], lambda q: q IS NOT NULL), ' ')) AS full_name,
  coalesce(CASE WHEN {S} % 4 = 0 THEN {pick(b.PERSON_TITLES, S)} END, CASE WHEN {S} % 3 <> 0 THEN 'A headline' END, '') AS title, {e(person_url(S))} AS linkedin_url,
  coalesce(CASE WHEN {S} % 3 = 0 THEN 'City ' || {s(S)} || ', ' || n_name WHEN {S} % 3 = 1 THEN n_name END, '') AS location,
  coalesce(CASE WHEN {S} % 3 <> 0 THEN 'A headline' END, '') AS about_snippet, CASE WHEN {S} % 2 = 0 THEN 'w.example' ELSE 'a.example' END AS company_domain, 'prospeo' AS provider
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
oracle("q_seniority_topk", f"SELECT company_key, result_pos, full_name, {e('title')} AS title, CAST(score AS BIGINT) AS score FROM x_best")
CTE["x_few"] = "SELECT * REPLACE (CASE WHEN result_pos % 7 = 0 THEN company_key ELSE 'other ' || company_key END AS company_key) FROM x_people"
CTE["x_few_best"] = best("x_few", "x_targets")
oracle("q_query_outcomes", """
SELECT company_key, target_title, CASE WHEN n > 0 THEN 'company' ELSE '' END AS cascade_level, CASE WHEN n > 0 THEN 'prospeo' ELSE '' END AS provider,
  coalesce(n, 0) AS result_count, CASE WHEN n > 0 THEN 'hit' ELSE 'no_candidate' END AS outcome
FROM x_targets LEFT JOIN (SELECT company_key, count(*) AS n FROM x_few_best GROUP BY company_key) USING (company_key)
""")
oracle("q_pair_verdicts", "SELECT company_key, result_pos, job_id, pair_decision AS decision, pair_reason AS reason FROM x_pairs")
oracle("q_pair_replies", "SELECT company_key, result_pos, job_id, v2.decision AS decision, v2.reason AS reason FROM x_replied")
oracle("q_keep_drop", """
SELECT company_key, result_pos, CAST(bool_or(v2.decision = 'yes') AS INT) AS kept,
  coalesce(arg_min(v2.reason, job_seq) FILTER (WHERE v2.decision = 'yes'), arg_max(v2.reason, job_seq) FILTER (WHERE v2.decision = 'no')) AS reason,
  count(*) FILTER (WHERE v2.decision = 'yes') AS n_links, count(*) AS n_pairs, count(*) FILTER (WHERE is_first) AS n_validations
FROM x_replied GROUP BY company_key, result_pos
""")
oracle("q_bridge", f"""
SELECT {row_id('dedup_key')} AS contact_id, job_id, CASE WHEN right(job_id, 1) IN ('0', '2', '4', '6', '8') THEN 'old' ELSE 'new' END AS linked_at,
  CASE WHEN right(job_id, 1) IN ('0', '2', '4', '6', '8') THEN 0 ELSE 1 END AS created FROM x_links
""")
oracle("q_jobs_companies", "SELECT decision, job_title, count(*) AS n_jobs FROM x_postings JOIN x_judged USING (company_key) GROUP BY decision, job_title")
oracle("q_validation_question", f"""
SELECT job_id, result_pos, md5('SCRAPED JOB' || chr(10) || '-----------' || chr(10) || 'Title:        ' || p.job_title || chr(10) || 'Location:     ' || CASE WHEN p.job_seq % 3 <> 0 THEN 'City ' || {s('p.job_seq')} ELSE '' END || chr(10) ||
  'Company:      ' || c.name || chr(10) || 'Company size: ' || m.size_band || chr(10) || 'Description (first ~500 chars):' || chr(10) || coalesce(substr(d.text, 1, 500), '') || chr(10) || chr(10) ||
  'CANDIDATE PERSON' || chr(10) || '----------------' || chr(10) || 'Full name:     ' || m.full_name || chr(10) || 'Current title: ' || coalesce(m.title, '') || chr(10) || 'Location:      ' || m.location || chr(10) ||
  'About:         ' || m.about_snippet || chr(10) || chr(10) || 'Could this person plausibly be the hiring manager or final decision-maker for this specific role?') AS text_md5
FROM x_memo m JOIN x_postings p USING (company_key) JOIN x_corp c USING (company_key) LEFT JOIN documents d ON d.doc_id = p.job_seq
""")

# --- keyed upserts -------------------------------------------------------------------------------
JOBS_REPLACED = ("title", "organization", "organization_slug", "date_posted", "description_text", "linkedin_org_employees", "raw", "scraped_at")
JOBS_KEPT = (
    "linkedin_job_id", "organization_url", "url", "seniority", "employment_type", "locations_derived", "city", "region", "country", "linkedin_org_size",
    "linkedin_org_industry", "linkedin_org_headquarters", "linkedin_org_specialties", "linkedin_org_description", "is_recruitment_agency",
)


def order_rows(version: str, condition: str) -> str:
    texts = ", ".join(f"'{version} {c} ' || {s('o_orderkey')} AS {c}" for c in JOBS_REPLACED + JOBS_KEPT)
    return f"SELECT 'J' || {s('o_orderkey')} AS id, {texts} FROM orders WHERE {condition}"


CTE["x_old_jobs"] = order_rows("old", "o_orderkey % 3 <> 0")
CTE["x_new_jobs"] = order_rows("new", "o_orderkey % 5 <> 0 OR o_orderkey % 3 = 0")
CTE["x_merged_jobs"] = "SELECT id, " + ", ".join(
    [f"CASE WHEN nw.id IS NOT NULL THEN nw.{c} ELSE od.{c} END AS {c}" for c in JOBS_REPLACED]
    + [f"CASE WHEN od.id IS NOT NULL THEN od.{c} ELSE nw.{c} END AS {c}" for c in JOBS_KEPT]
) + ", CAST(od.id IS NULL AS INT) AS created FROM x_new_jobs nw FULL JOIN x_old_jobs od USING (id)"
oracle("q_upsert_jobs", "SELECT * FROM x_merged_jobs")
oracle("q_batch_counts", """
SELECT count(*) FILTER (WHERE o.id IS NULL) AS n_new, count(*) FILTER (WHERE o.id IS NOT NULL) AS n_seen, count(*) AS n_total FROM x_new_jobs w LEFT JOIN x_old_jobs o USING (id)
""")
oracle("q_new_ids", "SELECT id FROM x_new_jobs EXCEPT SELECT id FROM x_old_jobs")
oracle("q_rerun_noop", "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_changed, CAST(0 AS BIGINT) AS n_created FROM x_merged_jobs")
oracle("q_upsert_companies", f"""
SELECT company_key AS linkedin_slug, {row_id('company_key')} AS id, CASE WHEN nw THEN name ELSE 'old ' || name END AS name, CASE WHEN od THEN 'old norm' ELSE normalized_name END AS normalized_name,
  CASE WHEN od THEN 'old industry' ELSE {e('industry')} END AS industry,
  coalesce(CASE WHEN nw AND k % 5 = 0 THEN 'new.example' END, CASE WHEN od AND k % 2 = 0 THEN 'old.example' END, '') AS domain, decision, CAST(coalesce(fit_score, -1) AS BIGINT) AS fit_score,
  CASE WHEN nw THEN 'new' ELSE 'old' END AS checked_at, CASE WHEN nw THEN 'new' ELSE 'old' END AS updated_at, CASE WHEN od THEN 'old' ELSE 'new' END AS created_at, CAST(nw AND NOT od AS INT) AS created
FROM (SELECT *, first_seq AS k, first_seq % 3 <> 0 AS od, first_seq % 4 <> 0 OR first_seq % 3 = 0 AS nw FROM x_judged) WHERE od OR nw
""")
CONTACTS_KEPT = (
    "company_id", "full_name", "location", "id", "normalized_full_name", "linkedin_url", "about_snippet", "provider", "cascade_level", "target_title", "found_at", "created_at",
)
CONTACTS_REPLACED = ("title", "validation_reason", "validation_decision", "validated_at")
CTE["x_contact_batch"] = f"""
SELECT {contact_key(person_url('l_suppkey'), person_name('l_suppkey'), "''", "'site.example'")} AS dedup_key, {row_id(s('l_orderkey'))} AS company_id, {person_name('l_suppkey')} AS full_name,
  'line ' || {s('l_linenumber')} AS title, 'part ' || {s('l_partkey')} AS validation_reason, 'City ' || {s('l_partkey % 40')} AS location,
  {", ".join(f"'{c} ' || {s('l_orderkey')} || '/' || {s('l_linenumber')} AS {c}" for c in CONTACTS_KEPT[3:] + CONTACTS_REPLACED[2:])}, row(l_orderkey, l_linenumber, l_partkey, l_suppkey) AS pos
FROM lineitem
"""
CTE["x_contact_old"] = f"SELECT DISTINCT {contact_key(person_url('s_suppkey'), person_name('s_suppkey'), chr(39) * 2, lit('site.example'))} AS dedup_key FROM supplier WHERE s_suppkey % 3 = 0"
oracle("q_upsert_contacts", f"""
SELECT dedup_key, {", ".join(f"CASE WHEN o.dedup_key IS NOT NULL THEN 'stored {c}' ELSE n.{c} END AS {c}" for c in CONTACTS_KEPT)},
  {", ".join(f"CASE WHEN n.dedup_key IS NOT NULL THEN n.{c} ELSE 'stored {c}' END AS {c}" for c in CONTACTS_REPLACED)}, CAST(o.dedup_key IS NULL AS INT) AS created
FROM (SELECT dedup_key, {", ".join(f"arg_min({c}, pos) AS {c}" for c in CONTACTS_KEPT)}, {", ".join(f"arg_max({c}, pos) AS {c}" for c in CONTACTS_REPLACED)}
      FROM x_contact_batch GROUP BY dedup_key) n FULL JOIN x_contact_old o USING (dedup_key)
""")
oracle("q_upsert_queries", f"""
SELECT {row_id('company_key')} AS company_id, target_title, CASE WHEN od THEN 'old id' ELSE {row_id('company_key', 'target_title')} END AS id, CASE WHEN nw THEN 'prospeo' ELSE '' END AS provider,
  CAST(CASE WHEN nw THEN 2 ELSE 0 END AS BIGINT) AS result_count, CASE WHEN nw THEN 'hit' ELSE 'no_candidate' END AS outcome, CASE WHEN nw THEN 'new' ELSE 'old' END AS queried_at, CAST(nw AND NOT od AS INT) AS created
FROM (SELECT *, first_seq % 2 = 0 AS od, first_seq % 3 <> 0 OR first_seq % 2 <> 0 AS nw FROM x_targets) WHERE od OR nw
""")

# --- checks and reports --------------------------------------------------------------------------
oracle("q_checks", """
SELECT 'orders' AS table_name, 'not_null:o_orderkey' AS check_name, count(*) FILTER (WHERE o_orderkey IS NULL) AS violations FROM orders
UNION ALL SELECT 'orders', 'not_null:o_orderdate', count(*) FILTER (WHERE o_orderkey % 97 = 0) FROM orders
UNION ALL SELECT 'orders', 'domain:o_orderstatus', count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) FROM orders
UNION ALL SELECT 'orders', 'range:o_totalprice', count(*) FILTER (WHERE o_totalprice NOT BETWEEN 1000 AND 400000) FROM orders
UNION ALL SELECT 'orders', 'unique:o_orderkey', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'lineitem', 'unique:l_orderkey,l_linenumber', count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
UNION ALL SELECT 'orders', 'reference:o_custkey', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > -500)
UNION ALL SELECT 'lineitem', 'reference:l_orderkey', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
""")
oracle("q_cascade", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)")
oracle("q_table_totals", """
SELECT 'totals' AS section, 'jobs' AS metric, count(*) AS value FROM x_postings
UNION ALL SELECT 'totals', 'companies_fit', count(*) FROM x_decided WHERE decision = 'fit'
UNION ALL SELECT 'totals', 'companies_not_fit', count(*) FROM x_decided WHERE decision = 'not_fit'
UNION ALL SELECT 'totals', 'contacts', count(DISTINCT dedup_key) FROM x_links
UNION ALL SELECT 'totals', 'contact_job_links', count(*) FROM x_links
""")
CTE["x_rest"] = "SELECT u.* FROM x_rollup u JOIN x_matched m USING (company_key) WHERE m.client_name IS NULL AND NOT u.any_agency"
CTE["x_rest_judged"] = evaluated("x_rest")
CTE["x_rest_targets"] = f"SELECT *, {lead_title('employees')} AS target_title FROM x_rest_judged WHERE decision = 'fit'"
CTE["x_rest_best"] = best("x_people", "x_rest_targets")
CTE["x_met_judged"] = f"""
SELECT j.company_key, j.first_seq, j.employees, {band('j.employees')} AS size_band, s.domain, coalesce(s.decision, j.decision) AS decision, s.company_key IS NOT NULL AS cached
FROM x_rest_judged j LEFT JOIN x_stored s USING (company_key)
"""
CTE["x_met_targets"] = f"SELECT *, {lead_title('employees')} AS target_title FROM x_met_judged WHERE decision = 'fit' AND {lead_title('employees')} IS NOT NULL"
CTE["x_met_searched"] = "SELECT * FROM x_met_targets t WHERE NOT EXISTS (SELECT 1 FROM x_guard g WHERE g.company_key = t.company_key AND g.target_title = t.target_title)"
CTE["x_met_best"] = best("x_people", "x_met_searched")
CTE["x_met_memo"] = memo("x_met_best")
CTE["x_met_pairs"] = f"""
SELECT *, v.decision AS pair_decision FROM (SELECT m.*, j.id AS job_id, {person_rule('m.judged_title', 'm.size_band')} AS v FROM x_met_memo m JOIN x_jobs j USING (company_key))
"""
CTE["x_met_settled"] = f"""
SELECT company_key, result_pos, {contact_key('linkedin_url', 'full_name', 'company_domain', 'domain')} AS dedup_key, bool_or(pair_decision = 'yes') AS kept,
  count(*) FILTER (WHERE pair_decision = 'yes') AS n_links, count(*) FILTER (WHERE is_first) AS n_validations FROM x_met_pairs GROUP BY ALL
"""
FUNNEL = [
    ("scrape", "jobs_scraped", "count(*) FROM x_jobs"),
    ("exclude", "companies_to_evaluate", "count(*) FROM x_rest"),
    ("exclude", "dropped_agencies", "count(*) FROM x_rollup JOIN x_matched USING (company_key) WHERE client_name IS NULL AND any_agency"),
    ("exclude", "active_client_companies", "count(DISTINCT client_name) FROM x_matched"),
    ("exclude", "active_client_job_rows", "count(*) FROM x_jobs JOIN x_matched USING (company_key) WHERE client_name IS NOT NULL"),
    ("fit_check", "fit", "count(*) FROM x_met_judged WHERE decision = 'fit'"),
    ("fit_check", "not_fit", "count(*) FROM x_met_judged WHERE decision <> 'fit'"),
    ("fit_check", "cached", "count(*) FROM x_met_judged WHERE cached"),
    ("fit_check", "odd_confidence", "CAST(0 AS BIGINT)"),
    ("people", "hits", "count(DISTINCT company_key) FROM x_met_best"),
    ("people", "no_candidate", "count(*) FROM x_met_searched WHERE company_key NOT IN (SELECT company_key FROM x_met_best)"),
    ("people", "searches", "count(*) FROM x_met_searched"),
    ("people", "candidates_returned", "count(*) FROM x_met_best"),
    ("people", "skipped_already_queried", "count(*) FROM x_met_targets WHERE company_key NOT IN (SELECT company_key FROM x_met_searched)"),
    ("validate", "candidates_kept", "count(*) FROM x_met_settled WHERE kept"),
    ("validate", "dropped", "count(*) FROM x_met_settled WHERE NOT kept"),
    ("validate", "validations_run", "CAST(sum(n_validations) AS BIGINT) FROM x_met_settled"),
    ("validate", "job_links", "CAST(sum(n_links) AS BIGINT) FROM x_met_settled WHERE kept"),
    ("validate", "contacts_created", "count(DISTINCT dedup_key) FROM x_met_settled WHERE kept AND dedup_key NOT IN (FROM x_contact_old)"),
    ("validate", "contacts_existing", "count(*) - count(DISTINCT CASE WHEN dedup_key NOT IN (FROM x_contact_old) THEN dedup_key END) FROM x_met_settled WHERE kept"),
]
oracle("q_funnel", " UNION ALL ".join(f"SELECT '{sec}' AS section, '{m}' AS metric, {q.replace(' FROM', ' AS value FROM', 1) if ' FROM' in q else q + ' AS value'}" for sec, m, q in FUNNEL))
oracle("q_shortlist", f"""
SELECT company_key, t.name, t.size_band, t.n_jobs, CAST(t.fit_score AS BIGINT) AS fit_score, t.target_title, p.full_name, {e('p.title')} AS title, CAST(p.score AS BIGINT) AS score, p.result_pos
FROM x_rest_best p JOIN x_rest_targets t USING (company_key)
""")
