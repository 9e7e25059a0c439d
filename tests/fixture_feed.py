"""A hand-written feed of 22 invented postings and its people results.

7 postings of three clients, 1 agency posting, 14 companies with one posting each, of which one has
2,500 employees and 13 fit.
"""

import json

CLIENTS = [
    ("c1", "BioNTech SE", "biontech"), ("c2", "BioNTech SE", "biontech"), ("c3", "BioNTech SE", "biontech"),
    ("c4", "Roche (Switzerland)", "roche"), ("c5", "Roche (Switzerland)", "roche"),
    ("c6", "ICON plc", "icon-plc"), ("c7", "ICON plc", "icon-plc"),
]
NAMES = [
    "Alpenrind Therapeutics", "Blaumeise Biotech", "Cormoran Pharma", "Dunlin Oncology", "Egret Gene Therapy",
    "Fulmar Clinical", "Gannet Biologics", "Heron Research", "Ibis Immunotherapy", "Jackdaw Drug Discovery",
    "Kestrel Rare Disease", "Lapwing Pharma", "Merlin Biotech", "Nightjar Laboratories",
]


def _record(key, title, organization, slug, employees, industry, country, **more):
    record = {
        "id": key, "linkedin_id": f"L{key}", "title": title, "organization": organization, "linkedin_org_slug": slug,
        "url": f"https://jobs.example/{key}", "date_posted": "2026-05-20T08:00:00+00:00",
        "description_text": f"{title} at {organization}", "seniority": "Mid", "employment_type": ["FULL_TIME"],
        "locations_derived": [f"Town, {country}"], "cities_derived": ["Town"], "regions_derived": ["Region"],
        "countries_derived": [country], "linkedin_org_employees": employees, "linkedin_org_industry": industry,
        "linkedin_org_specialties": ["Pharmaceuticals"], "linkedin_org_description": "", "extra_field": {"kept": True},
    }
    return record | more


def records():
    out = [_record(k, "Clinical Trial Manager", org, slug, 9000, "Pharma", "Germany") for k, org, slug in CLIENTS]
    out.append(_record("a1", "Medical Science Liaison", "Talentbruecke", "talentbruecke", 120, "Staffing", "Germany",
                       linkedin_org_recruitment_agency_derived=True))
    for i, name in enumerate(NAMES):
        out.append(_record(f"j{i}", "Regulatory Affairs Manager", name, f"org-{i}", 2500 if i == 13 else 60 + 90 * i, "Biotechnology", "Germany"))
    return out


def people():
    """One head per company, next to a junior and the nested form's odd spots."""
    docs = []
    for i in range(len(NAMES)):
        results = [
            {"person": {"first_name": "Ana", "last_name": f"Beispiel{i}", "current_job_title": "Head of Talent",
                        "linkedin_url": f"http://de.linkedin.com/in/ana-beispiel-{i}/", "email": "x@y.example",
                        "location": {"city": "Town", "state": "", "country": "Germany"}},
             "company": {"domain": "", "website": f"www.org{i}.example"}},
        ]
        docs.append({"company_key": f"org-{i}", "results": results})
    return docs


def write_lines(path, rows):
    path.write_text("\n".join(json.dumps(r) for r in rows), encoding="utf-8")
    return str(path)
