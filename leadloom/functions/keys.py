"""Natural and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadloom.functions.text import bound, company_norm, filled, person_norm, profile_url, site_label


def company_key(slug: Column, organization: Column) -> Column:
    return F.lower(F.coalesce(filled(slug), company_norm(organization)))


def contact_key(url: Column, full_name: Column, own_domain: Column, company_domain: Column) -> Column:
    """Canonical profile address, else normalized name and site label."""
    domain = F.coalesce(filled(own_domain), filled(company_domain), F.lit(""))
    fallback = F.concat(person_norm(full_name), F.lit("|"), site_label(domain))
    return bound(profile_url(url), lambda u: F.when(u != "", u).otherwise(fallback))


def memo_key(url: Column, full_name: Column) -> Column:
    """Key under which verdicts on a person are remembered: the address as given, else the name."""
    return F.coalesce(filled(url), full_name)


def row_id(*natural_key: Column) -> Column:
    """Surrogate id: the same natural key has the same id on every run."""
    return F.sha2(F.concat_ws("\x1f", *natural_key), 256)
