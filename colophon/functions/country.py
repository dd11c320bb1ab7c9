"""Countries named in affiliations and file names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from colophon.functions.normalize import country_code

# Results depend on these names and their order.
COUNTRY_TERMS = {
    "US": ["united states", "united states of america", "usa", "u.s.a.", "u.s.a", "u.s.", "america"],
    "CN": ["china", "people's republic of china", "peoples republic of china", "pr china", "p.r. china", "p.r.c.", "p.r.c"],
    "JP": ["japan"],
    "DE": ["germany", "deutschland"],
    "GB": ["united kingdom", "uk", "u.k.", "u.k", "england", "scotland", "wales", "northern ireland", "great britain"],
    "FR": ["france"],
    "IT": ["italy"],
    "ES": ["spain"],
    "NL": ["netherlands", "the netherlands"],
    "CH": ["switzerland"],
    "SE": ["sweden"],
    "NO": ["norway"],
    "FI": ["finland"],
    "DK": ["denmark"],
    "BE": ["belgium"],
    "AT": ["austria"],
    "CA": ["canada"],
    "AU": ["australia"],
    "NZ": ["new zealand"],
    "IN": ["india"],
    "KR": ["south korea", "republic of korea", "korea"],
    "RU": ["russia", "russian federation"],
    "IL": ["israel"],
    "SG": ["singapore"],
    "TW": ["taiwan"],
    "BR": ["brazil"],
    "PL": ["poland"],
    "IR": ["iran", "iran, islamic republic of"],
    "IE": ["ireland"],
    "PT": ["portugal"],
    "GR": ["greece"],
    "CZ": ["czech republic", "czechia"],
    "HU": ["hungary"],
    "TR": ["turkey", "türkiye", "turkiye"],
    "MX": ["mexico"],
    "AR": ["argentina"],
    "CL": ["chile"],
    "ZA": ["south africa"],
    "HK": ["hong kong", "hong kong sar"],
}
# Files are named so, and these hold several countries.
FILE_COUNTRIES = {
    "Argentina": "AR",
    "Australia": "AU",
    "Austria": "AT",
    "Belgium": "BE",
    "Brazil": "BR",
    "Canada": "CA",
    "China": "CN",
    "Czech Republic": "CZ",
    "Denmark": "DK",
    "England": "GB",
    "Finland": "FI",
    "France": "FR",
    "Germany": "DE",
    "Hong Kong": "HK",
    "India": "IN",
    "Iran": "IR",
    "Israel": "IL",
    "Italy": "IT",
    "Japan": "JP",
    "Mexico": "MX",
    "Netherlands": "NL",
    "Norway": "NO",
    "Poland": "PL",
    "Russia": "RU",
    "Saudi Arabia": "SA",
    "Scotland": "GB",
    "Singapore": "SG",
    "South Africa": "ZA",
    "South Korea": "KR",
    "Spain": "ES",
    "Sweden": "SE",
    "Switzerland": "CH",
    "Taiwan": "TW",
    "Turkey": "TR",
    "UAE": "AE",
    "UK": "GB",
    "US": "US",
}
AGGREGATE_FILES = [
    "1 QSM-Total Publications Country Wise.xlsx",
    "Countries Quantum Sensing and Metrology - WoS.xlsx",
]


def infer_country(text: Column, terms: dict[str, list[str]] = COUNTRY_TERMS) -> Column:
    """``(status, country_code, matched_terms)`` of a text.

    Terms count where no ASCII letter or digit adjoins, in any case. One code is ``unambiguous``,
    several are ``ambiguous``, none is ``none``; null texts are ``none``.
    """
    hits = []
    for code, names in terms.items():
        for name in names:
            hit = text.rlike(rf"(?iu)(?<![A-Za-z0-9]){re.escape(name)}(?![A-Za-z0-9])")
            hits.append(F.when(hit, F.struct(F.lit(code).alias("code"), F.lit(name).alias("term"))))
    found = F.filter(F.array(*hits), lambda h: h.isNotNull())

    def judged(h: Column) -> Column:
        codes = F.array_distinct(F.transform(h, lambda x: x["code"]))
        status = F.when(F.size(codes) == 1, "unambiguous").when(F.size(codes) > 1, "ambiguous").otherwise("none")
        code = F.when(F.size(codes) == 1, country_code(F.get(codes, F.lit(0))))
        named = F.transform(h, lambda x: x["term"])
        return F.struct(status.alias("status"), code.alias("country_code"), named.alias("matched_terms"))

    return F.element_at(F.transform(F.array(found), judged), 1)


def country_of_file(path: Column) -> Column:
    """Country code of a spreadsheet named after a country; null for aggregates and unknown names."""
    name = F.element_at(F.split(path, "/"), -1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    known = F.create_map(*[F.lit(x) for pair in FILE_COUNTRIES.items() for x in pair])
    return F.when(~name.isin(AGGREGATE_FILES), country_code(F.try_element_at(known, stem)))
