"""Country names: the fixed alias tables and the lookup expression."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The names each source uses, in lower case, and the common name of the country.
# The three sources differ (accents, hyphens), so their tables stay apart.
EMISSIONS_ALIASES = {
    "france (including monaco)": "france",
    "occupied palestinian territory": "state of palestine",
    "st. kitts and nevis": "saint kitts and nevis",
    "st. vincent & the grenadines": "saint vincent and the grenadines",
    "sao tome & principe": "sao tome and principe",
    "plurinational state of bolivia": "bolivia",
    "democratic people s republic of korea": "democratic people's republic of korea",
    "timor-leste (formerly east timor)": "timor-leste",
    "myanmar (formerly burma)": "myanmar",
    "democratic republic of the congo (formerly zaire)": "democratic republic of the congo",
    "republic of cameroon": "cameroon",
    "lao people s democratic republic": "lao people's democratic republic",
    "czech republic (czechia)": "czech republic",
    "islamic republic of iran": "iran",
    "italy (including san marino)": "italy",
    "bosnia & herzegovina": "bosnia and herzegovina",
    "libyan arab jamahiriyah": "libya",
    "antigua & barbuda": "antigua and barbuda",
}

GENERATION_ALIASES = {
    "bolivia (plurinational state of)": "bolivia",
    "cote d'ivoire": "cote d ivoire",
    "czechia": "czech republic",
    "iran (islamic republic of)": "iran",
    "north macedonia": "macedonia",
    "venezuela (bolivarian republic of)": "venezuela",
}

INVESTMENT_ALIASES = {
    "bolivia (plurinational state of)": "bolivia",
    "côte d'ivoire": "cote d ivoire",
    "czechia": "czech republic",
    "iran (islamic republic of)": "iran",
    "united kingdom of great britain and northern ireland": "united kingdom",
    "venezuela (bolivarian republic of)": "venezuela",
    "türkiye": "turkey",
    "micronesia (federated states of)": "federated states of micronesia",
    "guinea-bissau": "guinea bissau",
}

# The countries an investment report can be narrowed to.
DEVELOPED_COUNTRIES = [
    "united states", "canada", "united kingdom", "germany", "france", "japan",
    "australia", "switzerland", "sweden", "norway", "denmark", "netherlands",
    "finland", "singapore", "south korea", "new zealand", "austria", "belgium",
    "ireland", "luxembourg", "iceland", "italy", "spain", "portugal", "greece",
    "israel", "united arab emirates", "china",
]


def canonical(name: Column, aliases: Mapping[str, str]) -> Column:
    """Lower-cased name, replaced by its common name where ``aliases`` lists it.

    The aliases become a literal map inside the projection: no UDF and no join.
    """
    lowered = F.lower(name)
    if not aliases:
        return lowered
    lookup = F.create_map(*[F.lit(text) for text in chain.from_iterable(aliases.items())])
    return F.coalesce(F.try_element_at(lookup, lowered), lowered)
