"""Keyword priorities of channels.

The first key of a table, in the order given, that is part of a channel's name applies to
it. Keywords of earlier groups rank before those of later ones, and within a group in the
order given.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exposure priorities.
EXPOSURE = {
    # direct communication
    "email": [["delivered", "delivery"], ["sent", "send"], ["open", "opens"], ["click", "clicks", "clk", "clks"]],
    "sms": [["delivered", "delivery"], ["sent", "send"], ["click", "clicks", "clk", "clks"]],
    "whatsapp": [["delivered", "delivery"], ["sent", "send"], ["read", "seen"], ["click", "clicks", "clk", "clks"]],
    "push": [["delivered", "delivery"], ["sent", "send"], ["open", "opens"], ["click", "clicks", "clk", "clks"]],
    "inapp": [["delivered", "shown", "impression"], ["click", "clicks", "clk", "clks"]],
    "notification": [["delivered", "shown"], ["open", "opens"]],
    # television and video
    "tv": [["grp", "trp"]],
    "television": [["grp", "trp"]],
    "cable": [["grp", "trp"]],
    "satellite": [["grp", "trp"]],
    "ott": [["view", "views", "complete", "completion"], ["impression", "impr"]],
    "ctv": [["view", "views"], ["impression"]],
    "connectedtv": [["view", "views"], ["impression"]],
    "youtube": [["view", "views"], ["impression"]],
    # display
    "display": [["impression", "impr", "imp"]],
    "programmatic": [["impression", "impr", "imp"]],
    "native": [["impression"]],
    "banner": [["impression"]],
    "richmedia": [["impression", "interaction"]],
    "retargeting": [["impression"], ["click", "clicks", "clk", "clks"]],
    # social media
    "social": [["reach"], ["impression", "impr"], ["engagement", "engage"]],
    "facebook": [["reach"], ["impression"], ["engagement"]],
    "instagram": [["reach"], ["impression"], ["engagement"]],
    "meta": [["reach"], ["impression"], ["engagement"]],
    "twitter": [["reach"], ["impression"], ["engagement"]],
    "x": [["reach"], ["impression"]],
    "linkedin": [["reach"], ["impression"], ["click", "clicks", "clk", "clks"]],
    "snapchat": [["reach"], ["impression"], ["view"]],
    "pinterest": [["reach"], ["impression"], ["click", "clk", "clks", "clicks"]],
    "reddit": [["impression"], ["engagement"]],
    # search
    "search": [["click", "clicks", "clk", "clks"]],
    "sem": [["click", "clicks", "clk", "clks"]],
    "ppc": [["click", "clicks", "clk", "clks"]],
    "googleads": [["click", "clicks", "clk", "clks"]],
    "bing": [["click", "clicks", "clk", "clks"]],
    "yahoo": [["click", "clicks", "clk", "clks"]],
    # retail media
    "ecom": [["click", "clicks", "clk", "clks"], ["pdp", "product", "detail"]],
    "ecommerce": [["click", "clicks", "clk", "clks"], ["pdp"]],
    "marketplace": [["click", "clk", "clks", "clicks"], ["pdp"]],
    "amazon": [["click", "clicks", "clk", "clks"], ["pdp", "detail_page", "dpv"]],
    "flipkart": [["click", "clicks", "clk", "clks"], ["pdp"]],
    "myntra": [["click", "clicks", "clk", "clks"], ["pdp"]],
    "ajio": [["click", "clicks", "clk", "clks"], ["pdp"]],
    "meesho": [["click", "clicks", "clk", "clks"], ["pdp"]],
    "swiggy": [["click", "clicks", "clk", "clks"], ["menu_view", "pdp"]],
    "zomato": [["click", "clicks", "clk", "clks"], ["menu_view"]],
    "blinkit": [["click", "clk", "clks", "clicks"], ["product_view"]],
    "instamart": [["click", "clk", "clks", "clicks"], ["product_view"]],
    "bigbasket": [["click", "clk", "clks", "clicks"], ["product_view"]],
    # print
    "print": [["circulation"], ["reach"]],
    "newspaper": [["circulation"], ["reach"]],
    "magazine": [["circulation"], ["reach"]],
    "journal": [["circulation"], ["reach"]],
    # radio and audio
    "radio": [["grp", "trp"]],
    "fm": [["grp", "trp"]],
    "audio": [["impression", "listen"]],
    "spotify": [["listen", "impression"]],
    "gaana": [["listen", "impression"]],
    "jiosaavn": [["listen", "impression"]],
    # out of home
    "ooh": [["reach"], ["footfall", "traffic"]],
    "dooh": [["reach"], ["footfall"]],
    "outdoor": [["reach"], ["footfall"]],
    "hoarding": [["reach"], ["traffic"]],
    "metro": [["footfall"], ["reach"]],
    "airport": [["footfall"], ["reach"]],
    "mall": [["footfall"], ["reach"]],
    "transit": [["footfall"], ["reach"]],
    # partners
    "influencer": [["view", "views"], ["engagement", "engage"], ["click", "clk", "clks", "clicks"]],
    "creator": [["view"], ["engagement"]],
    "affiliate": [["click", "clicks", "clk", "clks"], ["conversion"]],
    "partner": [["click", "clk", "clks", "clicks"], ["lead"]],
    # events
    "event": [["footfall", "attendance"], ["lead"]],
    "activation": [["footfall"], ["sampling"]],
    "roadshow": [["footfall"], ["lead"]],
    "expo": [["attendance"], ["lead"]],
    # telephone
    "callcenter": [["connected", "answered"], ["call", "calls"], ["lead"]],
    "telesales": [["connected"], ["conversion"]],
    "ivr": [["connected"], ["call"]],
}
EXPOSURE_DEFAULT = [["impression", "impr", "imp"], ["reach"], ["grp", "trp"], ["view", "views"], ["click", "clicks", "clk", "clks"]]

# Response priorities; a channel key without keywords keeps catalogue order.
# ``Product Detail Page`` has capitals and so never meets a name, which is compared in lower case.
RESPONSE = {
    "email": [["conversion", "purchase", "order"], ["click", "clk", "clks", "clicks"], ["open", "read"]],
    "sms": [["conversion", "order"], ["click", "clk", "clks", "clicks"]],
    "whatsapp": [["conversion"], ["click", "clk", "clks", "clicks"], ["open", "read"]],
    "tv": [],
    "radio": [],
    "print": [],
    "ooh": [],
    "display": [["conversion"], ["engagement"], ["click", "clk", "clks", "clicks"]],
    "social": [["conversion"], ["engagement"], ["click", "clk", "clks", "clicks"]],
    "facebook": [["conversion"], ["engagement"], ["click", "clk", "clks", "clicks"]],
    "instagram": [["conversion"], ["engagement"], ["click", "clk", "clks", "clicks"]],
    "search": [["conversion", "order"], ["engagement"], ["click", "clk", "clks", "clicks"]],
    "sem": [["conversion"], ["engagement"], ["click", "clk", "clks", "clicks"]],
    "amazon": [["order", "sale"], ["pdp", "product_view"]],
    "flipkart": [["order"], ["pdp"]],
    "ecommerce": [["order", "purchase"], ["pdp", "Product Detail Page"], ["engagement"], ["click", "clk", "clks", "clicks"]],
    "influencer": [["conversion"], ["engagement"], ["click", "clk", "clks", "clicks"]],
    "affiliate": [["conversion"], ["engagement"], ["click", "clk", "clks", "clicks"]],
}
RESPONSE_DEFAULT = [["order", "conversion", "sale"], ["engagement"], ["click", "clk", "clks", "clicks"], ["impression"]]

# Priorities of the global response.
GLOBAL_RESPONSE = [
    ["revenue", "sales", "sales_value", "gmv", "turnover"],
    ["qty", "quantity", "unit", "units", "volume", "sold"],
    ["order", "orders", "transaction"],
    ["conversion", "install", "lead"],
]


@dataclass(frozen=True)
class Priorities:
    keys: tuple[str, ...]
    keywords: tuple[tuple[str, ...], ...]
    default: tuple[str, ...]


def keywords(groups: list[list[str]]) -> tuple[str, ...]:
    return tuple(word for group in groups for word in group)


def ranked(table: dict[str, list[list[str]]], default: list[list[str]]) -> Priorities:
    return Priorities(tuple(table), tuple(map(keywords, table.values())), keywords(default))


PRIORITIES = {
    "exposure": ranked(EXPOSURE, EXPOSURE_DEFAULT),
    "response": ranked(RESPONSE, RESPONSE_DEFAULT),
}


def plain_channel(channel: Column) -> Column:
    return F.regexp_replace(F.lower(channel), "[^a-z0-9]", "")


def matching_key(channel: Column, role: str, longest: bool = False) -> Column:
    """Priority key of a channel, null for the default.

    The first key found in the channel's name, or with ``longest`` the longest one, so
    that ``dooh`` is not taken for ``ooh``.
    """
    keys = list(PRIORITIES[role].keys)
    if longest:
        keys.sort(key=lambda k: -len(k))
    name = plain_channel(channel)
    return F.get(F.filter(F.array(*[F.lit(k) for k in keys]), lambda k: F.contains(name, k)), F.lit(0))


def _word_array(words: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(w) for w in words]).cast("array<string>")


def channel_keywords(channel: Column, role: str, longest: bool = False) -> Column:
    """Keywords of a channel in rank order."""
    table = PRIORITIES[role]
    known = F.create_map(*[c for k, words in zip(table.keys, table.keywords) for c in (F.lit(k), _word_array(words))])
    return F.coalesce(F.try_element_at(known, matching_key(channel, role, longest)), _word_array(table.default))


def keyword_place(name: Column, words: Column) -> Column:
    """Place of the first keyword found in ``name``; after all keywords if none is."""
    places = F.transform(words, lambda w, i: F.when(F.contains(F.lower(name), w), i))
    return F.coalesce(F.array_min(places), F.size(words))
