"""Outlet names: one slug, display name and platform from a URL host or a free-text label."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfold.functions.binding import bind
from newsfold.functions.text import JS_SPACE, literal_map, trim_whitespace

# Fixed values: (slug, display name, platform), hosts and label spellings of the listed outlets,
# and the outlet of records that name none.
OUTLETS = [
    ("thestar", "The Star", "news"),
    ("nst", "New Straits Times", "news"),
    ("malaysiakini", "Malaysiakini", "news"),
    ("bernama", "Bernama", "news"),
    ("twitter", "Twitter / X", "twitter"),
    ("facebook", "Facebook", "facebook"),
    ("instagram", "Instagram", "instagram"),
]
HOSTS = {
    "thestar.com.my": "thestar",
    "nst.com.my": "nst",
    "malaysiakini.com": "malaysiakini",
    "bernama.com": "bernama",
    "twitter.com": "twitter",
    "x.com": "twitter",
    "facebook.com": "facebook",
    "instagram.com": "instagram",
}
LABELS = {
    "the star": "thestar",
    "thestar": "thestar",
    "new straits times": "nst",
    "nst": "nst",
    "malaysiakini": "malaysiakini",
    "malaysia kini": "malaysiakini",
    "bernama": "bernama",
    "twitter": "twitter",
    "x": "twitter",
    "facebook": "facebook",
    "fb": "facebook",
    "instagram": "instagram",
    "ig": "instagram",
}
UNKNOWN_SLUG = "unknown"
UNKNOWN_NAME = "Tidak diketahui"
OTHER_PLATFORM = "other"
PLATFORMS = ("news", "twitter", "facebook", "instagram", "other")


@dataclass(frozen=True)
class Directory:
    """A fixed, hand-kept list of outlets; small enough to be part of the plan."""

    outlets: tuple[tuple[str, str, str], ...]
    hosts: dict[str, str]
    labels: dict[str, str]

    def __post_init__(self):
        wrong = sorted({platform for _, _, platform in self.outlets} - set(PLATFORMS))
        if wrong:
            raise ValueError(f"unknown platforms: {', '.join(wrong)}")

    def names(self) -> Column:
        return literal_map({slug: name for slug, name, _ in self.outlets})

    def platforms(self) -> Column:
        return literal_map({slug: platform for slug, _, platform in self.outlets})


LISTED = Directory(tuple(OUTLETS), HOSTS, LABELS)


def simple_label(label: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(label), "[^a-z0-9]+", " "))


def outlet_of_host(host: Column, hosts: dict[str, str]) -> Column:
    """Slug of the listed host that ``host`` equals or is a subdomain of.

    One map lookup per distinct depth of the listed hosts, so there is no suffix comparison
    against every entry.
    """
    depths = sorted({known.count(".") + 1 for known in hosts}, reverse=True)
    table = literal_map(hosts)
    return bind(
        host,
        lambda h: F.coalesce(*[F.try_element_at(table, F.substring_index(h, ".", -depth)) for depth in depths]),
    )


def with_outlet(df: DataFrame, label: str, host: str, directory: Directory = LISTED) -> DataFrame:
    """Add ``source_slug``, ``display_name`` and ``platform``; ``label`` is null unless it was text.

    The host decides, then the listed spelling of the label, then the label itself.
    """
    simple, slug = F.col("simple_label"), F.col("source_slug")
    by_label = F.try_element_at(literal_map(directory.labels), simple)
    own_name = F.when(simple != "", F.regexp_replace(trim_whitespace(F.col(label)), rf"[{JS_SPACE}]+", " "))
    own_slug = F.nullif(F.replace(simple, F.lit(" "), F.lit("-")), F.lit(""))
    listed_name = F.try_element_at(directory.names(), slug)
    return (
        df.withColumn("simple_label", simple_label(F.col(label)))
        .withColumn("source_slug", F.coalesce(outlet_of_host(F.col(host), directory.hosts), by_label))
        .withColumn("display_name", F.coalesce(listed_name, own_name, F.lit(UNKNOWN_NAME)))
        .withColumn("platform", F.coalesce(F.try_element_at(directory.platforms(), slug), F.lit(OTHER_PLATFORM)))
        .withColumn("source_slug", F.coalesce(slug, own_slug, F.lit(UNKNOWN_SLUG)))
        .drop("simple_label")
    )
