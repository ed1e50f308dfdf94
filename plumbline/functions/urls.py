"""Hosts, sites and the rules by which an image is refused."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: suffixes under which a site has one label more
SECOND_LEVEL = ("co", "com", "org")


def host(url: Column) -> Column:
    h = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.regexp_replace(h, r"^www\.", "")


def host_in(url: Column, hosts: list[str]) -> Column:
    """Whether the host is one of hosts or under one."""
    h = host(url)
    out = F.lit(False)
    for x in hosts:
        out = out | (h == x) | F.endswith(h, F.lit("." + x))
    return F.coalesce(out, F.lit(False))


def site(url: Column) -> Column:
    """The last two labels of the host, three under a second-level suffix."""
    h = host(url)
    three = F.regexp_extract(h, r"([^.]+\.(?:" + "|".join(SECOND_LEVEL) + r")\.[^.]+)$", 1)
    return F.when(three != "", three).otherwise(F.regexp_extract(h, r"([^.]+\.[^.]+)$", 1))


def stem(url: Column) -> Column:
    """The last part of the path without its ending."""
    path = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"\.[^.]*$", "")


def is_local(url: Column, folder: str = "posters") -> Column:
    """A picture stored beside the page."""
    return F.rlike(url, F.lit(rf"(?i)^{folder}/[A-Za-z0-9][A-Za-z0-9_.-]*\.(?:jpe?g|png|webp|gif|avif)$")) & ~F.contains(url, F.lit(".."))


def safe_image(url: Column) -> Column:
    """The value that an image element may load, else null."""
    u = F.trim(url)
    data = F.rlike(u, F.lit(r"(?i)^data:image/(png|jpe?g|gif|webp|avif|svg\+xml)[;,]"))
    scheme, web = F.rlike(u, F.lit(r"(?i)^[a-z][a-z0-9+.-]*:")), F.rlike(u, F.lit(r"(?i)^https?://"))
    plain = F.rlike(u, F.lit(r"^[A-Za-z0-9_/.%-]+$")) & ~F.startswith(u, F.lit("//"))
    return F.when(data | web | (~scheme & plain), u)


def reject_reason(url: Column, distrusted: list[str], placeholder: str, opaque: str, trusted: list[str] | None = None, logo: str | None = None, mirrored: Column | None = None, known: Column | None = None) -> Column:
    """Why an image may not be stored, the first reason; null if it may.

    A picture of our own folder is judged by its id alone.  mirrored: the film that the id is a
    screening of.  known: whether the catalogue has the id.
    """
    own = is_local(url)
    word = F.rlike(stem(url), F.lit(r"\p{L}{4,}"))
    remote = (
        F.when(~url.startswith("https://"), "not https").when(host(url) == "", "no host").when(host_in(url, distrusted), "distrusted host")
        .when(~host_in(url, trusted or []) & F.rlike(stem(url), F.lit(opaque)) & ~word, "opaque name")
    )
    if logo:
        remote = remote.when(F.rlike(stem(url), F.lit(logo)), "logo")
    remote = remote.when(F.rlike(F.lower(url), F.lit(placeholder)), "placeholder")
    why = F.when(F.coalesce(url, F.lit("")) == "", "empty value")
    reason = F.coalesce(why, F.when(~F.coalesce(own, F.lit(False)), remote))
    if mirrored is not None:
        reason = F.coalesce(reason, F.when(mirrored.isNotNull(), "screening of a catalogued film"))
    if known is not None:
        reason = F.coalesce(reason, F.when(~F.coalesce(known, F.lit(False)), "unknown id"))
    return reason
