"""URL and company-name expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerlens.constants import (
    ATS_HOSTS,
    CAREER_IGNORED_EXTENSIONS,
    CAREER_KEYWORDS,
    CAREER_PATHS,
    DIRECTORY_EXCLUDED_DOMAINS,
    DIRECTORY_IGNORED_EXTENSIONS,
)
from offerlens.functions.text import (
    blank_to_null,
    collapse_space,
    let,
    remove_diacritics,
    trim_space,
)

_HOST = r"^(?i)[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def normalize_company_name(name: Column) -> Column:
    folded = collapse_space(let(F.lower(trim_space(name)), remove_diacritics))
    bare = F.regexp_replace(folded, r"[,\s]+(s\.?\s?l\.?|s\.?\s?l\.?\s?u\.?|s\.?\s?a\.?)$", "")
    return trim_space(bare)


def url_host(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(trim_space(url), _HOST, 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)


def is_absolute_url(url: Column) -> Column:
    return F.coalesce(trim_space(url).rlike(r"^(?i)(https?://[^/?#\s]+|(?!https?:)[a-z][a-z0-9+.-]*:.)"),
                      F.lit(False))


def website_domain(url: Column) -> Column:
    host = F.regexp_replace(url_host(url), r"^www\.", "")
    return F.when(F.contains(host, F.lit(".")), host)


def pick_website(*candidates: Column) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in candidates])


def normalize_website_url(url: Column) -> Column:
    text = trim_space(url)
    full = F.when(text.rlike("^(?i)https?://"), text).otherwise(F.concat(F.lit("https://"), text))
    # scheme and host are lower-cased, a path keeps its case
    rest = F.regexp_replace(full, "^(?i)https?://[^/?#]*", "")
    site = F.lower(F.regexp_extract(full, "^(?i)https?://([^/?#]*)", 1))
    return F.when(url_host(full).isNotNull(),
                  F.regexp_replace(F.concat(F.lit("https://"), site, rest), "/$", ""))


def candidate_urls(base: Column) -> Column:
    urls = F.array(base, *[F.concat(base, F.lit(p)) for p in CAREER_PATHS])
    return F.array_distinct(urls)


def _without_dots(path: Column) -> Column:
    """A rooted path without its ``.`` and ``..`` segments; what leads above the root stays there."""
    parts = F.split(path, "/")
    folded = F.aggregate(
        F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), F.array().cast("array<string>"),
        lambda done, part: F.when(F.lower(part).isin(".", "%2e"), done)
        .when(F.lower(part).isin("..", ".%2e", "%2e.", "%2e%2e"), F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(part))))
    # a path that ends in a dot segment ends in a slash
    closed = F.when(path.rlike(r"(?i)/(\.|%2e){1,2}$"), F.concat(folded, F.array(F.lit("")))).otherwise(folded)
    return F.concat(F.lit("/"), F.array_join(closed, "/"))


_AUTHORITY = r"^(?i)(https?)://([^/?#]*)"
_DOTS = r"(?i)/(\.|%2e){1,2}(/|$)"
#: What normalize_url changes: letters of scheme or host, a port, dot segments.
_UNSETTLED = r"^(?:[a-z]*[A-Z]|https?://[^/?#]*[A-Z:]|[^?#]*/(?:\.|%2[eE]){1,2}(?:[/?#]|$))"


def _normalized(url: Column) -> Column:
    scheme = F.lower(F.regexp_extract(url, _AUTHORITY, 1))
    place = F.regexp_extract(url, _AUTHORITY, 2)
    user, host = F.regexp_extract(place, "^(.*@)?", 0), F.lower(F.regexp_replace(place, "^.*@", ""))
    port = F.regexp_replace(host, F.when(scheme == "http", ":0*80$|:$").otherwise(":0*443$|:$"), F.lit(""))
    rest = F.regexp_replace(url, _AUTHORITY, "")
    path = F.regexp_extract(rest, "^[^?#]*", 0)
    clean = F.when(path.rlike(_DOTS), let(path, _without_dots)).otherwise(path)
    return F.concat(scheme, F.lit("://"), user, port, clean, F.regexp_extract(rest, "[?#].*$", 0))


def normalize_url(url: Column) -> Column:
    """An http(s) URL with scheme and host in lower case, without a default port and dot segments; others as they are."""
    return let(url, lambda u: F.when(u.rlike(_UNSETTLED) & u.rlike(_AUTHORITY), _normalized(u)).otherwise(u))


def resolve_url(href: Column, base: Column) -> Column:
    """Absolute form of a link on a page: absolute, scheme-relative, rooted, relative, query only, fragment only or empty.

    Dot segments, default ports and the case of scheme and host are settled as browsers do; hosts are not turned to punycode.
    """
    plain = F.regexp_replace(base, "#.*$", "")
    path = F.regexp_extract(plain, r"^[^?]*", 0)
    origin = F.regexp_extract(path, r"^([^:/?#]+://[^/?#]*)", 1)
    folder = F.regexp_extract(path, r"^([^:/?#]+://[^/?#]*(?:/[^?#]*/)?)", 1)
    folder = F.when(F.endswith(folder, F.lit("/")), folder).otherwise(F.concat(folder, F.lit("/")))
    return normalize_url(let(trim_space(href), lambda link: (
        F.when(link == "", plain)
        .when(link.rlike(r"^(?i)[a-z][a-z0-9+.-]*:"), link)
        .when(F.startswith(link, F.lit("//")), F.concat(F.regexp_extract(base, r"^([^:/?#]+:)", 1), link))
        .when(F.startswith(link, F.lit("/")), F.concat(origin, link))
        .when(F.startswith(link, F.lit("#")), F.concat(plain, link))
        .when(F.startswith(link, F.lit("?")), F.concat(path, link))
        .otherwise(F.concat(folder, link)))))


def canonical_detail_url(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"/+$", "")


def _ends_with_any(text: Column, endings: tuple[str, ...]) -> Column:
    return text.rlike("(" + "|".join(re.escape(e) for e in endings) + ")$")


def is_excluded_url(url: Column, base_domain: Column, longest: int | None = None) -> Column:
    """``longest`` excludes longer URLs; by default length does not matter."""
    domain = website_domain(url)
    return (
        _too_long(url, longest)
        | _ends_with_any(F.lower(url), DIRECTORY_IGNORED_EXTENSIONS)
        | ~url.rlike("^(https?://|/)")
        | domain.isNull() | (domain == base_domain) | domain.isin(*DIRECTORY_EXCLUDED_DOMAINS)
    )


def _too_long(url: Column, longest: int | None) -> Column:
    return F.lit(False) if longest is None else F.length(url) > longest


def is_career_link(href: Column, url: Column, base_host: Column, longest: int | None = None) -> Column:
    host = url_host(url)
    return (
        (trim_space(href) != "") & ~href.rlike("^(mailto:|tel:|javascript:|#)")
        & ~_too_long(url, longest)
        & (host.eqNullSafe(base_host) | host.isin(*ATS_HOSTS))
        & ~_ends_with_any(F.lower(url_path(url)), CAREER_IGNORED_EXTENSIONS)
        & F.lower(url).rlike("|".join(CAREER_KEYWORDS))
    )
