"""Host names and link resolution for landed pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_AUTHORITY = r"(?s)^//([^/?#]*)"
_ORIGIN = r"^(https?://[^/?#\x00-\x20]+)"
_ROOT_RELATIVE = r"^/(?!/)[^?#\x00-\x20]*+(?:\?[^#\x00-\x20]++)?+(?:#[^\x00-\x20]++)?+$"
_DOT_SEGMENT = r"(?s)(?:^|/)\.\.?(?:/|$)"


def host_of(url: Column) -> Column:
    """Lower-case host without port or user; empty when the text has none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def host_suffixes(host: Column) -> Column:
    """The host and its parent domains, longest first: a.b.com, b.com, com."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda start: F.array_join(F.slice(labels, start, F.size(labels)), "."),
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` over a value that is computed once; keeps a large expression from repeating its inputs."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _parts(url: Column) -> Column:
    """Scheme, authority, path, query and fragment as a struct; a part that is absent is empty."""
    text = F.regexp_replace(url, r"^[\x00-\x20]+|[\t\r\n]+|[\x00-\x20]+$", "")

    def split(stripped: Column) -> Column:
        rest = F.regexp_replace(stripped, _SCHEME, "")
        local = F.regexp_replace(rest, _AUTHORITY, "")
        return F.struct(
            F.lower(F.regexp_extract(stripped, _SCHEME, 1)).alias("scheme"),
            F.regexp_extract(rest, _AUTHORITY, 1).alias("authority"),
            F.regexp_extract(local, r"(?s)^([^?#]*)", 1).alias("path"),
            F.regexp_extract(local, r"(?s)^[^?#]*\?([^#]*)", 1).alias("query"),
            F.regexp_extract(local, r"(?s)^[^#]*#(.*)$", 1).alias("fragment"),
        )

    return _let(text, split)


def _without_dots(path: Column) -> Column:
    segments = F.split(path, "/")
    empty = F.array().cast("array<string>")
    kept = F.aggregate(
        segments,
        empty,
        lambda done, segment: F.when(segment == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when(segment == ".", done)
        .otherwise(F.concat(done, F.array(segment))),
    )
    ends_in_dots = F.element_at(segments, -1).isin(".", "..")
    return F.array_join(F.when(ends_in_dots, F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")


def _assembled(scheme: Column, authority: Column, path: Column, query: Column, fragment: Column) -> Column:
    rooted = F.when((path == "") | path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
    return F.concat(
        scheme,
        F.lit("://"),
        authority,
        rooted,
        F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)),
        F.when(fragment == "", "").otherwise(F.concat(F.lit("#"), fragment)),
    )


def _resolved_path(page_path: Column, path: Column) -> Column:
    directory = F.regexp_replace(page_path, r"[^/]*$", "")
    relative = F.regexp_replace(F.concat(directory, F.lit("/"), path), r"/{2,}", "/")
    merged = F.when(path.startswith("/"), path).otherwise(relative)
    plain = _let(merged, lambda joined: F.when(joined.rlike(_DOT_SEGMENT), _without_dots(joined)).otherwise(joined))
    return F.coalesce(F.nullif(plain, F.lit("")), F.lit("/"))


def _resolved(pair: Column, link: Column) -> Column:
    page, ref = pair["page"], pair["ref"]
    same_scheme = (ref["scheme"] == "") | (ref["scheme"] == page["scheme"])
    path = _resolved_path(page["path"], ref["path"])
    query = F.coalesce(F.nullif(ref["query"], F.lit("")), page["query"])
    return (
        F.when(~page["scheme"].isin("http", "https") | ~same_scheme, link)
        .when(
            ref["authority"] != "",
            _assembled(page["scheme"], ref["authority"], ref["path"], ref["query"], ref["fragment"]),
        )
        .when(
            ref["path"] == "", _assembled(page["scheme"], page["authority"], page["path"], query, ref["fragment"])
        )
        .otherwise(_assembled(page["scheme"], page["authority"], path, ref["query"], ref["fragment"]))
    )


def resolve_link(base: Column, link: Column) -> Column:
    """Resolve a link found on an http(s) page against the page's address; an empty link stays empty.

    Reference resolution as in RFC 3986, written as one JVM expression. Root-relative links without dot segments,
    nearly all of those on real pages, only get the page's origin put before them; the general case is evaluated for
    the others. A link of another scheme is returned as it is.
    """
    origin = F.regexp_extract(base, _ORIGIN, 1)
    pair = F.struct(_parts(base).alias("page"), _parts(link).alias("ref"))
    return (
        F.when(link == "", F.lit(""))
        .when((origin != "") & link.rlike(_ROOT_RELATIVE) & ~link.contains("/."), F.concat(origin, link))
        .otherwise(_let(pair, lambda both: _resolved(both, link)))
    )
