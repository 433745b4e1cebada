"""URL parsing and canonical forms as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as c
from .text import col, strip

_ABSOLUTE = "^[A-Za-z][A-Za-z0-9+.-]*:"


def scheme(url) -> Column:
    return F.lower(F.regexp_extract(col(url), "^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def netloc(url) -> Column:
    return F.regexp_extract(col(url), "^[^:/?#]+://([^/?#]*)", 1)


def host(url) -> Column:
    """Lower-case host without user and port."""
    return F.lower(F.regexp_replace(F.regexp_replace(netloc(url), "^.*@", ""), ":[0-9]*$", ""))


def path(url) -> Column:
    return F.regexp_extract(col(url), "^[^:/?#]+://[^/?#]*([^?#]*)", 1)


def query(url) -> Column:
    return F.regexp_extract(col(url), r"^[^?#]*\?([^#]*)", 1)


def base_domain(url) -> Column:
    """Last two labels of the host."""
    return F.substring_index(host(url), ".", -2)


def domain_key(url) -> Column:
    """Lower-case host with port, the key of crawl state."""
    return F.lower(netloc(url))


def link_form(url) -> Column:
    """Scheme, host and path with a slash at the end; nothing is lower-cased."""
    p = path(url)
    return F.concat(scheme(url), F.lit("://"), netloc(url), p, F.when(p.endswith("/"), "").otherwise("/"))


def file_slug(url) -> Column:
    return F.translate(F.regexp_replace(F.regexp_replace(col(url), "https?://", ""), "^/+|/+$", ""), "./", "__")


def seed(raw) -> Column:
    """struct<url, error> of a typed-in domain; one of the two is null."""
    text = strip(F.coalesce(col(raw), F.lit("")))
    full = F.when(text.startswith("http://") | text.startswith("https://"), text).otherwise(F.concat(F.lit("https://"), text))
    h, p = host(full), path(full)
    dots = F.length(h) - F.length(F.replace(h, F.lit("."), F.lit("")))
    where = F.when(dots == 1, F.concat(F.lit("www."), h)).otherwise(F.lower(netloc(full)))
    slash = F.when(p.endswith("/"), p).otherwise(F.concat(p, F.lit("/")))
    error = (
        F.when(text == "", "empty").when(h == "", "no host").when(h.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), "address")
        .when(h == "localhost", "local").when(dots == 0, "no dot")
    )
    return F.struct(F.when(error.isNull(), F.concat(F.lit("https://"), where, slash)).alias("url"), error.alias("error"))


def _flatten(p: Column) -> Column:
    """A path without . and .. segments."""
    none = F.array().cast("array<string>")
    parts = F.split(p, "/", -1)
    kept = F.aggregate(
        parts, none,
        lambda a, x: F.when(x == ".", a).when(x == "..", F.when(F.size(a) > 1, F.slice(a, 1, F.size(a) - 1)).otherwise(a)).otherwise(F.concat(a, F.array(x))),
    )
    dir_end = F.element_at(parts, -1).isin(".", "..")
    out = F.array_join(kept, "/")
    return F.when(dir_end & ~out.endswith("/"), F.concat(out, F.lit("/"))).otherwise(out)


def resolve(base, href) -> Column:
    """The absolute form of a reference found on a page."""
    b, r = col(base), col(href)
    root = F.concat(scheme(b), F.lit("://"), netloc(b))
    bare = F.regexp_extract(r, r"^([^?#]*)", 1)
    rest = F.regexp_extract(r, r"^[^?#]*(.*)$", 1)
    folder = F.regexp_replace(path(b), "[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    return (
        F.when(r.rlike(_ABSOLUTE), r)
        .when(r.startswith("//"), F.concat(scheme(b), F.lit(":"), r))
        .when(r == "", b)
        .when(r.startswith("#"), F.concat(F.regexp_replace(b, "#.*$", ""), r))
        .when(r.startswith("?"), F.concat(root, path(b), r))
        .when(r.startswith("/"), F.concat(root, _flatten(bare), rest))
        .otherwise(F.concat(root, _flatten(F.concat(folder, bare)), rest))
    )


def _unquoted(x: Column) -> Column:
    """Decoded part of a query; a per cent sign without two hexadecimal digits is itself."""
    return F.url_decode(F.regexp_replace(x, "%(?![0-9A-Fa-f]{2})", "%25"))


def _quoted(x: Column) -> Column:
    """Encoded part of a query: letters, digits and ``_.-~`` as they are, a space as a plus sign."""
    return F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def clean_query(q, tracking=c.TRACKING) -> Column:
    """A query without tracking parameters: blank values stay, parameters of one name come together, all are encoded anew."""
    parts = F.filter(F.split(col(q), "&"), lambda x: x != "")
    pairs = F.transform(parts, lambda x: F.struct(
        _unquoted(F.substring_index(x, "=", 1)).alias("k"),
        F.when(F.contains(x, F.lit("=")), _unquoted(F.regexp_replace(x, "^[^=]*=", ""))).otherwise("").alias("v")))
    kept = F.filter(pairs, lambda x: ~F.lower(x["k"]).isin(*tracking))
    return F.get(F.transform(F.array(kept), lambda every: F.array_join(F.flatten(F.transform(
        F.array_distinct(F.transform(every, lambda x: x["k"])),
        lambda k: F.transform(F.filter(every, lambda x: x["k"] == k), lambda x: F.concat(_quoted(x["k"]), F.lit("="), _quoted(x["v"]))))), "&")), F.lit(0))


def discovered(url, source_page, binary=c.BINARY, auth=c.AUTH_WORDS, tracking=c.TRACKING) -> Column:
    """struct<url, error> of a link found on a page: resolved, screened, without fragment and tracking parameters."""
    full = resolve(source_page, strip(F.coalesce(col(url), F.lit(""))))
    p, q = path(full), query(full)
    segments = F.split(F.lower(p), "/")
    tail = F.when(q == "", "").otherwise(clean_query(q, tracking))
    error = (
        F.when(strip(F.coalesce(col(url), F.lit(""))) == "", "empty").when(~scheme(full).isin("http", "https"), "scheme")
        .when(F.lower(p).rlike(rf"\.({'|'.join(binary)})$"), "binary")
        .when(F.arrays_overlap(segments, F.array(*map(F.lit, auth))), "auth")
        .when(base_domain(full) != base_domain(source_page), "other domain")
    )
    clean = F.concat(
        scheme(full), F.lit("://"), F.lower(netloc(full)), F.regexp_replace(p, "/+", "/"), F.when(tail != "", F.concat(F.lit("?"), tail)).otherwise(""))
    return F.struct(F.when(error.isNull(), clean).alias("url"), error.alias("error"))
