"""URL parts, resolution, building, checking and redaction."""

from __future__ import annotations

import re

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelake import constants as K
from pagelake.functions.text import find, let

# RFC 3986, appendix B, with the scheme limited to its legal characters.
SPLIT_URL = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
SPLIT_AUTHORITY = r"^(?:(.*)@)?(\[[^\]]*\]|[^:]*)(?::([0-9]*))?$"
DEFAULT_PORTS = {"https": 443}
OTHER_PORT = 80


def scheme(url: Column) -> Column:
    return F.lower(find(url, SPLIT_URL, 1))


def authority(url: Column) -> Column:
    return F.regexp_extract(url, SPLIT_URL, 2)


def path(url: Column) -> Column:
    return F.regexp_extract(url, SPLIT_URL, 3)


def query(url: Column) -> Column:
    return F.regexp_extract(url, SPLIT_URL, 4)


def fragment(url: Column) -> Column:
    return F.regexp_extract(url, SPLIT_URL, 5)


def host(url: Column) -> Column:
    """Lower-case host without user info, port and brackets; NULL when there is none."""
    raw = F.lower(F.regexp_extract(authority(url), SPLIT_AUTHORITY, 2))
    return F.nullif(F.regexp_replace(raw, r"[\[\]]", ""), F.lit(""))


def port(url: Column) -> Column:
    return find(authority(url), SPLIT_AUTHORITY, 3).try_cast("int")


def _assemble(scheme_: Column, authority_: Column, path_: Column, query_: Column, fragment_: Column) -> Column:
    """Glue the five parts; empty parts leave no delimiter behind."""
    return F.concat(
        F.when(scheme_.isNotNull() & (scheme_ != ""), F.concat(scheme_, F.lit(":"))).otherwise(""),
        F.when(authority_ != "", F.concat(F.lit("//"), authority_)).otherwise(""),
        F.when((authority_ != "") & path_.rlike("^[^/]"), F.concat(F.lit("/"), path_)).otherwise(path_),
        F.when(query_ != "", F.concat(F.lit("?"), query_)).otherwise(""),
        F.when(fragment_ != "", F.concat(F.lit("#"), fragment_)).otherwise(""),
    )


def _resolve_dots(segments: Column) -> Column:
    """Apply ``.`` and ``..`` segments from left to right."""
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(s))),
    )
    ends_in_dots = F.element_at(segments, -1).isin(".", "..")
    closed = F.when(ends_in_dots, F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    joined = F.array_join(closed, "/")
    return F.when(joined == "", "/").otherwise(joined)


def split_base(url: Column) -> Column:
    """Parts of a page URL that its links are resolved against; split once per page."""
    return F.struct(
        scheme(url).alias("scheme"),
        authority(url).alias("authority"),
        path(url).alias("path"),
        query(url).alias("query"),
        F.concat(scheme(url), F.lit("://"), authority(url)).alias("site"),
    )


def resolve(base: Column, value: Column) -> Column:
    """``value`` resolved against a ``split_base`` struct; NULL for a missing or empty value."""

    def by_path(p: Column) -> Column:
        directory = F.regexp_extract(base["path"], r"(?s)^(.*/)[^/]*$", 1)
        merged = F.when(p.startswith("/"), p).otherwise(
            F.regexp_replace(
                F.concat(F.when(directory == "", "/").otherwise(directory), p), r"(?<=.)/{2,}(?=.)", "/"
            )
        )
        return let(
            merged,
            lambda m: F.when(
                m.rlike(r"(^|/)\.\.?(/|$)"), _resolve_dots(F.split(m, "/", -1))
            ).otherwise(m),
        )

    def general(v: Column) -> Column:
        def build(u: Column) -> Column:
            other_scheme = u["scheme"].isNotNull() & ~u["scheme"].eqNullSafe(base["scheme"])
            keep_path = u["path"] == ""
            relative = _assemble(
                base["scheme"],
                base["authority"],
                F.when(keep_path, base["path"]).otherwise(let(u["path"], by_path)),
                F.when(keep_path & (u["query"] == ""), base["query"]).otherwise(u["query"]),
                u["fragment"],
            )
            return (
                F.when(other_scheme | base["scheme"].isNull(), v)
                .when(
                    u["authority"] != "",
                    _assemble(base["scheme"], u["authority"], u["path"], u["query"], u["fragment"]),
                )
                .otherwise(relative)
            )

        parts = F.struct(
            scheme(v).alias("scheme"), authority(v).alias("authority"), path(v).alias("path"),
            query(v).alias("query"), fragment(v).alias("fragment"),
        )
        return let(parts, build)

    def usual(v: Column) -> Column:
        # Most links are /path or complete already; they need no general resolution.
        rooted = v.rlike(r"^/[^/?#\s][^?#\s]*(\?[^#\s]+)?(#\S+)?$") & ~v.contains("/.")
        return (
            F.when(v == "", None)
            .when(v.rlike(r"^https?://[^?#\s]+$"), v)
            .when(rooted & base["scheme"].isNotNull(), F.concat(base["site"], v))
            .otherwise(general(v))
        )

    return let(F.regexp_replace(value, r"[\t\r\n]|^[\x00-\x20]+", ""), usual)


def absolute_url(base: Column, value: Column) -> Column:
    """``value`` resolved against the URL ``base``; NULL for a missing or empty value."""
    return let(split_base(base), lambda b: resolve(b, value))


def project_id(url: Column) -> Column:
    return find(path(url), K.PROJECT_PATH, 1).try_cast("long")


def username(url: Column) -> Column:
    return find(path(url), K.USER_PATH, 1)


def endpoint(url: Column) -> Column:
    """First path segment, or ``root``."""
    return F.coalesce(find(path(url), r"^/*([^/]+)", 1), F.lit("root"))


def _decode(value: Column) -> Column:
    return F.coalesce(F.try_url_decode(value), value)


def _encode(value: Column) -> Column:
    return F.replace(F.replace(F.url_encode(value), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def query_pairs(url: Column) -> Column:
    """Decoded ``(k, v)`` pairs of the query in order; a key without ``=`` has an empty value."""
    pieces = F.filter(F.split(query(url), "&", -1), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            _decode(F.regexp_extract(p, r"(?s)^([^=]*)", 1)).alias("k"),
            _decode(F.regexp_extract(p, r"(?s)^[^=]*=(.*)$", 1)).alias("v"),
        ),
    )


def append_params(url: Column, pairs: Column) -> Column:
    """``url`` with an encoded query made of ``(k, v)`` structs; repeated keys stay repeated."""
    text = F.array_join(
        F.transform(pairs, lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&"
    )
    return F.when(F.size(pairs) > 0, F.concat(url, F.lit("?"), text)).otherwise(url)


def with_page(url: Column, page: Column) -> Column:
    """Set the ``page`` query value, keep every other one, equal keys side by side."""

    def build(pairs: Column) -> Column:
        keys = F.array_distinct(
            F.concat(F.transform(pairs, lambda p: p["k"]), F.array(F.lit("page")))
        )
        wanted = F.flatten(
            F.transform(
                keys,
                lambda k: F.when(
                    k == "page", F.array(F.struct(k.alias("k"), page.cast("string").alias("v")))
                ).otherwise(F.filter(pairs, lambda p: p["k"] == k)),
            )
        )
        bare = _assemble(scheme(url), authority(url), path(url), F.lit(""), F.lit(""))
        tail = F.when(fragment(url) != "", F.concat(F.lit("#"), fragment(url))).otherwise("")
        return F.concat(append_params(bare, wanted), tail)

    return let(query_pairs(url), build)


def page_number(url: Column) -> Column:
    """Page number of a listing URL: the query first, the path second."""
    values = F.filter(query_pairs(url), lambda p: (p["k"] == "page") & (p["v"] != ""))
    from_query = F.get(values, F.lit(0))["v"]
    return F.coalesce(
        F.when(from_query.rlike(r"^\d+$"), from_query.try_cast("long")),
        find(path(url), K.PAGE_IN_PATH, 1).try_cast("long"),
    )


def listing_url(base: str, category: Column) -> Column:
    """First listing page of a category (slug, path or full URL), or of everything."""
    slug = F.regexp_replace(category, r"^/+|/+$", "")
    return (
        F.when(category.isNull() | (category == ""), f"{base}/projects/")
        .when(category.rlike(r"^https?://"), category)
        .when(slug.startswith("projects/category/"), F.concat(F.lit(f"{base}/"), slug, F.lit("/")))
        .otherwise(F.concat(F.lit(f"{base}/projects/category/"), slug, F.lit("/")))
    )


def listing_key(url: Column) -> Column:
    """The listing a page belongs to: its URL without page number and fragment."""
    kept = F.filter(query_pairs(url), lambda p: p["k"] != "page")
    bare = _assemble(scheme(url), authority(url), F.regexp_replace(path(url), r"/page-\d+(?=/|$)", ""), F.lit(""), F.lit(""))
    return F.regexp_replace(append_params(bare, kept), r"(?<!/)$", "/")


def listing_category(url: Column) -> Column:
    """Category slug of a listing URL, the inverse of ``listing_url``; NULL for the listing of everything."""
    return find(path(url), r"/projects/category/(.+?)/?(?:page-\d+/?)?$", 1)


def category_slug(category: str) -> str:
    """The slug behind a category given as slug, path or full URL."""
    return re.sub(r"^(?:https?://[^/]*)?/*(?:projects/category/)?", "", category).split("?")[0].strip("/")


def people_url(base: str, category: Column, page: Column) -> Column:
    """People listing page; only pages after the first carry a number."""
    slug = F.regexp_replace(category, r"^/+|/+$", "")
    first = (
        F.when(category.isNull() | (category == ""), f"{base}/freelancers/")
        .when(category.rlike(r"^https?://"), F.concat(F.regexp_replace(category, r"/+$", ""), F.lit("/")))
        .otherwise(F.concat(F.lit(f"{base}/freelancers/"), slug, F.lit("/")))
    )
    return F.when(page == 1, first).otherwise(
        F.concat(first, F.lit("page-"), page.cast("string"), F.lit("/"))
    )


def detail_url(base: str, project: Column) -> Column:
    """Detail page of an id, or of a relative or absolute link."""
    text = project.cast("string")
    return F.when(
        text.rlike(r"^\d+$"), F.concat(F.lit(f"{base}/projects/"), text, F.lit("/"))
    ).otherwise(absolute_url(F.lit(f"{base}/"), text))


def handle(base: str, user: Column) -> Column:
    """User name out of a handle or a profile link; NULL when a link holds none."""
    is_link = user.rlike(r"^https?://") | user.contains("/users/")
    from_link = find(path(absolute_url(F.lit(f"{base}/"), user)), r"/users/([^/?#]+)/?", 1)
    return F.when(is_link, from_link).otherwise(F.regexp_replace(user, r"^/+|/+$", ""))


def user_url(base: str, user: Column) -> Column:
    return F.concat(F.lit(f"{base}/users/"), handle(base, user), F.lit("/"))


def is_allowed_host(host_: Column, allowed: Sequence[str], subdomains: bool = True) -> Column:
    bare = F.regexp_replace(F.lower(host_), r"\.+$", "")
    result = bare.isin(*allowed)
    if subdomains:
        for name in allowed:
            result = result | bare.endswith(f".{name}")
    return F.coalesce(result, F.lit(False))


def url_problem(url: Column, allowed: Sequence[str], subdomains: bool = True) -> Column:
    """``bad_scheme``, ``bad_host`` or NULL."""
    return F.when(
        ~F.coalesce(scheme(url), F.lit("")).isin("http", "https"), "bad_scheme"
    ).when(~is_allowed_host(host(url), allowed, subdomains), "bad_host")


def origin(url: Column) -> Column:
    default = F.lit(OTHER_PORT)
    for name, number in DEFAULT_PORTS.items():
        default = F.when(scheme(url) == name, number).otherwise(default)
    return F.struct(
        scheme(url).alias("scheme"), host(url).alias("host"), F.coalesce(port(url), default).alias("port")
    )


def redirect_verdict(
    source: Column,
    target: Column,
    allowed: Sequence[str],
    subdomains: bool = True,
    allow_downgrade: bool = False,
) -> Column:
    """``refused_downgrade``, ``bad_scheme``, ``bad_host``, ``cross_origin`` or ``same_origin``."""
    crosses = ~origin(source).eqNullSafe(origin(target))
    downgrade = crosses & (scheme(source) == "https") & (scheme(target) == "http")
    problem = url_problem(target, allowed, subdomains)
    verdict = F.when(downgrade, "refused_downgrade") if not allow_downgrade else F.when(F.lit(False), "")
    return (
        verdict.when(problem.isNotNull(), problem)
        .when(crosses, "cross_origin")
        .otherwise("same_origin")
    )


def redact_url(url: Column) -> Column:
    """Hide user info and the values of secret query keys."""
    user_info = F.regexp_extract(authority(url), SPLIT_AUTHORITY, 1)
    raw_host = F.regexp_replace(F.lower(F.regexp_extract(authority(url), SPLIT_AUTHORITY, 2)), r"[\[\]]", "")
    named = F.regexp_extract(user_info, r"^([^:]*)", 1) != ""
    net = F.concat(
        F.when(named, "***@").otherwise(""),
        raw_host,
        F.when(port(url) > 0, F.concat(F.lit(":"), port(url).cast("string"))).otherwise(""),
    )
    safe_query = F.regexp_replace(query(url), K.SECRET_QUERY, "$1=***")
    return _assemble(scheme(url), net, path(url), safe_query, fragment(url))


def failure_key(url: Column) -> Column:
    """File-safe key of a page that could not be parsed."""
    return F.substring(F.regexp_replace(url, K.UNSAFE_FILE_CHARS, "_"), 1, K.FAILURE_KEY_LENGTH)


def is_attachment(url: Column) -> Column:
    return url.rlike(K.ATTACHMENT_URL)
