"""Column functions on URLs and canonical paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Scope

_LOCALE = r"(?i)^/[a-z]{2}-[a-z]{2}(?=/|$)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(value: Column, of) -> Column:
    """of(value), with the value computed once a row: an expression that names it n times would compute it n times, one on top of that n * n times."""
    return F.get(F.transform(F.array(value), lambda v: of(v)), F.lit(0))


def present(c: Column) -> Column:
    """The value, as a generator that leaves out rows where it is null: a filter would compute it a second time."""
    return F.explode(F.filter(F.array(c), lambda v: v.isNotNull()))


def trimmed(c: Column | str) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(col(c), r"^[\s\u00a0\ufeff]+|[\s\u00a0\ufeff]+$", "")


def url_path(c: Column | str) -> Column:
    """The path of an http(s) URL as it stands, '' for none."""
    return F.regexp_extract(col(c), r"(?i)^https?://[^/?#]*([^?#]*)", 1)


def url_host(c: Column | str) -> Column:
    return F.lower(F.regexp_extract(col(c), r"(?i)^https?://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def clean_path(c: Column) -> Column:
    """A path without locale and final slashes, in lower case; the root is '/'."""
    bare = F.regexp_replace(F.regexp_replace(c, _LOCALE, ""), r"/+$", "")
    return F.lower(F.coalesce(F.regexp_replace(bare, r"\A\z", "/"), F.lit("/")))


def canonical_path(c: Column | str, host: str | None = None) -> Column:
    """URL or absolute path to canonical path: no host, locale, query, fragment or final slash, lower case.

    Null for other hosts (host None takes any), relative and unreadable input.
    """
    c = col(c)
    is_url = c.rlike(r"(?i)^https?://[^/?#\s]+") & ((url_host(c) == host) if host else F.lit(True))
    return F.when(is_url, clean_path(url_path(c))).when(c.startswith("/"), clean_path(F.regexp_extract(c, r"^([^?#]*)", 1)))


def entry_path(c: Column | str, host: str | None = None) -> Column:
    """canonical_path, but the root is no entry."""
    return bound(canonical_path(c, host), lambda p: F.when(p != "/", p))


def parent_path(c: Column | str) -> Column:
    """The path without its last segment; null at the top."""
    return F.nullif(F.regexp_extract(col(c), r"^(.+)/[^/]*$", 1), F.lit(""))


def first_segment(c: Column | str) -> Column:
    return F.nullif(F.split(col(c), "/")[1], F.lit(""))


def last_segment(c: Column | str) -> Column:
    return F.regexp_extract(col(c), r"([^/]*)$", 1)


def slug_text(c: Column | str) -> Column:
    """A slug without its leading number."""
    return F.regexp_replace(col(c), r"^\d+[a-z]?-", "")


def module_path(slug: Column | str) -> Column:
    return F.concat(F.lit("/training/modules/"), col(slug))


def absolute(path: Column | str, host: str, locale: str = "") -> Column:
    return F.concat(F.lit(f"https://{host}{'/' + locale if locale else ''}"), col(path))


def probe_url(c: Column | str, host: str, locale: str = "en-us") -> Column:
    """The address that a URL or path is probed at, with an explicit locale."""
    return absolute(canonical_path(c, host), host, locale)


def under_prefix(path: Column | str, prefix: str) -> Column:
    """path is prefix or lies below it ('cloud' holds '/cloud/x', not '/cloud-x')."""
    p = prefix if prefix.startswith("/") else f"/{prefix}"
    return (col(path) == p) | col(path).startswith(f"{p}/")


def under_any(path: Column | str, prefixes: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | under_prefix(path, p)
    return out


def in_scope(path: Column | str, scope: Scope) -> Column:
    """Below an included prefix and below no excluded one."""
    return under_any(F.lower(col(path)), scope.include) & ~under_any(F.lower(col(path)), scope.exclude)


def scope_class(path: Column | str, learn: Scope, index: Scope) -> Column:
    """'learn', 'index' or null."""
    return F.when(in_scope(path, learn), "learn").when(in_scope(path, index), "index")


def scope_for(path: Column | str, learn: Scope, index: Scope) -> Column:
    """'learn', 'index-only', 'excluded' or null: the first scope that includes the path decides."""
    out = F
    for scope, name in ((learn, "learn"), (index, "index-only")):
        out = out.when(under_any(path, scope.include), F.when(under_any(path, scope.exclude), "excluded").otherwise(name))
    return out


def ancestors(path: Column | str, itself: bool = True) -> Column:
    """Array of the path's prefixes by segment, longest last; with or without the path itself."""
    parts = F.split(col(path), "/")
    n = F.size(parts) - (0 if itself else 1)
    made = F.transform(F.sequence(F.lit(2), n), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    return F.when(n >= 2, made).otherwise(F.array().cast("array<string>"))


def alias_key(url: Column | str, host: str | None = None) -> Column:
    """What two spellings of one page have in common."""
    return F.coalesce(canonical_path(url, host), F.lower(col(url)))


def normal_page_url(loc: Column | str, host: str, locale: str = "en-us") -> Column:
    """A sitemap address of the given locale without locale, fragment and view parameter; null for others."""
    c = col(loc)
    path = url_path(c)
    query = F.regexp_extract(c, r"\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^view(=|$)"))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    bare = F.regexp_replace(path, f"(?i)^/{locale}(?=/|$)", "")
    good = (url_host(c) == host) & path.rlike(f"(?i)^/{locale}(/|$)")
    return F.when(good, F.concat(F.lit(f"https://{host}"), bare, tail))


def bare_path(url: Column | str) -> Column:
    """The path of a URL without slashes at either end."""
    return F.regexp_replace(url_path(url), r"^/+|/+$", "")


def sitemap_family(loc: Column | str) -> Column:
    """struct(family, locale, part) of .../<family>_<locale>_<n>.xml, else null."""
    c, p = col(loc), r"([^/]+)_([a-z]{2}-[a-z]{2})_(\d+)\.xml$"
    return F.when(c.rlike(p), F.struct(*(F.regexp_extract(c, p, i).alias(n) for i, n in ((1, "family"), (2, "locale"))), F.regexp_extract(c, p, 3).cast("int").alias("part")))


def source_file_url(path: Column | str, root: str, base: str, domain: str, strip: str = "") -> Column:
    """The page a Markdown file below root is published at."""
    rel = F.regexp_replace(F.regexp_replace(col(path), f"^{root.rstrip('/')}/", ""), r"\.md$", "")
    rel = F.regexp_replace(rel, r"(^|/)index$", "")
    rel = F.regexp_replace(rel, f"^{strip}/?", "") if strip else rel
    return F.regexp_replace(F.concat_ws("/", F.lit(f"https://{domain}"), *([F.lit(base.strip("/"))] if base.strip("/") else []), rel), r"/+$", "")


def first_mapping(path: Column | str, mappings: list[tuple[str, str]]) -> Column:
    """The target of the first (source prefix, target) that begins the path."""
    out = F
    for source, target in mappings:
        out = out.when(col(path).startswith(source), F.lit(target))
    return out if mappings else F.lit(None).cast("string")


def exam_code(name: Column | str) -> Column:
    return F.lower(trimmed(name))


def exam_code_of_uid(uid: Column | str) -> Column:
    return F.lower(F.regexp_replace(col(uid), r"^exam\.", ""))


def study_guide_path(code: Column | str, skills: bool = False) -> Column:
    return F.concat(F.lit(f"/credentials/{'applied-skills' if skills else 'certifications'}/resources/study-guides/"), col(code))


def encoded(c: Column | str) -> Column:
    """Percent-encoding with spaces as %20."""
    return F.replace(F.url_encode(col(c)), F.lit("+"), F.lit("%20"))


def is_module_path(c: Column | str) -> Column:
    return col(c).rlike(r"^/training/[^/]+/") & ~col(c).rlike(r"^/training/(paths|courses)(/|$)")


def normal_link(c: Column | str, tracking: str = "") -> Column:
    """A URL without /en-us/; its tracking id set to the given one, if any."""
    out = F.regexp_replace(col(c), r"(?i)/en-us/", "/")
    return F.regexp_replace(out, r"([?&]WT\.mc_id=)[^&#]*", f"$1{tracking}") if tracking else out


#: Characters of a path that stay as they are; others are percent-encoded.
_PLAIN = r"[A-Za-z0-9/%:@!$&'()*+,;=~._-]"


def resolved(href: Column | str, base: Column | str, host: str | None = None) -> Column:
    """An href (relative, ./, ../, absolute or URL) resolved against a page path; null off the site.

    A fold over the path's segments: '..' takes the last one off, '.' and empty
    ones add none.  Query and fragment go; escapes stay as they are.
    """
    b, none = F.coalesce(col(base), F.lit("/")), F.array().cast("array<string>")
    step = lambda held, s: F.when((s == "") | (s == "."), held).when(s == "..", F.slice(held, 1, F.greatest(F.size(held) - 1, F.lit(0)))).otherwise(F.concat(held, F.array(s)))
    each = lambda walked: F.transform(F.split(walked, ""), lambda c: F.when((c == "") | c.rlike(_PLAIN), c).otherwise(encoded(c)))
    safe = lambda walked: F.when(walked.rlike(f"^{_PLAIN}*$"), walked).otherwise(F.array_join(each(walked), ""))

    def of(h: Column) -> Column:
        url = F.when(h.startswith("//"), F.concat(F.lit("https:"), h)).otherwise(h)
        outside = url.rlike(r"(?i)^[a-z][a-z0-9+.-]*:")
        bare = F.regexp_extract(h, r"^([^?#]*)", 1)
        inside = bound(bare, lambda p: F.when(p.startswith("/"), p).when(p == "", b).otherwise(F.concat(F.regexp_extract(b, r"^(.*/)", 1), p)))
        path = F.when(outside, url_path(url)).otherwise(inside)
        walked = F.concat(F.lit("/"), F.array_join(F.aggregate(F.split(path, "/"), none, step), "/"))
        here = ~outside | (url.rlike(r"(?i)^https?://[^/?#\s]+") & ((url_host(url) == host) if host else F.lit(True)))
        return F.when((h != "") & ~h.startswith("#") & here, bound(walked, safe))

    return bound(trimmed(href), of)


def toc_target(href: Column | str, folder: Column | str, host: str | None = None) -> Column:
    """The page a sidebar entry leads to: resolved in its folder, without file ending and /index."""
    path = resolved(href, F.concat(col(folder), F.lit("/")), host)
    return bound(F.regexp_replace(F.regexp_replace(path, r"\.(md|ya?ml|json)$", ""), r"/index$", ""), canonical_path)


def toc_folder(page: Column | str, rel: Column | str) -> Column:
    """The folder of a page's sidebar file."""
    at = F.regexp_replace(resolved(rel, page), r"/toc\.json$", "")
    return bound(at, lambda p: F.when(p == "", "/").otherwise(canonical_path(p)))


def link_target(href: Column | str, page: Column | str, host: str | None = None) -> Column:
    """The page an article's link leads to; null for other hosts, anchors and the page itself."""
    to = bound(resolved(href, page, host), canonical_path)
    return bound(to, lambda t: F.when(~F.coalesce(t == col(page), F.lit(False)), t))
