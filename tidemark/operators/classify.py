"""CASE classifiers: path kinds, redirects, probes, links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import GONE_STATUSES, HUBS, LEARN_OTHER, NOT_DOCS_PREFIXES, RETIRED_PREFIXES
from ..functions.paths import canonical_path, col, last_segment, parent_path, trimmed, under_any, url_host
from ..functions.text import decoded

#: Path shapes in the order they are tried (fixed values of the rules).
SHAPES = (
    ("unit", r"^/training/modules/[^/]+/[^/]+$"),
    ("module", r"^/training/modules/[^/]+$"),
    ("path", r"^/training/paths/[^/]+$"),
    ("course", r"^/training/courses/[^/]+$"),
    ("study-guide", r"^/credentials/(?:certifications|applied-skills)/resources/study-guides/[^/]+$"),
    ("exam", r"^/credentials/certifications/exams/[^/]+$"),
    ("certification", r"^/credentials/certifications/[^/]+$"),
    ("applied-skill", r"^/credentials/applied-skills/[^/]+$"),
)
NOT_FOUND_TITLE = r"(?i)^404\b|content not found"


def classify_path(path: Column | str) -> Column:
    """The kind of page a canonical path has the shape of."""
    p, out = col(path), F
    for kind, pattern in SHAPES:
        out = out.when(p.rlike(pattern), kind)
    other = p == "/"
    for prefix in NOT_DOCS_PREFIXES:
        other = other | p.startswith(prefix)
    return out.when(other, "other").otherwise("docs")


def module_of(path: Column | str) -> Column:
    return F.nullif(F.regexp_extract(col(path), r"^/training/modules/([^/]+)", 1), F.lit(""))


def classify_known(path: Column | str, is_module: Column, is_unit: Column) -> Column:
    """classify_path, but 'other' paths that are modules, or lie in one, by the cached catalogue."""
    kind = classify_path(path)
    return F.when((kind == "other") & is_module, "module").when((kind == "other") & is_unit, "unit").otherwise(kind)


def shape_of(path: Column | str, is_module: Column, is_unit: Column) -> Column:
    """Kind in ledger terms: 'path' is a learning path, catalogue modules count wherever they are."""
    kind = classify_path(path)
    return F.when(is_module, "module").when(is_unit, "unit").when(kind == "path", "learning-path").otherwise(kind)


def classify_redirect(start: Column | str, to: Column | str) -> Column:
    """moved, landing (an ancestor, a hub, a product's front page) or retired."""
    a, b = col(start), col(to)
    front = (b == "/") | a.startswith(F.concat(b, F.lit("/"))) | (F.size(F.split(b, "/")) == 2) | b.isin(*HUBS)
    return F.when(b.isNull(), "moved").when(under_any(b, RETIRED_PREFIXES), "retired").when((a != b) & front, "landing").otherwise("moved")


def classify_probe(status: Column, first_status: Column, final_path: Column, path: Column, error: Column, offsite: Column) -> Column:
    """struct(outcome, status, to, kind) of a docs probe: live, gone, moved or transient."""
    unusable = error | status.isNull()
    served = status.between(200, 299)
    outcome = F.when(unusable, "transient").when(offsite, "moved").when(status.isin(*GONE_STATUSES), "gone").when(served & final_path.isNull(), "transient").when(served & (final_path == path), "live").when(served, "moved").otherwise("transient")
    to = F.when((outcome == "moved") & ~offsite, final_path)
    return F.struct(outcome.alias("outcome"), F.when(outcome == "moved", F.coalesce(first_status, status)).otherwise(status).alias("status"), to.alias("to"), F.when(outcome == "moved", classify_redirect(path, to)).alias("kind"))


def classify_learn_probe(kind: Column, path: Column, status: Column, first_status: Column, final_path: Column, title: Column, error: Column, offsite: Column, shape: Column) -> Column:
    """struct(outcome, to, status) of a catalogue probe; a move stays within the kind, all else is a landing page."""
    missing = status.isin(*GONE_STATUSES) | ((status == 200) & F.coalesce(title, F.lit("")).rlike(NOT_FOUND_TITLE))
    same = F.when(kind == "module", (shape == "module") | final_path.startswith(F.concat(path, F.lit("/")))).otherwise(shape == kind)
    outcome = (
        F.when(error | status.isNull(), "transient")
        .when(offsite, "landing")
        .when(missing, "gone")
        .when((status != 200) | final_path.isNull(), "transient")
        .when(final_path == path, "live")
        .when(kind == "study-guide", "gone")
        .when((kind == "exam") & (shape == "certification"), "live")
        .when(same, "moved")
        .otherwise("landing")
    )
    return F.struct(outcome.alias("outcome"), F.when(outcome.isin("moved", "landing") & ~offsite, final_path).alias("to"), F.coalesce(first_status, status).alias("status"))


def interpret_probe(path: Column, status: Column, final_path: Column, title: Column) -> Column:
    """struct(verdict, redirects_to) of a page's live answer: ok, broken, moved or unknown."""
    title = F.coalesce(title, F.lit(""))
    other = final_path.isNotNull() & (final_path != path)
    is_exam, is_cert = path.rlike(r"^/credentials/certifications/exams/[^/]+$"), final_path.rlike(r"^/credentials/certifications/(?!exams$|resources$)[^/]+$")
    guide = path.rlike(dict(SHAPES)["study-guide"])
    lost = path.startswith("/training/modules/") & ~final_path.startswith("/training/modules/")
    verdict = (
        F.when(status.isNull(), "unknown")
        .when(status.isin(*GONE_STATUSES), "broken")
        .when(status != 200, "unknown")
        .when(title.rlike(NOT_FOUND_TITLE), "broken")
        .when(title.rlike("(?i)^browse all training") | F.coalesce(final_path.startswith("/training/browse"), F.lit(False)), "broken")
        .when(other & is_exam & is_cert, "ok")
        .when(other & guide, "broken")
        .when(other & lost, "broken")
        .when(other, "moved")
        .otherwise("ok")
    )
    goes = other & (status == 200) & ~title.rlike(NOT_FOUND_TITLE) & ((verdict == "moved") | ((verdict == "broken") & lost & ~guide & ~final_path.startswith("/training/browse") & ~title.rlike("(?i)^browse all training")))
    return F.struct(verdict.alias("verdict"), F.when(goes, final_path).alias("redirects_to"))


def classify_expected(status: Column, final_path: Column, expected: Column, error: Column) -> Column:
    """verified, absent, redirected or transient: whether an expected page exists."""
    return F.when(error | status.isNull(), "transient").when(status.isin(*GONE_STATUSES), "absent").when(status != 200, "transient").when(final_path == expected, "verified").when(final_path.isNull(), "transient").otherwise("redirected")


def classify_hierarchy(status: Column, not_found_code: Column, shape: Column, error: Column) -> Column:
    """ok, not-found, http-error, transient, bad-shape or misaligned; shape is text.hierarchy's outcome."""
    return F.when(error | status.isNull() | (status == 429) | (status >= 500), "transient").when((status == 404) & not_found_code, "not-found").when(status != 200, "http-error").otherwise(shape)


def external_page(status: Column, error: Column) -> Column:
    return F.when(error | status.isNull(), "transient").when(status.isin(*GONE_STATUSES), "gone").when(status.between(200, 399), "live").otherwise("transient")


def link_kind(path: Column | str) -> Column:
    """training, learn-other or docs."""
    p = col(path)
    return F.when(p.rlike(r"^/training(/|$)"), "training").when(p.rlike(rf"^/({'|'.join(LEARN_OTHER)})(/|$)"), "learn-other").otherwise("docs")


def classify_link(href: Column | str, module: Column | str | None, host: str) -> Column:
    """struct(kind, path, url) of a link on a unit page: a page of the site by kind, or external, by its URL without fragment.

    Null for anchors, other schemes, the site's front page, and the module itself
    with its units.  A relative link is one below the site's root; those with
    dots go through paths.resolved first.
    """
    h = trimmed(decoded(href))
    scheme = h.rlike("(?i)^[a-z][a-z0-9+.-]*:")
    at = F.when(scheme | h.startswith("/"), h).otherwise(F.concat(F.lit("/"), F.regexp_replace(h, r"^(?:\./)+", "")))
    path = canonical_path(at, host)
    own = F.lit(False) if module is None else F.coalesce((path == col(module)) | path.startswith(F.concat(col(module), F.lit("/"))), F.lit(False))
    none = F.lit(None).cast("string")
    page = F.struct(link_kind(path).alias("kind"), path.alias("path"), none.alias("url"))
    outside = F.struct(F.lit("external").alias("kind"), none.alias("path"), F.regexp_replace(h, "#.*$", "").alias("url"))
    return F.when((h == "") | h.startswith("#"), None).when(path.isNotNull(), F.when((path != "/") & ~own, page)).when(h.rlike("(?i)^https?://") & (url_host(h) != host), outside)


def decide_offline(path: Column, verdict: Column, redirects_to: Column, confidence: Column) -> Column:
    """keep, rewrite or drop by a verdict of the caches; null where only a live check can tell, which a broken link needs as well.

    A sure move is rewritten if it leads to another page, and dropped if to a landing page or an archive.
    """
    sure = (verdict == "moved") & (confidence == "high") & redirects_to.isNotNull()
    return F.when(verdict == "valid", "keep").when(sure, F.when(classify_redirect(path, redirects_to) == "moved", "rewrite").otherwise("drop"))


def decide_probe(path: Column, verdict: Column, redirects_to: Column) -> Column:
    """keep, rewrite, drop or unverified by a live verdict (ok, moved, broken, else)."""
    real = redirects_to.isNotNull() & (classify_redirect(path, redirects_to) == "moved")
    return F.when(verdict == "ok", "keep").when((verdict == "moved") & real, "rewrite").when(verdict.isin("moved", "broken"), "drop").otherwise("unverified")


def refresh_reason(is_new: Column, has_urls: Column, same_sig: Column, consistent: Column, same_first: Column) -> Column:
    """Why a module's units must be read again: the first condition that fails, or null."""
    return F.when(is_new, "new").when(~has_urls, "no-unit-urls").when(~same_sig, "sig-changed").when(~consistent, "inconsistent").when(~same_first, "first-unit-moved")


def unit_of(path: Column | str) -> Column:
    """struct(module path, unit slug)."""
    return F.struct(parent_path(path).alias("module"), last_segment(path).alias("unit"))
