"""Vocabulary, limits and site parameters.

The site's host is a parameter everywhere: the engine knows path shapes and
rules, not one address.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

# Fixed values of the change ledger's format.
SCHEMA_VERSION = 1
CHANGE_FILES = ("removed", "moved")
KINDS = ("module", "unit", "learning-path", "course", "certification", "exam", "applied-skill", "study-guide", "docs")
FAMILIES = ("learn", "docs")
REMOVED_OUTCOMES = ("gone", "landing", "retired", "unverified")
MOVED_OUTCOMES = ("moved",)
EVIDENCE = ("tombstone", "unit-diff", "hierarchy-not-found", "rename", "quarantine", "docs-redirect", "live-probe", "history")
EVIDENCE_PRIORITY = ("tombstone", "hierarchy-not-found", "unit-diff", "rename", "live-probe", "quarantine", "docs-redirect", "history")
KIND_OF_TYPE = {"learningPath": "learning-path", "course": "course", "certification": "certification", "exam": "exam", "appliedSkill": "applied-skill"}
CLASSIFIED = ("gone", "landing", "retired", "moved")
COVERING = ("gone", "landing", "retired")
# Fixed values of the path rules.
NOT_DOCS_PREFIXES = ("/training/", "/credentials/", "/certifications/", "/shows/", "/api/", "/answers/", "/samples/", "/collections/", "/users/", "/assessments/", "/search", "/previous-versions/", "/events/", "/community/")
#: First segments of pages of the site that are neither training nor documentation.
LEARN_OTHER = ("credentials", "shows", "answers", "collections", "events", "users", "contribute", "assessments")
RETIRED_PREFIXES = ("/previous-versions", "/archive")
HUBS = ("/", "/docs", "/training", "/training/browse", "/credentials", "/credentials/browse", "/certifications", "/search", "/samples", "/answers")
REDIRECT_STATUSES = (301, 302, 303, 307, 308)
GONE_STATUSES = (404, 410)
MAX_HOPS = 5
MAX_ROUNDS = 3


@dataclass(frozen=True)
class Scope:
    include: tuple[str, ...]
    exclude: tuple[str, ...] = ()


@dataclass(frozen=True)
class Site:
    host: str = "site.example"
    #: Pages whose body is cached, and pages of which only the address is.
    learn: Scope = field(default_factory=lambda: Scope(("/docs",), ("/docs/internal",)))
    index: Scope = field(default_factory=lambda: Scope(("/reference",)))


def number_option(env: Mapping[str, str], name: str, default: float, least: float = 0, most: float = float("inf")) -> float:
    """A numeric option; blank means the default, anything else outside the bounds is an error."""
    raw = (env.get(name) or "").strip()
    if not raw:
        return default
    try:
        value = float(raw)
    except ValueError:
        value = float("nan")
    if not least <= value <= most:
        raise ValueError(f"{name} must be a number from {least} to {most}, not {raw!r}")
    return value


@dataclass(frozen=True)
class Limits:
    """Budgets of a run."""

    probes: int = 300
    reverify: int = 100
    page_fetches: int = 6000
    missing_checks: int = 2000
    verify: int = 2000
    quarantine_rechecks: int = 1000
    changed_min_share: float = 0.2
    redirect_recheck_days: int = 30
    sitemap_recheck_days: int = 28
    sitemap_rechecks: int = 25
    transient_streak: int = 40
    runtime_minutes: int = 90
    stale_days: int = 10

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Limits:
        env = os.environ if env is None else env
        names = {f: f"TIDEMARK_{f.upper()}" for f in cls.__dataclass_fields__}
        kinds = {f: type(getattr(cls(), f)) for f in names}
        return cls(**{f: kinds[f](number_option(env, n, getattr(cls(), f))) for f, n in names.items()})


class LedgerError(ValueError):
    """A change table that cannot be used."""


class UsageError(ValueError):
    """Arguments that cannot be used."""


class GateFailure(RuntimeError):
    """A run stopped by its quality gates."""

    def __init__(self, problems: list[str]) -> None:
        super().__init__("; ".join(problems))
        self.problems = problems
