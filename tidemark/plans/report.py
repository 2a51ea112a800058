"""Reports over the ledger: link checks, changelog, freshness, status."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..config import UsageError
from ..functions.paths import canonical_path
from ..functions.scalars import age_hours, is_timestamp
from ..operators.joins import lookup_changes
from ..operators.ledger import changes_since


def check_links(links: DataFrame, ledger: DataFrame, link: str = "url", host: str | None = None, all_links: bool = True) -> DataFrame:
    """link, path, status (removed, moved or none), outcome, confidence, to.  none: no change is recorded, which is no verdict."""
    rows = links.select(F.col(link).alias("link"), canonical_path(link, host).alias("path"))
    hit = lookup_changes(rows, ledger).select(F.col("link").alias("path"), "state", "outcome", "confidence", "to")
    out = rows.join(hit, "path", "left").select("link", "path", F.coalesce("state", F.lit("none")).alias("status"), "outcome", "confidence", "to")
    return out if all_links else out.where("status <> 'none'")


def changelog(ledger: DataFrame, since: str) -> DataFrame:
    import datetime

    try:
        datetime.date.fromisoformat(since)
    except (TypeError, ValueError) as e:
        raise UsageError(f"since must be YYYY-MM-DD, not {since!r}") from e
    return changes_since(ledger, since).select("firstSeen", "path", F.col("file").alias("status"), "outcome", "to", "kind")


def freshness(stamps: DataFrame, now: str, stale_days: int = 10) -> DataFrame:
    """family, stamp, age_hours, stale: the oldest valid stamp of each family; none at all is stale."""
    rows = stamps.groupBy("family").agg(F.min(F.when(is_timestamp("stamp"), F.col("stamp"))).alias("stamp"))
    age = age_hours("stamp", now)
    return rows.select("family", "stamp", age.alias("age_hours"), F.coalesce(age > stale_days * 24, F.lit(True)).alias("stale"))


def freshness_warnings(fresh: DataFrame) -> DataFrame:
    text = F.when(F.col("stamp").isNull(), F.concat("family", F.lit(": never refreshed"))).when(F.col("stale"), F.concat("family", F.lit(": refreshed "), F.col("age_hours").cast("string"), F.lit(" hours ago")))
    return fresh.select(text.alias("warning")).where("warning is not null")


# Fixed values of the status file: its version, the sections that come first, the
# stamps of the learn section's parts, and the order of that section's keys.
STATUS_VERSION = 1
SECTIONS = ("learn", "docs")
PART_STAMPS = {"catalog": "catalogGeneratedAt", "content": "contentGeneratedAt"}
LEARN_KEYS = (
    "generatedAt", "runId", "modules", "removed", "outOfScope", "totalApiModules", "unitUrlsRefreshedAt", "unitHierarchyRequests", "unitHierarchyFailures", "unitUrlsNull",
    "unitHierarchyNotFound", "unitUrlsCarriedForward", "unusedCategories", "emptiedCategories", "content", "catalogChanges", "contentChanges", "catalogGeneratedAt", "contentGeneratedAt",
)


def with_section(status: dict, section: str, data: dict, now: str, run_id: str | None = None) -> dict:
    """The status with one section exchanged: the version, the known sections, then others as they stood."""
    held = {**status, "schemaVersion": STATUS_VERSION, section: {"generatedAt": now, "runId": run_id, **data}}
    first = ["schemaVersion", *(k for k in SECTIONS if held.get(k))]
    return {k: held[k] for k in dict.fromkeys([*first, *held])}


def _stamp(text) -> datetime | None:
    try:
        at = datetime.fromisoformat(text)
    except (TypeError, ValueError):
        return None
    return at if at.tzinfo else at.replace(tzinfo=timezone.utc)


def learn_section(existing: dict | None, part: str, fields: dict, now: str) -> dict:
    """The learn section after one of its parts has contributed; the other part's keys stay."""
    if part not in PART_STAMPS:
        raise UsageError(f"a part is one of {', '.join(PART_STAMPS)}, not {part!r}")
    rest = {k: v for k, v in (existing or {}).items() if k not in ("generatedAt", "runId")}
    made = {**rest, **fields, PART_STAMPS[part]: now}
    return {k: made[k] for k in [*(k for k in LEARN_KEYS if k in made), *sorted(set(made) - set(LEARN_KEYS))]}


def contributed(status: dict, part: str, fields: dict, now: str, run_id: str | None = None) -> dict:
    """The status after a part of the learn section has reported: the section is as old as its oldest part."""
    learn = status.get("learn")
    data = learn_section(learn if isinstance(learn, dict) else None, part, fields, now)
    stamps = sorted((at, data[k]) for k in PART_STAMPS.values() if (at := _stamp(data.get(k))))
    return with_section(status, "learn", data, stamps[0][1] if stamps else now, run_id)


def read_status(spark: SparkSession, path: str) -> dict:
    """The status file as it stands; a missing or damaged one is empty."""
    from ..sources import files

    if not files.exists(spark, path):
        return {}
    try:
        held = json.loads(spark.read.text(path, wholetext=True).first().value)
    except (AttributeError, ValueError):
        return {}
    return held if isinstance(held, dict) else {}


def write_status(spark: SparkSession, path: str, status: dict) -> None:
    """Put a status file in place, in one step."""
    from ..sources import files

    files.write_text(spark.createDataFrame([(json.dumps(status, indent=2, ensure_ascii=False),)], "value string"), path)


def one_row(spark: SparkSession, **fields) -> DataFrame:
    return spark.createDataFrame([Row(**fields)])


def seed_report(candidates: DataFrame, compared: DataFrame, given: dict[str, int], dry_run: bool, probing: bool, sample: int = 10) -> str:
    """A seed run in words: what was read, candidates by evidence and kind with a sample, what the ledger gained."""
    mode = ", ".join(x for x in ("dry run, nothing written" if dry_run else "", "" if probing else "no probes") if x)
    lines = ["Seed of the change ledger" + (f" ({mode})" if mode else "")]
    lines += [f"  {name}: {n}" for name, n in given.items()]
    lines.append("Candidates:")
    lines += [f"  {r.evidence} {r.kind}: {r.n}" for r in candidates.groupBy("evidence", "kind").agg(F.count("*").alias("n")).orderBy("evidence", "kind").collect()]
    some = candidates.orderBy("path").limit(sample + 1).collect()
    lines += [f"    {r.kind} {r.path} [{r.evidence}, {r.firstSeen}]" for r in some[:sample]] + (["    ..."] if len(some) > sample else [])
    lines.append("Ledger:")
    return "\n".join(lines + [f"  {r.change}: {r.n}" for r in compared.orderBy("change").collect()])


def plan_report(plan: DataFrame, queued: DataFrame) -> str:
    """A plan in words: paths by action, and how many of each queue fit the budgets."""
    lines = ["Plan:"] + [f"  {r.action}: {r.n}" for r in plan.groupBy("action").agg(F.count("*").alias("n")).orderBy("action").collect()]
    return "\n".join(lines + ["Queues:"] + [f"  {r.phase}: {r.n}" for r in queued.groupBy("phase").agg(F.count("*").alias("n")).orderBy("phase").collect()])
