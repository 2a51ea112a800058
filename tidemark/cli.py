"""Command line: `python -m tidemark.cli validate|check|since|seed|docs|sidebars|links|catalogue|content ...`

Exit codes: 0 all good, 1 something broken or moved was found, or a run was
stopped by its gates (nothing is written then), 2 bad arguments.  What a site
answered comes as tables; no command fetches anything by itself.
"""

from __future__ import annotations

import argparse
import json
import sys

from .config import GateFailure, LedgerError, Site, UsageError


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark", description="Link validity and change ledger over cached tables.")
    sub = p.add_subparsers(dest="command", required=True)
    v = sub.add_parser("validate", help="a verdict for every link")
    v.add_argument("--tables", required=True, help="folder of Parquet tables: index, redirects, quarantine, modules, ...")
    v.add_argument("--confirm-live", metavar="TABLE", help="Parquet table of live answers (path, live_verdict, live_to) for broken and moved links")
    v.add_argument("--probe-unverifiable", action="store_true", help="let live answers decide unverifiable links as well")
    c = sub.add_parser("check", help="what the ledger records about links; none means no record, not that a link is good")
    c.add_argument("--all", action="store_true", help="list links without a record as well")
    for s in (v, c):
        s.add_argument("links", nargs="*")
        s.add_argument("--input", help="JSON array of links, - for standard input")
        s.add_argument("--host", help="the site's host; links of other hosts cannot be verified")
    n = sub.add_parser("since", help="the changes recorded since a day")
    n.add_argument("day")
    for s in (c, n):
        s.add_argument("--ledger", required=True, help="folder with removed.json and moved.json")
    d = sub.add_parser("seed", help="fill a ledger from a catalogue's history and from lists of links")
    d.add_argument("--tables", required=True, help="folder of Parquet tables, as for validate")
    d.add_argument("--ledger", required=True, help="folder with removed.json and moved.json, read and (unless --dry-run) written")
    d.add_argument("--history", action="append", default=[], metavar="FOLDER::FILE", help="a catalogue file in a git repository; may stand several times")
    d.add_argument("--urls", metavar="FILE", help="links, one a line or a JSON array")
    d.add_argument("--today", required=True, help="the day of the run, YYYY-MM-DD")
    d.add_argument("--max-probes", type=whole_number, default=None)
    d.add_argument("--answers", metavar="TABLE", help="Parquet table of probe answers (path, outcome, to, status)")
    d.add_argument("--no-probe", action="store_true")
    d.add_argument("--dry-run", action="store_true")
    d.add_argument("--min-modules", type=whole_number, default=1)
    o = sub.add_parser("docs", help="plan a pass over the documentation's sitemaps, or fold its answers in")
    o.add_argument("--tables", required=True, help="folder of Parquet tables: rows, catalogue, index, quarantine, redirects, and results of the pass")
    o.add_argument("--ledger", required=True, help="folder with removed.json and moved.json")
    o.add_argument("--out", help="folder for the new tables; without it only the plan is shown")
    o.add_argument("--today", required=True)
    o.add_argument("--sitemap-failed", action="store_true", help="a sitemap file could not be read: nothing counts as removed, and the index is not written")
    passes = []
    for name, text in PASSES.items():
        q = sub.add_parser(name, help=text)
        q.add_argument("--tables", required=True, help="folder of Parquet tables: inputs, answers, and what the run before left")
        q.add_argument("--out", help="folder for the new tables; without it only counts are shown")
        q.add_argument("--today", required=True)
        if name in ("catalogue", "content"):
            q.add_argument("--ledger", required=True, help="folder with removed.json and moved.json")
        if name == "catalogue":
            q.add_argument("--allowed", required=True, help="product categories in scope, by commas")
            q.add_argument("--full", action="store_true", help="read the units of all modules again")
        if name == "links":
            q.add_argument("--full-at", help="day of the last pass over all modules; without it this is the first run")
            q.add_argument("--full", action="store_true", help="read all modules again")
        if name == "sidebars":
            q.add_argument("--families", help="first path segments in scope, by commas")
            q.add_argument("--other-scope", action="store_true", help="the run before had another scope: use nothing of it")
        passes.append(q)
    for s in (d, o, *passes):
        s.add_argument("--host")
    for s in (v, c, n, d, o, *passes):
        s.add_argument("--output", help="write the JSON report there")
    return p


PASSES = {
    "sidebars": "ask folders for their sidebars, and keep those of folders that were not asked",
    "links": "keep the links of modules' last units, cleaned",
    "catalogue": "fold a download of the modules in, with removals, units and ledger",
    "content": "fold the typed content lists in, with removals and ledger",
}


def whole_number(text: str) -> int:
    if not text.isdigit():
        raise argparse.ArgumentTypeError(f"a whole number, not {text!r}")
    return int(text)


def urls_of(path: str) -> list[str]:
    """Links of a file: a JSON array of texts, or one a line; blank lines and lines with # are left out."""
    text = open(path, encoding="utf-8").read()
    if text.lstrip().startswith("["):
        links = json.loads(text)
        if not all(isinstance(x, str) for x in links):
            raise UsageError("links must be a JSON array of texts")
        return links
    return [x for x in (line.strip() for line in text.splitlines()) if x and not x.startswith("#")]


def tables_of(spark, folder: str, names) -> dict:
    from .sources import files

    return {n: spark.read.parquet(f"{folder}/{n}") for n in names if files.exists(spark, f"{folder}/{n}")}


def seed(spark, args) -> str:
    """The report of a seed run; the ledger is written unless it is a dry run."""
    from pyspark.sql import functions as F

    from .config import Limits
    from .operators.records import compact_snapshots
    from .plans import report, runs, validate
    from .sources import files
    from .sources.git_history import GitHistory, parse_spec

    for spec in args.history:
        try:
            parse_spec(spec)
        except ValueError as e:
            raise UsageError(str(e)) from e
    caches = validate.Caches(**tables_of(spark, args.tables, validate.Caches.__dataclass_fields__))
    have = caches.modules.count() if caches.modules is not None else 0
    if have < args.min_modules:
        raise UsageError(f"the catalogue has {have} modules, fewer than {args.min_modules}")
    snapshots = spark.createDataFrame([], "path string, day string, kind string")
    if args.history:
        spark.dataSource.register(GitHistory)
        raw = spark.read.format("git_history").option("specs", ";".join(args.history)).load().withColumn("time", F.date_format(F.timestamp_seconds("time"), "yyyy-MM-dd'T'HH:mm:ss"))
        m = compact_snapshots(raw.select("content", "time"), host=args.host).where("lastChecked is not null").withColumn("day", F.substring("lastChecked", 1, 10))
        snapshots = m.select("path", "day", F.lit("module").alias("kind")).unionByName(m.select(F.explode("unitUrls").alias("path"), "day", F.lit("unit").alias("kind"))).distinct()
    links = spark.createDataFrame([(u,) for u in urls_of(args.urls)] if args.urls else [], "url string")
    answers = spark.read.parquet(args.answers) if args.answers and not args.no_probe else spark.createDataFrame([], "path string, outcome string, to string, status int")
    budget = 0 if args.no_probe else Limits().probes if args.max_probes is None else args.max_probes
    changes = files.read_ledger(spark, args.ledger, args.host)
    live = [] if caches.modules is None else [caches.modules.where("not coalesce(hierarchyNotFound, false)").select("path"), caches.modules.select(F.explode("unitUrls").alias("path"))]
    live = spark.createDataFrame([], "path string") if not live else live[0].union(live[1]).distinct()
    found, compared, candidates = runs.seeded(snapshots, links, caches, changes, live, lambda q: answers.join(q.select("path"), "path", "left_semi"), Site(host=args.host or Site().host), Limits(probes=budget), args.today)
    text = report.seed_report(candidates, compared, {"snapshots": snapshots.select("day").distinct().count(), "links": links.count(), "modules": have}, args.dry_run, budget > 0)
    if not args.dry_run:
        files.write_ledger(found, args.ledger, f"{args.today}T00:00:00Z")
    return text


def docs(spark, args) -> str:
    """The plan's report; with --out the pass's new tables and ledger are written."""
    from .plans import report, runs
    from .sources import files

    t = tables_of(spark, args.tables, ("rows", "catalogue", "index", "quarantine", "redirects", "results"))
    if "rows" not in t:
        raise UsageError(f"no table of sitemap rows in {args.tables}")
    empty = {
        "catalogue": "path string, url string, title string, lastmod string, checked string", "index": "path string, lastmod string", "quarantine": "path string, url string, title string, status int, firstDetected string, lastChecked string",
        "redirects": "`from` string, to string, kind string, status int, firstSeen string, lastSeen string", "results": "path string, outcome string, status int, to string, title string, noindex boolean",
    }
    t = {n: spark.createDataFrame([], schema) for n, schema in empty.items()} | t
    out = runs.docs_run(t["rows"], t["catalogue"], t["index"], t["quarantine"], t["redirects"], t["results"], files.read_ledger(spark, args.ledger, args.host), args.today, Site(host=args.host or Site().host), sitemap_ok=not args.sitemap_failed)
    if args.out:
        for name, df in (("catalogue", out.records), ("quarantine", out.quarantine), ("redirects", out.redirects), *([("index", out.index)] if out.index_written else [])):
            files.write_if_changed(df, f"{args.out}/{name}")
        files.write_ledger(out.ledger, args.ledger, f"{args.today}T00:00:00Z")
    return report.plan_report(out.plan, runs.queue_budget(out.plan, today=args.today)) + "\n" + "\n".join(f"  {r.name}: {r.n}" for r in out.counts.collect())


def _given(spark, folder: str, schemas: dict[str, str], needed: tuple[str, ...]) -> dict:
    """Tables of a folder, empty ones where they are missing; those that are needed must be there."""
    t = tables_of(spark, folder, schemas)
    for name in needed:
        if name not in t:
            raise UsageError(f"no table {name} in {folder}")
    return {n: spark.createDataFrame([], schema) for n, schema in schemas.items() if n not in t} | t


def _kept(args, tables: dict, counts: dict) -> str:
    """Writes the tables of a run if it has a folder for them, and tells its counts."""
    from .sources import files

    written = [name for name, df in tables.items() if args.out and files.write_if_changed(df, f"{args.out}/{name}")]
    told = [f"{k}: {v}" for k, v in sorted(counts.items())]
    return "\n".join([*told, f"written: {', '.join(written) or 'nothing'}"])


def sidebars(spark, args) -> str:
    from .plans import sidebars as S

    t = _given(spark, args.tables, {"index": "path string, lastmod string", "tocs": S.TOCS, "none": S.NONE, "answers": "folder string, outcome string, toc string"}, ("index",))
    ask = lambda queue: t["answers"].join(queue.select("folder"), "folder", "left_semi")
    out = S.sidebar_run(t["index"], t["tocs"], t["none"], ask, args.today, families=args.families.split(",") if args.families else None, same_scope=not args.other_scope, host=args.host)
    counts = {"asked": out.asked, "failed": out.failed, "waiting": out.waiting, "without": out.none.count(), **out.tocs.transform(S.totals).first().asDict()}
    return _kept(args, {} if out.unchanged else {"tocs": out.tocs, "none": out.none}, counts)


def links(spark, args) -> str:
    from .plans import module_links as M
    from .plans import validate

    link = "array<struct<kind: string, path: string, url: string, text: string, section: string>>"
    schemas = {"modules": "path string, unitUrls array<string>, unitSig string", "scope": "path string", "records": M.RECORDS, "links": M.LINKS, "pages": f"path string, outcome string, unitTitle string, links {link}", "checks": "path string, verdict string, redirects_to string"}
    t = _given(spark, args.tables, schemas, ("modules",))
    scope = t["scope"] if "scope" in tables_of(spark, args.tables, ("scope",)) else t["modules"]
    caches = validate.Caches(**tables_of(spark, args.tables, validate.Caches.__dataclass_fields__))
    answered = lambda name: lambda queue: t[name].join(queue.select("path"), "path", "left_semi")
    out = M.module_link_run(t["modules"], scope, t["records"], t["links"], args.full_at, answered("pages"), caches, answered("checks"), args.today, site=Site(host=args.host or Site().host), first=not args.full_at, full=args.full)
    return _kept(args, {"records": out.records, "links": out.links}, out.counts | {"full_at": out.full_at})


def _answers(spark, t):
    return lambda queue: t["answers"].join(queue.select("path"), "path", "left_semi")


def catalogue(spark, args) -> str:
    from .plans import runs
    from .sources import files

    module = "uid string, title string, path string, products array<string>, units array<string>, lastModified string, firstUnitPath string"
    schemas = {
        "api": module, "units": "uid string, lastModified string", "taxonomy": "id string, name string, children array<struct<id: string, name: string>>", "previous": f"{module}, unitUrls array<string>, unitSig string, hierarchyNotFound boolean",
        "previous_removed": "uid string, path string, title string, lastSeen string, removedOn string", "fetched": "uid string, outcome string, urls array<string>", "answers": "path string, outcome string, to string, status int",
    }
    t = _given(spark, args.tables, schemas, ("api", "units", "taxonomy"))
    changes = files.read_ledger(spark, args.ledger, args.host)
    out = runs.catalogue_run(t["api"], t["units"], t["taxonomy"], t["previous"], t["previous_removed"], t["fetched"], changes, _answers(spark, t), args.allowed.split(","), args.today, full=args.full)
    counts = {"modules": out.modules.count(), "removed": out.removed.count(), "out_of_scope": out.out_of_scope.count(), "collisions": out.collisions.count(), "changes": out.ledger.count()}
    text = _kept(args, {"modules": out.modules, "removed": out.removed, "out_of_scope": out.out_of_scope}, counts)
    if args.out:
        files.write_ledger(out.ledger, args.ledger, f"{args.today}T00:00:00Z")
    return text


def content(spark, args) -> str:
    from .plans import runs
    from .sources import files

    item = "type string, uid string, title string, path string"
    schemas = {"current": item, "probes": "uid string, path string, outcome string", "previous": f"{item}, studyGuide string", "previous_removed": f"{item}, lastSeen string, removedOn string", "live": "path string", "answers": "path string, outcome string, to string, status int"}
    t = _given(spark, args.tables, schemas, ("current",))
    items, removed, ledger = runs.content_run(t["current"], t["probes"], t["previous"], t["previous_removed"], files.read_ledger(spark, args.ledger, args.host), t["live"], _answers(spark, t), args.today)
    text = _kept(args, {"items": items, "removed": removed}, {"items": items.count(), "removed": removed.count(), "changes": ledger.count()})
    if args.out:
        files.write_ledger(ledger, args.ledger, f"{args.today}T00:00:00Z")
    return text


def links_of(args, stdin) -> list[str]:
    if args.links:
        return args.links
    text = stdin.read() if args.input in (None, "-") else open(args.input, encoding="utf-8").read()
    try:
        links = json.loads(text)
    except ValueError as e:
        raise UsageError("links must be a JSON array") from e
    if not isinstance(links, list) or not all(isinstance(x, str) for x in links):
        raise UsageError("links must be a JSON array of texts")
    return links


def main(argv: list[str] | None = None, spark=None, stdin=sys.stdin, stdout=sys.stdout) -> int:
    try:
        args = parser().parse_args(argv)
    except SystemExit as e:
        return 2 if e.code else 0
    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    from .plans import report, validate
    from .sources import files

    try:
        run = {"seed": seed, "docs": docs, "sidebars": sidebars, "links": links, "catalogue": catalogue, "content": content}.get(args.command)
        if run:
            text = run(spark, args)
            if args.output:
                with open(args.output, "w", encoding="utf-8") as f:
                    f.write(text + "\n")
            else:
                print(text, file=stdout)
            return 0
        if args.command == "since":
            rows = report.changelog(files.read_ledger(spark, args.ledger), args.day)
        else:
            given = spark.createDataFrame([(x, i) for i, x in enumerate(links_of(args, stdin))], "url string, ord int")
            if args.command == "check":
                rows = report.check_links(given, files.read_ledger(spark, args.ledger, args.host), host=args.host, all_links=args.all)
            else:
                tables = tables_of(spark, args.tables, validate.Caches.__dataclass_fields__)
                rows = validate.validate(given, validate.Caches(**tables), Site(host=args.host or Site().host), host=args.host)
                if "ledger" in tables:
                    rows = validate.enriched(rows, tables["ledger"])
                if args.confirm_live:
                    rows = validate.with_live(rows, spark.read.parquet(args.confirm_live), args.probe_unverifiable)
                rows = rows.orderBy("ord").drop("ord")
        out = [r.asDict(recursive=True) for r in rows.collect()]
    except GateFailure as e:
        print(e, file=sys.stderr)
        return 1
    except (UsageError, LedgerError) as e:
        print(e, file=sys.stderr)
        return 2
    text = json.dumps({"command": args.command, "rows": out}, indent=1, ensure_ascii=False)
    if args.output:
        with open(args.output, "w", encoding="utf-8") as f:
            f.write(text + "\n")
    else:
        print(text, file=stdout)
    bad = {"broken", "moved", "removed"}
    return int(args.command != "since" and any((r.get("verdict") or r.get("status")) in bad for r in out))


if __name__ == "__main__":
    sys.exit(main())
