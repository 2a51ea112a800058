"""Queries of the runs that carry tables forward: sidebars, module links, the ledger's refresh, queues that trip."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ledger, queues
from ..sources.shared import dealt, tasks_for
from . import docs_pass, module_links, sidebars
from .catalogue import T, query

_NO_TOC = "coalesce(strftime(max(o_orderdate), '%Y-%m-%d'), '1999-01-01')"


@query(f"""WITH f AS (SELECT '/c' || o_custkey AS folder, count(*) AS n FROM orders GROUP BY 1), t AS (SELECT '/c' || c_custkey AS folder FROM customer WHERE c_acctbal > 6000),
 e AS (SELECT '/c' || c_custkey AS folder, {_NO_TOC} AS day FROM customer LEFT JOIN orders ON o_custkey = c_custkey WHERE c_mktsegment = 'MACHINERY' GROUP BY 1),
 a AS (SELECT folder, e.day, e.folder IS NOT NULL AS had, CASE WHEN n IS NULL THEN 'dropped' WHEN t.folder IS NOT NULL THEN 'refresh' WHEN n < 8 THEN 'small' WHEN date_diff('day', CAST(e.day AS DATE), DATE '2000-06-01') < 100 THEN 'answered' ELSE 'ask' END AS action FROM f FULL JOIN t USING (folder) FULL JOIN e USING (folder))
 SELECT folder, CASE WHEN action <> 'ask' THEN action WHEN row_number() OVER (PARTITION BY action ORDER BY had, coalesce(day, ''), folder) <= 60 THEN 'probe' ELSE 'wait' END AS action FROM a""")
def sidebar_plan(spark, sf):
    """Customers as folders, their orders as pages; some have a sidebar, some are known to have none."""
    o, c = T(spark, sf, "orders"), T(spark, sf, "customer")
    name = lambda k: F.concat(F.lit("/c"), k)
    last = o.groupBy("o_custkey").agg(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("day"))
    none = c.where("c_mktsegment = 'MACHINERY'").join(last, F.col("c_custkey") == F.col("o_custkey"), "left").select(name("c_custkey").alias("folder"), F.coalesce("day", F.lit("1999-01-01")).alias("day"))
    index = o.select(F.concat(name("o_custkey"), F.lit("/o"), "o_orderkey").alias("path"))
    limits = sidebars.SidebarLimits(least_pages=8, probes=60, recheck_days=100)
    return sidebars.plan(index, c.where("c_acctbal > 6000").select(name("c_custkey").alias("toc")), none, "2000-06-01", limits)


@query("""WITH c AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id) SELECT '/c/' || conv_id AS folder, CASE WHEN n IN (3, 4) THEN '2024-01-01' ELSE '2024-06-01' END AS day, CASE WHEN n > 2 THEN n END AS pages FROM c""")
def sidebar_merge(spark, sf):
    """Conversations as folders: the run before knew their first four turns, and of those with eight that they had none; two turns: none any more; three: no answer."""
    c = T(spark, sf, "conversations").select(F.concat(F.lit("/c/"), "conv_id").alias("folder"), "role", "turn")
    turns = c.groupBy("folder").agg(F.count("*").alias("n"))

    def groups(rows):
        g = rows.groupBy("folder", "role").agg(F.sort_array(F.collect_list(F.format_string("%s/t%04d", "folder", "turn"))).alias("pages"))
        one = F.struct(F.array("role").alias("title"), F.lit(None).cast("string").alias("landing"), "pages")
        return g.groupBy("folder").agg(F.sort_array(F.collect_list(one)).alias("groups"))

    none = spark.createDataFrame([], "folder string, outcome string, groups " + sidebars.GROUPS)
    early = groups(c.where("turn < 4").join(turns.where("n < 8"), "folder", "left_semi")).select("folder", F.lit("ok").alias("outcome"), "groups")
    tocs = sidebars.merged(spark.createDataFrame([], sidebars.TOCS), spark.createDataFrame([], sidebars.NONE), spark.createDataFrame([], "folder string, action string"), none.unionByName(early), "2024-01-01")[0]
    now = groups(c).join(turns, "folder").select("folder", F.when(F.col("n") == 2, "none").when(F.col("n") == 3, "failed").otherwise("ok").alias("outcome"), "groups")
    after, without = sidebars.merged(tocs, turns.where("n >= 8").select("folder", F.lit("2024-01-01").alias("day")), spark.createDataFrame([], "folder string, action string"), now, "2024-06-01")
    return after.select(F.col("toc").alias("folder"), F.col("since").alias("day"), F.col("pages").cast("long").alias("pages")).unionByName(without.select("folder", "day", F.lit(None).cast("long").alias("pages")))


def _harvest(spark, sf):
    """(modules, scope, records): orders as modules, their lines as units; orders before 1998 were harvested, when all had one priority."""
    o = T(spark, sf, "orders").withColumn("path", F.concat(F.lit("/training/modules/m"), "o_orderkey"))
    units = T(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_set(F.concat(F.lit("/training/modules/m"), "l_orderkey", F.lit("/"), "l_linenumber"))).alias("unitUrls"))
    modules = o.join(units, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("path", "unitUrls", F.concat("o_orderstatus", F.col("o_orderpriority")).alias("unitSig"), "o_custkey", "o_orderstatus")
    none = F.lit(None).cast("string")
    records = o.where("o_orderdate < '1998-01-01'").select("path", F.concat("o_orderstatus", F.lit("3-MEDIUM")).alias("unitSig"), none.alias("unit"), none.alias("unitTitle"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("harvestedAt"))
    scope = modules.join(T(spark, sf, "customer").where("c_acctbal > 0"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("path")
    return modules, scope, records


_HARVEST = """m AS (SELECT o_orderkey, o_orderstatus, o_orderstatus || o_orderpriority AS sig, CASE WHEN o_orderdate < '1998-01-01' THEN o_orderstatus || '3-MEDIUM' END AS old, strftime(o_orderdate, '%Y-%m-%d') AS day, '/training/modules/m' || o_orderkey AS path FROM orders),
 s AS (SELECT m.* FROM m JOIN orders USING (o_orderkey) JOIN customer ON c_custkey = o_custkey WHERE c_acctbal > 0)"""


@query(f"""WITH {_HARVEST}, u AS (SELECT l_orderkey, max('/training/modules/m' || l_orderkey || '/' || l_linenumber) AS unit FROM lineitem GROUP BY 1),
 r AS (SELECT path, unit, CASE WHEN unit IS NULL THEN -1 WHEN old IS NULL THEN 0 WHEN old <> sig THEN 1 ELSE 2 END AS k, CASE WHEN old IS NOT NULL THEN day ELSE '' END AS h FROM s LEFT JOIN u ON l_orderkey = o_orderkey)
 SELECT path, unit, CASE WHEN k < 0 THEN 'no-units' WHEN row_number() OVER (PARTITION BY k < 0 ORDER BY k, h, path) <= 9000 THEN 'fetch' ELSE 'wait' END AS action FROM r""")
def module_link_plan(spark, sf):
    return module_links.plan(*_harvest(spark, sf), True, 9000).select("path", "unit", "action")


@query(f"""WITH {_HARVEST} SELECT path, CASE WHEN o_orderstatus = 'O' THEN sig ELSE old END AS "unitSig", CASE WHEN o_orderstatus = 'O' THEN '2001-01-01' ELSE day END AS "harvestedAt" FROM s WHERE o_orderstatus = 'O' OR (old IS NOT NULL AND (o_orderstatus <> 'P' OR old = sig))""")
def module_links_carried(spark, sf):
    """Open orders were fetched, pending ones failed."""
    modules, scope, records = _harvest(spark, sf)
    inside = modules.join(scope, "path", "left_semi")
    none = F.lit(None).cast("string")
    fetched = inside.where("o_orderstatus = 'O'").select("path", "unitSig", none.alias("unit"), none.alias("unitTitle"), F.lit("2001-01-01").alias("harvestedAt"))
    return module_links.carried(modules, scope, records, fetched, inside.where("o_orderstatus = 'P'")).select("path", "unitSig", "harvestedAt")


@query("""WITH d AS (SELECT l_orderkey AS module, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS pos, CASE WHEN l_returnflag = 'A' THEN 'external' ELSE 'docs' END AS kind, '/docs/p' || l_partkey AS path, 'https://s' || l_suppkey || '.example/' AS url, CASE WHEN p_size < 10 THEN 'drop' WHEN p_size < 20 THEN 'rewrite' WHEN p_size < 30 THEN 'unverified' WHEN p_size < 40 THEN 'keep' END AS d, '/docs/brands/' || replace(lower(p_brand), '#', '-') AS t FROM lineitem JOIN part ON p_partkey = l_partkey)
 SELECT module, CAST(pos AS INT) AS pos, kind, CASE WHEN kind = 'external' THEN url WHEN d = 'rewrite' THEN t ELSE path END AS target, CASE WHEN kind = 'docs' AND d = 'rewrite' THEN path END AS was, CASE WHEN kind = 'docs' AND d IN ('keep', 'rewrite') THEN '2024-06-01' END AS checked, kind = 'docs' AND coalesce(d = 'unverified', false) AS unverified FROM d WHERE kind = 'external' OR coalesce(d, '') <> 'drop' QUALIFY row_number() OVER (PARTITION BY module, kind, target ORDER BY pos) = 1""")
def module_links_cleaned(spark, sf):
    """Lines as links to parts, by live checks that go by the part's size."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    lines = T(spark, sf, "lineitem")
    lines = dealt(lines, tasks_for(lines), "l_orderkey").withColumn("pos", F.row_number().over(queues.Window.partitionBy("l_orderkey").orderBy(*order)))
    none, outside = F.lit(None).cast("string"), F.col("l_returnflag") == "A"
    links = lines.select(
        F.col("l_orderkey").alias("module"), "pos", F.when(outside, "external").otherwise("docs").alias("kind"), F.when(~outside, F.concat(F.lit("/docs/p"), "l_partkey")).alias("path"),
        F.when(outside, F.concat(F.lit("https://s"), "l_suppkey", F.lit(".example/"))).alias("url"), none.alias("text"), none.alias("section"), none.alias("was"), none.alias("checked"), F.lit(False).alias("unverified"),
    )
    size = F.col("p_size")
    decision = F.when(size < 10, "drop").when(size < 20, "rewrite").when(size < 30, "unverified").when(size < 40, "keep")
    told = T(spark, sf, "part").select(F.concat(F.lit("/docs/p"), "p_partkey").alias("path"), decision.alias("decision"), F.lit("probe").alias("via"), F.concat(F.lit("/docs/brands/"), F.replace(F.lower("p_brand"), F.lit("#"), F.lit("-"))).alias("to")).where("decision is not null")
    out = module_links.applied(links, told, "2024-06-01").where("decision <> 'drop'")
    return out.select("module", "pos", "kind", F.coalesce("url", "path").alias("target"), "was", "checked", "unverified")


@query("""WITH q AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS n FROM events), s AS (SELECT event_id, n, event_type = 'error' AS bad, n - max(CASE WHEN event_type <> 'error' THEN n ELSE 0 END) OVER (ORDER BY n) AS run FROM q)
 SELECT event_id, n AS queue_pos FROM s WHERE n <= coalesce((SELECT min(n) FROM s WHERE bad AND run >= 5), (SELECT max(n) FROM s))""")
def queue_trip(spark, sf):
    """Events as answers in the order of their attempts: five errors in a row stop the queue."""
    rows = queues.numbered(T(spark, sf, "events").select("ts", "event_id", "event_type"), "ts", "event_id")
    return queues.before_trip(rows, "queue_pos", F.col("event_type") == "error", 5).select("event_id", "queue_pos")


_UNIT = "'/training/modules/m' || l_orderkey || '/u' || l_linenumber"


@query(f"""WITH m AS (SELECT '/training/modules/m' || o_orderkey AS path, o_orderkey, substr(o_orderpriority, 1, 1) AS p FROM orders WHERE o_orderstatus = 'P'),
 l AS (SELECT l_orderkey, {_UNIT} AS path, max(l_returnflag) AS f FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1, 2),
 u AS (SELECT l.path, f, p FROM l LEFT JOIN m ON o_orderkey = l_orderkey WHERE coalesce(p, '') NOT IN ('2', '5'))
 SELECT path, CASE p WHEN '2' THEN 'gone' WHEN '3' THEN 'moved' WHEN '4' THEN 'unverified' ELSE 'landing' END AS outcome, CASE WHEN p <> '4' THEN '2024-06-01' END AS verified FROM m WHERE p <> '1'
 UNION ALL SELECT path, CASE WHEN f = 'R' AND coalesce(p, '') = '4' THEN 'unverified' ELSE 'gone' END, CASE WHEN f = 'A' THEN '2024-01-01' WHEN coalesce(p, '') <> '4' THEN '2024-06-01' END FROM u""")
def refreshed_ledger(spark, sf):
    """Pending orders as lost modules, returned lines as lost units, others known before: probes answer by the order's priority."""
    o, none = T(spark, sf, "orders"), F.lit(None).cast("string")
    module = lambda k: F.concat(F.lit("/training/modules/m"), k)
    units = T(spark, sf, "lineitem").where("l_returnflag in ('A', 'R')").groupBy("l_orderkey", F.concat(module("l_orderkey"), F.lit("/u"), "l_linenumber").alias("path")).agg(F.max("l_returnflag").alias("f"))
    known = units.where("f = 'A'").select(F.lit("removed").alias("file"), "path", F.lit("unit").alias("kind"), F.lit("learn").alias("family"), F.lit("gone").alias("outcome"), none.alias("to"), none.alias("title"), none.alias("parent"), F.lit("2023-01-01").alias("firstSeen"), F.lit("2024-01-01").alias("lastVerified"), F.lit("unit-diff").alias("evidence"), F.lit(404).alias("status"))
    lost = o.where("o_orderstatus = 'P'").select(module("o_orderkey").alias("path"), F.lit("module").alias("kind"), F.lit("tombstone").alias("evidence"))
    new = lost.unionByName(units.where("f = 'R'").select("path", F.lit("unit").alias("kind"), F.lit("unit-diff").alias("evidence"))).select("path", "kind", none.alias("parent"), none.alias("title"), "evidence", none.alias("firstSeen"))
    priority = F.substr("o_orderpriority", F.lit(1), F.lit(1))
    answer = F.when(priority == "1", "live").when(priority == "2", "gone").when(priority == "3", "moved").when(priority == "4", "transient").otherwise("landing")
    answers = o.select(module("o_orderkey").alias("path"), answer.alias("answer"))

    def probe(queue):
        told = queue.join(answers, "path", "left")
        return told.select("path", F.coalesce("answer", F.lit("gone")).alias("outcome"), F.when(F.col("answer") == "moved", F.concat("path", F.lit("-new"))).alias("to"), F.lit(None).cast("int").alias("status"))

    out = ledger.refresh(known, new, spark.createDataFrame([], "path string"), "learn", "2024-06-01", probe, 100_000_000, reverify=0)
    return out.select("path", "outcome", F.col("lastVerified").alias("verified"))


_PHASE = "CASE event_type WHEN 'click' THEN 'fetch' WHEN 'purchase' THEN 'missing' WHEN 'signup' THEN 'quarantine' ELSE 'verify' END"


@query(f"""WITH e AS (SELECT {_PHASE} AS phase, event_id, value < 60 AS bad, epoch(ts) - min(epoch(ts)) OVER () AS sec, row_number() OVER (PARTITION BY {_PHASE} ORDER BY ts, event_id) AS n FROM events),
 s AS (SELECT *, n - max(CASE WHEN bad THEN 0 ELSE n END) OVER (PARTITION BY phase ORDER BY n) AS run, max(n) OVER (PARTITION BY phase) AS last FROM e),
 c AS (SELECT phase, min(CASE WHEN bad AND run >= 9 AND n < last THEN n END) AS b, min(CASE WHEN sec >= 1296000 THEN n END) - 1 AS d FROM s GROUP BY phase)
 SELECT phase, CAST(event_id AS VARCHAR) AS key, CASE WHEN bad THEN 'transient' ELSE 'live' END AS outcome FROM s JOIN c USING (phase) WHERE n <= least(coalesce(b, last), coalesce(d, last))""")
def phase_answers(spark, sf):
    """Events as answers in four phases, under one clock of 15 days; nine small values in a row stop a phase."""
    e = T(spark, sf, "events")
    phase = F.when(F.col("event_type") == "click", "fetch").when(F.col("event_type") == "purchase", "missing").when(F.col("event_type") == "signup", "quarantine").otherwise("verify")
    at = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    began = e.agg(F.min(at).alias("m")).first().m
    rows = e.select(phase.alias("phase"), F.col("event_id").cast("string").alias("key"), "ts", "event_id", F.when(F.col("value") < 60, "transient").otherwise("live").alias("outcome"), (at - began).alias("at"))
    own = queues.Window.partitionBy("phase").orderBy("ts", "event_id")
    queue = rows.select("phase", "key", F.row_number().over(own).cast("long").alias("queue_pos"))
    none = F.lit(None).cast("string")
    answers = rows.select("key", "outcome", F.lit(None).cast("int").alias("status"), none.alias("to"), none.alias("title"), F.lit(False).alias("noindex"), "at", "phase")
    told = docs_pass.run_phases(queue, lambda q: answers.join(q.select("key"), "key", "left_semi"), 9, 15 * 24 * 60)
    return told.answers.select("phase", "key", "outcome")


@query("""WITH p AS (SELECT url, page_id, regexp_extract(url, '^https?://([^/?#]*)', 1) AS source FROM pages) SELECT page_id, url, source, CASE WHEN starts_with(source, 'm.') THEN 'before' ELSE 'now' END AS title FROM p WHERE starts_with(source, 'm.') OR contains(url, '?')""")
def other_sources(spark, sf):
    """Hosts as sources: mobile ones could not be read, of the others the pages with a query were found."""
    p = T(spark, sf, "pages").select("page_id", "url", F.regexp_extract("url", r"^https?://([^/?#]*)", 1).alias("source"))
    mobile = F.col("source").startswith("m.")
    fresh = p.where(~mobile & F.col("url").contains("?")).withColumn("title", F.lit("now"))
    return docs_pass.other_sources(p.withColumn("title", F.lit("before")), fresh, p.where(mobile).select("source"))
