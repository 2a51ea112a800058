"""Gates: every rule is a row (rule, ok, observed, bound, message)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import GateFailure

GATE = "rule string, ok boolean, observed double, bound double, message string"


def gate(spark: SparkSession, rule: str, observed: float, bound: float, ok: bool, message: str) -> DataFrame:
    return spark.createDataFrame([(rule, bool(ok), float(observed), float(bound), None if ok else message)], GATE)


def floor_gate(spark: SparkSession, rule: str, count: int, least: int) -> DataFrame:
    return gate(spark, rule, count, least, count >= least, f"{rule}: {count} is below {least}")


def drop_percent(before: float, after: float) -> float:
    return max(0.0, (before - after) / before * 100) if before > 0 else 0.0


def drop_gate(spark: SparkSession, rule: str, before: int, after: int, most_percent: float) -> DataFrame:
    drop = drop_percent(before, after)
    return gate(spark, rule, drop, most_percent, drop <= most_percent, f"{rule}: {before} to {after} is a drop of {drop:.2f}%, more than {most_percent}%")


def ratio_gate(spark: SparkSession, rule: str, part: int, whole: int, most_percent: float, least_sample: int = 0) -> DataFrame:
    """part of whole at most so many percent; too small samples pass."""
    share = part / whole * 100 if whole else 0.0
    return gate(spark, rule, share, most_percent, whole < least_sample or share <= most_percent, f"{rule}: {part} of {whole} is {share:.2f}%, more than {most_percent}%")


def kept_gate(spark: SparkSession, rule: str, before: int, after: int, least_percent: float) -> DataFrame:
    share = after / before * 100 if before else 100.0
    return gate(spark, rule, share, least_percent, share >= least_percent, f"{rule}: {after} of {before} kept is {share:.2f}%, less than {least_percent}%")


def size_floor(previous: int, absolute: int = 20_000, ratio: float = 0.6) -> int:
    return max(absolute, int(-(-(previous * ratio) // 1)))


def index_baseline(previous: int, catalogue: int, ratio: float = 0.85, bootstrap: float = 0.5) -> tuple[int, float, str]:
    """(count, ratio, source) that a new index is held against: the last index, or at first the catalogue."""
    return (previous, ratio, "index") if previous else (catalogue, bootstrap, "catalogue")


def index_gate(spark: SparkSession, new: int, baseline: tuple[int, float, str]) -> DataFrame:
    count, ratio, source = baseline
    least = int(-(-(count * ratio) // 1))
    return gate(spark, "index-size", new, least, new >= least, f"index-size: {new} paths, below {least} ({ratio} of the {source})")


def duplicates_gate(rows: DataFrame, url: str, key: str, most: int = 50) -> DataFrame:
    """Groups of equal URLs, and of URLs with one key, at most so many."""
    spark = rows.sparkSession
    exact = rows.groupBy(url).count().where("count > 1").count()
    alias = rows.groupBy(key).agg(F.countDistinct(url).alias("n")).where("n > 1").count()
    return gate(spark, "exact-duplicates", exact, most, exact <= most, f"{exact} duplicated URLs").unionByName(gate(spark, "alias-duplicates", alias, most, alias <= most, f"{alias} pages under several URLs"))


def category_coverage(allowed: DataFrame, counts: DataFrame, previous: DataFrame, known_empty: DataFrame, live_uids: DataFrame) -> DataFrame:
    """id, state of every allowed category without modules.

    problem: it had modules that are still served; emptied: none of them is;
    still-empty: it had none; exempt: known to be empty; new: not known before.
    previous (id, uids).
    """
    empty = allowed.select("id").join(counts.where("n > 0").select("id"), "id", "left_anti")
    alive = previous.select("id", F.explode("uids").alias("uid")).join(live_uids.select("uid").distinct(), "uid").groupBy("id").agg(F.count("*").alias("alive"))
    old = previous.select("id", F.size("uids").alias("had")).join(alive, "id", "left")
    rows = empty.join(known_empty.select("id").withColumn("exempt", F.lit(True)), "id", "left").join(old, "id", "left")
    state = F.when(F.col("exempt"), "exempt").when(F.col("had").isNull(), "new").when(F.col("had") == 0, "still-empty").when(F.col("alive") > 0, "problem").otherwise("emptied")
    return rows.select("id", state.alias("state"))


def recovered(known_empty: DataFrame, counts: DataFrame) -> DataFrame:
    return known_empty.select("id").join(counts.where("n > 0").select("id"), "id", "left_semi")


def content_gates(previous: DataFrame, current: DataFrame, most_percent: float, floors: dict[str, int]) -> DataFrame:
    """Per type: not below its floor, not dropped too much.  previous and current (type, n)."""
    rows = previous.select("type", F.col("n").alias("before")).join(current.select("type", F.col("n").alias("after")), "type", "full").na.fill(0)
    least = F.coalesce(F.element_at(F.create_map(*[x for k, v in {"": 0, **floors}.items() for x in (F.lit(k), F.lit(v))]), F.col("type")), F.lit(0))
    drop = F.when(F.col("before") > 0, F.greatest(F.lit(0.0), (F.col("before") - F.col("after")) / F.col("before") * 100)).otherwise(0.0)
    ok = (F.col("after") >= least) & (drop <= most_percent)
    return rows.select(F.concat(F.lit("content:"), "type").alias("rule"), ok.alias("ok"), F.col("after").cast("double").alias("observed"), least.cast("double").alias("bound"), F.when(~ok, F.concat_ws(" ", "type", F.lit("has"), F.col("after").cast("string"), F.lit("rows"))).alias("message"))


def contract(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """rule, failed: how many rows break each rule (null counts as broken), in one pass."""
    made = rows.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()])
    return made.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("failed")) for n in rules])).alias("r")).select("r.*")


def breaker(attempted: int, failed: int, least: int = 50) -> bool:
    """More than half of at least so many failed."""
    return attempted >= least and failed * 2 > attempted


class Streak:
    """Trips after so many bad answers in a row."""

    def __init__(self, most: int) -> None:
        self.most, self.run = most, 0

    def add(self, bad: bool) -> bool:
        self.run = self.run + 1 if bad else 0
        return self.run >= self.most


def enforce(*gates: DataFrame) -> None:
    """Raise GateFailure with the messages of all gates that fail."""
    problems = [r.message for r in reduce(DataFrame.unionByName, gates).where("not ok").collect()]
    if problems:
        raise GateFailure(problems)
