"""URL filters by a sort-merge range join over reversed-host keys.

A rule (host, path) fits the urls of its host and of all subdomains whose path
starts with the rule's. The canonical key of a rule is its host with the labels
reversed, a ``/`` and the path; a url is looked up under one key for each suffix
of its host. Then "fits" means "the rule's key is a prefix", and a rule is the
interval from its key to its key followed by the byte 0xFF, which UTF-8 never
holds. Intervals are nested or apart.

Sweep. Interval starts, ends and url keys are sorted together by range
partitioning, with a salt behind the key so that a key of many hosts is split.
Each chunk first gets the rules that earlier chunks left open. In a chunk, the
running sum of starts and ends is the height of the stack of active rules, and
the top of the stack is the last rule that started at that height: one window
keeps the heights, a second one the register of each height. Of a url's keys the
longest rule (host and path together) wins, of equally long ones that of the
longer host.

Only DataFrame functions are used. Distinct (host, path) pairs are swept, so
repeated urls cost one lookup; the result is joined back to the rows.

Defined results: null urls and urls without ``://`` have an empty host and path
and fit no rule; a url no rule fits gets the verdict ``default`` ("allow": what
is not listed stays); of equal rules with different verdicts "block" counts;
rules with a null host or verdict are ignored, a null path is an empty one;
repeated rows and null ids are judged like others; an empty table gives an empty
result. Columns of the input are returned only if named in ``keep``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readerflow.operators.barrier import materialize
from readerflow.session import scratch_path

from .common import LOWER, UPPER, put, table

# The rules of op13, as the task gives them.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
START, PROBE, END = 0, 1, 2


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host with A-Z lower-cased, path) of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def labels(host: Column) -> Column:
    """Labels of a host, last one first."""
    return F.reverse(F.split(host, "\\.", -1))


def rule_table(spark: SparkSession, rules) -> DataFrame:
    """(host, path, verdict) of literal rules."""
    rows = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules])
    return spark.range(1).select(F.inline(rows))


def canonical(rules: DataFrame) -> DataFrame:
    """(key, n_labels, rule, verdict), one row a rule."""
    host = F.translate("host", UPPER, LOWER)
    r = rules.where("host IS NOT NULL AND verdict IS NOT NULL").select(host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    return (r.select(F.concat(F.array_join(labels(F.col("host")), "."), F.lit("/"), F.col("path")).cast("binary").alias("key"),
                     F.size(labels(F.col("host"))).alias("n_labels"), F.concat("host", "path").alias("rule"), "verdict")
            .groupBy("key", "n_labels", "rule").agg(F.max("verdict").alias("verdict")))


def matched_rules(urls: DataFrame, rules: DataFrame, chunks: int | None = None) -> DataFrame:
    """(host, path, rule, verdict) of the distinct (host, path) rows that a rule fits."""
    spark, root = urls.sparkSession, scratch_path(urls.sparkSession, "url-filters")
    chunks = chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rules = canonical(rules)
    # a longer suffix of a host than any rule's host fits none
    deepest = rules.agg(F.max("n_labels")).first()[0] or 0
    if not deepest:
        return urls.select("host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict")).limit(0)
    held = F.struct(F.char_length("rule").alias("size"), "n_labels", "rule", "verdict")
    none = F.lit(None).cast("string")
    edges = rules.select("key", held.alias("held"))
    edges = (edges.select("key", F.lit(START).alias("kind"), F.col("key").alias("lo"), "held", none.alias("host"), none.alias("path"), F.lit(0).cast("long").alias("salt"))
             .union(edges.select(F.concat("key", F.lit(b"\xff")), F.lit(END), "key", "held", none, none, F.lit(0).cast("long"))))
    rows = materialize(urls.select("host", "path"), rev=labels(F.col("host")))
    rows = rows.select("host", "path", "rev", F.explode(F.sequence(F.lit(1), F.least(F.size("rev"), F.lit(deepest)))).alias("k"))
    key = F.concat(F.array_join(F.slice("rev", 1, F.col("k")), "."), F.lit("/"), F.col("path")).cast("binary")
    probes = rows.select(key.alias("key"), F.lit(PROBE).alias("kind"), F.lit(None).cast("binary").alias("lo"),
                         F.lit(None).cast(edges.schema["held"].dataType).alias("held"), "host", "path", F.xxhash64("host").alias("salt"))
    dealt = edges.union(probes).repartitionByRange(chunks, "key", "kind", "salt").withColumn("chunk", F.spark_partition_id())
    columns = ("chunk", "key", "kind", "lo", "held", "host", "path")
    dealt = put(dealt.select(*columns), f"{root}/sorted", f"chunk int, key binary, kind int, lo binary, held {edges.schema['held'].dataType.simpleString()}, host string, path string")

    # rules that are open where a chunk begins
    span = (dealt.where(F.col("kind") != PROBE).groupBy("lo").agg(F.min("chunk").alias("a"), F.max("chunk").alias("b"), F.first("held").alias("held")).where("b > a"))
    carried = span.select(F.explode(F.sequence(F.col("a") + 1, F.col("b"))).alias("chunk"), F.col("lo").alias("key"), F.lit(START).alias("kind"), "lo", "held", none.alias("host"), none.alias("path"))

    step = F.when(F.col("kind") == START, 1).when(F.col("kind") == END, -1).otherwise(0)
    by_key = Window.partitionBy("chunk").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    register = Window.partitionBy("chunk", "height").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = dealt.union(carried.select(*columns)).withColumn("height", F.sum(step).over(by_key))
    swept = swept.withColumn("top", F.last(F.when(F.col("kind") == START, F.col("held")), ignorenulls=True).over(register))
    best = swept.where(f"kind = {PROBE} AND height > 0").groupBy("host", "path").agg(F.max("top").alias("top"))
    return best.select("host", "path", "top.rule", "top.verdict")


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow",
               keep: tuple[str, ...] = (), chunks: int | None = None) -> DataFrame:
    """Per row: the id, host, path, rule (null if none fits), verdict and the columns of ``keep``."""
    spark = pages.sparkSession
    host, path = url_parts(F.col(url_col).cast("string"))
    rows = materialize(pages.select(id_col, url_col, *keep), __host=host, __path=path).select(id_col, F.col("__host").alias("host"), F.col("__path").alias("path"), *keep)
    urls = put(rows.where("host <> ''").select("host", "path").distinct(), scratch_path(spark, "urls"), "host string, path string")
    found = matched_rules(urls, rules, chunks)
    return rows.join(found, ["host", "path"], "left").select(id_col, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"), *keep)


def keep_allowed(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", keep: tuple[str, ...] = ()) -> DataFrame:
    """The rows whose verdict is not "block"."""
    return judge_urls(pages, rules, id_col, url_col, default, keep).where("verdict <> 'block'")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), rule_table(spark, RULES))


_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
ORACLE = f"""
WITH r(rhost, rpath, rverdict) AS (VALUES {_RULES_SQL}),
u AS (SELECT row_number() OVER () AS rid, page_id,
             CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT rid, page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS (SELECT rid, arg_max(struct_pack(rule := rhost || rpath, verdict := rverdict), length(rhost || rpath)) AS best
      FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY rid)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (rid)
"""
