"""Allow and block rules for URLs, as a sort-merge range join.

Host labels are reversed, so that a rule's host and path are a prefix of the keys
it fits, and the rule an interval of sorted keys. Intervals nest. A sweep over the
sorted keys carries the stack of rules that enclose the last rule begun; those of
the stack that are a prefix of a key are the rules that fit it.

Built-in column expressions throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"


def _part(url: str, group: int) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), _PARTS, group)


def host_of(url: str) -> Column:
    return F.translate(_part(url, 1), _UPPER, _LOWER)


def path_of(url: str) -> Column:
    return _part(url, 2)


def _reversed(host: str) -> Column:
    return F.reverse(F.split(host, "\\.", -1))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules (verdict, host, path) as a table."""
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def _stacks(rules: DataFrame) -> DataFrame:
    """Each rule's ``key`` and the ``stack`` of rules around it, itself the last.

    Of rules with the same host and path one is kept, a block before an allow.
    """
    host = F.translate("host", _UPPER, _LOWER)
    keyed = (
        rules.dropna(subset=["verdict", "host", "path"])
        .select(host.alias("host"), "path", "verdict")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("key", F.concat(F.array_join(_reversed("host"), "."), F.lit("/"), "path"))
    )
    around = keyed.select(F.col("key").alias("outer_key"), "host", "path", "verdict")
    ends = F.explode(F.sequence(F.lit(1), F.length("key"))).alias("n")
    prefixes = keyed.select("key", ends).select("key", F.expr("left(key, n)").alias("outer_key"))
    rule = F.struct(F.length("outer_key").alias("size"), "outer_key", "host", "path", "verdict")
    return (
        prefixes.join(around, "outer_key")
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(rule)).alias("stack"))
    )


def judge(
    pages: DataFrame,
    rules: DataFrame,
    columns: list[str],
    url: str = "url",
    default: str = ALLOW,
    salts: int | None = None,
) -> DataFrame:
    """``columns``, ``host``, ``path``, ``rule`` and ``verdict`` of every row.

    A rule (``verdict``, ``host``, ``path``) fits its host and all subdomains where
    the path starts with its path. The one with the longest host and path together
    wins, of equally long ones that with the longer host. Without one ``rule`` is
    null and the verdict ``default``. A null URL, or one without ``://``, has an
    empty host and path, which no rule fits. Rules with a null are left out.

    Each host and path is judged once, however many rows have it. The sweep is dealt
    over ``salts`` sorted parts, each with all rules and a share of the keys.
    """
    spark = pages.sparkSession
    salts = salts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [f"__{i}" for i in range(len(columns))]
    parsed = pages.select(
        *(F.col(c).alias(n) for c, n in zip(columns, names)),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
    )
    stacks = _stacks(rules)
    roots = stacks.select(F.substring_index("key", "/", 1).alias("root")).distinct()
    # a host has as many ancestors as labels; those deeper than all rules fit none
    deepest = roots.agg(F.max(F.size(F.split("root", "\\.", -1)))).scalar()
    depth = F.least(F.size("labels"), F.coalesce(deepest, F.lit(1)))
    ends = F.transform(F.sequence(F.lit(1), "depth"), lambda n: F.slice("labels", 1, n))
    keys = (
        parsed.select("host", "path")
        .filter("host != ''")
        .distinct()
        .withColumn("labels", _reversed("host"))
        .withColumn("depth", depth)
        .select("host", "path", F.explode(ends).alias("ancestor"))
        .select("host", "path", F.array_join("ancestor", ".").alias("root"))
        .join(roots, "root")
        .select(
            F.pmod(F.xxhash64("host", "path"), F.lit(salts)).alias("salt"),
            F.concat("root", F.lit("/"), "path").alias("key"),
            F.lit(1).alias("kind"),
            "host",
            "path",
        )
    )
    starts = stacks.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"),
        "key",
        F.lit(0).alias("kind"),
        "stack",
    )
    sweep = Window.partitionBy("salt").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    active = F.last("stack", ignorenulls=True).over(sweep)
    fits = F.filter("active", lambda r: F.startswith(F.col("key"), r["outer_key"]))
    best = F.element_at("fits", -1)
    judged = (
        keys.unionByName(starts, allowMissingColumns=True)
        .withColumn("active", active)
        .filter("kind = 1")
        .withColumn("fits", F.coalesce(fits, F.array()))
        .filter(F.size("fits") > 0)
        .select("host", "path", best.alias("best"))
        .select(
            "host",
            "path",
            F.struct(
                (F.length("best.host") + F.length("best.path")).alias("size"),
                F.length("best.host").alias("host_size"),
                F.concat("best.host", "best.path").alias("rule"),
                "best.verdict",
            ).alias("best"),
        )
        .groupBy("host", "path")
        .agg(F.max("best").alias("best"))
    )
    return parsed.join(judged, ["host", "path"], "left").select(
        *(F.col(n).alias(c) for c, n in zip(columns, names)),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


#: Rules of the registered query.
RULES = [
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
]

_VALUES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
SQL = f"""
WITH rules(verdict, host, path) AS (VALUES {_VALUES}),
parsed AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '{_PARTS}', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '{_PARTS}', 2) AS path
  FROM pages
)
SELECT p.page_id, p.host, p.path,
       arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
       coalesce(arg_max(r.verdict, length(r.host || r.path)), '{ALLOW}') AS verdict
FROM parsed p LEFT JOIN rules r
  ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
GROUP BY p.page_id, p.host, p.path
"""
