"""URL verdicts by pattern rules, each indexed by the rarest of its literal tokens."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pairtables.llm.common import lower_ascii

#: A rule index below both bounds is broadcast; beyond them it is joined by a shuffle.
MAX_INDEX_ROWS, MAX_INDEX_CHARS = 100_000, 16 * 1024 * 1024
#: Rules without literals, which are run on every url.
MAX_ALWAYS = 1_000
RULES = "rule string, action string, pattern string, named boolean, literals array<string>"


@dataclass(frozen=True)
class Rule:
    """A regular expression over ``host + path``. ``literals`` are tokens (letters and digits,
    lower case) that every url it fits has; without any, it is run on every url. Of fitting
    rules the longest ``name`` wins, ``named`` ones before others; then block before allow,
    then the smaller name."""

    name: str
    action: str
    pattern: str
    literals: tuple[str, ...] = field(default=())
    named: bool = False


def prefix_rule(host: str, path: str, action: str) -> Rule:
    """A host and its subdomains, and the start of a path (from its ``/``)."""
    whole = re.findall(r"[a-z0-9]+", host)
    # What ends at the end of the path may go on in the url, so it is no token of its own.
    ends = path if path.endswith("/") else path.rpartition("/")[0]
    whole += re.findall(r"[a-z0-9]+", ends.lower())
    quoted = re.escape(host) + re.escape(path)
    return Rule(host + path, action, rf"^(?:[^/]*\.)?{quoted}", tuple(whole), named=True)


def _word_rule(word: str) -> Rule:
    """A whole token of the host."""
    return Rule(word, "block", rf"^(?:[^/]*[^a-z0-9/])?{word}(?:[^a-z0-9]|$)", (word,))


#: Fixed values of the query.
NAMED_RULES = (
    prefix_rule("org", "/", "allow"),
    prefix_rule("example.org", "/es/", "block"),
    prefix_rule("example.org", "/en/1", "block"),
    prefix_rule("com", "/fr/", "allow"),
    prefix_rule("com", "/de/", "block"),
)
#: Kinds of hosts that a corpus of prose leaves out.
GENERAL_RULES = tuple(
    _word_rule(w)
    for w in (
        "adult", "bet", "bets", "betting", "casino", "coupon", "escort", "gambling",
        "hookup", "jackpot", "lottery", "payday", "pills", "poker", "porn", "replica", "sex",
        "slots", "spam", "torrent", "viagra", "warez", "xxx",
    )
)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for null and without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return lower_ascii(host), path


def _tokens(target: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(lower_ascii(target), F.lit("[a-z0-9]+"), F.lit(0)))


def rules_table(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    """Rules as a table."""
    return spark.createDataFrame([(r.name, r.action, r.pattern, r.named, list(r.literals)) for r in rules], RULES)


def prefix_rules(lists: DataFrame) -> DataFrame:
    """The same as ``prefix_rule`` for every row of a block or allow list with ``host``, ``path`` and
    ``action``, which may have millions of rows; rows with a null among them are no rules, a host is
    taken in lower case, an empty path is the whole host, and of equal rules blocks win."""
    host, path = lower_ascii(F.col("host")), F.when(F.col("path") == "", "/").otherwise(F.col("path"))
    known = lists.where("host is not null and path is not null and action is not null")
    known = known.select(F.concat(host, path).alias("rule"), host.alias("_host"), path.alias("_path"), "action")
    known = known.groupBy("rule", "_host", "_path").agg(F.max("action").alias("action"))
    # A quotation ends at the first \E, so one in the text is written outside.
    quoted = F.concat(F.lit(r"\Q"), F.replace("rule", F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    ends = F.concat("_host", F.regexp_extract("_path", "(?s)^.*/", 0))
    return known.select(
        "rule", "action", F.concat(F.lit(r"^(?:[^/]*\.)?"), quoted).alias("pattern"), F.lit(True).alias("named"),
        _tokens(ends).alias("literals"),
    )


def judge_urls(urls: DataFrame, rules: tuple[Rule, ...] | DataFrame, default: str = "allow") -> DataFrame:
    """``url``, ``host``, ``path``, ``rule``, ``verdict`` for each distinct url; null is a url.

    ``rule`` is the name of the winning rule where that is a named one; the verdict is the
    winning rule's, or ``default``. An empty table gives no rows. Rules are a tuple, or a table
    (columns of ``RULES``) whose index is broadcast below a size and joined by a shuffle beyond it;
    at most ``MAX_ALWAYS`` of them may be without literals.
    """
    spark = urls.sparkSession
    table = rules if isinstance(rules, DataFrame) else rules_table(spark, rules)
    literal = F.coalesce(F.size("literals"), F.lit(0)) > 0
    always = table.where(~literal).drop("literals").limit(MAX_ALWAYS + 1).collect()
    if len(always) > MAX_ALWAYS:
        raise ValueError(f"more than {MAX_ALWAYS} rules have no literals")
    small = _is_small(table)
    host, path = split_url(F.col("url"))
    sites = urls.select("url").distinct().select("url", host.alias("host"), path.alias("path"))
    sites = sites.withColumn("_target", F.concat("host", "path"))
    tokens = sites.select("url", "host", "path", "_target", F.explode(_tokens(F.col("_target"))).alias("token"))
    # How often a token that some rule names is in the urls; the rarest one indexes the rule.
    literals = table.select("rule", F.explode("literals").alias("token"))
    wanted = literals.select("token").distinct()
    used = tokens.join(F.broadcast(wanted) if small else wanted, "token").groupBy("token").count()
    rank = Window.partitionBy("rule").orderBy(F.coalesce("count", F.lit(0)), "token")
    rarest = (
        literals.join(used, "token", "left").withColumn("_rank", F.row_number().over(rank)).where("_rank = 1")
        .select("rule", "token")
    )
    index = table.drop("literals").join(rarest, "rule")
    fetched = tokens.join(F.broadcast(index) if small else index, "token").drop("token")
    for r in always:
        every = sites.select("*", *[F.lit(r[k]).alias(k) for k in ("rule", "action", "pattern", "named")])
        fetched = fetched.unionByName(every)
    best = F.max(
        F.struct(
            F.col("named"), F.length("rule").alias("length"), (F.col("action") == "block").alias("blocks"),
            F.col("rule"), F.col("action"),
        )
    ).alias("_best")
    judged = fetched.where(F.regexp_like("_target", F.col("pattern"))).groupBy("url").agg(best)
    out = sites.drop("_target").alias("s").join(
        judged.withColumnRenamed("url", "_url").alias("j"), F.col("s.url").eqNullSafe(F.col("j._url")), "left"
    )
    return out.select(
        "url", "host", "path",
        F.when(F.col("_best.named"), F.col("_best.rule")).alias("rule"),
        F.coalesce("_best.action", F.lit(default)).alias("verdict"),
    )


def _is_small(table: DataFrame) -> bool:
    """Whether the index, one row per rule, may go to every executor."""
    chars = F.length("rule") + F.length("pattern") + F.length(F.array_join("literals", " "))
    size = table.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(chars), F.lit(0)).alias("chars")).first()
    return size["n"] <= MAX_INDEX_ROWS and size["chars"] <= MAX_INDEX_CHARS


def judge_pages(pages: DataFrame, rules: tuple[Rule, ...] | DataFrame, default: str = "allow") -> DataFrame:
    """One row per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``.

    Each distinct url is judged once; pages are joined to it, and a url that a third of the
    pages share is one row on the other side, so Spark may split its pages over tasks.
    Repeated and null page ids are kept as they are; other columns are ignored.
    """
    rows = pages.select("page_id", "url")
    judged = judge_urls(rows, rules, default).withColumnRenamed("url", "_url")
    return rows.join(judged, rows["url"].eqNullSafe(judged["_url"])).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op8_url_rules(spark, sf_dir: str) -> DataFrame:
    return judge_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), NAMED_RULES + GENERAL_RULES)


_WORDS = "|".join(r.name for r in GENERAL_RULES)
ORACLE_SQL = rf"""
with t as (select page_id, case when position('://' in url) > 0
  then substr(url, position('://' in url) + 3) else '' end as rest from pages),
h as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
  regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path from t),
r(rhost, rpath, action) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
m as (select page_id, host, path, arg_max(struct_pack(rule := rhost || rpath, action := action),
    length(rhost || rpath)) as best
  from h left join r on (host = rhost or host like '%.' || rhost) and starts_with(path, rpath)
  group by all)
select page_id, host, path, best.rule as rule, coalesce(best.action,
  case when regexp_matches(host, '(^|[^a-z0-9])({_WORDS})([^a-z0-9]|$)') then 'block' else 'allow' end) as verdict
from m
"""
