"""URL rules by a sort-merge range join (operator 7).

*Keys.* A host is written with its labels reversed (``www.example.org`` becomes
``org.example.www``), each label ended by ``END``, a character below all others. A
rule for a host then fits exactly the keys that start with the rule's key: an
interval of the sorted keys. Intervals of rules are nested or disjoint.

*Join.* URLs are range-partitioned and sorted by (key, page_id), so a host with a
third of all pages spreads over many tasks. The bounds of each partition (one
row per partition) say which partitions a rule's interval meets; rules are sent
to those, and only those. Each task sweeps its rows in key order with a stack of
the active rule hosts: a host is pushed when its interval opens and popped when
a key lies beyond it. A host's frame holds its rules by path, looked up by the
prefixes of the URL's path.

*Choice.* Of the rules that fit, the longest (host and path together) wins; of
equally long ones the one with the longer host, then block before allow. Rules
that repeat host and path are one rule; block wins. Where no rule fits the
verdict is ``DEFAULT``.

Defined results: a null URL, or one without ``://``, has an empty host and path; no
rule with a host fits it, a rule with an empty host fits every URL that its path
fits. A null host or path of a rule counts as empty; a rule without a verdict is no rule. Repeated rows give repeated
results; empty tables give an empty result, no rules the default verdict.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, materialise, read_table, ship_package

DEFAULT = "allow"
#: Ends a label in a key; below every character that a host can hold.
END = "\x00"
#: The rules of the registered query.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = rest.substr(F.length(host) + 1, F.length(rest))
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(low, F.lit("")), F.coalesce(F.regexp_extract(after, r"^[^?#]*", 0), F.lit(""))


def host_key(host: Column) -> Column:
    """The host's labels reversed, each ended by ``END``; an empty host has the empty key."""
    labels = F.reverse(F.split(host, r"\.", -1))
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(labels, END), F.lit(END)))


class Sweep:
    """Rows in key order, rules before pages of the same key; the stack holds the open rule hosts."""

    def __init__(self, default: str):
        self.default = default
        self.stack: list[tuple[str, str, dict, list[int]]] = []  # key, host, rules by path, path lengths

    def close(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def rule(self, key: str, host: str, path: str, verdict: str) -> None:
        self.close(key)
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, host, {}, []))
        _, _, rules, lengths = self.stack[-1]
        if path not in rules or verdict == "block":
            rules[path] = verdict
        if len(path) not in lengths:
            lengths.append(len(path))
            lengths.sort(reverse=True)

    def page(self, key: str, path: str) -> tuple[str | None, str]:
        """(rule, verdict) of a URL."""
        self.close(key)
        best = None
        for _, host, rules, lengths in self.stack:
            for n in lengths:
                verdict = rules.get(path[:n]) if n <= len(path) else None
                if verdict is not None:
                    rank = (len(host) + n, len(host))
                    if best is None or rank > best[0]:
                        best = (rank, host + path[:n], verdict)
                    break
        return (None, self.default) if best is None else best[1:]


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """(page_id, host, path, rule, verdict) of each row of ``pages`` (page_id, url); rules (host, path, verdict)."""
    spark = pages.sparkSession
    ship_package(spark)
    kind = pages.schema["page_id"].dataType.simpleString()
    host, path = split_url(col(pages, "url"))
    urls = pages.select(col(pages, "page_id").alias("page_id"), host.alias("host"), path.alias("path")).withColumn(
        "key", host_key(F.col("host")))
    dealt = materialise(urls.repartitionByRange("key", "page_id").withColumn("part", F.spark_partition_id()), "urls")
    bounds = dealt.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))  # one row per partition
    low = F.lower(F.coalesce(col(rules, "host"), F.lit("")))
    given = rules.where(col(rules, "verdict").isNotNull()).select(low.alias("host"), F.coalesce(col(rules, "path"), F.lit("")).alias("path"),
                         col(rules, "verdict").alias("verdict")).distinct().withColumn("key", host_key(F.col("host")))
    table = bounds.orderBy("low").collect()
    parts = spark.sparkContext.broadcast([(r.part, r.low, r.high) for r in table])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each rule once for every partition whose keys its interval can meet."""
        from bisect import bisect_left
        tops = [p[2] for p in parts.value]
        for batch in batches:
            rows, at = [], []
            for i, key in enumerate(batch.column(3).to_pylist()):
                k = bisect_left(tops, key)  # first partition that ends at or beyond the interval's start
                while k < len(tops) and (parts.value[k][1] <= key or parts.value[k][1].startswith(key)):
                    rows.append(i)
                    at.append(parts.value[k][0])
                    k += 1
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(at, pa.int32())],
                                             ["host", "path", "verdict", "key", "part"])

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, part = Sweep(default), None
        for batch in batches:
            kept, found, verdicts = [], [], []
            keys, hosts, paths, given_, parts_ = (batch.column(c).to_pylist() for c in
                                                  ("key", "host", "path", "verdict", "part"))
            for i, (key, host, path, verdict, p) in enumerate(zip(keys, hosts, paths, given_, parts_)):
                if p != part:
                    state, part = Sweep(default), p
                if verdict is not None:
                    state.rule(key, host, path, verdict)
                else:
                    rule, judged = state.page(key, path)
                    kept.append(i)
                    found.append(rule)
                    verdicts.append(judged)
            own = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [own.column("page_id"), own.column("host"), own.column("path"), pa.array(found, pa.string()),
                 pa.array(verdicts, pa.string())], ["page_id", "host", "path", "rule", "verdict"])

    placed = given.select("host", "path", "verdict", "key").mapInArrow(
        place, "host string, path string, verdict string, key string, part int")
    rows = dealt.select("part", "key", "page_id", "host", "path", F.lit(None).cast("string").alias("verdict")).unionByName(
        placed.select("part", "key", F.lit(None).cast(kind).alias("page_id"), "host", "path", "verdict"))
    n = max([1, *(r.part + 1 for r in table)])
    return rows.repartitionById(n, F.col("part")).sortWithinPartitions(
        "part", "key", F.col("verdict").isNull()).mapInArrow(
        sweep, f"page_id {kind}, host string, path string, rule string, verdict string")


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(read_table(spark, sf_dir, "pages"), rules)


QUERIES = {"op7_url_rules": op7_url_rules}
ORACLE_SQL = {"op7_url_rules": r"""
with s as (
  select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) end as rest from pages),
h as (select page_id, rest, coalesce(regexp_extract(rest, '^[^/?#]*'), '') as raw_host from s),
p as (select page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
  coalesce(regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*'), '') as path from h),
r as (select * from (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')) as t(rhost, rpath, rverdict)),
m as (select p.page_id, p.host, p.path, r.rhost || r.rpath as rule, r.rverdict,
  row_number() over (partition by p.page_id order by length(r.rhost) + length(r.rpath) desc, length(r.rhost) desc) as k
  from p left join r on (p.host = r.rhost or ends_with(p.host, '.' || r.rhost)) and starts_with(p.path, r.rpath))
select page_id, host, path, rule, coalesce(rverdict, 'allow') as verdict from m where k = 1
"""}
