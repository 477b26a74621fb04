"""URL rules as a sorted array of 64-bit digests.

A rule is a host and a path prefix with a verdict.  The list becomes one file: the
sorted xxhash64 keys of ``host + path``, the offsets of the stored strings, the
strings and the verdicts.  The file is written to the shared folder and handed to
every executor with ``addFile``; tasks memory-map it, so its pages are shared by all
workers of a machine.  A url asks for each suffix of its host with each prefix of its
path that is as long as some rule's; the keys of a whole batch are looked up by one
vectorised binary search and confirmed against the stored string, so a collision of
digests cannot give a verdict.  The longest fitting rule wins (ties: the longer host).

Lists beyond ``LIST_ROWS`` rules are not sent to the executors; asked keys are joined
with the rules instead (:func:`_judge_by_join`).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakwork.llm.common import register, table
from cloakwork.session import scratch_root

LIST_ROWS = 5_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def host(url: str) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(F.col(url), PARTS, 1), F.lit("")), UPPER, LOWER)


def path(url: str) -> Column:
    return F.coalesce(F.regexp_extract(F.col(url), PARTS, 2), F.lit(""))


def write_list(rules: DataFrame) -> str:
    """Write (host, path, verdict) as a digest file and give it to all executors; returns its name.

    Equal (host, path) pairs are one rule; block wins over allow.  Nulls count as empty.
    """
    import xxhash

    spark = rules.sparkSession
    rows = rules.groupBy(F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path")).agg(
        F.max(F.when(F.col("verdict") == "block", 1).otherwise(0)).alias("block")
    )
    found = sorted((xxhash.xxh64_intdigest(f"{r['host']}\0{r['path']}".encode()), f"{r['host']}\0{r['path']}".encode(), r["block"]) for r in rows.collect())
    texts = [t for _, t, _ in found]
    head = [len(found), sum(map(len, texts))]
    lengths = sorted({len(t.split(b"\0")[1].decode()) for t in texts})
    ends = np.cumsum([0, *map(len, texts)])
    arrays = [[*head, len(lengths)], [k for k, _, _ in found], ends, lengths]
    body = b"".join(np.array(a, dtype="<u8").tobytes() for a in arrays) + bytes(b for _, _, b in found) + b"".join(texts)
    name = f"{uuid.uuid4().hex}.digests"
    root = scratch_root(spark)
    store, folder = fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)
    store.create_dir(f"{folder}/lists", recursive=True)
    with store.open_output_stream(f"{folder}/lists/{name}") as out:
        out.write(body)
    spark.sparkContext.addFile(f"{root.rstrip('/')}/lists/{name}")
    return name


class DigestList:
    """The mapped file: ``probe`` answers many keys at once."""

    def __init__(self, file: str):
        raw = np.memmap(file, dtype=np.uint8, mode="r")
        self.n, size, widths = (int(x) for x in raw[:24].view("<u8"))
        at = 24
        self.keys = raw[at : at + 8 * self.n].view("<u8")
        at += 8 * self.n
        self.ends = raw[at : at + 8 * self.n + 8].view("<u8")
        at += 8 * self.n + 8
        self.lengths = [int(x) for x in raw[at : at + 8 * widths].view("<u8")]
        at += 8 * widths
        self.block = raw[at : at + self.n]
        self.texts = raw[at + self.n : at + self.n + size]

    def probe(self, asked: list[bytes], keys: np.ndarray) -> np.ndarray:
        """Place of each asked string in the list, -1 where it is not there."""
        out = np.full(len(asked), -1, dtype=np.int64)
        if not self.n:
            return out
        at = np.searchsorted(self.keys, keys)
        for i in np.flatnonzero((at < self.n) & (self.keys[np.minimum(at, self.n - 1)] == keys)):
            k = int(at[i])
            while k < self.n and self.keys[k] == keys[i]:  # equal digests stand together
                if self.texts[int(self.ends[k]) : int(self.ends[k + 1])].tobytes() == asked[i]:
                    out[i] = k
                    break
                k += 1
        return out


def asked_keys(host: str, path: str, lengths: list[int]) -> list[bytes]:
    """What a url may match, best rule first: longest host + path, then longest host."""
    labels = host.split(".") if host else []
    suffixes = [".".join(labels[i:]) for i in range(len(labels))]
    pairs = [(s, path[:n]) for s in suffixes for n in lengths if n <= len(path)]
    pairs.sort(key=lambda x: (-len(x[0]) - len(x[1]), -len(x[0])))
    return [f"{s}\0{p}".encode() for s, p in pairs]


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row.

    A null url or one without ``://`` has empty host and path and no rule; a url
    without a rule gets ``default``.  Equal rows get equal answers; an empty list
    gives every row the default.  Columns named like the added ones are replaced.
    """
    df = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host(url), "path": path(url)})
    if rules.limit(LIST_ROWS + 1).count() > LIST_ROWS:
        return _judge_by_join(df, rules, default)
    name = write_list(rules)

    @F.pandas_udf("rule string, verdict string")
    def decide(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        import xxhash

        known = DigestList(SparkFiles.get(name))
        for hosts, paths in batches:
            asked = [asked_keys(h, p, known.lengths) for h, p in zip(hosts, paths, strict=True)]
            flat = [k for keys in asked for k in keys]
            at = known.probe(flat, np.array([xxhash.xxh64_intdigest(k) for k in flat], dtype=np.uint64))
            rule, verdict, i = [], [], 0
            for keys in asked:
                hit = next((j for j in range(i, i + len(keys)) if at[j] >= 0), None)
                rule.append(None if hit is None else flat[hit].replace(b"\0", b"").decode())
                verdict.append(default if hit is None else ("block" if known.block[at[hit]] else "allow"))
                i += len(keys)
            yield pd.DataFrame({"rule": rule, "verdict": verdict})

    return df.withColumn("_d", decide("host", "path")).select("*", "_d.rule", "_d.verdict").drop("_d")


def _judge_by_join(df: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same for lists of any size: asked keys meet the rules in an equi-join."""
    rules = rules.groupBy(F.coalesce("host", F.lit("")).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path")).agg(
        F.max(F.when(F.col("verdict") == "block", 1).otherwise(0)).alias("block")
    )
    lengths = [r[0] for r in rules.select(F.length("rule_path")).distinct().collect()]  # lengths of paths, not rules
    urls = df.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    asked = urls.withColumn("rule_host", F.explode(hosts)).filter("rule_host <> ''")
    cuts = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path"))
    asked = asked.withColumn("_n", F.explode(cuts)).withColumn("rule_path", F.expr("left(path, _n)"))
    size = F.length("rule_host") + F.length("rule_path")
    best = F.max(F.struct(size, F.length("rule_host"), F.concat("rule_host", "rule_path").alias("rule"), "block")).alias("_b")
    found = asked.join(rules, ["rule_host", "rule_path"]).groupBy("host", "path").agg(best)
    verdict = F.when(F.col("_b").isNull(), default).when(F.col("_b.block") == 1, "block").otherwise("allow")
    return df.join(found, ["host", "path"], "left").withColumns({"rule": F.col("_b.rule"), "verdict": verdict}).drop("_b").select(*df.columns, "rule", "verdict")


SQL = rf"""
with p as (select page_id,
  translate(coalesce(regexp_extract(url, '{PARTS}', 1), ''), '{UPPER}', '{LOWER}') as host,
  coalesce(regexp_extract(url, '{PARTS}', 2), '') as path from pages),
r as (select *, case
  when ('.' || host) like '%.example.net' and starts_with(path, '/en/') then 'example.net/en/'
  when ('.' || host) like '%.example.com' and starts_with(path, '/de/') then 'example.com/de/'
  when ('.' || host) like '%.org' and starts_with(path, '/fr/') then 'org/fr/'
  when ('.' || host) like '%.net' and starts_with(path, '/') then 'net/' end as rule from p)
select page_id, host, path, rule, case when rule in ('net/', 'example.com/de/') then 'block' else 'allow' end as verdict from r
"""


@register("op7_url_digests", SQL)
def query(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(table(spark, folder, "pages").select("page_id", "url"), rules).drop("url")
