"""URL filter as a Bloom filter cascade over the corpus's keys (operator 2).

A rule is a host and a path prefix with a verdict.  The keys of a url are its
host's label suffixes, each with the prefixes of its path that are as long as
some rule's path.  For each verdict a cascade holds the listed keys exactly
*for the corpus*: level 1 encodes the listed keys; level 2 the keys of the
corpus that pass level 1 without being listed; level 3 the listed keys that
pass level 2; and so on until nothing passes wrongly.  Judging a url then only
tests bits on the executors, longest key first: no rule table is joined, and a
key that passes *is* the rule.

Listed keys are dealt to shards by hash, so that no level of one shard passes
``MAX_SHARD_KEYS * 12`` bits; shards are built and applied one after another,
each in a map-only pass.

Defined cases: a null url or one without ``://`` has an empty host and path and
no rule; the verdict without a rule is ``default``; rules that repeat count
once, and of contradicting ones ``block`` wins; an empty rule table or an empty
url table works; columns beyond id and url are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisor.llm.common import Bloom, bloom, rename_free, staged
from revisor.llm.hashing import mix
from revisor.session import release

MAX_SHARD_KEYS = 16_000_000
MAX_LEVELS = 60
DEFAULT_VERDICT = "allow"
#: The verdicts, the first beating the second on equal keys.
VERDICTS = ("block", "allow")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(raw, _UPPER, _LOWER), path


def keys_of(host: str, path: str, lengths: list[int]) -> list[tuple[str, str]]:
    """(host suffix, path prefix) keys of a url, longest first, then the longer host."""
    suffixes, at = [host], host.find(".")
    while at >= 0:
        suffixes.append(host[at + 1:])
        at = host.find(".", at + 1)
    keys = [(s, path[:n]) for s in suffixes if s for n in lengths if n <= len(path)]
    return sorted(keys, key=lambda k: (-len(k[0]) - len(k[1]), -len(k[0])))


def key_hash(host: str, path: str) -> tuple[int, int]:
    """128 bits; hosts hold no ``/``, so the first one parts host and path."""
    x = xxhash.xxh3_128_intdigest(f"{host}/{path}")
    return x >> 64, x & ((1 << 64) - 1)


def level_hash(high: np.ndarray, low: np.ndarray, level: int) -> np.ndarray:
    return mix(high ^ mix(low + np.uint64(level)))


class Cascade:
    def __init__(self):
        self.levels: list[Bloom] = []

    def listed(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Odd levels say listed, even ones take it back; the first level missed decides."""
        out = np.zeros(len(high), dtype=bool)
        open_ = np.arange(len(high))
        for k, level in enumerate(self.levels):
            open_ = open_[level.has(level_hash(high[open_], low[open_], k))]
            out[open_] = k % 2 == 0
        return out


def _hash_columns(rows: list[tuple[str, str]]) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.array([key_hash(*r) for r in rows], dtype=np.uint64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _passing(keys: DataFrame, levels: list[Bloom], first: int) -> DataFrame:
    """Rows of (host, path, high, low) that pass all the given levels."""
    shared = keys.sparkSession.sparkContext.broadcast(levels)

    def test(batches):
        for batch in batches:
            high = batch.column("high").to_numpy().view(np.uint64)
            low = batch.column("low").to_numpy().view(np.uint64)
            keep = np.ones(len(high), dtype=bool)
            for k, level in enumerate(shared.value):
                keep &= level.has(level_hash(high, low, first + k))
            yield batch.filter(pa.array(keep))

    return keys.mapInArrow(test, keys.schema)


def _level(keys: DataFrame, level: int, count: int) -> Bloom:
    def salted(batches):
        for batch in batches:
            h = level_hash(batch.column("high").to_numpy().view(np.uint64),
                           batch.column("low").to_numpy().view(np.uint64), level)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])

    return bloom(keys.select("high", "low").mapInArrow(salted, "h long"), "h", count)


_KEYS = "host string, path string, high long, low long"


def _rule_keys(rules: DataFrame) -> DataFrame:
    def hashed(batches):
        for batch in batches:
            rows = list(zip(batch.column("host").to_pylist(), batch.column("path").to_pylist()))
            high, low = _hash_columns(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), batch.column("path"), pa.array(high.view(np.int64)), pa.array(low.view(np.int64))],
                names=["host", "path", "high", "low"])

    return rules.select("host", "path").distinct().mapInArrow(hashed, _KEYS)


def _universe(urls: DataFrame, lengths: list[int], first: Bloom) -> DataFrame:
    """Distinct keys of the corpus that pass the first level."""
    shared = urls.sparkSession.sparkContext.broadcast(first)

    def keys(batches):
        for batch in batches:
            rows = {k for host, path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())
                    for k in keys_of(host, path, lengths)}
            rows = list(rows)
            high, low = _hash_columns(rows)
            keep = shared.value.has(level_hash(high, low, 0))
            kept = [r for r, k in zip(rows, keep) if k]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in kept], pa.string()), pa.array([r[1] for r in kept], pa.string()),
                 pa.array(high[keep].view(np.int64)), pa.array(low[keep].view(np.int64))],
                names=["host", "path", "high", "low"])

    return urls.select("host", "path").mapInArrow(keys, _KEYS).distinct()


def build_cascade(urls: DataFrame, listed: DataFrame, lengths: list[int]) -> Cascade:
    """Cascade over ``listed`` keys, exact for every key of ``urls`` (columns host, path)."""
    cascade = Cascade()
    listed, *paths = staged(listed, "url-listed")
    count = listed.count()
    if count:
        cascade.levels.append(_level(listed, 0, count))
        universe, path = staged(_universe(urls, lengths, cascade.levels[0]), "url-universe")
        paths.append(path)
        wrong, path = staged(universe.join(listed.select("host", "path"), ["host", "path"], "left_anti"), "url-wrong")
        paths.append(path)
        sides = [wrong, listed]
        while (count := sides[0].count()):
            k = len(cascade.levels)
            if k >= MAX_LEVELS:
                raise RuntimeError("two keys share a 128-bit hash: the cascade can't part them")
            cascade.levels.append(_level(sides[0], k, count))
            left, path = staged(_passing(sides[1], cascade.levels[-1:], k), "url-left")
            paths.append(path)
            sides = [left, sides[0]]
    release(urls.sparkSession, *paths)
    return cascade


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = DEFAULT_VERDICT, max_shard_keys: int = MAX_SHARD_KEYS) -> DataFrame:
    """Columns: the id, ``host``, ``path``, ``rule`` (host and path) and ``verdict``.

    ``rules`` has the columns host, path and verdict (``allow`` or ``block``).
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    urls = rename_free(pages, page_id=id_col, url=url_col).select("page_id", host.alias("host"), path.alias("path"))
    rules = rules.filter(F.col("host").isNotNull() & F.col("path").isNotNull())
    lengths = sorted(r["n"] for r in rules.select(F.length("path").alias("n")).distinct().collect())
    keys, path_of = staged(_rule_keys(rules), "url-rules")
    kind = dict(urls.dtypes)["page_id"]
    schema = f"page_id {kind}, host string, path string, rule_host string, rule_path string, verdict string"
    out = urls.select("*", F.lit(None).cast("string").alias("rule_host"), F.lit(None).cast("string").alias("rule_path"),
                      F.lit(None).cast("string").alias("verdict"))
    shards = max(1, -(-keys.count() // max_shard_keys))
    for shard in range(shards):
        cascades = []
        for verdict in VERDICTS:
            own = rules.filter(F.col("verdict") == verdict)
            listed = (keys.filter(F.pmod("low", F.lit(shards)) == shard)
                      .join(own.select("host", "path"), ["host", "path"], "left_semi").select("host", "path", "high", "low"))
            cascades.append((verdict, build_cascade(urls, listed, lengths)))
        out = out.mapInArrow(_judge_batches(spark.sparkContext.broadcast(cascades), lengths), schema)
    release(spark, path_of)
    return out.select("page_id", "host", "path", F.concat("rule_host", "rule_path").alias("rule"),
                      F.coalesce("verdict", F.lit(default)).alias("verdict"))


def _judge_batches(shared, lengths):
    def run(batches):
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            best = list(zip(*(batch.column(c).to_pylist() for c in ("rule_host", "rule_path", "verdict"))))
            keys = [keys_of(h, p, lengths) for h, p in zip(hosts, paths)]
            flat = [k for own in keys for k in own]
            high, low = _hash_columns(flat)
            said = np.full(len(flat), None, dtype=object)
            for verdict, cascade in reversed(shared.value):
                said[cascade.listed(high, low)] = verdict
            at = 0
            for i, own in enumerate(keys):
                for k, verdict in zip(own, said[at:at + len(own)]):
                    if verdict is not None:
                        old = best[i]
                        if old[0] is None or (len(k[0]) + len(k[1]), len(k[0])) > (len(old[0]) + len(old[1]), len(old[0])):
                            best[i] = (*k, verdict)
                        break
                at += len(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("host"), batch.column("path")]
                + [pa.array(list(c), pa.string()) for c in zip(*best)],
                names=["page_id", "host", "path", "rule_host", "rule_path", "verdict"])

    return run
