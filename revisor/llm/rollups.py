"""Token counts as delta-maintained rollups (operator 9).

Totals by source, language and tokenizer version are never recounted.  A change
is a row with the document's counts *before* and *after*: an insert has no
before, a delete no after, a revised count both.  ``apply`` turns a batch of
changes into signed additions to the totals and commits their sums under the
batch's id; ``totals`` adds up the committed batches.

A batch is committed when its folder holds the success mark that Spark's writer
leaves last.  Applying a committed batch again changes nothing; a batch that was
cut off before its mark counts for nothing and is written anew.  ``compact``
folds committed batches into a base that remembers their ids.

Defined cases: a null source, language or version is a group of its own; a
missing count is 0 tokens; a change with neither side does nothing; repeated
rows are changes each; groups without documents leave the totals; an empty batch
commits and adds nothing; columns beyond the named ones are not read.  Counting
tokens gives one row for every row, ids null or repeated as they are; a null or
empty text has 0 tokens, a very long one is counted whole.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revisor.llm.common import bound_batches, slices

KEYS = ["source", "lang", "tokenizer"]
SIDE = "struct<source:string,lang:string,tokenizer:string,tokens:bigint>"
DELTA_SCHEMA = "source string, lang string, tokenizer string, documents long, tokens long"


def count_tokens(docs: DataFrame, tokenizers: dict[str, str], id_col: str = "doc_id", text_col: str = "text",
                 carry: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """One row per document with the token count of each tokenizer as column ``n_<name>``.

    ``tokenizers`` maps a version name to a rank file (``.tiktoken``); a null
    text has 0 tokens.
    """
    kinds = dict(docs.dtypes)
    names = [f"n_{name}" for name in tokenizers]
    bound_batches(docs)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *carry)

    def run(batches):
        import base64

        import public_tokenizers
        import tiktoken

        encoders = []
        for name, path in tokenizers.items():
            with open(path, "rb") as f:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
            encoders.append(tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}))
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            counts = [pa.array([len(e.encode_ordinary(t)) for t in texts], pa.int64()) for e in encoders]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[batch.column(c) for c in carry], *counts],
                                             names=["doc_id", *carry, *names])

    schema = ", ".join([f"doc_id {kinds[id_col]}", *[f"{c} {kinds[c]}" for c in carry], *[f"{n} long" for n in names]])
    return rows.mapInArrow(run, schema)


def side(source, lang, tokenizer, tokens):
    """The before or after part of a change."""
    return F.struct(source.cast("string").alias("source"), lang.cast("string").alias("lang"),
                    tokenizer.cast("string").alias("tokenizer"), tokens.cast("long").alias("tokens"))


def no_side():
    return F.lit(None).cast(SIDE)


class Rollup:
    """Totals kept under ``path`` (a shared folder)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, batch: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
            raise ValueError(f"not a batch id: {batch!r}")
        return f"{self.path}/batch={batch}"

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _folders(self, prefix: str) -> list[str]:
        fs, root = self._fs(self.path)
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(n[len(prefix):] for n in names if n.startswith(prefix) and self._marked(f"{self.path}/{n}"))

    def _marked(self, folder: str) -> bool:
        fs, mark = self._fs(f"{folder}/_SUCCESS")
        return fs.exists(mark)

    def _base(self) -> str | None:
        """Folder of the latest base."""
        bases = self._folders("base=")
        return f"{self.path}/base={bases[-1]}" if bases else None

    def _ids(self, base: str | None) -> DataFrame:
        """Ids of the batches folded into a base; their number grows, so they stay on the executors."""
        return self.spark.read.schema("id string").parquet(f"{base}/ids") if base else self.spark.createDataFrame([], "id string")

    def _pending(self, base: str | None) -> tuple[list[str], list[str]]:
        """Committed batches whose folders are there: those not folded yet, and those a cut-off compaction left."""
        there = self._folders("batch=")
        if not base or not there:
            return there, []
        folders = self.spark.createDataFrame([(b,) for b in there], "id string")
        folded = {r["id"] for r in folders.join(self._ids(base), "id", "left_semi").collect()}
        return [b for b in there if b not in folded], sorted(folded)

    def committed(self, batch: str) -> bool:
        return self._marked(self._folder(batch)) or not self._ids(self._base()).filter(F.col("id") == batch).isEmpty()

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commit a batch of changes (columns ``before`` and ``after``); False if it was committed before."""
        if self.committed(batch):
            return False
        signed = changes.select(F.explode(F.array(
            F.struct(F.lit(-1).cast("long").alias("sign"), F.col("before").cast(SIDE).alias("row")),
            F.struct(F.lit(1).cast("long").alias("sign"), F.col("after").cast(SIDE).alias("row")))).alias("c"))
        signed = signed.filter("c.row IS NOT NULL").select(
            *[F.col(f"c.row.{k}").alias(k) for k in KEYS], F.col("c.sign").alias("documents"),
            (F.col("c.sign") * F.coalesce("c.row.tokens", F.lit(0).cast("long"))).alias("tokens"))
        (signed.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
         .filter("documents != 0 OR tokens != 0").write.mode("overwrite").parquet(self._folder(batch)))
        return True

    def totals(self) -> DataFrame:
        """Documents and tokens by source, language and tokenizer version."""
        base = self._base()
        paths = [self._folder(b) for b in self._pending(base)[0]] + ([f"{base}/totals"] if base else [])
        if not paths:
            return self.spark.createDataFrame([], DELTA_SCHEMA)
        deltas = self.spark.read.schema(DELTA_SCHEMA).parquet(*paths)
        return (deltas.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
                .filter("documents != 0 OR tokens != 0"))

    def compact(self) -> None:
        """Fold all committed batches into a new base; replays of them stay without effect."""
        base = self._base()
        batches, leftover = self._pending(base)
        number = len(self._folders("base="))
        folder = f"{self.path}/base={number:08d}"
        self.totals().write.mode("overwrite").parquet(f"{folder}/totals")
        new = self.spark.createDataFrame([(b,) for b in batches], "id string")
        self._ids(base).union(new).write.mode("overwrite").parquet(f"{folder}/ids")
        fs, mark = self._fs(f"{folder}/_SUCCESS")
        fs.create(mark, True).close()
        for b in batches + leftover:
            fs, p = self._fs(self._folder(b))
            fs.delete(p, True)
