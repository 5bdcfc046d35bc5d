"""Token counts kept up to date by signed batches.

Totals per source, language and tokenizer version are sums of deltas. A batch of inserts,
deletes and revised counts becomes one small table of signed deltas, written under the
batch's id. Running totals are brought up to date by the batches that came since. A batch is
known by its id, also after it has been rolled up, so retries and replays count once.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orestrata.sources import paths

KEYS = ("source", "lang", "tokenizer_version")
CHANGES = "op string, source string, lang string, tokenizer_version string, tokens bigint, old_tokens bigint"
DELTAS = "source string, lang string, tokenizer_version string, documents bigint, tokens bigint"
DELTA_COLUMNS = (*KEYS, "documents", "tokens")
_BATCH_ID = re.compile("[A-Za-z0-9_-]+")
_ROLLUP = re.compile("rollup-[0-9]{10}")

# Fixed value: the split pattern of the byte-level vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_token_count(docs: DataFrame, ranks_path: str, name: str = "tokens", text: str = "text") -> DataFrame:
    """`docs` without `text` and with its number of byte-pair tokens in `name`. Null and empty
    texts have 0. Tasks read the vocabulary from its path, which every executor must reach."""
    rest = [c for c in docs.columns if c != text]
    if name in rest:
        raise ValueError(f"there is a column {name} already")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(ranks_path)
        for batch in batches:
            at = batch.schema.names.index(text)
            counts = [len(encoding.encode_ordinary(value)) if value else 0 for value in batch.column(at).to_pylist()]
            kept = [column for i, column in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(counts, pa.int64())], [*rest, name])

    return docs.mapInArrow(run, docs.select(*rest).withColumn(name, F.lit(0).cast("bigint")).schema)


def inserts(counted: DataFrame, version: str) -> DataFrame:
    """Changes that add documents: one per row of (source, lang, tokens)."""
    return _changes(counted, "insert", version, F.col("tokens"), F.lit(None))


def deletes(counted: DataFrame, version: str) -> DataFrame:
    """Changes that take back documents with the counts they were inserted or revised with."""
    return _changes(counted, "delete", version, F.lit(None), F.col("tokens"))


def revisions(counted: DataFrame, version: str) -> DataFrame:
    """Changes from `old_tokens` to `tokens`; the documents stay."""
    return _changes(counted, "revise", version, F.col("tokens"), F.col("old_tokens"))


def _changes(counted: DataFrame, op: str, version: str, tokens: Column, old: Column) -> DataFrame:
    return counted.select(
        F.lit(op).alias("op"), "source", "lang", F.lit(version).alias("tokenizer_version"),
        tokens.cast("bigint").alias("tokens"), old.cast("bigint").alias("old_tokens"),
    )


def deltas(changes: DataFrame) -> DataFrame:
    """Signed sums of a batch of changes, one row per key that it changes.

    An insert adds a document and its tokens, a delete takes away one and its old tokens, a
    revision adds the difference. Null counts are 0; any other op is an error. Null sources,
    languages and versions are keys like any others. Repeated rows are changes of their own.
    """
    op = F.col("op")
    known = F.when(op.isin("insert", "delete", "revise"), 0).otherwise(F.raise_error(F.concat(F.lit("unknown op "), F.coalesce(op, F.lit("null")))).cast("int"))
    documents = F.when(op == "insert", 1).when(op == "delete", -1).otherwise(known)
    new, old = F.coalesce("tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    tokens = F.when(op == "insert", new).when(op == "delete", -old).otherwise(new - old)
    sums = changes.groupBy(*KEYS).agg(F.sum(documents).alias("documents"), F.sum(tokens).alias("tokens"))
    return sums.filter("documents <> 0 OR tokens <> 0")


def digest(rows: DataFrame) -> list[int]:
    """What tells the deltas of a batch from others, whatever the order of rows."""
    value = F.xxhash64(*[F.col(c) for c in DELTA_COLUMNS])
    marks = [F.count(F.lit(1)), F.coalesce(F.bit_xor(value), F.lit(0)), F.coalesce(F.sum(F.pmod(value, F.lit(1 << 31))), F.lit(0))]
    return list(rows.agg(*marks).first())


class TokenLedger:
    """Batches of deltas and their running totals in one folder, which all executors must reach.

    A batch is the folder `batch=<id>`, committed once Spark's mark of a finished write is in
    it. A rollup is a folder `rollup-<number>`: the totals of the batches whose ids and digests
    its `batches.json` lists, which is written last. Totals are the newest rollup and the
    batches that it does not list. One writer at a time; readers may come at any time.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _rollup(self) -> tuple[str | None, dict[str, list[int]]]:
        """The newest whole rollup and the batches in it."""
        for name in reversed([n for n in paths.children(self.spark, self.folder) if _ROLLUP.fullmatch(n)]):
            if (listed := paths.read_text(self.spark, f"{self.folder}/{name}/batches.json")) is not None:
                return name, json.loads(listed)
        return None, {}

    def _batches(self) -> list[str]:
        """Ids of the committed batches that lie in the folder."""
        names = [n.removeprefix("batch=") for n in paths.children(self.spark, self.folder) if n.startswith("batch=")]
        return [n for n in names if paths.exists(self.spark, f"{self._batch(n)}/{paths.FINISHED}")]

    def _batch(self, batch_id: str) -> str:
        return f"{self.folder}/batch={batch_id}"

    def _read(self, *places: str) -> DataFrame:
        if not places:
            return self.spark.createDataFrame([], DELTAS)
        return self.spark.read.schema(DELTAS).parquet(*places)

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Count a batch once; whether it was new.

        The write takes effect as a whole; one that a crash cut off counts for nothing and is
        written anew. A batch committed before is left as it is, also if it has been rolled up
        since; if its changes now sum up differently, that is an error.
        """
        if not _BATCH_ID.fullmatch(batch_id):
            raise ValueError(f"not a batch id: {batch_id!r}")
        rows, rolled_up = deltas(changes), self._rollup()[1]
        known = rolled_up.get(batch_id)
        if known is None and batch_id in self._batches():
            known = digest(self._read(self._batch(batch_id)))
        if known is not None:
            if digest(rows) != known:
                raise ValueError(f"batch {batch_id!r} was committed with other changes")
            return False
        rows.write.mode("overwrite").parquet(self._batch(batch_id))
        return True

    def _parts(self) -> tuple[DataFrame, dict[str, list[int]], list[str]]:
        """Rows that sum up to the totals, the batches rolled up, and those that are not."""
        name, rolled_up = self._rollup()
        loose = [batch for batch in self._batches() if batch not in rolled_up]
        places = [f"{self.folder}/{name}/totals"] if name else []
        return self._read(*places, *map(self._batch, loose)), rolled_up, loose

    def totals(self) -> DataFrame:
        """Documents and tokens per key over all committed batches; keys whose documents are
        all gone, and no tokens left, are not listed. No batch gives an empty table."""
        sums = self._parts()[0].groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return sums.filter("documents <> 0 OR tokens <> 0")

    def roll_up(self, into: "TokenLedger | None" = None) -> None:
        """Bring the running totals up to date with all committed batches, here or in another,
        empty ledger. Batches that are rolled up are remembered by id and digest, and their
        folders may then be deleted (`forget`)."""
        target = into or self
        _, rolled_up, loose = self._parts()
        if into and (into._rollup()[0] or into._batches()):
            raise ValueError("the other ledger has batches of its own")
        if not loose and not into:
            return
        listed = rolled_up | {batch: digest(self._read(self._batch(batch))) for batch in loose}
        newest = max([int(n.removeprefix("rollup-")) for n in paths.children(self.spark, target.folder) if _ROLLUP.fullmatch(n)], default=0)
        place = f"{target.folder}/rollup-{newest + 1:010}"
        self.totals().write.mode("overwrite").parquet(f"{place}/totals")
        paths.write_text(self.spark, f"{place}/batches.json", json.dumps(listed))

    def compact(self, into: "TokenLedger") -> None:
        """The totals as another ledger, which knows all batches of this one."""
        self.roll_up(into)

    def forget(self) -> None:
        """Delete what the newest rollup has made needless: its batches and older rollups."""
        name, rolled_up = self._rollup()
        for child in paths.children(self.spark, self.folder):
            old = _ROLLUP.fullmatch(child) and name and child < name
            if old or child.removeprefix("batch=") in rolled_up and child.startswith("batch="):
                paths.remove(self.spark, f"{self.folder}/{child}")
