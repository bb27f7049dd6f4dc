"""Token counts as delta-maintained rollups.

A change says how one document's counts enter or leave the totals: an insert adds, a
delete takes away, a revision takes the old counts away and adds the new ones. Changes are
summed to signed deltas per (source, lang, tokenizer) and written as one batch; a batch is a folder
that counts once its _SUCCESS marker stands, so a job that dies leaves nothing behind, a retry
replaces what it left, and committing the same batch again changes nothing. Totals are sums of
deltas; `compacted` folds batches into one without changing totals and keeps their names. Sums add up in any
order, so batches may be committed in any order too.

Defined results: null sources and languages are groups of their own; a null count is 0; a batch
without changes commits and changes nothing; groups whose documents are all gone are left out
of `totals`; repeated changes within one batch count each.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from .packing import WordEncoder, vocabulary_path
from .shared import text_of, words

KEYS = ("source", "lang", "tokenizer")
MEASURES = ("n_docs", "n_tokens", "n_chars")
WORDS, BYTES = "words-1", "byte_bpe_50k"
_FOLD = "compacted"  # the batch that holds all earlier ones; no caller's batch may have its name
_DELTA = "source string, lang string, tokenizer string, n_docs long, n_tokens long, n_chars long"


def counted(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, source, lang, n_words, n_ids (tokens by the vocabulary), n_chars and `digest` of every row's text."""
    path = vocabulary or vocabulary_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of(path)
        for batch in batches:
            sizes = [len(encoder.encode(text)) // 4 for text in batch.column(batch.num_columns - 1).to_pylist()]
            kept = batch.select(list(range(batch.num_columns - 1)))
            yield pa.record_batch([*kept.columns, pa.array(sizes, pa.int64())], names=[*kept.schema.names, "n_ids"])

    text = text_of(docs)
    slim = docs.select(
        "doc_id", "source", "lang",
        F.coalesce(F.size(words(text)), F.lit(0)).cast("bigint").alias("n_words"),
        F.char_length(text).cast("bigint").alias("n_chars"),
        F.sha2(text, 256).alias("digest"),
        text.alias("text"),
    )
    schema = "doc_id long, source string, lang string, n_words long, n_chars long, digest string, n_ids long"
    return slim.mapInArrow(count, schema)


def _signed(sign: int, tokenizer: str, n_tokens: Column) -> Column:
    return F.struct(
        F.lit(tokenizer).alias("tokenizer"),
        F.lit(sign).cast("bigint").alias("n_docs"),
        (sign * F.coalesce(n_tokens, F.lit(0))).cast("bigint").alias("n_tokens"),
        (sign * F.coalesce(F.col("n_chars"), F.lit(0))).cast("bigint").alias("n_chars"),
    )


def inserts(docs: DataFrame, tokenizer: str, n_tokens: str) -> DataFrame:
    """Changes that add the documents."""
    return docs.select("source", "lang", F.inline(F.array(_signed(1, tokenizer, F.col(n_tokens)))))


def deletes(docs: DataFrame, tokenizer: str, n_tokens: str) -> DataFrame:
    """Changes that take the documents away."""
    return docs.select("source", "lang", F.inline(F.array(_signed(-1, tokenizer, F.col(n_tokens)))))


def revisions(docs: DataFrame, old: str, old_tokens: str, new: str, new_tokens: str) -> DataFrame:
    """Changes that replace the documents' counts by one tokenizer version with those by another."""
    both = F.array(_signed(-1, old, F.col(old_tokens)), _signed(1, new, F.col(new_tokens)))
    return docs.select("source", "lang", F.inline(both))


class Rollup:
    """Additive totals kept as committed batches of deltas under one path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path.rstrip("/")

    def _batch(self, batch: str) -> str:
        return f"{self._path}/batch={batch}"

    def committed(self, batch: str) -> bool:
        return storage.exists(self._spark, f"{self._batch(batch)}/_SUCCESS") or batch in self._folded()

    def _folded(self) -> list[str]:
        """Names of the batches that were committed before they were folded into this rollup."""
        path = f"{self._path}/folded.json"
        return json.loads(storage.read_text(self._spark, path)) if storage.exists(self._spark, path) else []

    def batches(self) -> list[str]:
        """Names of all committed batches, folded ones among them."""
        markers = storage.glob(self._spark, f"{self._path}/batch=*/_SUCCESS")
        return sorted({*self._folded(), *(m.rsplit("/", 2)[1].removeprefix("batch=") for m in markers)} - {_FOLD})

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Write the batch's deltas unless it is committed already; says whether it was written."""
        if batch == _FOLD:
            raise ValueError(f"{_FOLD} is the name of a fold")
        if self.committed(batch):
            return False
        self._write(batch, changes)
        return True

    def _write(self, batch: str, changes: DataFrame) -> None:
        deltas = changes.groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])
        deltas.write.mode("overwrite").parquet(self._batch(batch))

    def deltas(self) -> DataFrame:
        """All committed deltas. Batches are listed by their markers; a half-written one is not seen."""
        markers = storage.glob(self._spark, f"{self._path}/batch=*/_SUCCESS")
        paths = [marker.rsplit("/", 1)[0] for marker in markers]
        reader = self._spark.read.schema(_DELTA)
        return reader.parquet(*paths) if paths else self._spark.createDataFrame([], _DELTA)

    def totals(self) -> DataFrame:
        sums = self.deltas().groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])
        return sums.where(" or ".join(f"{m} <> 0" for m in MEASURES))

    def compacted(self, into: str) -> Rollup:
        """A new rollup of the same totals in one batch; committing a batch again that was committed here changes nothing there."""
        folded = Rollup(self._spark, into)
        storage.write_text(self._spark, f"{folded._path}/folded.json", json.dumps(self.batches()))
        folded._write(_FOLD, self.deltas())
        return folded
