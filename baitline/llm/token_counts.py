"""Token counts by a map-side two-tier lookup: no pre-token is ever shuffled.

Tier one is a broadcast table from frequent pre-tokens to their numbers of tokens, at most TABLE_ENTRIES of them, so
its size is bounded whatever the corpus. It is filled from a bounded sample of SAMPLE_DOCS documents; as the table and
the library agree on every entry, the sample decides speed only, never a count. Tier two is a cache in each Python
worker for the pre-tokens that miss; they are encoded by the library once a worker.

Defined cases: null text counts as empty and has no tokens; special strings inside a text are one token each, as the
library's default has it; repeated rows are counted each; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baitline.llm import tokens
from baitline.llm.common import OnBatches, kept, short_batches, text_or_empty

TABLE_ENTRIES = 32_768
SAMPLE_DOCS = 2_000
#: Longer texts are not sampled, so what the driver holds is bounded.
SAMPLE_CHARS = 32_768
#: A pre-token longer than this is not put in the broadcast table, so its bytes are bounded too.
TABLE_CHARS = 32


def count_one(path: str, word: str) -> int:
    return len(tokens.merged(path, word))


def frequent_table(docs: DataFrame, path: str, text_col: str = "text", entries: int = TABLE_ENTRIES, sample_docs: int = SAMPLE_DOCS) -> dict[str, int]:
    """Numbers of tokens of the pre-tokens that are frequent in the first sample_docs documents met."""
    splitter = tokens.Splitter(path, tokens.BYTE_PATTERN, lower=False)
    seen: Counter[str] = Counter()
    for row in docs.select(text_or_empty(text_col).alias("t")).where(F.length("t") <= SAMPLE_CHARS).take(sample_docs):
        if splitter.safe(row.t):
            for special, part in splitter.pieces(row.t):
                if not special:
                    seen.update(splitter.words(part))
    words = [w for w, n in seen.most_common(entries) if len(w) <= TABLE_CHARS and n > 1]
    return {w: count_one(path, w) for w in words}


class Counts:
    """Counts the tokens of texts in one worker."""

    def __init__(self, path: str, table: dict[str, int]):
        self.splitter = tokens.Splitter(path, tokens.BYTE_PATTERN, lower=False)
        self.words = tokens.Words(table, lambda w: count_one(path, w))
        self.path = path

    def __call__(self, text: str) -> int:
        if not self.splitter.safe(text):
            return len(tokens.load(self.path).encode(text, add_special_tokens=False).ids)
        return sum(1 if special else sum(map(self.words.__getitem__, self.splitter.words(part))) for special, part in self.splitter.pieces(text))


def _run(batches: Iterator[pa.RecordBatch], key: str, path: str, given: Broadcast, limit: int) -> Iterator[pa.RecordBatch]:
    counts = kept(key, lambda: Counts(path, given.value))
    for batch in batches:
        texts = batch.column(1).to_pylist()
        n = [counts(t) for t in texts]
        size = [len(t.encode("utf-8")) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024, table: dict[str, int] | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than limit tokens) for every row of docs."""
    spark = docs.sparkSession
    short_batches(spark)
    given = spark.sparkContext.broadcast(frequent_table(docs, path, text_col) if table is None else table)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(OnBatches(_run, uuid4().hex, path, given, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
