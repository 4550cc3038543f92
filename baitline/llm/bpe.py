"""BPE encoding and decoding with a transducer lexicon.

The frequent words of all texts, counted in a pass of its own, are compiled into a minimal acyclic transducer whose
outputs are their ids. The file goes to the shared folder and from there to
each executor, where all workers memory-map the one copy. A word that is not in it is merged exactly, by the library,
and kept in a bounded worker cache, as are stretches without white space, so one met again isn't cut into words.
Decoding goes from ids back to text through the vocabulary.

Defined cases: null text counts as empty (no ids, empty decoded text); special strings inside a text become their one
id; repeated rows are encoded each; extra columns are ignored or, in encode_documents, kept.
"""

from __future__ import annotations

import hashlib
import struct
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from uuid import uuid4

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baitline.llm import tokens
from baitline.llm.common import OnBatches, kept, shared_dir, short_batches, text_or_empty
from baitline.llm.transducer import Lexicon, compile_lexicon

LEXICON_WORDS = 50_000
#: A worker hands its counts on when it holds this many stretches without white space, so its memory is bounded.
COUNTED_WORDS = 200_000
#: Longer words are left to the worker caches, so the lexicon's size is bounded.
LEXICON_CHARS = 48


@lru_cache(maxsize=2)
def _names(path: str) -> list[str]:
    tokenizer = tokens.load(path)
    return [tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]


def merge_word(path: str, word: str) -> list[int]:
    """The ids of one normalised word, merged by the library."""
    return [t.id for t in tokens.merged(path, word)]


def _counted(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """(word, n): partial counts of the words of texts; a text that goes through the library whole has none."""
    splitter = tokens.Splitter(path, tokens.WORD_PATTERN, lower=True)
    seen: Counter[str] = Counter()  # of chunks, which are cut into words once

    def out() -> pa.RecordBatch:
        words: dict[str, int] = {}
        for chunk, n in seen.items():
            for w in splitter.findall(chunk):
                words[w] = words.get(w, 0) + n
        seen.clear()
        words = {w: n for w, n in words.items() if len(w) <= LEXICON_CHARS}
        return pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], names=["word", "n"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            if splitter.safe(text):
                for special, part in splitter.pieces(text):
                    if not special:
                        seen.update(splitter.chunks(part))
            if len(seen) >= COUNTED_WORDS:
                yield out()
    yield out()


def frequent_words(docs: DataFrame, path: str, text_col: str = "text", words: int = LEXICON_WORDS) -> list[str]:
    """The most frequent words over every text of docs, ties by the word."""
    short_batches(docs.sparkSession)
    counts = docs.select(text_or_empty(text_col).alias("t")).mapInArrow(OnBatches(_counted, path), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [r.word for r in counts.orderBy(F.desc("n"), "word").limit(words).collect()]


def frequent_lexicon(docs: DataFrame, path: str, text_col: str = "text", words: int = LEXICON_WORDS) -> bytes:
    return compile_lexicon((w.encode(), merge_word(path, w)) for w in frequent_words(docs, path, text_col, words))


def publish(spark: SparkSession, data: bytes) -> str:
    """Writes data into the shared folder and has every executor fetch it once; the name to open it by."""
    name = f"lexicon-{hashlib.sha256(data).hexdigest()[:24]}.bin"
    sc = spark.sparkContext
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/{name}")
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(path):
        out = fs.create(path, True)
        for at in range(0, len(data), 1 << 20):
            out.write(bytearray(data[at : at + (1 << 20)]))
        out.close()
    sc.addFile(fs.makeQualified(path).toString())
    return name


class Codec:
    """Encodes and decodes texts in one worker."""

    def __init__(self, path: str, lexicon: Lexicon):
        self.path, self.lexicon, self.names = path, lexicon, _names(path)
        self.splitter = tokens.Splitter(path, tokens.WORD_PATTERN, lower=True)
        self.words = tokens.Words({}, self._find)
        self.chunks = tokens.Words({}, self._chunk)

    def _coded(self, ids) -> tuple[bytes, str]:
        names = self.names
        return struct.pack(f"<{len(ids)}I", *ids), " ".join([names[i] for i in ids])

    def _find(self, word: str) -> tuple[bytes, str]:
        ids = self.lexicon.find(word.encode())
        if ids is None:
            return self._coded(merge_word(self.path, word))
        out = self.words.given[word] = self._coded(ids)  # words of the lexicon stay when the cache is emptied
        return out

    def _chunk(self, chunk: str) -> tuple[bytes, str]:
        found = [self.words[w] for w in self.splitter.findall(chunk)]
        return found[0] if len(found) == 1 else self._joined(found)

    @staticmethod
    def _joined(found: list[tuple[bytes, str]]) -> tuple[bytes, str]:
        """Parts in order; those without ids leave no space in the text."""
        return b"".join([ids for ids, _ in found]), " ".join([text for ids, text in found if ids])

    def __call__(self, text: str) -> tuple[bytes, str]:
        """(ids as little-endian uint32, decoded text)."""
        if not self.splitter.safe(text):
            return self._coded(tokens.load(self.path).encode(text, add_special_tokens=False).ids)
        found = []
        for special, part in self.splitter.pieces(text):
            if special:
                found.append(self._coded([tokens.load(self.path).token_to_id(part)]))
            else:
                found.extend(map(self.chunks.__getitem__, self.splitter.chunks(part)))
        return self._joined(found)


def _run(batches: Iterator[pa.RecordBatch], key: str, path: str, name: str, more: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    codec = kept(key, lambda: Codec(path, Lexicon.mapped(SparkFiles.get(name))))
    for batch in batches:
        coded = [codec(t) for t in batch.column(1).to_pylist()]
        columns = {"doc_id": batch.column(0), "n_tokens": pa.array([len(ids) // 4 for ids, _ in coded], pa.int64())}
        columns["ids_sha256"] = pa.array([hashlib.sha256(ids).hexdigest() for ids, _ in coded])
        columns["decoded_sha256"] = pa.array([hashlib.sha256(text.encode("utf-8")).hexdigest() for _, text in coded])
        if "ids" in more:
            columns["ids"] = pa.array([memoryview(ids).cast("I").tolist() if ids else [] for ids, _ in coded], pa.list_(pa.int32()))
        if "decoded" in more:
            columns["decoded"] = pa.array([text for _, text in coded], pa.string())
        yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", more: tuple[str, ...] = ("ids", "decoded"), lexicon: bytes | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, as more asks, ids and decoded, for every row of docs."""
    spark = docs.sparkSession
    short_batches(spark)
    name = publish(spark, frequent_lexicon(docs, path, text_col) if lexicon is None else lexicon)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += "".join(f", {c} {kind}" for c, kind in (("ids", "array<int>"), ("decoded", "string")) if c in more)
    return rows.mapInArrow(OnBatches(_run, uuid4().hex, path, name, more), schema)
