"""Formats that need a reader of their own: FASTQ, BAM and packed samples. One task a file, streamed row by row.

Files are opened through Arrow file systems, so paths may be in any store that Arrow reaches.
"""

from __future__ import annotations

import gzip
import io
import struct
import tarfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def _store(path: str):
    """(Arrow file system, path in it); a path without scheme, or with file: alone, is local."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")


def _files(path: str) -> list[str]:
    from pyarrow import fs

    store, root = _store(path)
    info = store.get_file_info(root)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    scheme = path.split("://")[0] + "://" if "://" in path else ""
    found = [f.path for f in store.get_file_info(fs.FileSelector(root)) if f.type == fs.FileType.File] if info.type == fs.FileType.Directory else [info.path]
    shown = (f for f in found if not f.rsplit("/", 1)[-1].startswith(("_", ".")))  # as Spark's own readers do
    return sorted(f"{scheme}{f}" for f in shown)


def _open(path: str):
    from pyarrow import fs

    store, inner = _store(path)
    return store.open_input_file(inner)


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p in _files(self.path)]

    def read(self, partition: _File) -> Iterator[tuple]:
        with _open(partition.path) as f:
            yield from self.rows(f, partition.path)

    def rows(self, file, path: str) -> Iterator[tuple]:
        raise NotImplementedError


class _Fastq(_Reader):
    def rows(self, file, path: str) -> Iterator[tuple]:
        lines = io.BufferedReader(gzip.GzipFile(fileobj=file) if path.endswith(".gz") else file)
        number = 0
        while head := lines.readline():
            seq, plus, qual = (lines.readline().rstrip(b"\r\n").decode() for _ in range(3))
            head = head.rstrip(b"\r\n").decode()
            if not head.startswith("@") or not plus.startswith("+") or len(seq) != len(qual):
                raise ValueError(f"{path}: record {number + 1} is not FASTQ")
            yield path, number, head[1:], seq, qual
            number += 1


class Fastq(DataSource):
    """(file, ord, id, seq, qual) of FASTQ files, plain or gzip; a malformed record is an error."""

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return "file string, ord long, id string, seq string, qual string"

    def reader(self, schema) -> DataSourceReader:
        return _Fastq(self.options["path"])


class _Bam(_Reader):
    def rows(self, file, path: str) -> Iterator[tuple]:
        data = gzip.GzipFile(fileobj=file)  # blocks are gzip members

        def take(n: int) -> bytes:
            out = data.read(n)
            if len(out) != n:
                raise ValueError(f"{path} is cut short")
            return out

        if take(4) != b"BAM\x01":
            raise ValueError(f"{path} is not BAM")
        take(struct.unpack("<i", take(4))[0])
        names = []
        for _ in range(struct.unpack("<i", take(4))[0]):
            names.append(take(struct.unpack("<i", take(4))[0])[:-1].decode())
            take(4)
        letters = "=ACMGRSVTWYHKDBN"
        while size := data.read(4):
            block = take(struct.unpack("<i", size)[0])
            ref, pos, n_name, mapq, _, n_cigar, flag, n_seq = struct.unpack_from("<iiBBHHHi", block)
            at = 32 + n_name
            read_id = block[32 : at - 1].decode()
            at += 4 * n_cigar
            packed = block[at : at + (n_seq + 1) // 2]
            seq = "".join(letters[b >> 4] + letters[b & 15] for b in packed)[:n_seq]
            at += (n_seq + 1) // 2 + n_seq
            yield read_id, flag, names[ref] if ref >= 0 else None, pos + 1, mapq, seq, self._edits(block, at), float(mapq)

    @staticmethod
    def _edits(block: bytes, at: int) -> int | None:
        widths = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
        codes = {"c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I"}
        while at < len(block):
            tag, kind = block[at : at + 2], chr(block[at + 2])
            at += 3
            if tag == b"NM" and kind in codes:
                return struct.unpack_from(codes[kind], block, at)[0]
            if kind in "ZH":
                at = block.index(b"\0", at) + 1
            elif kind == "B":
                at += 5 + widths[chr(block[at])] * struct.unpack_from("<i", block, at + 1)[0]
            else:
                at += widths[kind]
        return None


class Bam(DataSource):
    """The same columns as text.sam, of BAM files."""

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return "read_id string, flag int, target string, pos int, mapq int, seq string, nm int, score double"

    def reader(self, schema) -> DataSourceReader:
        return _Bam(self.options["path"])


class _Packed(_Reader):
    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p in _files(self.path) if p.endswith(".tar.gz")]

    def rows(self, file, path: str) -> Iterator[tuple]:
        sample = path.rsplit("/", 1)[-1].removesuffix(".tar.gz")
        with tarfile.open(fileobj=file, mode="r|gz") as members:
            for member in members:
                if member.isfile():
                    yield sample, member.name, member.size, members.extractfile(member).read()


class Packed(DataSource):
    """(sample, member, size, content) of packed sample folders <sample>.tar.gz."""

    @classmethod
    def name(cls) -> str:
        return "packed_sample"

    def schema(self) -> str:
        return "sample string, member string, size long, content binary"

    def reader(self, schema) -> DataSourceReader:
        return _Packed(self.options["path"])


def _load(spark: SparkSession, source: type[DataSource], path: str) -> DataFrame:
    spark.dataSource.register(source)
    return spark.read.format(source.name()).load(path)


def fastq(spark: SparkSession, path: str) -> DataFrame:
    return _load(spark, Fastq, path)


def fastq_pairs(spark: SparkSession, first: str, second: str) -> DataFrame:
    """(ord, id1, seq1, qual1, id2, seq2, qual2): mates by position in their files."""
    one = fastq(spark, first).selectExpr("ord", "id as id1", "seq as seq1", "qual as qual1")
    two = fastq(spark, second).selectExpr("ord", "id as id2", "seq as seq2", "qual as qual2")
    return one.join(two, "ord")


def bam(spark: SparkSession, path: str) -> DataFrame:
    return _load(spark, Bam, path).where("(flag & 4) = 0")


def packed_samples(spark: SparkSession, path: str) -> DataFrame:
    return _load(spark, Packed, path)


def samples(spark: SparkSession, root: str, wanted: list[str]) -> tuple[list[str], list[str]]:
    """(found, missing) of the wanted samples under root, sorted; one that is both a folder and packed is an error."""
    from pyarrow import fs

    store, inner = _store(root)
    entries = {f.base_name: f.type for f in store.get_file_info(fs.FileSelector(inner))}
    folders = {n for n, t in entries.items() if t == fs.FileType.Directory}
    packed = {n.removesuffix(".tar.gz") for n in entries if n.endswith(".tar.gz")}
    if both := sorted(folders & packed & set(wanted)):
        raise ValueError(f"both packed and unpacked: {', '.join(both)}")
    return sorted(set(wanted) & (folders | packed)), sorted(set(wanted) - folders - packed)
