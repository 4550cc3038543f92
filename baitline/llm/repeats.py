"""Removal of repeated byte strings with distributed suffix arrays.

A byte is removed if it lies in a string of LENGTH bytes that also starts earlier (smaller id, or the same document,
earlier start); strings are judged on the input.

Cutting. Every GRAM-byte gram has a 64-bit digest, and each string of LENGTH bytes is owned by the smallest gram in it,
its anchor. Equal strings have equal anchors at equal offsets, so they meet when anchors are grouped; and consecutive
starts with one anchor are a cell, about 35 bytes of starts whose strings span up to MOST bytes of text, the context.

1. Documents are dealt to blocks. A block sums up its cells: one entry per anchor and context, with its first
   occurrence. Copies, however many, leave one entry a block: cells whose digests agree are compared byte by byte.
2. Entries meet by anchor. An anchor with one entry is done; the others' contexts are asked for, as text.
3. Contexts of an anchor are put into an enhanced suffix array, with those of other anchors of the same part. Equal
   contexts, found by their bytes, are one leaf of it with several occurrences. The scan over it finds the
   common-prefix intervals of LENGTH bytes or more that can't be extended to the left: the maximal repeat groups with
   all their occurrences. All but the first occurrence of a group are repeats.
4. Spans go back to the documents' blocks, where they are united.

An anchor with more than ``hot`` different contexts (a passage that very many documents share, at its edges) isn't
gathered in one task: its contexts are cut into pieces of STEP starts, aligned at the anchor, and dealt by the bytes
that all strings of a piece have, LENGTH - STEP + 1 of them. A piece is a shorter context, so steps 3 and 4 are the same.

Digests only say which bytes are compared; nothing is removed on a digest's word.

One plan: the exchange of the texts serves steps 1, 3 and 4. What is shuffled: the texts (compressed), an entry of about 20 bytes per 35 bytes of text, and the contexts
whose anchors occur in several blocks or with different texts. No row, group or text is collected anywhere.

Defined cases: null text is empty; texts shorter than LENGTH lose nothing; a null id comes before all others; rows
with one id are told apart and ordered by their texts, equal rows in any order; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from baitline.llm.common import OnBatches, input_bytes, short_batches, text_or_empty
from baitline.llm.suffix_array import MOST, later_occurrences

LENGTH = 100
GRAM = 32
HOT = 2048
STEP = 8
#: Contexts that one suffix array holds, unless a single anchor has more.
TOGETHER = 8192
#: Compressed input of a block, and starts handled at a time.
BLOCK_BYTES = 4 << 20
SLICE = 1 << 18
LOW_ID = -(1 << 63)
U = np.uint64
#: Odd multipliers of the digests.
M1, M2, M3, M4, M5 = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0xD6E8FEB86659FD93), U(0xA0761D6478BD642F)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * M4
    return x ^ (x >> U(29))


def grams(data: np.ndarray) -> np.ndarray:
    """Digest of the GRAM bytes from each place on; GRAM - 1 fewer than bytes."""
    w = data.astype(U)
    w = w[:-1] | (w[1:] << U(8))
    w = w[:-2] | (w[2:] << U(16))
    w = w[:-4] | (w[4:] << U(32))
    w = mix(w * M1)
    w = mix(w[:-8] * M2 + w[8:] * M3)
    return mix(w[:-16] * M3 + w[16:] * M5)


def window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each width values."""
    size, low = 1, x
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    rest = width - size
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def string_digests(g: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two digests of the LENGTH bytes from each start on, from the grams that cover them."""
    a, b, c, d = g[starts], g[starts + GRAM], g[starts + 2 * GRAM], g[starts + LENGTH - GRAM]
    return mix(mix(mix(a * M1 + b) * M2 + c) * M3 + d), mix(mix(mix(a * M5 + c) * M4 + d) * M2 + b)


CELL = np.dtype([("anchor", "<u8"), ("context", "<u8"), ("doc", "<u4"), ("start", "<u4"), ("count", "<u2"), ("at", "<u2")])


def cells(data: bytes, doc: int) -> np.ndarray:
    """The cells of one text: anchor, context digest, first start, number of starts and the anchor's place after it, in order."""
    every = np.frombuffer(data, np.uint8)
    out = []
    for low in range(0, len(every) - LENGTH + 1, SLICE):
        g = grams(every[low : low + SLICE + LENGTH - 1])
        n = len(g) - (LENGTH - GRAM)  # starts
        place = window_min((g & U(~(SLICE * 2 - 1) & (2**64 - 1))) | np.arange(len(g), dtype=U), LENGTH - GRAM + 1) & U(SLICE * 2 - 1)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        count = np.diff(np.concatenate((first, [n])))
        place = place[first].astype(np.int64)
        end = first + count + LENGTH - 1 - GRAM  # the last gram of the context
        c = g[first] * M1 + count.astype(U) * M5 + (place - first).astype(U)
        for at in (first + GRAM, first + 2 * GRAM, np.minimum(first + 3 * GRAM, end), np.maximum(end - GRAM, first), end):
            c = mix(c * M2 + g[at])
        part = np.empty(len(first), CELL)
        part["anchor"], part["context"], part["doc"], part["start"], part["count"], part["at"] = g[place], mix(c), doc, first + low, count, place - first
        out.append(part)
    return np.concatenate(out) if out else np.empty(0, CELL)


def pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length, bytes of equal weight together, compressed."""
    return zstandard.compress(b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns), 1)


def unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    sizes = [np.dtype(k).itemsize for k in kinds]
    n = len(raw) // sum(sizes)
    out, at = [], 0
    for kind, size in zip(kinds, sizes):
        out.append(np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(kind).reshape(n))
        at += n * size
    return out


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(3).compress
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([squeeze(t.encode("utf-8", "surrogatepass")) for t in batch.column(2).to_pylist()], pa.binary())], names=["block", "doc_id", "z"])


class Block:
    """The documents of a block in order: ids (null as LOW_ID), null marks and texts."""

    def __init__(self, table: pa.Table):
        expand = zstandard.ZstdDecompressor().decompress
        ids = table.column("doc_id").to_pylist()
        docs = sorted(((LOW_ID if i is None else i), expand(z), i) for i, z in zip(ids, table.column("z").to_pylist()))
        self.ids = np.array([d[0] for d in docs], np.int64)
        self.texts = [d[1] for d in docs]
        self.given = [d[2] for d in docs]

    def cells(self) -> tuple[np.ndarray, np.ndarray]:
        """(cells sorted by anchor, context, document and start; marks of the first of each anchor and context).

        Cells with one anchor and context have equal bytes: where they differ, the later ones get another digest.
        """
        found = np.concatenate([np.empty(0, CELL), *(cells(t, n) for n, t in enumerate(self.texts))])
        salt = 0
        while True:
            found = found[np.lexsort((found["start"], found["doc"], found["context"], found["anchor"]))]
            new = np.ones(len(found), bool)
            new[1:] = (found["anchor"][1:] != found["anchor"][:-1]) | (found["context"][1:] != found["context"][:-1])
            later = np.flatnonzero(~new)
            first = np.maximum.accumulate(np.where(new, np.arange(len(found)), 0))[later]
            wrong = [i for i, a, b in zip(later.tolist(), self.contexts(found[first]), self.contexts(found[later])) if a != b]
            if not wrong:
                return found, new
            salt += 1
            for i, text in zip(wrong, self.contexts(found[wrong])):
                found["context"][i] = int.from_bytes(hashlib.blake2b(text, digest_size=8, salt=salt.to_bytes(8, "big")).digest(), "big")

    def contexts(self, rows: np.ndarray) -> Iterator[bytes]:
        """The texts of cells."""
        for doc, start, count in zip(rows["doc"].tolist(), rows["start"].tolist(), rows["count"].tolist()):
            yield self.texts[doc][start : start + count + LENGTH - 1]


def _rows(names: str, *columns) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in names.split(", ")]
    return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


ENTRIES = "part int, block int, data binary"
ENTRY_KINDS = ("<u8", "<u8", "<i8", "<u4", "<u4")


def runs(sorted_values: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, from, to) of each run of equal values."""
    if not len(sorted_values):
        return []
    cuts = np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1], [True]))).tolist()
    return [(int(sorted_values[a]), a, b) for a, b in zip(cuts, cuts[1:])]


def part_of(digests: np.ndarray, parts: int) -> np.ndarray:
    return ((digests >> U(40)) % U(parts)).astype(np.int64) if parts <= 1 << 20 else (digests % U(parts)).astype(np.int64)


def _entries(table: pa.Table, parts: int) -> pa.Table:
    """Step 1: a block's entries by part: anchor, context, id, number in the block, start."""
    block = Block(table)
    found, new = block.cells()
    found = found[new]
    part = part_of(found["anchor"], parts)
    order = np.argsort(part, kind="stable")
    found = found[order]
    out = [(p, pack(f["anchor"], f["context"], block.ids[f["doc"]], f["doc"], f["start"])) for p, a, b in runs(part[order]) for f in (found[a:b],)]
    return _rows(ENTRIES, [p for p, _ in out], [table.column("block")[0].as_py()] * len(out), [d for _, d in out])


#: What a block is asked for: an entry's context, or its pieces.
SEND, SPLIT = 1, 2


def _answers(table: pa.Table, hot: int = HOT) -> pa.Table:
    """Step 2: what the blocks are asked of a part's entries."""
    blocks = table.column("block").to_pylist()
    read = [unpack(d, *ENTRY_KINDS)[:2] for d in table.column("data").to_pylist()]
    anchor, context = (np.concatenate([r[i] for r in read]) for i in range(2))
    block = np.repeat(np.array(blocks, np.int64), [len(r[0]) for r in read])
    order = np.lexsort((context, anchor))
    anchor, context, block = anchor[order], context[order], block[order]
    new_anchor = np.concatenate(([True], anchor[1:] != anchor[:-1]))
    new = new_anchor | np.concatenate(([True], context[1:] != context[:-1]))
    firsts, own = np.flatnonzero(new_anchor), np.cumsum(new_anchor) - 1
    entries, contexts = np.diff(np.append(firsts, len(anchor)))[own], np.add.reduceat(new, firsts)[own]
    told = np.where(entries > 1, np.where(contexts > hot, SPLIT, SEND), 0).astype(np.uint8)
    keep = np.flatnonzero(told)
    keep = keep[np.argsort(block[keep], kind="stable")]
    asked = [(b, pack(anchor[k], context[k], told[k])) for b, x, y in runs(block[keep]) for k in (keep[x:y],)]
    return _rows(ENTRIES, [0] * len(asked), [b for b, _ in asked], [d for _, d in asked])


SENT = "kind int, part int, block int, data binary, texts binary"
SENT_NAMES = [f.split()[0] for f in SENT.split(", ")]
CONTEXTS, SPANS = 0, 1
CONTEXT_KINDS = ("<u8", "<i8", "<u4", "<u4", "<u2")
SPAN_KINDS = ("<u4", "<u4", "<u4")


def pieces(cell: np.void, text: bytes) -> Iterator[tuple[int, int, int]]:
    """(key, first start, number of starts) of a context's pieces; starts are counted from the context's own.

    A piece holds the starts whose strings have the anchor between low and high bytes after their beginning; the bytes
    from low before the anchor on that all such strings have make its key.
    """
    at, count = int(cell["at"]), int(cell["count"])
    for low in range(0, LENGTH - GRAM + 1, STEP):
        high = min(low + STEP - 1, LENGTH - GRAM)
        first, last = max(at - high, 0), min(at - low, count - 1)
        if first <= last:
            yield xxh3_64_intdigest(text[at - low : at + LENGTH - high], low), first, last - first + 1


def _sent(left: pa.Table, right: pa.Table, parts: int) -> pa.Table:
    """Step 3, in a block: spans of its own repeats, and contexts and pieces for the parts."""
    if not left.num_rows:
        return _rows(SENT, [], [], [], [], [])
    number = left.column("block")[0].as_py()
    block = Block(left)
    found, new = block.cells()
    told = np.zeros(len(found), np.uint8)
    at = np.flatnonzero(new)
    answers = [unpack(d, "<u8", "<u8", "u1") for d in right.column("data").to_pylist()]
    if answers and len(at):
        anchor, context, code = (np.concatenate([a[i] for a in answers]) for i in range(3))
        # both sides without repeats: sorted together, an answer comes before its own cell
        anchors, contexts = np.concatenate((found["anchor"][at], anchor)), np.concatenate((found["context"][at], context))
        order = np.lexsort((np.arange(len(anchors)) < len(at), contexts, anchors))
        place = np.flatnonzero(order < len(at))
        place = place[place > 0]
        own, prior = order[place], order[place - 1]
        same = (prior >= len(at)) & (anchors[own] == anchors[prior]) & (contexts[own] == contexts[prior])
        told[at[own[same]]] = code[prior[same] - len(at)]
    rows = []

    def repeat(doc: np.ndarray, start: np.ndarray, count: np.ndarray) -> None:
        if len(doc):
            rows.append((SPANS, number % parts, number, pack(doc.astype("<u4"), start.astype("<u4"), (start + count + np.uint32(LENGTH - 1)).astype("<u4")), b""))

    repeat(found["doc"][~new], found["start"][~new], found["count"][~new])
    send = found[told == SEND]
    split = found[told == SPLIT]
    if len(split):
        split = split[np.lexsort((split["start"], split["doc"]))]
        cut = np.empty(len(split) * (-(-(LENGTH - GRAM + 1) // STEP)), CELL)
        n = 0
        for cell, text in zip(split, block.contexts(split)):
            for key, first, count in pieces(cell, text):
                cut[n] = key, 0, cell["doc"], int(cell["start"]) + first, count, 0
                n += 1
        cut = cut[:n]
        seen: set = set()
        again = np.array([(x := (k, t)) in seen or seen.add(x) is not None for k, t in zip(cut["anchor"].tolist(), block.contexts(cut))], bool)
        repeat(cut["doc"][again], cut["start"][again], cut["count"][again])
        send = np.concatenate((send, cut[~again]))
    part = part_of(send["anchor"], parts)
    order = np.lexsort((send["start"], send["doc"], send["anchor"], part))
    send = send[order]
    for p, a, b in runs(part[order]):
        s = send[a:b]
        rows.append((CONTEXTS, p, number, pack(s["anchor"], block.ids[s["doc"]], s["doc"], s["start"], s["count"]), zstandard.compress(b"".join(block.contexts(s)), 3)))
    return _rows(SENT, *([r[i] for r in rows] for i in range(5)))


def _grouped(table: pa.Table) -> pa.Table:
    """Step 3, in a part: spans of all occurrences of maximal repeats but the first, by block; known spans go through."""
    ready, table = table.filter(pc.field("kind") == SPANS), table.filter(pc.field("kind") == CONTEXTS)
    if not table.num_rows:
        return ready.select(SENT_NAMES)
    read = [unpack(d, *CONTEXT_KINDS) for d in table.column("data").to_pylist()]
    anchor, ids, doc, start, count = (np.concatenate([r[i] for r in read]) for i in range(5))
    block = np.repeat(np.array(table.column("block").to_pylist(), np.int64), [len(r[0]) for r in read])
    count = count.astype(np.int64)
    joined = b"".join(zstandard.decompress(t) for t in table.column("texts").to_pylist())
    whole = np.frombuffer(joined, np.uint8)
    offset = np.cumsum(count + LENGTH - 1) - (count + LENGTH - 1)
    # leaves: equal contexts of an anchor, the first occurrence before the others (equal ids are in one block, so doc orders them)
    order = np.lexsort((start, doc, ids, anchor))
    spans: list[tuple[np.ndarray, ...]] = []  # block, doc, start, end
    leaves, later = [], []
    for _, a, b in runs(anchor[order]):
        members = order[a:b]
        seen: set[bytes] = set()
        own = []
        for i, low, size in zip(members.tolist(), offset[members].tolist(), count[members].tolist()):
            text = joined[low : low + size + LENGTH - 1]
            if text in seen:
                later.append(i)
            else:
                seen.add(text)
                own.append(i)
        if len(own) > 1:
            leaves.append(own)
    if later:
        i = np.array(later)
        spans.append((block[i], doc[i], start[i], (start[i] + count[i] + LENGTH - 1).astype("<u4")))
    low = 0
    while low < len(leaves):
        high, chosen = low + 1, [*leaves[low]]
        while high < len(leaves) and len(chosen) + len(leaves[high]) <= TOGETHER:
            chosen += leaves[high]
            high += 1
        i = np.array(chosen)
        spans.extend(_repeats_of(whole, offset[i], count[i], block[i], ids[i], doc[i], start[i]))
        low = high
    if not spans:
        return ready.select(SENT_NAMES)
    block, doc, start, end = (np.concatenate([s[i] for s in spans]) for i in range(4))
    order = np.argsort(block, kind="stable")
    doc, start, end = doc[order].astype("<u4"), start[order].astype("<u4"), end[order].astype("<u4")
    out = [(b, pack(doc[x:y], start[x:y], end[x:y])) for b, x, y in runs(block[order])]
    return pa.concat_tables([ready.select(SENT_NAMES), _rows(SENT, [SPANS] * len(out), [0] * len(out), [b for b, _ in out], [d for _, d in out], [b""] * len(out))])


def _repeats_of(whole: np.ndarray, offset: np.ndarray, count: np.ndarray, block: np.ndarray, ids: np.ndarray, doc: np.ndarray, start: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Spans of one suffix array over contexts whole[offset : offset + count + LENGTH - 1]."""
    owner = np.repeat(np.arange(len(offset)), count)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    begins = offset[owner] + inside
    ends = (offset + count + LENGTH - 1)[owner]
    # strings that occur once can't be in an interval; digests tell most of them
    low, high = int(offset.min()), int((offset + count).max()) + LENGTH - 1
    if high - low > 4 * (int(count.sum()) + LENGTH * len(count)):  # the contexts lie far apart
        g = None
    else:
        g = grams(whole[low:high])
    if g is not None:
        one, _ = string_digests(g, begins - low)
    else:
        one = np.concatenate([string_digests(grams(whole[o : o + n + LENGTH - 1]), np.arange(n))[0] for o, n in zip(offset, count)])
    by = np.argsort(one, kind="stable")
    same = one[by][1:] == one[by][:-1]
    twice = np.zeros(len(one), bool)
    twice[by[1:][same]] = True
    twice[by[:-1][same]] = True
    keep = np.flatnonzero(twice)
    if not len(keep):
        return
    owner, inside, begins, ends = owner[keep], inside[keep], begins[keep], ends[keep]
    prior = np.concatenate(([False], (owner[1:] == owner[:-1]) & (inside[1:] == inside[:-1] + 1)))  # the start before is given too
    before = np.where(prior, whole[np.maximum(begins - 1, 0)].astype(np.int64), -1)
    rank = np.lexsort((inside, start[owner], doc[owner], ids[owner]))
    place = np.empty(len(rank), np.int64)
    place[rank] = np.arange(len(rank))
    rest, length = later_occurrences(whole, begins, ends, before, place, LENGTH)
    o = owner[rest]
    yield block[o], doc[o], (start[o] + inside[rest]).astype("<u4"), (start[o] + inside[rest] + length).astype("<u4")


def dealing(docs: DataFrame, block_bytes: int) -> tuple[int, int]:
    """(blocks, parts): numbers that grow with the input, so blocks and parts stay of one size; a part is of two blocks.

    A block writes a row to each part that it has something for, so rows are never more than entries.
    """
    blocks = max(12, -(-input_bytes(docs) // block_bytes))
    return blocks, max(12, blocks // 2)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def united(spans: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of (start, end) rows."""
    out: list[list[int]] = []
    for a, b in spans[np.argsort(spans[:, 0], kind="stable")].tolist():
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _finished(left: pa.Table, right: pa.Table, whole: bool) -> pa.Table:
    """Step 4: the documents of a block, with their spans united."""
    if not left.num_rows:
        return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())] + ([pa.array([], pa.string()), pa.array([], _SPAN_LIST)] if whole else []), names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept", "spans"] * whole)
    block = Block(left)
    read = [unpack(d, *SPAN_KINDS) for d in right.column("data").to_pylist()]
    doc, start, end = (np.concatenate([np.empty(0, np.uint32), *(r[i] for r in read)]) for i in range(3))
    order = np.argsort(doc, kind="stable")
    doc, start, end = doc[order], start[order], end[order]
    cuts = np.searchsorted(doc, np.arange(len(block.texts) + 1))
    out = []
    for n, (given, text) in enumerate(zip(block.given, block.texts)):
        a, b = cuts[n], cuts[n + 1]
        runs = united(np.column_stack((start[a:b], end[a:b])).astype(np.int64)) if b > a else []
        kept, at = [], 0
        for x, y in runs:
            kept.append(text[at:x])
            at = y
        kept.append(text[at:])
        rest = b"".join(kept)
        out.append((given, len(text), len(text) - len(rest), len(runs), hashlib.sha256(rest).hexdigest(), rest, runs))
    columns = [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()))]
    if whole:
        columns += [pa.array([o[5].decode("utf-8", "ignore") for o in out], pa.string()), pa.array([[{"start": x, "end": y} for x, y in o[6]] for o in out], _SPAN_LIST)]
    return pa.table(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept", "spans"] * whole)


_SPAN_LIST = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole: bool = False, block_bytes: int = BLOCK_BYTES, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if whole, the kept text (cut characters left out) and spans."""
    spark = docs.sparkSession
    short_batches(spark)
    blocks, parts = dealing(docs, block_bytes)
    key = F.col(id_col).cast("long")
    rows = docs.select(F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("block"), key.alias("doc_id"), text_or_empty(text_col).alias("text"))
    dealt = rows.mapInArrow(OnBatches(_deal), "block int, doc_id long, z binary")
    entries = dealt.groupBy("block").applyInArrow(lambda t: _entries(t, parts), ENTRIES)
    answers = entries.groupBy("part").applyInArrow(lambda t: _answers(t, hot), ENTRIES)
    sent = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(lambda a, b: _sent(a, b, parts), SENT)
    spans = sent.groupBy("part").applyInArrow(lambda t: _grouped(t), SENT).select("block", "data")
    return dealt.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(lambda a, b: _finished(a, b, whole), RESULT + ", kept string, spans array<struct<start:long,end:long>>" * whole)
