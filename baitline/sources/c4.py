"""Protein-to-genome alignments in C4 text, with a coding-sequence record after each block."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "query string, contig string, revcomp boolean, model string, score int, s long, e long, t_start long, t_end long, strand int, "
    "frags array<struct<q_s:long,q_e:long,h_s:long,h_e:long>>, ident array<int>, hit_seq string, intron_spans array<long>, pct double, cds string"
)
_HEAD = re.compile(r"^\s*(Query|Target|Model|Raw score|Query range|Target range): (.*)$")
_ROW = re.compile(r"^(\s*-?\d+ : )(.*?)( :\s*-?\d+\s*)$")


def parse(block: str) -> dict | None:
    """One alignment block; None where there is none."""
    head, groups, record = {}, [], []
    lines = block.split("\n")
    i = 0
    while i < len(lines):
        line = lines[i]
        if m := _HEAD.match(line):
            head[m[1]] = m[2].strip()
        elif line.startswith(">"):
            record = [line[1:], *(x.strip() for x in lines[i + 1 :])]
            break
        elif (m := _ROW.match(line)) and i + 3 < len(lines):
            low, high = len(m[1]), len(m[1]) + len(m[2])
            rows = [lines[i + k].ljust(high)[low:high] for k in range(4)]
            groups.append(rows)
            i += 3
        i += 1
    if "Query" not in head or not groups:
        return None
    query, similar, residues, bases = ("".join(g[k] for g in groups) for k in range(4))
    start, end = (int(x) for x in head["Query range"].split(" -> "))
    t0, t1 = (int(x) for x in head["Target range"].split(" -> "))
    step = 1 if t0 <= t1 else -1
    frags: list[list[int]] = []
    ident: list[int] = []
    codons: list[str] = []
    spans: list[int] = []
    q3, h = start * 3, t0
    fresh, column, length = True, [], len(query)
    k = 0
    while k < length:
        if query[k : k + 4] == ">>>>" or re.match(r"\s*>>>> ", query[k:]) and bases[k].islower():
            # an intron: two lower-case ends with dots between, and its length in the similarity row
            stop = k
            while stop < length and (bases[stop].islower() or bases[stop] in ". "):
                stop += 1
            found = re.search(r"(\d+) bp", similar[k:stop])
            span = int(found[1]) if found else 0
            h += step * span
            spans.append(span)
            fresh, k = True, stop
            continue
        if bases[k].islower() or bases[k] == ".":
            k += 1
            continue
        if residues[k] == "#":  # bases out of frame
            run = k
            while run < length and residues[run] == "#":
                run += 1
            n = sum(c.isalpha() for c in bases[k:run])
            h += step * n
            spans.append(n)
            fresh, k = True, run
            continue
        if query[k] in "{}":
            k += 1
            continue
        if fresh:
            frags.append([q3 // 3, q3 // 3, h, h])
            fresh = False
        column.append(k)
        q3 += query[k].isalpha()
        h += step * bases[k].isalpha()
        frags[-1][1], frags[-1][3] = -(-q3 // 3), h
        k += 1
        if len(column) == 3:
            codons.append("".join(bases[c] if bases[c].isalpha() else "-" for c in column))
            ident.append(int(all(similar[c] == "|" for c in column)))
            column = []
    meta = record[0].split(",") if record else []
    return {
        "query": head["Query"].split()[0], "contig": head["Target"].split()[0], "revcomp": "[revcomp]" in head["Target"], "model": head.get("Model", ""), "score": int(head["Raw score"]), "s": start, "e": end, "t_start": t0, "t_end": t1, "strand": step,
        "frags": [{"q_s": a, "q_e": b, "h_s": min(c, d), "h_e": max(c, d)} for a, b, c, d in frags], "ident": ident, "hit_seq": "".join(codons), "intron_spans": spans, "pct": float(meta[4]) if len(meta) > 4 else None, "cds": "".join(record[1:]),
    }


def _parse_all(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [f.strip().split(" ")[0] for f in re.split(r", (?![^<]*>)", SCHEMA)]
    for frame in frames:
        rows = [r for r in map(parse, frame["value"]) if r]
        yield pd.DataFrame(rows, columns=columns)


def alignments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "C4 Alignment:").text(path).mapInPandas(_parse_all, SCHEMA)
