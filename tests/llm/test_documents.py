"""Operators on documents against plain versions, on a small table and on one of odd cases."""

import gc
import hashlib
import random
import struct
import time
from collections import Counter, defaultdict
from pathlib import Path
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from baitline.llm import bpe, components, exact_dedup, mixing, passages, repeats, simhash, token_counts, toxicity
from baitline.llm.common import table

SMALL = "/root/testdata/sf0.001"
CLASHING = ["block", "part", "salt", "sha", "norm", "digest", "key", "node", "fp", "kind", "size", "draw", "bucket", "_row", "nth"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


def random_words(rng, n, names=400):
    letters = lambda i: chr(97 + i % 26) + (letters(i // 26) if i >= 26 else "")
    return " ".join(letters(rng.randrange(names)) for _ in range(n))


@pytest.fixture(scope="module")
def odd_rows():
    """Nulls in any column, empty and very long texts, repeated rows and ids, special strings, odd characters."""
    rng = random.Random(5)
    passage = random_words(rng, 80, 100_000)
    long = random_words(rng, 30_000, 50_000)
    texts = [
        None, "", " \t\n ", "One", "one  ONE\tone", "one one one", passage, passage + " tail one", "head two " + passage, passage.replace(" ", "\n"), long, long, "<|endoftext|> x <|startoftext|>y",
        "aaaa" * 200, "İstanbul ΣΑΣ ﬁ ́ é   \x1c   🙂 ½ Ⅻ", "日本語 テキスト", "idiot scum " * 5, "a\u0000b c", "-" * 500, "x" * 99, "x" * 100, "x" * 101,
    ]
    rows = []
    for i, t in enumerate(texts):
        rows.append((i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, None))
    rows += [(6, passage, None, None, 1), (6, passage, None, None, 1), (7, "another text with the same id", "en", "s1", 2), (None, passage, None, "s0", None), (None, None, None, None, None), (None, "text without an id", "xx", "s0", 3)]
    return [(*r, *["?"] * len(CLASHING)) for r in rows]


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SMALL, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


def bag(rows):
    return Counter(map(tuple, rows))


# --- exact dedup ---


def normal(text):
    out = "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "")
    while "  " in out:
        out = out.replace("  ", " ")
    return out


def plain_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[normal(t)].append(i)
    out, seen = [], set()
    for i, t in rows:
        own = groups[normal(t)]
        keep = min((x for x in own if x is not None), default=None)
        first = i == keep and normal(t) not in seen
        if first:
            seen.add(normal(t))
        out.append((i, keep, len(own), first, hashlib.sha256(normal(t).encode()).hexdigest()))
    return out


def test_exact_groups(odd, odd_rows, docs, texts):
    assert bag(exact_dedup.exact_groups(odd).collect()) == bag(plain_exact([(r[0], r[1]) for r in odd_rows]))
    assert bag(exact_dedup.exact_groups(docs).collect()) == bag(plain_exact(list(texts.items())))


def test_drop_copies(odd, odd_rows, none):
    left = exact_dedup.drop_copies(odd)
    assert left.columns == odd.columns
    assert sorted(normal(r.text) for r in left.collect()) == sorted({normal(r[1]) for r in odd_rows})
    assert exact_dedup.drop_copies(none).count() == exact_dedup.exact_groups(none).count() == 0


# --- tokens ---


@pytest.mark.parametrize("kind", ["few", "none"])
def test_token_counts(odd, odd_rows, none, kind):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    got = token_counts.count_tokens(odd, path, table={} if kind == "none" else None)
    n = lambda t: len(tokenizer.encode(t or "", add_special_tokens=False).ids)
    assert bag(got.collect()) == bag((r[0], len((r[1] or "").encode()), n(r[1]), n(r[1]) > 1024) for r in odd_rows)
    assert token_counts.count_tokens(none, path).count() == 0


def test_token_counts_of_the_small_table(docs, texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    want = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}
    assert {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, path).collect()} == want


def test_bpe(odd, odd_rows, docs, texts, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)

    def plain(i, text):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        return i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    assert bag(bpe.encode(odd, path, more=()).collect()) == bag(plain(r[0], r[1]) for r in odd_rows)
    assert bag(bpe.encode(docs, path, more=()).collect()) == bag(plain(*x) for x in texts.items())
    whole = bpe.encode(odd, path, lexicon=bpe.compile_lexicon([])).where("doc_id = 4").first()
    assert whole.ids == tokenizer.encode("one  ONE\tone", add_special_tokens=False).ids and whole.decoded == tokenizer.decode(whole.ids)
    assert bpe.encode(none, path).count() == 0


def test_caches_are_bounded():
    from baitline.llm.tokens import CACHE_CHARS, Words

    words = Words({"a": 0}, len, most=3)
    assert [words[w] for w in ("a", "bb", "ccc", "x" * (CACHE_CHARS + 1), "dddd", "bb")] == [0, 2, 3, CACHE_CHARS + 1, 4, 2]
    assert len(words) <= 4 and max(map(len, words)) <= CACHE_CHARS
    for i in range(50):
        assert words["y" * (i % 20 + 1)] == i % 20 + 1
    assert len(words) <= 4 and words["a"] == 0


def test_lexicon_is_exact_and_minimal():
    from baitline.llm.transducer import Lexicon, compile_lexicon

    rng = random.Random(1)
    words = {bytes(rng.choice(b"abc") for _ in range(rng.randrange(0, 9))): [rng.randrange(50) for _ in range(rng.randrange(4))] for _ in range(500)}
    lexicon = Lexicon(compile_lexicon(words.items()))
    for w, ids in words.items():
        assert list(lexicon.find(w)) == ids
    for _ in range(500):
        w = bytes(rng.choice(b"abcd") for _ in range(rng.randrange(0, 10)))
        assert (lexicon.find(w) is not None) == (w in words)
    # states of the minimal automaton are the distinct sets of suffixes
    prefixes = {w[:i] for w in words for i in range(len(w) + 1)}
    rights = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for p in prefixes}
    assert len(lexicon.final) == len(rights)


# --- SimHash ---


def plain_fingerprint(text, k, seed=42):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64(p.encode(), seed=seed).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in nodes:
        for b in nodes:
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def plain_near(rows):
    prints = [(i, plain_fingerprint(t, 4)) for i, t in rows]
    root = classes({f for _, f in prints}, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for i, f in prints:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return [(i, f"{f:016x}", least.get(root[f])) for i, f in prints]


def test_near_groups(odd, odd_rows, docs, texts, none):
    assert bag(simhash.near_groups(odd).collect()) == bag(plain_near([(r[0], r[1]) for r in odd_rows]))
    assert bag(simhash.near_groups(docs).collect()) == bag(plain_near(list(texts.items())))
    assert simhash.near_groups(none).count() == 0


@pytest.mark.parametrize(("distance", "total"), [(4, None), (5, None), (8, 18), (2, None)])
def test_links_have_the_components_of_all_pairs(spark, distance, total):
    rng = random.Random(distance)
    points = []
    for _ in range(30):
        center = (rng.getrandbits(64), rng.getrandbits(64))
        for _ in range(rng.choice([1, 3, 40])):
            flip = lambda x: x ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5)))
            points.append((flip(center[0]) % 2**64, flip(center[1]) % 2**64))
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    nodes = {p: n for n, p in enumerate(dict.fromkeys(points if total else [(a, 0) for a, _ in points]))}
    if total:
        frame = spark.createDataFrame([(signed(a), signed(b), n) for (a, b), n in nodes.items()], "fp long, fp2 long, node long")
    else:
        frame = spark.createDataFrame([(signed(a),) for a, _ in nodes], "fp long")
        nodes = {(a, 0): signed(a) for a, _ in nodes}
    got = {r.node: r.component for r in components.connected_components(simhash.linked(frame, distance, total)).collect()}
    near = lambda a, b: (a[0] ^ b[0]).bit_count() <= distance and (total is None or (a[0] ^ b[0]).bit_count() + (a[1] ^ b[1]).bit_count() <= total)
    want = classes(set(nodes), near)
    mine = defaultdict(set)
    for p, n in nodes.items():
        mine[got.get(n, n)].add(p)
    other = defaultdict(set)
    for p, r in want.items():
        other[r].add(p)
    assert {frozenset(x) for x in mine.values()} == {frozenset(x) for x in other.values()}


def test_grid_joins_near_copies_without_bands(spark):
    """The grid over the sets' fingerprints proposes pairs by itself; the shingles decide on them."""
    rng = random.Random(4)
    words = [f"w{rng.randrange(10**6)}" for _ in range(600)]
    other = [f"x{rng.randrange(10**6)}" for _ in range(600)]
    texts = [" ".join(words), " ".join([*words[:300], "new", *words[301:]]), " ".join(other), " ".join([*other, "more"]), ""]
    rows = [(i, i, *(v - (1 << 64) if v >= 1 << 63 else v for v in found[:3]), found[3], []) for i, found in enumerate(simhash.sketch(t, 5) for t in texts)]
    assert all((rows[a][3] ^ rows[b][3]).bit_count() <= simhash.NEAR_DISTANCE for a, b in ((0, 1), (2, 3)))
    links = simhash.alike(spark.createDataFrame(rows, simhash.SKETCH)).collect()
    assert {frozenset((r.a, r.b)) for r in links} == {frozenset((rows[a][2], rows[b][2])) for a, b in ((0, 1), (2, 3))}


def test_lexicon_words_are_counted_over_all_texts(spark):
    """Words of late rows and of long texts count like those of the first 2,000 rows."""
    rows = [(i, "early") for i in range(2_500)] + [(2_500 + i, "late late") for i in range(2_500)] + [(5_000, "long " * 20_000)]
    found = bpe.frequent_words(spark.createDataFrame(rows, "doc_id long, text string"), public_tokenizers.path("word_bpe_49k.json"), words=2)
    assert found == ["long", "late"]


def test_stretches_without_white_space_are_cut_once(monkeypatch):
    """A stretch met again is not cut into words again; what is found is what the library gives, separators and all."""
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    codec = bpe.Codec(path, bpe.Lexicon(bpe.compile_lexicon((w.encode(), bpe.merge_word(path, w)) for w in ("the", "word", "!!"))))
    cut = Counter()
    real = codec.splitter.findall
    monkeypatch.setattr(codec.splitter, "findall", lambda part: (cut.update([part]), real(part))[1])
    odd = ["The word's, the WORD's!!  the\nword's, don't_'s 12\xa03", "a\x1cb \x1d\x1e c\x1f", "ÉCOLE\u2003l'été\x85'll it'LL", "<|endoftext|>the<|startoftext|> word" + "x" * 90, ""]
    for text in odd * 2:
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec(text) == (struct.pack(f"<{len(ids)}I", *ids), library.decode(ids, skip_special_tokens=False))
    assert cut["word's,"] == cut["the"] == 1 and max(len(c) for c in cut) < 100


def test_words_of_the_lexicon_stay_in_a_full_cache():
    path = public_tokenizers.path("word_bpe_49k.json")
    codec = bpe.Codec(path, bpe.Lexicon(bpe.compile_lexicon([(b"the", bpe.merge_word(path, "the"))])))
    codec.words.most = 2
    for word in ("the", "one", "two", "three", "four"):
        assert codec.words[word][0] == struct.pack(f"<{len(bpe.merge_word(path, word))}I", *bpe.merge_word(path, word))
    assert "the" in dict.keys(codec.words) and len(codec.words) <= 3


def test_drop_near(spark, odd, none):
    rng = random.Random(3)
    text = random_words(rng, 400, 5000)
    near = text.replace(text.split()[200], "changed")
    other = random_words(rng, 400, 5000)
    frame = spark.createDataFrame([(5, text), (3, near), (9, text), (4, other), (None, text), (8, None), (7, "")], "doc_id long, text string")
    left = simhash.drop_near(frame)
    assert left.columns == frame.columns and sorted(r.doc_id for r in left.collect()) == [3, 4, 7]
    assert simhash.drop_near(odd).columns == odd.columns
    assert simhash.drop_near(none).count() == 0


def test_drop_near_finds_all_pairs_from_four_fifths_on(spark):
    rng = random.Random(12)
    rows, want = [], set()
    for pair in range(200):
        words = random_words(rng, rng.randrange(60, 500), 100_000).split()
        other = [*words]
        grams = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        near = lambda w: len(grams(words) & grams(w)) / len(grams(words) | grams(w))
        while near(other) > (0.92, 0.84)[pair % 2]:
            before = [*other]
            other[rng.randrange(len(other))] = f"edit{rng.randrange(10**6)}"
        if pair % 4 == 3:  # just above the limit, or just below
            while near(other) >= 0.8:
                before, other = other, [*other]
                other[rng.randrange(len(other))] = f"edit{rng.randrange(10**6)}"
            other = before if pair % 8 == 3 else other
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join(other))]
        want |= {2 * pair} | ({2 * pair + 1} if near(other) < 0.8 else set())
    left = simhash.drop_near(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in left} == want


@pytest.mark.parametrize("hot", [20, 40])
def test_near_copies_in_hot_cells(spark, hot):
    """Clusters of near copies, chains of them, and single texts in cells that are cut into pieces: as by all pairs."""
    rng = random.Random(17)
    rows = []
    for cluster in range(4):
        base = random_words(rng, 150, 100_000).split()
        for _ in range(30):  # around one text
            words = [*base]
            for _ in range(rng.randrange(4)):
                words[rng.randrange(150)] = f"edit{rng.randrange(10**6)}"
            rows.append(" ".join(words))
        for _ in range(12):  # a chain that leads away from it
            for _ in range(2):
                base[rng.randrange(150)] = f"edit{rng.randrange(10**6)}"
            rows.append(" ".join(base))
    rows = [*enumerate(rows)]
    rng.shuffle(rows)
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, t in rows for w in (t.split(),)}
    root = classes(set(sets), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    left = simhash.drop_near(spark.createDataFrame(rows, "doc_id long, text string"), hot=hot)
    assert {r.doc_id for r in left.collect()} == set(root.values())


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(120)] + [(7, 7)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for l in links for x in l if l[0] != l[1]}
    pairs = set(links)
    want = classes(nodes, lambda a, b: (a, b) in pairs)
    assert got == want


# --- repeats ---


def plain_repeats(rows, length=100):
    out, seen = [], set()
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            part = data[s : s + length]
            if part in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(part)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        runs = sum(1 for k in range(len(data)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize(("hot", "block_bytes"), [(2048, 4 << 20), (1, 1 << 16)])
def test_repeats(odd, odd_rows, docs, texts, none, hot, block_bytes):
    assert bag(repeats.remove_repeats(odd, hot=hot, block_bytes=block_bytes).collect()) == bag(plain_repeats([(r[0], r[1]) for r in odd_rows]))
    assert bag(repeats.remove_repeats(docs, hot=hot, block_bytes=block_bytes).collect()) == bag(plain_repeats(list(texts.items())))
    assert repeats.remove_repeats(none).count() == 0


def test_repeats_in_hard_texts(spark):
    rng = random.Random(8)
    base = "".join(rng.choice("ab ") for _ in range(3000))
    rows = []
    for i in range(60):
        at = [rng.randrange(2900) for _ in range(3)]
        rows.append((i, "".join(base[a : a + rng.randrange(60, 300)] + "".join(rng.choice("xyz") for _ in range(rng.randrange(30))) for a in at)))
    rows += [(100, "ab" * 400), (101, "ab" * 300 + "c" + "ab" * 90), (102, "é" * 150)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    whole = repeats.remove_repeats(frame, whole=True).collect()
    assert bag(r[:5] for r in whole) == bag(plain_repeats(rows))
    for r in whole:
        data = dict(rows)[r.doc_id].encode()
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert all(0 <= s.start < s.end <= len(data) for s in r.spans)


def colliding_halves(rng, n):
    """Pairs of 16-byte printable texts whose sixteen bytes have one digest in repeats.grams: written down by solving for the second half."""
    whole, odd = 1 << 64, repeats.M4.item()

    def mixed(x):
        x = (x ^ (x >> 32)) * odd % whole
        return x ^ (x >> 29)

    def unmixed(x):
        x = x ^ (x >> 29) ^ (x >> 58)
        x = x * pow(odd, -1, whole) % whole
        return x ^ (x >> 32)

    m1, m2, m3 = (repeats.M1.item(), repeats.M2.item(), repeats.M3.item())
    word = lambda text: mixed(int.from_bytes(text, "little") * m1 % whole)
    out = []
    while len(out) < n:
        one, two = (bytes(rng.randrange(97, 123) for _ in range(8)) for _ in range(2))
        total = (word(one) * m2 + word(two) * m3) % whole
        for _ in range(20_000):
            first = bytes(rng.randrange(33, 127) for _ in range(8))
            second = unmixed((total - word(first) * m2) * pow(m3, -1, whole) % whole) * pow(m1, -1, whole) % whole
            second = second.to_bytes(8, "little")
            if all(32 < c < 127 for c in second):
                out.append((one + two, first + second))
                break
    return out


@pytest.mark.parametrize("hot", [2048, 1])
def test_texts_whose_digests_collide_are_kept(spark, hot):
    rng = random.Random(3)
    pairs = [(b"abcdefghijklmnop", b"?_k386<OE\\a-'kiA"), *colliding_halves(rng, 6)]
    for a, b in pairs:  # the pairs do collide
        assert a != b and len({repeats.grams(np.frombuffer(bytes(8) + x + bytes(24), np.uint8))[8].item() for x in (a, b)}) == 1
    rows = []
    for a, b in pairs:
        head, tail = ("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(140)) for _ in range(2))
        for middle in (a, b, a, b):
            rows.append((len(rows), head + middle.decode() + tail))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = bag(plain_repeats(rows))
    assert any(0 < r[2] < r[1] for r in want)
    assert bag(repeats.remove_repeats(frame, hot=hot).collect()) == want  # over twelve blocks
    one_block = frame.withColumn("doc_id", F.lit(None).cast("long"))
    assert bag(r[1:] for r in repeats.remove_repeats(one_block, hot=hot).collect()) == bag(r[1:] for r in plain_repeats([(None, t) for _, t in rows]))


@pytest.mark.parametrize("hot", [2048, 4])
def test_repeats_of_a_passage_with_very_many_neighbours(spark, hot):
    rng = random.Random(4)
    line = "".join(rng.choice("abcdef ") for _ in range(150))
    rows = [(i, "".join(rng.choice("uvw ") for _ in range(rng.randrange(80))) + line + "".join(rng.choice("xyz") for _ in range(rng.randrange(80)))) for i in range(150)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert bag(repeats.remove_repeats(frame, hot=hot, block_bytes=4096).collect()) == bag(plain_repeats(rows))


def test_batches_of_long_texts_stay_small(spark):
    """Whatever was built in between: the limits are read when a query runs."""
    from baitline.llm.common import BATCH_BYTES, long_batches, short_batches

    frame = spark.range(400, numPartitions=1).select(F.repeat(F.lit("x"), 200_000).alias("t"))

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])

    short_batches(spark)
    built = frame.mapInArrow(sizes, "n long")
    long_batches(spark)
    assert max(r.n for r in built.collect()) * 200_000 <= 2 * BATCH_BYTES
    short_batches(spark)


def test_input_bytes_does_not_multiply(docs, spark):
    from baitline.llm.common import input_bytes

    labels = table(spark, SMALL, "labels")
    assert input_bytes(docs.join(labels, "doc_id", "left")) <= input_bytes(docs) + input_bytes(labels)


def test_suffix_array_and_intervals():
    from baitline.llm.suffix_array import maximal_repeats, sorted_suffixes

    rng = random.Random(1)
    for _ in range(60):
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 20))) for _ in range(rng.randint(1, 5))]
        data = np.frombuffer(b"".join(strings), np.uint8)
        starts, ends, before, at = [], [], [], 0
        for s in strings:
            for i in range(len(s)):
                starts.append(at + i), ends.append(at + len(s)), before.append(s[i - 1] if i else -1)
            at += len(s)
        starts, ends, before = map(np.array, (starts, ends, before))
        suffixes = [bytes(data[a:b]) for a, b in zip(starts, ends)]
        order, lcp = sorted_suffixes(data, starts, ends)
        assert [suffixes[i] for i in order] == sorted(suffixes)
        groups = {(n, frozenset(m.tolist())) for n, m in maximal_repeats(data, starts, ends, before, 3)}
        # every group is a set of all suffixes with one prefix, not extensible by one byte on either side
        want = set()
        for n in range(3, 21):
            for prefix in {s[:n] for s in suffixes if len(s) >= n}:
                members = [i for i, s in enumerate(suffixes) if s[:n] == prefix]
                longer = {suffixes[i][n : n + 1] for i in members}
                left = [before[i] for i in members]
                if len(members) > 1 and (len(longer) > 1 or b"" in longer) and (-1 in left or len(set(left)) > 1):
                    want.add((n, frozenset(members)))
        assert groups == want


# --- fuzzy passages ---


def test_passages(spark, odd, none):
    rng = random.Random(4)
    shared = random_words(rng, 70, 100_000).split()
    edited = [*shared]
    edited[30] = "changed"
    del edited[50]
    fill = lambda n: random_words(rng, n, 1_000_000).split()
    rows = [(1, fill(50) + shared + fill(50)), (2, fill(20) + edited + fill(40)), (3, fill(300)), (4, shared), (5, fill(30) + shared[:30] + fill(30)), (6, []), (7, fill(44))]
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = {r.doc_id: r for r in passages.passage_classes(frame).collect()}
    assert {i: r.class_id for i, r in got.items()} == {1: 1, 2: 1, 3: 3, 4: 1, 5: 5, 6: 6, 7: 7}
    assert got[1].n_links >= 1 and not got[1].passages and got[3].n_links == got[5].n_links == 0
    (p,) = [x for x in got[2].passages if x.source_id == 1]
    assert p.similarity >= 0.9 and abs(p.start - 20) <= 1 and abs(p.end - 89) <= 1 and abs(p.source_start - 50) <= 1 and abs(p.source_end - 120) <= 1
    many = passages.passage_classes(odd).collect()
    assert len(many) == odd.count() and all(r.class_id is not None or r.doc_id is None for r in many)
    assert passages.passage_classes(none).count() == 0


def plain_pairs(rows, least=45):
    """Pairs of ids whose texts share ``least`` equal words in a row, without any index of seeds."""
    places = defaultdict(set)
    for i, t in rows:
        words = (t or "").encode().lower().split()
        for k in range(len(words) - least + 1):
            places[tuple(words[k : k + least])].add(i)
    return {(x, y) for own in places.values() if len(own) > 1 for x in own for y in own if x < y}


def test_passages_against_all_pairs(spark, docs, texts):
    got = {r.doc_id: r for r in passages.passage_classes(docs).collect()}
    want = plain_pairs(texts.items())
    assert len(want) >= 5
    assert all(got[x].class_id == got[y].class_id and got[x].n_links and got[y].n_links for x, y in want)
    found, _ = passages.shared_passages(docs)
    pairs = {(r.id_a, r.id_b) for r in found.collect()}
    assert len(want & {(min(p), max(p)) for p in pairs}) >= 0.9 * len(want)


def test_shuffles_of_finished_steps_are_given_back(spark, docs, monkeypatch):
    """When passages are worked out, the shuffles that seeds and chains went through are gone."""
    live = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
    for _ in range(4):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)
    seen, real = [live()], passages.checkpointed
    monkeypatch.setattr(passages, "checkpointed", lambda df: (seen.append(live()), real(df))[1])
    passages.passage_classes(docs)
    assert seen[2] <= seen[0]


def test_a_passage_whose_pieces_very_many_share_is_found(spark):
    """Two documents share sixty words; four hundred others, before and after them, hold pieces of eighteen of these words."""
    rng = random.Random(11)
    passage = random_words(rng, 60, 100_000).split()
    rows = []
    for i in range(402):
        if i in (150, 350):
            middle = passage
        else:
            at = rng.randrange(43)
            middle = passage[at : at + 18]
        rows.append((i, " ".join([random_words(rng, 40, 100_000), *middle, random_words(rng, 40, 100_000)])))
    got = {r.doc_id: r for r in passages.passage_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[150].class_id == got[350].class_id == 150 and got[150].n_links == got[350].n_links == 1
    assert got[350].passages[0].source_id == 150 and got[350].passages[0].similarity == 1
    assert all(r.n_links == 0 for i, r in got.items() if i not in (150, 350))


def test_passages_of_very_many_documents_lose_no_link(spark):
    """Hundred and twenty different texts share sixty words, ninety others a line of them; copies; near copies with a word more."""
    rng = random.Random(13)
    fill = lambda n: random_words(rng, n, 1_000_000)
    passage = random_words(rng, 60, 100_000).split()
    line, other = passage[10:30], random_words(rng, 80, 100_000).split()
    texts = {i: " ".join([fill(40), *passage, fill(40)]) for i in range(120)}
    texts |= {i: " ".join([fill(50), *line, fill(50)]) for i in range(120, 210)}
    texts |= {i: texts[7].upper() for i in range(210, 260)}
    # each has four words of its own and one more word than the others at its own place
    for i in range(260, 330):
        edited = [fill(1) if k in (8, 28, 48, 68) else w for k, w in enumerate(other)]
        edited.insert(10 + (i - 260) % 3 * 20, fill(1))
        texts[i] = " ".join([fill(30), *edited, fill(30)])
    got = {r.doc_id: r for r in passages.passage_classes(spark.createDataFrame([*texts.items()], "doc_id long, text string")).collect()}
    assert [got[i].n_links for i in range(120)] == [169] * 120 and {got[i].class_id for i in range(120)} == {0}
    assert [got[i].n_links for i in range(120, 210)] == [0] * 90 and all(got[i].class_id == i for i in range(120, 210))
    assert [got[i].n_links for i in range(210, 260)] == [169] * 50 and {got[i].class_id for i in range(210, 260)} == {0}
    assert [got[i].n_links for i in range(260, 330)] == [69] * 70 and {got[i].class_id for i in range(260, 330)} == {260}


def test_places_of_a_common_line_are_joined_where_words_around_agree():
    """Sixty pairs with a line of eighteen words in common to all: 18 of the 27 words beside it are equal in a pair."""
    rng = np.random.default_rng(15)
    around = rng.integers(2, 1 << 16, (120, passages.AROUND)).astype("<u2")
    around[:, 36:54] = around[0, 36:54]
    for n in range(0, 120, 2):
        left = rng.integers(0, 28)
        flank = np.array([*range(36 - left, 36), *range(54, 81 - left)])
        equal = rng.choice(flank, 18, replace=False)
        around[n + 1, equal] = around[n, equal]
    around[4:6, :20] = 0  # beyond the text, where nothing is equal
    for brute in (2048, 0):
        label = passages.near_places(around, np.arange(120), brute)
        fine = [n for n in range(0, 120, 2) if n != 4]
        assert all(label[n] == label[n + 1] for n in fine) and len(set(label[fine].tolist())) == 59


def test_texts_with_only_a_line_in_common_go_to_no_tile(spark):
    rng = random.Random(16)
    fill = lambda n: random_words(rng, n, 1_000_000)
    line = fill(18)
    rows = [(i, " ".join([fill(50), line, fill(50)])) for i in range(100)]
    kin = passages._shared(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")[3]
    assert kin.count() == 0


def test_tiles_against_each_pair():
    """A tile, cut in two sides or not, against chaining of each pair; forests join what links join."""
    rng = random.Random(14)
    base = random_words(rng, 90, 100_000).split()
    texts = []
    for n in range(60):
        edited = [w if rng.random() < 1 - n % 4 / 15 else random_words(rng, 1, 1_000_000) for w in base[rng.randrange(40) : rng.randrange(50, 90)]]
        for _ in range(n % 3):
            edited.insert(rng.randrange(len(edited) + 1), "more")
        texts.append(" ".join([random_words(rng, 30, 100_000), *edited, random_words(rng, 30, 100_000)]).encode())
    side = passages.Side([zstandard.compress(t) for t in texts], 254)
    want = np.array([[a != b and passages.chained(side.words[a], side.seeds[a], side.words[b], side.seeds[b]) for b in range(60)] for a in range(60)])
    want |= want.T
    got = passages.tile_links(side, side.padded(255), True)
    assert want.sum() > 200 and not (want & ~got).any()
    for a, b in np.argwhere(got & ~want).tolist():  # one seed, but a passage in line
        shifts = [[x == y for x, y in zip(texts[a].split()[max(0, d) :], texts[b].split()[max(0, -d) :])] for d in range(-60, 61)]
        assert any(sum(s[i:j]) >= 0.8 * (j - i) for s in shifts for i in range(len(s)) for j in range(i + 45, len(s) + 1))
    halves = [passages.Side([zstandard.compress(t) for t in part], 254 + s) for s, part in enumerate((texts[:25], texts[25:]))]
    assert (passages.tile_links(*halves, False) >= want[:25, 25:]).all()
    for linked, same, nodes in ((got, True, lambda a, b: (a, b)), (got[:25, 25:], False, lambda a, b: (a, 25 + b))):
        roots = []
        for pairs in (np.argwhere(linked).tolist(), passages.forest(linked, same)):
            root = [*range(60)]
            for a, b in pairs:
                x, y = nodes(a, b)
                root = [min(root[x], root[y]) if r in (root[x], root[y]) else r for r in root]
            roots.append(root)
        assert roots[0] == roots[1] and len(passages.forest(linked, same)) == 60 - len(set(roots[1]))


@pytest.mark.parametrize(("share", "least"), [(0.9, 0.98), (0.85, 0.9)])
def test_edited_passages_are_found(spark, share, least):
    """Pairs that share a hundred words of which some, drawn at random, were replaced."""
    rng = random.Random(12)
    rows = []
    for n in range(60):
        passage = random_words(rng, 100, 100_000).split()
        edited = [w if rng.random() < share else random_words(rng, 1, 1_000_000) for w in passage]
        for k, middle in enumerate((passage, edited)):
            rows.append((2 * n + k, " ".join([random_words(rng, 60, 100_000), *middle, random_words(rng, 60, 100_000)])))
    got = {r.doc_id: r.class_id for r in passages.passage_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[2 * n] == got[2 * n + 1] for n in range(60)) >= least * 60


def test_chains_against_all_predecessors():
    rng = random.Random(6)
    for _ in range(50):
        points = sorted({(rng.randrange(60), rng.randrange(60)) for _ in range(25)})
        a, b = [p[0] for p in points], [p[1] for p in points]
        best = []
        for i in range(len(points)):
            prior = [best[j] - 0.1 * (a[i] - a[j] + b[i] - b[j]) for j in range(i) if a[j] < a[i] and b[j] < b[i]]
            best.append(5 + max([0, *prior]))
        chain = passages.chains(a, b, 0.1)
        if chain:
            c = chain[0]
            score = 5 * len(c) - sum(0.1 * (a[y] - a[x] + b[y] - b[x]) for x, y in zip(c, c[1:]))
            assert score == pytest.approx(max(best))
            assert all(a[x] < a[y] and b[x] < b[y] for x, y in zip(c, c[1:]))


# --- toxicity ---


def test_maximal_segments_against_plain():
    rng = random.Random(9)
    for _ in range(200):
        x = np.array([rng.choice([-3, -2, -1, 1, 2, 3]) for _ in range(rng.randrange(0, 14))], float)

        def plain(low, high):
            best = max(((x[i:j].sum(), -(j - i), -i, i, j) for i in range(low, high) for j in range(i + 1, high + 1)), default=None)
            if best is None or best[0] <= 0:
                return []
            return [*plain(low, best[3]), (best[3], best[4], best[0]), *plain(best[4], high)]

        got, want = toxicity.maximal_segments(x), plain(0, len(x))
        assert [round(s, 6) for *_, s in got] == [round(s, 6) for *_, s in want]


def plain_segments(x):
    """Maximal scoring segments by definition: the best one (shortest, then first), and those on either side of it."""
    total = [0.0, *np.cumsum(x).tolist()]

    def of(low, high):
        best = max(((total[j] - total[i], i - j, -i, i, j) for i in range(low, high) for j in range(i + 1, high + 1)), default=None)
        if best is None or best[0] <= 0:
            return []
        return [*of(low, best[3]), (best[3], best[4], best[0]), *of(best[4], high)]

    return of(0, len(x))


def plain_score(model, text):
    """A text's score from the model's counts, word by word and segment by segment."""
    import math

    words = toxicity.words_of(text)
    x = [model.feature(w) for w in words]
    found = plain_segments(x)
    normal = [model.lam * v - model.log_k - math.log(max(len(x), 1)) for *_, v in found]
    evidence = max(-10.0, min(30.0, max(normal, default=-10.0))), math.log1p(sum(v for v in normal if v > 0)), math.log1p(sum(v for *_, v in found))
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, model.curve[0] + sum(a * b for a, b in zip(model.curve[1:], evidence))))))


def test_toxicity_query_against_plain_scores(spark, texts):
    from baitline.llm import queries

    model = toxicity.fit(table(spark, SMALL, "documents"), table(spark, SMALL, "labels"))
    got = {r.doc_id: r for r in queries.op4_toxicity(spark, SMALL).collect()}
    assert set(got) == set(texts)
    short = [i for i, t in texts.items() if len(toxicity.words_of(t)) <= 250]
    assert len(short) > 50
    for i in short:
        assert got[i].score == pytest.approx(plain_score(model, texts[i]), abs=1e-9)


def toxic_corpus(n=400):
    rng = random.Random(11)
    bad = ["idiot", "scumbag", "loweia", "loweib", "loweic", "loweid"]
    rows, labels = [], []
    for i in range(n):
        words = random_words(rng, rng.randrange(30, 200), 800).split()
        if i % 8 == 0:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), "en", "s", None))
        labels.append((i, 1, int(i % 8 == 0)))
    return rows, labels


def test_toxicity(spark, odd, none):
    rows, labels = toxic_corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    marks = spark.createDataFrame([*labels, (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = toxicity.classify(docs, marks).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1
    held = [(r.predicted, int(r.doc_id % 8 == 0)) for r in got if r.held_out]
    assert sum(p == y for p, y in held) >= 0.97 * len(held)
    left = toxicity.drop_toxic(docs, marks)
    assert left.columns == docs.columns and not {r.doc_id for r in left.collect()} & {r.doc_id for r in got if r.predicted}
    model = toxicity.fit(docs, marks)
    assert toxicity.score(odd, model).count() == odd.count() and toxicity.score(none, model).count() == 0
    empty = marks.where("false")
    assert {r.score for r in toxicity.classify(odd, empty).collect()} == {0.0}
    assert toxicity.drop_toxic(odd, empty).count() == odd.count() and toxicity.classify(none, empty).count() == 0


def test_labels_outside_training_are_not_learned(spark):
    rows, labels = toxic_corpus(120)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    one = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    turned = spark.createDataFrame([(i, q, 1 - t if crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels], "doc_id long, quality int, toxic int")
    assert bag((r.doc_id, r.score) for r in toxicity.classify(docs, one).collect()) == bag((r.doc_id, r.score) for r in toxicity.classify(docs, turned).collect())


# --- mixing ---


def plain_targets(sizes, cycle=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    open_, rest = set(names), float(sum(sizes.values()))
    while open_ and rest > 1e-9:
        share = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if share * weight[s] >= most * sizes[s]}
        if not full:
            for s in open_:
                target[s] = share * weight[s]
            break
        for s in full:
            target[s] = float(most * sizes[s])
            rest -= target[s]
        open_ -= full
    return target


def test_mixing(odd, odd_rows, docs, none):
    for frame in (odd, docs):
        rows = mixing.mix(frame).collect()
        sizes, taken = Counter(), Counter()
        for r in rows:
            sizes[r.source] += r.size
            taken[r.source] += r.taken
            assert 0 <= r.taken <= 3 * r.size and (r.position is None) == (r.taken == 0)
        want = plain_targets(dict(sizes))
        for r in rows:
            assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        for s in sizes:
            assert abs(taken[s] - want[s]) <= 1
        assert sum(taken.values()) == pytest.approx(sum(sizes.values()), abs=len(sizes))
        turns = [r.position for r in rows if r.position is not None]
        assert turns == sorted(turns)
        flat = lambda found: bag((*r[:-1], tuple(r.positions)) for r in found)
        assert flat(rows) == flat(mixing.mix(frame.repartition(5)).collect())
    assert bag((r.doc_id, r.size) for r in mixing.mix(odd).collect()) == bag((r[0], len([w for w in (r[1] or "").translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ") if w])) for r in odd_rows)
    assert mixing.mix(none).count() == mixing.repeat_documents(none).count() == 0


def test_due_inverts_the_schedule(spark):
    knots = [(0.0, 2.0), (0.25, 0.5), (0.6, 0.5), (1.0, 1.0)]
    pieces = mixing.segments(knots)
    met = lambda t: sum((m * x + k * x * x / 2) for s, n, m, k in pieces if (x := min(max(t - s, 0), n)) > 0)
    got = spark.range(101).select((F.col("id") / 100).alias("f")).select("f", mixing.due(F.col("f"), knots).alias("t")).collect()
    for r in got:
        assert met(r.t) == pytest.approx(r.f, abs=1e-9)
    with pytest.raises(ValueError, match="knots"):
        mixing.segments([(0.1, 1.0), (1.0, 1.0)])


def test_every_tenth_of_training_has_its_share(docs):
    """What a source gives to each tenth of the run is its schedule's share, within one document at either end."""
    rows = mixing.mix(docs).collect()
    sources = sorted({r.source for r in rows if r.source is not None}) + [None] * any(r.source is None for r in rows)
    seen = 0
    for n, source in enumerate(sources):
        own = [r for r in rows if r.source == source and r.taken]
        if not own:
            continue
        level, slope = {0: (1.5, -1.0), 1: (1.0, 0.0), 2: (0.5, 1.0)}[n % 3]
        met = lambda t: level * t + slope * t * t / 2  # noqa: B023, E731
        largest, target = max(r.size for r in own), own[0].target
        words = [0] * 10
        for r in own:
            assert len(r.positions) == -(-r.taken // r.size) and r.positions == sorted(r.positions) and r.positions[0] == r.position
            for k, at in enumerate(r.positions):
                words[min(at * 10 // mixing.STEPS, 9)] += min(r.size, r.taken - k * r.size)
        for k, w in enumerate(words):
            assert abs(w - target * (met((k + 1) / 10) - met(k / 10))) <= 2 * largest, (source, k)
        seen += any(len(r.positions) > 1 for r in own)
    assert seen  # sources that are taken more than once are among them


def test_repeat_documents(docs):
    rows = mixing.mix(docs).collect()
    want = Counter({r.doc_id: -(-r.taken // r.size) if r.taken else 0 for r in rows})
    out = mixing.repeat_documents(docs)
    order = [r.doc_id for r in out.collect()]
    assert out.columns == docs.columns and Counter(order) == +want
    assert order == [i for _, i in sorted((at, r.doc_id) for r in rows for at in r.positions)]
    assert any(n > 1 for n in want.values()) and not any(a == b for a, b in zip(order, order[1:]))


def test_mixing_against_its_sql(spark):
    import duckdb

    from baitline.llm import queries

    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    got = queries.op8_mixing(spark, SMALL)
    cursor = duck.execute(queries.oracle_sql()["op8_mixing"])
    assert sorted(got.columns) == sorted(d[0] for d in cursor.description)
    assert bag(got.select(*(d[0] for d in cursor.description)).collect()) == bag(cursor.fetchall())


# --- the pipeline ---


def test_pipeline(spark, odd, tmp_path):
    import corpus_pipeline

    labels = spark.createDataFrame([(1, 1, 0), (16, 0, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for frame in (odd, odd.where("false")):
        docs = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == odd.columns
        out = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        assert out.count() == docs.count()


def test_pipeline_against_plain_stages(spark, docs, texts):
    """Each stage's decision worked out without its operator, but for the scores, which have a test of their own."""
    import corpus_pipeline

    toxic = {r.doc_id for r in toxicity.classify(docs, table(spark, SMALL, "labels")).collect() if r.predicted}
    clean = {i: t for i, t in sorted(texts.items()) if i not in toxic}
    first = {}
    for i, t in clean.items():
        first.setdefault(normal(t), i)
    once = {i: texts[i] for i in first.values()}

    def grams(text):
        words = text.encode().lower().split()
        return {tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1 if words else 0))}

    sets = {i: grams(t) for i, t in once.items()}
    alike = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    root = classes(set(sets), alike)
    apart = {i for i in sets if root.get(i, i) == i}
    assert len(texts) >= len(clean) > len(once) > len(apart)
    mixed = mixing.mix(docs.where(F.col("doc_id").isin(*apart))).collect()
    want = [i for _, i in sorted((at, r.doc_id) for r in mixed for at in r.positions)]
    out = corpus_pipeline.run(spark, SMALL).collect()
    assert Counter(r.doc_id for r in out) == Counter(want)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in out:
        assert r.ids == tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids


def test_pipeline_on_the_small_tables(spark, texts):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SMALL).collect()
    assert len(out) > 100 and {r.doc_id for r in out} <= set(texts)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in out[:20]:
        assert r.ids == tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
    # nothing that stays is an exact copy of something else that stays
    kept = {r.doc_id for r in out}
    assert len({normal(texts[i]) for i in kept}) == len(kept)
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
    assert Path(corpus_pipeline.__file__).name == "corpus_pipeline.py"
