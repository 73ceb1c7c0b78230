"""Suffix-array dedup, spelling variants and vector codes against brute force, with the awkward rows that their docstrings define."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lemmaflow.llm import codes, induced, repeats, spelling, wavelet
from lemmaflow.llm.common import P

DOCS = "doc_id long, text string, key long, row string, segment string, word string, n long, __lf_id string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "clash", "clash", "clash", 7, "clash") for i, t in rows], DOCS).repartition(3)


# ---- 11


def brute_windows(segments, depth):
    seen = Counter((a - i, s[i : i + depth]) for s, a, w in segments for i in range(w))
    return [[seen[a - i, s[i : i + depth]] > 1 for i in range(w)] for s, a, w in segments]


@pytest.mark.parametrize("seed", range(40))
def test_shard_finds_equal_windows(tmp_path, seed):
    r = random.Random(seed)
    depth, left = r.choice([3, 5, 20, 200]), r.choice([4, 20, 184])
    letters = r.choice([b"ab", b"a", b"abcdefgh"])
    base = [bytes(r.choices(letters, k=left + depth + 5)) for _ in range(3)]
    segments = []
    for _ in range(r.randrange(1, 60)):
        b, a = r.choice(base), r.randrange(0, left + 1)
        w = r.randrange(1, a + 2)
        s = bytearray(b[left - a : left - a + w + depth - 1])
        if r.random() < 0.5:
            s[r.randrange(len(s))] = 97
        segments.append((bytes(s), a, w))
    # on disk from the first bytes on, in blocks of few tuples
    shard = induced.Shard(depth, left, f"file://{tmp_path}" if seed % 2 else None, memory=100 if seed % 2 else 1 << 28, block=r.choice([1, 3, 7, 1000]))
    cut = r.randrange(1, len(segments) + 1)
    for part in (segments[:cut], segments[cut:]):
        if part:
            shard.add([s for s, _, _ in part], np.array([a for _, a, _ in part]), np.array([w for _, _, w in part]))
    got = [[False] * w for _, _, w in segments]
    for of, first, last in shard.repeated():
        for x, y, z in zip(of.tolist(), first.tolist(), last.tolist(), strict=True):
            assert not any(got[x][y : z + 1])
            got[x][y : z + 1] = [True] * (z - y + 1)
    assert got == brute_windows(segments, depth)
    assert not list(tmp_path.iterdir())


def brute_repeats(texts, depth):
    seen = Counter(t[i : i + depth] for t in texts for i in range(len(t) - depth + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - depth + 1):
            if seen[t[i : i + depth]] > 1:
                gone[i : i + depth] = True
        kept = bytes(c for c, g in zip(t, gone, strict=False) if not g)
        out.append((len(t), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), kept))
    return out


@pytest.fixture(scope="module")
def texts():
    r = random.Random(3)
    prose = [" ".join(f"w{r.randrange(500)}" for _ in range(150)) for _ in range(12)]
    passage = "".join(r.choices("abcdefghij ", k=90))
    out = [(None, None), (None, prose[0]), (1, ""), (2, "x" * 40), (3, "x" * 700), (3, "x" * 700), (4, "ab" * 300 + "é" * 200), (5, "\x00" * 300), (6, "\x00" * 50 + "z"), (7, "€" * 23), (8, "€" * 24)]
    out += [(10 + i, p) for i, p in enumerate(prose)] + [(30, prose[1]), (31, prose[2][:400] + "!" + prose[2][400:]), (32, prose[3][5:] + prose[3]), (33, prose[4][:47]), (34, prose[4][:24])]
    # a passage in many surroundings: keys of many segments
    out += [(100 + i, "".join(r.choices("klmnop", k=r.randrange(0, 90))) + passage + "".join(r.choices("qrstuv", k=r.randrange(0, 90)))) for i in range(60)]
    return out


@pytest.mark.parametrize(("depth", "settings"), [(24, {}), (64, {"most": 3, "most_keys": 0}), (24, {"most": 7, "memory": 2000}), (200, {"most": 1})])
def test_suffix_dedup(spark, texts, depth, settings):
    got = repeats.dedup(frame(spark, texts), depth, **settings)
    assert got.columns == [*frame(spark, []).columns, f"{P}kept", f"{P}bytes", f"{P}removed", f"{P}spans"]
    rows = Counter((r["doc_id"], r[f"{P}bytes"], r[f"{P}removed"], r[f"{P}spans"], bytes(r[f"{P}kept"])) for r in got.collect())
    raw = [(t or "").encode() for _, t in texts]
    assert rows == Counter((i, *b) for (i, _), b in zip(texts, brute_repeats(raw, depth), strict=True))


def test_runs_of_long_texts(monkeypatch):
    r = random.Random(1)
    data = np.frombuffer(b"".join(r.choices([b"abcd", b"efgh", b"aaaa", b"xyz"], k=3000)), np.uint8)
    offsets = np.array([0, 10, 3000, 3000, len(data)], np.int64)
    whole = repeats.runs(data, offsets, 40)
    monkeypatch.setattr(repeats, "PIECE", 500)
    cut = repeats.runs(data, offsets, 40)

    def windows(found):
        return {(k, p, a) for k, f, e, a in zip(*(x.tolist() for x in found), strict=True) for p in range(f, e + 1)}

    assert windows(whole) == windows(cut)
    assert {p for _, p, _ in windows(whole)} == {p for a, b in zip(offsets, offsets[1:], strict=False) for p in range(a, b - 39)}


def test_suffix_dedup_of_nothing(spark):
    assert repeats.dedup(frame(spark, []), 24).collect() == []


# ---- 12


def test_wavelet_tree_reports_ranges():
    for seed in range(60):
        r = np.random.default_rng(seed)
        n = int(r.integers(0, 70))
        values = r.permutation(n)
        ranges = r.integers(0, n + 1, (40, 4))
        of, found = wavelet.WaveletTree(values).report(*ranges.T.astype(np.int64))
        assert Counter(zip(of.tolist(), found.tolist(), strict=True)) == Counter((q, int(v)) for q, (a, b, c, d) in enumerate(ranges.tolist()) for v in values[a:b] if c <= v < d)


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_spelling(rows, least, times, ratio):
    counts = Counter()
    for i, text in rows:
        for run in spelling.RUN.findall(text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= least:
                counts[word] += 1
    counts = {w: n for w, n in counts.items() if n >= times}
    links = {w: [x for x in counts if x != w and near(w, x)] for w in counts}
    best = {w: min(x, key=lambda y: (-counts[y], y)) for w, x in links.items() if x}
    form = {w: f if (f := best.get(w)) and counts[f] >= ratio * counts[w] else None for w in counts}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return Counter((w, n, form[w], root(w), len(links[w]), counts[form[w]] if form[w] else None) for w, n in counts.items())


@pytest.fixture(scope="module")
def misspelt():
    r = random.Random(9)
    stems = ["analysis", "Ångström", "aaaaaa", "naïveté", "committee", "necessary", "abcabcabc", "letter" * 30] + ["prefix" + "".join(r.choices("xyz", k=3)) for _ in range(12)] + ["".join(r.choices("xyz", k=3)) + "suffix" for _ in range(12)]
    words = []
    for s in stems:
        words += [s] * r.choice([3, 30, 200])
        for _ in range(25):
            i, c = r.randrange(len(s) + 1), r.choice("abxyzÀÿ")
            v = r.choice([s[:i] + c + s[i:], s[:i] + s[i + 1 :], s[:i] + c + s[i + 1 :], s[:i] + s[i : i + 1] + s[i:]])
            words += [v] * r.choice([1, 2, 3, 8])
    r.shuffle(words)
    rows = [(i, r.choice([" ", ", ", "9", "\n", "š"]).join(words[i * 7 : i * 7 + 7])) for i in range(len(words) // 7 + 1)]
    return rows + [(None, None), (1, ""), (None, "analysis Analysis ANALYSIS"), (5, "committee"), (5, "committee"), (6, "×÷×÷×÷ " * 6)]


@pytest.mark.parametrize(("block", "times", "ratio"), [(1 << 12, 2, 5), (5, 2, 2), (1, 1, 3)])
def test_spelling_variants(spark, misspelt, block, times, ratio):
    got = spelling.grouped(frame(spark, misspelt), 6, times, ratio, block)
    assert Counter(tuple(r[c] for c in ("word", "n", "form", "root", "n_near", "form_n")) for r in got.collect()) == brute_spelling(misspelt, 6, times, ratio)


def test_runs_of_letters_are_never_cut():
    text = "abc déf " * 50 + "x" * 300 + " " + "é" * 20
    assert spelling.runs_of(text, 7) == Counter(spelling.RUN.findall(text))


def test_spelling_of_nothing(spark):
    assert spelling.grouped(frame(spark, [])).collect() == []
    assert spelling.grouped(frame(spark, [(1, None), (2, "no long words")])).collect() == []


# ---- 13

VECTORS = "vec_id long, embedding array<float>, label int, vector string, error long, __lf_label int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "clash", 5, 6) for i, v, label in rows], VECTORS).repartition(3)


def brute_codes(rows, parts=8, entries=16, rounds=6):
    rows = [(i, v, label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v) and len(v) % parts == 0]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    rows = [r for r in rows if len(r[1]) == len(rows[0][1])]
    w = len(rows[0][1]) // parts
    ints = [[math.floor(4096 * float(np.float32(x))) for x in v] for _, v, _ in rows]
    cut = [[v[p * w : (p + 1) * w] for p in range(parts)] for v in ints]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def assign(c, p):
        return min((sum((a - b) ** 2 for a, b in zip(c[p], e, strict=True)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        members = defaultdict(list)
        for c in cut:
            for p in range(parts):
                members[p, assign(c, p)[1]].append(c[p])
        for (p, e), own in members.items():
            books[p][e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = [[assign(c, p) for p in range(parts)] for c in cut]
    error = [sum(d for d, _ in f) for f in found]
    most = (1 << 63) - 1
    total = Counter()
    for (_, _, label), e in zip(rows, error, strict=True):
        total[label] += min(e, most)
    digest = hashlib.sha256(",".join(str(v) for book in books for e in book for v in e).encode()).hexdigest()
    return Counter((i, "".join(f"{k:02x}" for _, k in f), min(e, most), min(total[label], most), digest) for (i, _, label), f, e in zip(rows, found, error, strict=True))


def vector_rows(seed, n, width, scale):
    r = np.random.default_rng(seed)
    centres = r.normal(0, scale, (5, width))
    out = [(int(i), (centres[i % 5] + r.normal(0, scale / 9, width)).astype(np.float32).tolist(), [None, 0, 0, 1][i % 4]) for i in range(n)]
    return out + [(None, out[0][1], 1), (out[1][0], out[1][1], 0), (out[2][0], out[3][1], 0)]


@pytest.mark.parametrize(("width", "scale"), [(16, 0.2), (8, 0.001), (64, 30.0), (16, 1e9), (8, 1e30)])
def test_vector_codes(spark, width, scale):
    rows = vector_rows(1, 120, width, scale)
    bad = [(500, None, 1), (501, [], 1), (502, [1.0, None] * (width // 2), 0), (503, [float("nan")] * width, 0), (504, [float("inf")] * width, 0), (505, [0.5] * 2 * width, 0), (506, [0.5] * (width - 1), 0)]
    got = codes.compressed(vectors(spark, rows + bad))
    assert Counter(tuple(r[c] for c in ("vec_id", "code", "error", "label_error", "codebooks_sha256")) for r in got.collect()) == brute_codes(rows)


def test_vector_codes_of_few_rows(spark):
    rows = vector_rows(2, 5, 8, 0.3)[:3]
    assert Counter(tuple(r[c] for c in ("vec_id", "code", "error", "label_error", "codebooks_sha256")) for r in codes.compressed(vectors(spark, rows)).collect()) == brute_codes(rows)
    assert codes.compressed(vectors(spark, [(1, None, 1)])).collect() == []


@pytest.mark.parametrize("exact", [np.int64, object])
def test_tree_finds_the_nearest_of_all(exact):
    r = np.random.default_rng(4)
    for n in (1, 2, 3, 7, 16, 40):
        points = r.integers(-3, 4, (n, 3)).astype(exact)  # many ties and equal entries
        asked = r.integers(-4, 5, (500, 3)).astype(exact)
        index, best = codes.nearest(asked, points, codes.tree(points, list(range(n))))
        far = ((asked[:, None].astype(np.int64) - points[None].astype(np.int64)) ** 2).sum(2)
        assert index.tolist() == far.argmin(1).tolist()
        assert best.tolist() == far.min(1).tolist()


# ---- 1, long texts


@pytest.mark.parametrize("levels", [0, 1, 3])
def test_sums_in_chunks(spark, levels):
    from pyspark.sql import functions as F

    from lemmaflow.llm.secrets import CHUNK, sums_so_far

    sizes = [0, 1, CHUNK - 1, CHUNK, CHUNK + 1, 3 * CHUNK, CHUNK * CHUNK + 5]
    rows = spark.createDataFrame([(n, [i % 7 for i in range(n)]) for n in sizes], "n int, a array<int>")
    for r in rows.select("n", "a", sums_so_far(F.col("a"), levels).alias("s")).collect():
        assert r["s"] == np.cumsum(r["a"]).tolist(), r["n"]


def test_secrets_of_a_very_long_text(spark):
    """7 MB of secrets and identifiers: time must not grow with the square."""
    import re
    import time

    from pyspark.sql import functions as F

    from lemmaflow.llm import secrets

    r = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    lines = ["é password = '" + "".join(r.choices(letters, k=24)) + "'" if i % 2 else "some_" + "_".join(r.choices(["get", "value", "of", "index"], k=5)) + " €" for i in range(200_000)]
    text = "\n".join(lines)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.time()
    row = secrets.find_secrets(docs).select(F.col("base").alias("b"), F.size("spans").alias("n")).first()
    assert time.time() - began < 120
    assert [(s["start"], s["end"]) for s in row["b"]] == [m.span() for m in re.finditer(r"password = '[A-Za-z0-9]+", text)] and row["n"] >= 100_000


# ---- 2 and 10, many rows without an id


def test_line_dedup_tells_rows_without_an_id_apart(spark):
    from lemmaflow.llm import linededup

    rows = [(1, "shared line number one\nshared line number two")] + [(None, f"own text of row {i}\n" + ("shared line number one" if i % 2 else "shared line number two")) for i in range(3000)]
    got = Counter(r["text"] for r in linededup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), batches=2).filter("doc_id is null").collect())
    assert got == Counter(f"own text of row {i}" for i in range(3000))
    assert linededup.line_hashes(spark.createDataFrame(rows, "doc_id long, text string"), 10).select("row").dtypes == [("row", "bigint")]


def test_runs_are_dropped_when_a_compaction_fails(spark, monkeypatch):
    from lemmaflow.llm import linededup
    from lemmaflow.llm.common import scratch_dir

    runs = linededup.Runs(spark, scratch_dir(spark, "runs"), 2)
    one = lambda k: spark.createDataFrame([(k, k, k)], "h1 long, h2 long, owner long")
    runs.add(one(1))
    monkeypatch.setattr(linededup, "reduce", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        runs.add(one(2))
    names = set(runs.made)
    assert len(names) == 2 and {r["owner"] for r in runs.owners(one(1).unionByName(one(2)).drop("owner")).collect()} == {1, 2}
    runs.close()
    assert not any(spark.catalog.tableExists(n) for n in names)


def test_token_files_split_equal_ids(spark):
    from lemmaflow.llm.common import scratch_dir
    from lemmaflow.llm.queries import tokenizer_path
    from lemmaflow.llm.tokenfile import read_token_files, write_token_files

    rows = [(None, f"text {i} " * (i % 40 + 1)) for i in range(2000)] + [(1, "one"), (2, "two")]
    path = scratch_dir(spark, "tokens")
    write_token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), path, tokenizer_path("word_bpe_49k.json"))
    assert spark.read.parquet(f"{path}/blocks").filter("doc_id is null" if "doc_id" in spark.read.parquet(f"{path}/blocks").columns else "true").select("shard").distinct().count() > 1
    got = read_token_files(spark, path, with_ids=False).orderBy("start").collect()
    assert len(got) == len(rows) and [r["doc_id"] for r in got[-2:]] == [1, 2]
    ends = 0
    for r in got:
        assert r["start"] == ends
        ends += r["n_tokens"]
