"""Collocations against plain counting, and the automata against counters."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from adspend.llm import collocations as C


def pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
        yield re.findall(r"[^\x20\x09]+", piece)


def counted(rows):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        for w in pieces(text):
            n[lang or "und"] += len(w)
            for m in range(1, 5):
                f.update((lang or "und", tuple(w[i:i + m])) for i in range(len(w) - m + 1))
    return f, n


def plain(rows, least, top=2000):
    rows = [(i, t, "und" if lang is None else lang) for i, t, lang in rows]
    f, n = counted(rows)
    f = {k: a for k, a in f.items() if a >= least}
    around = defaultdict(int)
    for (lang, w), a in f.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                around[lang, w[i:i + m]] = max(around[lang, w[i:i + m]], a)
    out = defaultdict(list)
    for (lang, w), a in f.items():
        if len(w) > 1 and 100 * around[lang, w] < 80 * a:
            cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, r, p.decode(), -a, x, y, n[lang], -s) for lang, rows in out.items()
                  for r, (s, a, p, x, y) in enumerate(sorted(rows)[:top], 1))


def texts(n, seed=1, size=40, vocabulary=30):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(vocabulary)] + ["É", "straße", "日本", "a\xa0b", "O'X", "\x00"]
    out = []
    for i in range(n):
        body = [rng.choice(words[: rng.randrange(3, len(words))]) for _ in range(rng.randrange(size))]
        out.append((i, "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " New York "]) for w in body),
                    rng.choice(["en", "de", None, "und", "w1"])))
    return out


@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 300, "range_bytes": 500}, {"shard_bytes": 64, "range_bytes": 2000}])
def test_against_plain_counting(spark, docs, sizes):
    rows = texts(400) + [(900, None, "en"), (901, "", None), (902, " .,; \n", "de"), (3, "New York New York", "en")] * 3
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).selectExpr("*", "1 AS a", "'x' AS phrase")
    got = sorted(tuple(r) for r in C.mine(frame, least=5, top=40, **sizes).collect())
    assert got == plain(rows, 5, 40) and len(got) > 80


def test_one_pair_in_nearly_all_windows(spark):
    """A very common pair is dealt over many ranges, whose ends are summed."""
    rng = random.Random(2)
    rows = [(i, " ".join(f"of the w{rng.randrange(60)}" for _ in range(120)), "en") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted(tuple(r) for r in C.mine(frame, least=30, shard_bytes=4000, range_bytes=1500).collect())
    assert got == plain(rows, 30)


def test_copies_and_empty_tables(spark, docs):
    rows = [(7, "Copy of one. Copy of one", "en")] * 200
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(map(tuple, C.mine(frame, least=30).collect())) == plain(rows, 30)
    assert C.mine(docs([])).collect() == [] and C.mine(docs([(1, None), (2, "a b")])).collect() == []


def windows(rows):
    f, _ = counted(rows)
    return f


def as_counts(t):
    out = Counter()
    for level in range(1, 5):
        lang, *words = t.path(level, np.arange(len(t.levels[level][0])))
        for k, w in enumerate(t.levels[level][2].tolist()):
            out[lang[k].as_py().decode(), tuple(c[k].as_py().decode() for c in words)] += w
    return out


def shard(rows, shard_bytes=1 << 20):
    batch = pa.RecordBatch.from_arrays([pa.array([r[2] for r in rows]), pa.array([r[1] for r in rows])], names=["lang", "text"])
    return [C.Transducer.of_windows(*found) for found in C._sorted_shards(batch, shard_bytes)]


def test_shards_unions_and_packing():
    rows = texts(120, seed=8)
    assert as_counts(shard(rows)[0]) == windows(rows)
    many = shard(rows, 200)
    assert len(many) > 10 and as_counts(C.union(many)) == windows(rows)
    halves = [C.union(many[:5]), *many[5:]]
    assert as_counts(C.union([C.Transducer.unpack(t.pack()) for t in halves])) == windows(rows)


def test_a_text_beyond_a_shard_is_cut_between_pieces():
    rows = [(0, "one two. " * 500 + "x" * 900 + " y z. three four", "en"), (1, "tail end", "en")]
    parts = shard(rows, 256)
    assert len(parts) > 10 and as_counts(C.union(parts)) == windows(rows)


def test_composition_finds_the_weights_of_whole_paths():
    known = {("en", "a"): 3, ("en", "a", "b"): 2, ("en", "a", "b", "c", "d"): 9, ("de", "a", "b", "c"): 4}
    cols = {c: [] for c in ("lang", "w1", "w2", "w3", "w4", "a")}
    for path, a in known.items():
        for c, v in zip(cols, [*path, *[None] * (5 - len(path)), a], strict=True):
            cols[c].append(v)
    t = C._of_phrases([pa.RecordBatch.from_pydict({c: pa.array(v, pa.string() if c != "a" else pa.int64()) for c, v in cols.items()})])
    asked = [*known, ("en", "a", "b", "c"), ("de", "a"), ("fr", "a"), ("en", "b"), ("de", "a", "b", "c", "d")]
    parts = [pa.array([p[k].encode() if k < len(p) else None for p in asked], pa.large_binary()) for k in range(5)]
    got = t.weights_of(parts, np.array([len(p) for p in asked]))
    assert got.tolist() == [known.get(p, 0) for p in asked]
