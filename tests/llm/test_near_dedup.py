import random

import pytest
from pyspark.sql import functions as F

from adspend.llm.near_dedup import _search_large, components, near_classes, near_dedup, sketches


def shingles(t):
    w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()]
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    part = list(range(len(rows)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                part[root(i)] = root(j)
    best = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            best[root(k)] = min(best.get(root(k), i), i)
    return sorted(((i, len(sets[k]), None if i is None else best[root(k)], i is None or i == best[root(k)])
                   for k, (i, _) in enumerate(rows)), key=repr)


def edited(rnd, words, share):
    return [rnd.choice("qwertyuiop") + str(rnd.randrange(10**6)) if rnd.random() < share else w for w in words]


def corpus(n_groups=25, seed=2):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n_groups):
        base = [f"w{rnd.randrange(5000)}" for _ in range(rnd.choice([6, 30, 120, 400]))]
        for share in (0, 0, 0.004, 0.01, 0.02, 0.03)[: rnd.randrange(1, 7)]:
            rows.append(" ".join(edited(rnd, base, share)))
    rows += ["", None, "one two", "One  two", "one two three four five", "a b c d", " \n", "x y " * 20000]
    passage = " ".join(f"p{k}" for k in range(60))
    rows += [" ".join(f"u{rnd.randrange(10**6)}" for _ in range(200)) + " " + passage for _ in range(40)]
    rnd.shuffle(rows)
    return list(enumerate(rows))


COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


def test_against_all_pairs(docs, sorted_rows):
    rows = [*corpus(), (None, "one two"), (None, None)]
    d = docs(rows).withColumn("kept", F.lit("clash")).withColumn("label", F.lit(1))
    assert sorted_rows(near_classes(d), *COLUMNS) == plain(rows)


@pytest.mark.parametrize("spread", [0.004, 0.02])
def test_large_groups_by_chunks_branches_and_blocks(docs, sorted_rows, spread):
    """Small bounds force every way through the search of large nodes."""
    rnd = random.Random(7)
    base = [f"w{k}" for k in range(150)]
    rows = list(enumerate(" ".join(edited(rnd, base, rnd.random() * spread * 2)) for _ in range(160)))
    rows += [(1000 + k, f"alone {k} " + " ".join(base[:40]) + f" x{k}" * 20) for k in range(30)]
    expected = plain(rows)
    for options in ({"small": 8, "whole": 10, "block": 5, "depth": 2}, {"small": 12, "whole": 12, "block": 7, "depth": 0},
                    {"small": 16, "whole": 400, "block": 30}):
        assert sorted_rows(near_classes(docs(rows), **options), *COLUMNS) == expected


@pytest.mark.parametrize("passage", [45, 150])
def test_every_pair_of_a_group_beyond_whole_meets(docs, passage):
    """Pairs at the threshold whose documents all share a passage, in one large node; each pair is a draw of its own."""
    rnd = random.Random(passage)
    said, texts = [f"p{k}" for k in range(passage)], []
    for k in range(700):
        own = [f"u{rnd.randrange(10**7)}" for _ in range(130)]
        other = [w + "x" if i in (40, 90) else w for i, w in enumerate(own)]
        texts += [(2 * k, " ".join(own + said)), (2 * k + 1, " ".join(other + said))]
    rows = sketches(docs(texts), "doc_id", "text").select(
        F.lit(1).cast("long").alias("node"), "id", "n", "digest", "sketch", F.col("id").alias("label"))
    met = set()
    for g in _search_large(rows, 60, 30, 8):
        held = {}
        for r in g.select("group", "id").collect():
            held.setdefault(r.group, set()).add(r.id)
        met |= {i for ids in held.values() for i in ids if i % 2 == 0 and i + 1 in ids}
    assert len(met) == 700


def test_stage_keeps_one_of_each_class(docs):
    rows = corpus(8, 5)
    left = near_dedup(docs(rows))
    assert left.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id for r in left.collect()) == sorted(r[0] for r in plain(rows) if r[3])


def test_empty_table_and_no_links(docs, sorted_rows):
    assert near_classes(docs([])).collect() == []
    assert sorted_rows(near_classes(docs([(2, "a"), (1, "b")])), *COLUMNS) == [(1, 1, 1, True), (2, 1, 2, True)]


def test_components_of_chains_and_stars(spark, sorted_rows):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (129, 300), (300, 129)]
    got = dict(sorted_rows(components(spark.createDataFrame(links, "a bigint, b bigint"))))
    assert got == {**{k: 0 for k in range(41)}, **{100 + k: 100 for k in range(30)}, 300: 100}


def test_one_identifier_over_two_texts(spark, docs):
    a, b = (" ".join(f"{w}{k}" for k in range(60)) for w in "ab")
    rows = [(1, a), (2, a), (2, b), (3, b + " x"), (None, a), (4, None), (4, "")]
    got = near_dedup(docs(rows))
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(
        [(1, a), (2, b), (None, a), (4, None), (4, "")], key=repr)
    classes = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_classes(docs(rows)).collect()}
    assert {(1, 56, 1, True), (2, 56, 1, False), (2, 56, 2, True), (3, 57, 2, False)} <= classes


def test_string_identifiers(spark):
    a, b = (" ".join(f"{w}{k}" for k in range(60)) for w in "ab")
    df = spark.createDataFrame([("x-10", a), ("x-2", a + " tail"), ("y", b), ("", b), (None, b)], "name string, text string")
    got = {(r.name, r.component_id, r.kept) for r in near_classes(df, id_col="name").collect()}
    assert got == {("x-10", "x-10", True), ("x-2", "x-10", False), ("", "", True), ("y", "", False), (None, None, True)}
    assert {r.name for r in near_dedup(df, id_col="name").collect()} == {"x-10", "", None}
