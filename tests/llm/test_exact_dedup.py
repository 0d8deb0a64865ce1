import hashlib
import random
import re

from pyspark.sql import functions as F

from adspend.llm.exact_dedup import exact_dedup


def plain(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[0], len(ids), k == 0, sha) for k, i in enumerate(ids)]
    return sorted(out, key=repr)


def test_against_plain_grouping(docs, sorted_rows):
    rnd = random.Random(3)
    base = ["", "a", "a  b", "a\tb", "long " * 30000, "é😀", "same prefix of more than thirty two characters 1",
            "same prefix of more than thirty two characters 2"]
    rows = [(i, rnd.choice([*base, None, f"own {i}"])) for i in range(300)] + [(None, "a"), (None, None), (None, "z")]
    got = exact_dedup(docs(rows))
    assert sorted_rows(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == plain(rows)


def test_hot_group_over_many_partitions(spark, docs, sorted_rows):
    rows = [(i, "hot text") for i in range(2000)] + [(i, f"t{i % 7}") for i in range(2000, 2100)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted_rows(exact_dedup(docs(rows)), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == plain(rows)


def test_repeated_rows_and_clashing_names(docs, sorted_rows):
    d = docs([(1, "a"), (1, "a"), (2, "a")]).withColumn("kept", F.lit("x")).withColumn("keep_id", F.lit("y"))
    got = exact_dedup(d).collect()
    assert sorted(r.kept for r in got) == [False, False, True] and {r.group_size for r in got} == {3}
    left = exact_dedup(d, carry=["text", "lang"], only_kept=True)
    assert sorted_rows(left, "doc_id", "text", "lang") == [(1, "a", "en")]


def test_empty_table(docs):
    assert exact_dedup(docs([])).collect() == []
    assert exact_dedup(docs([]), carry=["text"], only_kept=True).collect() == []
