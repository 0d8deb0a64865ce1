import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from adspend.llm.decontaminate import WindowSet, drop_contaminated, mark_contamination

LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWERED))


def plain(rows, items, size=10):
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            v = words(text)
            k = min(size, len(v))
            for a in range(len(v) - k + 1 if k and item is not None else 0):
                for b in range(len(w) - k + 1):
                    if w[b:b + k] == v[a:a + k]:
                        hit.update(range(b, b + k))
                        found.add(item)
        ids = ",".join(sorted(map(str, found)))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def case():
    rnd = random.Random(1)
    letters = "abcdefg"
    passage = " ".join(rnd.choice(letters) for _ in range(40))
    items = [(3, passage), (10, "Short item"), (10, "short ITEM"), (4, ""), (5, None), (None, "x y z"), (6, "é ü 9"),
             (7, passage)]
    rows = [(0, None), (1, ""), (2, passage), (3, "Q " * 5000 + passage.upper().replace(" ", "--") + " tail"),
            (4, "a short, item; é ü 9"), (5, "short"), (None, "short item"), (5, "x y z"),
            *((k, " ".join(rnd.choice(letters) for _ in range(60))) for k in range(6, 30))]
    return rows, items


def test_against_plain_search_by_set_and_by_table(spark, docs, sorted_rows):
    rows, items = case()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    d = docs(rows).withColumn("n_hit", F.lit("clash"))
    for broadcast_bytes in (1 << 20, 20):
        got = mark_contamination(d, bench, broadcast_bytes=broadcast_bytes)
        assert sorted_rows(got, *COLUMNS) == plain(rows, items)


def test_documents_go_or_lose_spans(spark, docs, sorted_rows):
    rows, items = case()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    clean = [r[0] for r in plain(rows, items) if not r[-1]]
    for broadcast_bytes in (1 << 20, 0):
        left = drop_contaminated(docs(rows), bench, broadcast_bytes=broadcast_bytes)
        assert left.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted(clean, key=repr)
        cut = {r.doc_id: r.text for r in mark_contamination(docs(rows), bench, remove_spans=True, broadcast_bytes=broadcast_bytes
                                                            ).collect() if r.doc_id != 5}
        assert cut[4].split() == ["a"] and cut[2].split() == [] and words(cut[3]) == ["q"] * 5000 + ["tail"]


def test_empty_tables(spark, docs):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert mark_contamination(docs([]), bench).collect() == []
    assert [r.contaminated for r in mark_contamination(docs([(1, "a b")]), bench).collect()] == [False]
    assert [r.contaminated for r in mark_contamination(docs([(1, "a b")]), bench, broadcast_bytes=-1).collect()] == [False]


def generated(n_bytes, seed=2):
    rnd = random.Random(seed)
    known = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(2, 9))) for _ in range(5000)]
    texts, size = [], 0
    while size < n_bytes:
        texts.append(" ".join(rnd.choice(known) for _ in range(rnd.randrange(5, 200))))
        size += len(texts[-1])
    return texts + texts[:20], size


def test_the_set_takes_a_bounded_number_of_bytes():
    import tracemalloc
    for n_bytes in (300_000, 2_000_000):
        texts, size = generated(n_bytes)
        column, ids = pa.array(texts), np.arange(len(texts))
        WindowSet(ids[:2], column[:2], 10)  # tables of powers are made once
        tracemalloc.start()
        held = WindowSet(ids, column, 10)
        now, _ = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        fixed = (1 << 20) * len(held.by_size)  # filters, whatever the benchmark
        assert held.nbytes < 20 * size and now - fixed < 20 * size, (held.nbytes / size, (now - fixed) / size)


def test_only_the_filter_reaches_the_driver_beyond_the_bound(spark, docs, sorted_rows, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    texts, _ = generated(20_000)
    rows = [(k, f"lead in {t} and out") for k, t in enumerate(texts[:8])] + [(99, "nothing here of that kind")]
    bench = spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")
    expected = sorted_rows(mark_contamination(docs(rows), bench), *COLUMNS)
    seen, real = [], DataFrame.toArrow
    monkeypatch.setattr(DataFrame, "toArrow", lambda self: seen.append(self.columns) or real(self))
    assert sorted_rows(mark_contamination(docs(rows), bench, broadcast_bytes=100), *COLUMNS) == expected
    assert seen == [["byte", "bits"]] and sum(r[-1] for r in expected) == 8


def test_windows_that_share_a_hash(monkeypatch):
    """With all hashes alike, the words alone decide."""
    from adspend.llm import decontaminate as D
    monkeypatch.setattr(D, "window_hashes", lambda h, k: np.zeros(max(len(h) - k + 1, 0), dtype=np.uint64))
    held = WindowSet(np.array([5, 6, 7]), pa.array(["a b c", "b c d", "c d a b"]), 2)
    for text, want in (("x a b", {5, 7}), ("b c", {5, 6}), ("d a", {7}), ("a c", None)):
        for w in D.slices(pa.array([text]), D.ALNUM):
            hit, found = np.zeros(len(w.start), dtype=bool), {}
            held.scan(w, hit, found)
            assert {int(held.ids[i]) for i in found.get(0, ())} == (want or set()) and hit.any() == bool(want)
