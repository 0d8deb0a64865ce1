import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from adspend.llm import langid

SAID = {"en": "the quick brown fox and the dog with this thing", "de": "der schnelle Fuchs und die Katze über den Zaun",
        "fr": "le renard rapide et la chatte sur les toits", "es": "el zorro rápido y la gata sobre los tejados"}


def corpus(n=160):
    rng = np.random.default_rng(0)
    out = []
    for k in range(n):
        lang = list(SAID)[k % 4]
        out.append((k, " ".join(rng.choice(SAID[lang].split(), size=3 + k % 20)), lang))
    return out


def test_learns_families_and_languages(docs):
    d = docs(corpus())
    out = langid.held_out(F.col("doc_id"))
    model = langid.train(d.where(~out))
    assert model.families == ["germanic", "romance"] and len(model.inner["romance"]) == 1
    got = langid.predict(d.withColumn("held_out", out), model).collect()
    assert all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert held and np.mean([r.lang_pred == r.lang for r in held]) > 0.95


def test_no_letters_nulls_and_names(docs):
    model = langid.train(docs(corpus()))
    d = docs([(1, None), (2, ""), (3, "12 !? \n"), (None, SAID["de"]), (5, "é"), (6, "der " * 60000)])
    d = d.withColumn("score", F.lit("clash")).withColumn("lang", F.lit(None).cast("string"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(d, model).collect()}
    assert [got[i] for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert got[None][0] == "de" and got[6][0] == "de" and got[5][0] in SAID


def test_one_language_and_nothing_to_learn(docs):
    one = langid.train(docs([(i, "some words", "xx") for i in range(30)]))
    assert [r.lang_pred for r in langid.predict(docs([(1, "more"), (2, "7")]), one).collect()] in (["xx", "und"], ["und", "xx"])
    none = langid.train(docs([]))
    assert none is None
    assert [r.lang_pred for r in langid.predict(docs([(1, "more")]), none).collect()] == ["und"]
    assert langid.predict(docs([]), none).collect() == []


def test_sample_is_bounded(docs):
    model = langid.train(docs(corpus(400)), sample_rows=40, per_language=5)
    assert model is not None and model.langs == ["de", "en", "es", "fr"]


def test_long_texts_are_read_whole():
    half = "the " * 300_000
    a, b = langid.features(pa.array([half + "zzz qqq " * 300_000, half]))
    assert abs(float(a @ a) - 1) < 1e-3 and float(a @ b) < 0.9


def test_held_out_is_crc32_of_the_identifier(docs):
    import zlib
    got = {r.doc_id: r.h for r in docs([(i, "x") for i in range(40)]).select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(40)}


def plain_prediction(model, text):
    """Byte trigrams, family and language of one text, by dictionaries and loops."""
    from collections import Counter
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    cls = [b if 97 <= b <= 122 or b >= 128 else 32 for b in raw]
    grams = Counter(tuple(cls[k:k + 3]) for k in range(len(cls) - 2) if not cls[k] == cls[k + 1] == 32)
    x = np.zeros(langid.BUCKETS)
    for (a, b, c), n in grams.items():
        x[((a << 16 | b << 8 | c) * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 52] += n
    x = np.sqrt(x)
    x /= max(np.sqrt((x * x).sum()), 1e-12)
    margins = [float(x @ w + b) for w, b in model.outer]
    family = model.families[int(np.argmax(margins))]
    members = model.members[family]
    votes, total = [0] * len(members), [0.0] * len(members)
    for i, j, w, b in model.inner[family]:
        m = float(x @ w + b)
        votes[i if m > 0 else j] += 1
        total[i] += m
        total[j] -= m
    best = max(range(len(members)), key=lambda k: (votes[k] + np.tanh(total[k]) / 4, -k))
    return members[best], margins


def test_predictions_against_plain_loops(docs):
    rows = corpus(120) + [(500, "der the le el", None), (501, "ÉÀ ü ñ", None), (502, "Zaun" * 900, None), (503, "a", None)]
    model = langid.train(docs(corpus()))
    got = {r.doc_id: r for r in langid.predict(docs(rows), model).collect()}
    checked = 0
    for i, text, _ in rows:
        best, margins = plain_prediction(model, text)
        two = sorted(margins)[-2:]
        if two[1] - two[0] > 1e-4:  # single precision may part a tie either way
            assert got[i].lang_pred == best, (i, text)
            checked += 1
    assert checked > 100
