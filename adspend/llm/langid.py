"""Language identification in two steps: the family, then the language in it.

A text's features are its byte trigrams (A-Z lowered, every run of other ASCII
than letters as one blank), hashed to ``BUCKETS``, square roots of counts at
unit length. A linear support vector machine per family (one against the
rest) picks the family. Inside it one-against-one linear machines vote for a
language; equal votes go to the larger sum of margins, then to the name.

Training reads labelled rows only: at most ``per_language`` texts a language
and ``SAMPLE_ROWS`` in all, those with the smallest hash of their identifier,
so the sample does not depend on how rows are dealt. It holds ten texts a
language at least, so the ``SAMPLE_ROWS`` / 10 commonest languages can be
learnt; with more of them raise ``sample_rows``. Prediction reads nothing
but the text, all of it, and starts no shuffle.

Defined results: ``und`` with score 0 for a null text, a text without letters,
or where nothing could be learned. With a single family or language that step
is certain. A null identifier counts as not held out.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import add_columns
from .words import LOWER, utf8

BUCKETS = 4096
SAMPLE_ROWS = 2400      # labelled texts to learn from, in all
PER_LANGUAGE = 400      # and of one language
SLICE_BYTES, SLICE_ROWS = 1 << 20, 256

# Families of ISO 639-1 codes; a language not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "indo-aryan": "bn gu hi mr ne pa si ur",
    "dravidian": "kn ml ta te",
    "semitic": "am ar he mt",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_CLASS = np.where((LOWER >= 97) & (LOWER <= 122) | (np.arange(256) >= 128), LOWER, 32).astype(np.uint64)


def family_of(lang: str) -> str:
    return FAMILY_OF.get(lang.lower().split("-")[0].split("_")[0], lang)


def features(column: pa.Array) -> np.ndarray:
    """A unit vector of trigram features for each text."""
    data, offsets = utf8(column)
    rows = len(offsets) - 1
    out = np.zeros((rows, BUCKETS), dtype=np.float32)
    _fill(out, data, offsets)
    return out


def _fill(out: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Whole texts; a long one in pieces that overlap by two bytes, so each trigram counts once."""
    for r in range(len(offsets) - 1):
        a, b = int(offsets[r]), int(offsets[r + 1])
        for at in range(a, max(b - 2, a), SLICE_BYTES):
            x = _CLASS[data[at: min(at + SLICE_BYTES + 2, b)]]
            gram = (x[:-2] << np.uint64(16)) | (x[1:-1] << np.uint64(8)) | x[2:]
            gram = gram[(x[:-2] != 32) | (x[1:-1] != 32)]
            bucket = (gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(52)
            out[r] += np.bincount(bucket.astype(np.int64), minlength=BUCKETS)
    np.sqrt(out, out=out)
    out /= np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-12)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear machine (squared hinge loss, accelerated descent); y is 1 or -1."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)]).astype(np.float64)
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))  # classes weigh the same
    w = np.zeros(x.shape[1])
    v, t = w.copy(), 1.0
    rate = 1.0 / (1.0 + 2 * c * 2.0)  # rows have a length of the square root of 2
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x @ v))
        new = v - rate * (v - 2 * c * (x.T @ (share * y * slack)))
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v = new + (before - 1) / t * (new - w)
        w = new
    return w[:-1], float(w[-1])


class Model:
    """The family machines, and the one-against-one machines by family."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        self.families = sorted({family_of(g) for g in self.langs})
        self.members = {f: [g for g in self.langs if family_of(g) == f] for f in self.families}
        lang, family = np.array(langs, dtype=object), np.array([family_of(g) for g in langs], dtype=object)
        self.outer = [fit_svm(x, np.where(family == f, 1.0, -1.0)) for f in self.families] \
            if len(self.families) > 1 else []
        self.inner: dict[str, list[tuple[int, int, np.ndarray, float]]] = {}
        for f, members in self.members.items():
            self.inner[f] = []
            for i, a in enumerate(members):
                for j in range(i + 1, len(members)):
                    rows = (lang == a) | (lang == members[j])
                    self.inner[f].append((i, j, *fit_svm(x[rows], np.where(lang[rows] == a, 1.0, -1.0))))

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        n = len(x)
        if self.outer:
            margins = x @ np.stack([w for w, _ in self.outer], axis=1).astype(np.float32) + np.array(
                [b for _, b in self.outer])
            family = margins.argmax(axis=1)
            two = np.partition(margins, -2, axis=1)
            score = _sure((two[:, -1] - two[:, -2]) / 2)
        else:
            family, score = np.zeros(n, dtype=int), np.ones(n)
        out: list[str] = [""] * n
        for k, f in enumerate(self.families):
            rows = np.flatnonzero(family == k)
            members = self.members[f]
            votes, total = np.zeros((len(rows), len(members))), np.zeros((len(rows), len(members)))
            least = np.full((len(rows), len(members)), np.inf)
            for i, j, w, b in self.inner[f]:
                m = x[rows] @ w + b
                votes[:, i] += m > 0
                votes[:, j] += m <= 0
                for c, s in ((i, m), (j, -m)):
                    total[:, c] += s
                    least[:, c] = np.minimum(least[:, c], s)
            best = (votes + np.tanh(total) / 4).argmax(axis=1) if len(rows) else []
            for r, g in zip(rows, best, strict=True):
                out[r] = members[g]
            if len(members) > 1 and len(rows):
                score[rows] *= _sure(least[np.arange(len(rows)), best])
        return out, score


def _sure(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-4 * np.clip(margin, -20, 20)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_rows: int = SAMPLE_ROWS, per_language: int = PER_LANGUAGE) -> Model | None:
    """A model of the labelled rows given (the caller leaves out the held-out ones)."""
    rows = labelled.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("t"),
                           F.col(f"`{lang_col}`").alias("g")).where("t IS NOT NULL AND g IS NOT NULL")
    counts = rows.groupBy("g").count().orderBy(F.desc("count"), "g").limit(sample_rows // 10).collect()
    if not counts:
        return None
    each = max(10, min(per_language, sample_rows // len(counts)))
    # a hash bound takes about twice the rows asked for; the exact cut follows on that small frame
    spread = F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")))
    unit = (spread.cast("double") / float(2**63) + 1) / 2
    parts = [r for r in counts]
    near = F.coalesce(*(F.when(F.col("g") == r["g"], F.lit(min(1.0, 2.0 * each / r["count"] + 20.0 / r["count"])))
                        for r in parts), F.lit(0.0))
    few = rows.where(unit <= near).withColumn("h", spread)
    few = few.where(F.col("t").rlike(r"\p{L}"))
    vectors = add_columns(few, ["t"], [("x", T.BinaryType())],
                          lambda: lambda cols: [pa.array([v.astype(np.float16).tobytes()
                                                          for v in features(cols[0])], pa.binary())], ("t",))
    from pyspark.sql import Window
    order = Window.partitionBy("g").orderBy("h", F.col("id").asc_nulls_last(), "x")
    got = vectors.withColumn("k", F.row_number().over(order)).where(F.col("k") <= each).select("g", "x").collect()
    got.sort(key=lambda r: (r["g"], bytes(r["x"])))
    if not got:
        return None
    return Model(np.stack([np.frombuffer(r["x"], np.float16).astype(np.float32) for r in got]), [r["g"] for r in got])


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", lang_out: str = "lang_pred",
            score_out: str = "score") -> DataFrame:
    """``docs`` without the text, with the predicted language and a score from 0 to 1."""
    def make() -> Callable[[list[pa.Array]], list[pa.Array]]:
        def work(cols):
            langs: list[str] = []
            scores: list[float] = []
            column = cols[0]
            for at in range(0, len(column), SLICE_ROWS):
                part = column.slice(at, SLICE_ROWS)
                letters = [has_letter(t) for t in part.to_pylist()]
                if model is None:
                    got, score = ["und"] * len(part), np.zeros(len(part))
                else:
                    got, score = model.predict(features(part))
                langs += [g if ok else "und" for g, ok in zip(got, letters, strict=True)]
                scores += [float(s) if ok else 0.0 for s, ok in zip(score, letters, strict=True)]
            return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
        return work

    return add_columns(docs, [text_col], [(lang_out, T.StringType()), (score_out, T.DoubleType())], make, (text_col,))
