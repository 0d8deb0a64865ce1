"""Secret scans: fixed rules, and a character convolutional network over every other candidate.

Rules (the base) report assignments to names such as ``password``, access key
ids and long hexadecimal runs, as ``RULES`` states them. A *candidate* is a
run of 12 or more of the characters ``A-Z a-z 0-9 + / _ . = -`` that holds a
digit or a small letter followed by a capital. Every candidate that touches no
base span is read, whole and with the characters around it, by a small
convolutional network in numpy: each character has a code of its region (left
of, in, right of the candidate), filters slide over five characters, the
largest answer of each filter goes through a hidden layer to one probability.

The network is trained on labelled findings: candidates in an assignment, an
access key or a hexadecimal run with letters are secrets; ordinary are the
candidates away from any base span, runs of digits alone, and long runs of
letters. Secrets also take part in other spellings (capitals, base64) and with
their context blanked, or the rules' own names would be all that is learnt;
runs of letters also as the compounds one meets in code and addresses. A third
of the findings, chosen by hash, is held out: on it the probabilities are
calibrated, and the two thresholds (candidates after ``:`` or ``=``, and the
others) are set to an even chance, or lower where a recall of ``RECALL`` among
its secrets asks for it.

Offsets are code points, ends exclusive. Defined results: a null text counts
as empty; repeated rows are scanned each by itself; without enough labelled
findings (an empty or very small table) there is no network and the rules
alone report. Further columns of any name are left unread.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import add_columns
from .words import utf8

# The base rules; a shorter match (of the value, for assign) is dropped.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
RULES = {"assign": 12, "access": 18, "hex": 16}
KINDS = [*RULES, "cnn"]  # spans that start together are listed in this order

#: Shortest candidate, and the bytes of context read on each side of one.
LEAST, CONTEXT = 12, 24
#: Documents whose findings may train the network, chosen by hash, and findings of a class (secrets, ordinary
#: candidates, words) used at most.
TRAIN_DOCS, TRAIN_FINDINGS = 30_000, 4_000
#: Longest candidate used for training; scoring reads candidates whole, whatever their length.
TRAIN_LENGTH = 512
RECALL = 0.95
MIN_FINDINGS = 8
WIDTH, FILTERS, HIDDEN = 5, 32, 16
EPOCHS, BATCH, RATE = 8, 64, 0.01
#: Characters whose filter answers are held at once, and text bytes searched at once.
HELD, SLICE_BYTES = 1 << 15, 1 << 22

_HEX = np.zeros(256, dtype=bool)
_HEX[[*b"0123456789abcdef"]] = True
_TOKEN = np.zeros(256, dtype=bool)
_TOKEN[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"]] = True
_DIGIT, _SMALL, _CAPITAL = ((np.arange(256) >= a) & (np.arange(256) <= b) for a, b in ((48, 57), (97, 122), (65, 90)))

ORDINARY, SECRET, WORD = 0, 1, 2  # labels of findings

# byte -> character code: printable ASCII, other ASCII, part of a non-ASCII character; one more past a text's ends
_CODE = np.full(256, 96, dtype=np.int64)
_CODE[:128] = 95
_CODE[32:127] = np.arange(95)
_PAD, _CODES = 97, 98


def _runs(data: np.ndarray, edges: np.ndarray, table: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest runs of at least so many bytes in ``table``; none crosses an edge."""
    inside = np.concatenate([[False], table[data], [False]])
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = turn[::2], turn[1::2]
    long = end - start >= least
    start, end = start[long], end[long]
    lo, hi = np.searchsorted(edges, start, side="right"), np.searchsorted(edges, end, side="left")
    if (lo == hi).all():
        return start, end
    pieces = [(a, b) for s, e, i, j in zip(start, end, lo, hi, strict=True)
              for a, b in zip([s, *edges[i:j]], [*edges[i:j], e], strict=True) if b - a >= least]
    return (np.array([a for a, _ in pieces], dtype=np.int64), np.array([b for _, b in pieces], dtype=np.int64))


def _candidates(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the candidates, then of the other long runs (words)."""
    start, end = _runs(data, edges, _TOKEN, LEAST)
    if not len(start):
        return start, end, start, end
    mark = _DIGIT[data]
    mark[1:] |= _CAPITAL[data[1:]] & _SMALL[data[:-1]]
    total = np.concatenate([[0], np.cumsum(mark)])
    # a capital right at a run's start follows nothing inside the run
    keep = total[end] - total[start] - (mark[start] & ~_DIGIT[data[start]]) > 0
    return start[keep], end[keep], start[~keep], end[~keep]


@dataclass
class Scan:
    """Base spans and free candidates of a stretch of rows, as byte offsets into their texts."""
    spans: list[list[tuple[int, int, str]]]
    found: list[tuple[int, int, int]]  # row, start, end of candidates
    base: np.ndarray                   # whether a candidate touches a base span
    label: np.ndarray                  # of a candidate: secret or ordinary
    words: list[tuple[int, int, int]]  # long runs that are no candidates
    texts: list[bytes]


def scan(column: pa.Array) -> Iterator[tuple[int, Scan]]:
    """(first row, what its stretch of rows holds), a bounded number of bytes at a time."""
    data, at = utf8(column)
    first, n = 0, len(at) - 1
    while first < n:
        last = min(max(int(np.searchsorted(at, at[first] + SLICE_BYTES, side="right")) - 1, first + 1), n)
        yield first, _scan_rows(data[at[first]: at[last]], at[first: last + 1] - at[first])
        first = last


def _scan_rows(data: np.ndarray, at: np.ndarray) -> Scan:
    whole = data.tobytes()
    texts = [whole[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    spans: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    for text, mine in zip(texts, spans, strict=True):
        mine += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= RULES["assign"]]
        mine += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= RULES["access"]]
    start, end = _runs(data, at, _HEX, RULES["hex"])
    row = np.searchsorted(at, start, side="right") - 1
    for r, a, b in zip(row.tolist(), (start - at[row]).tolist(), (end - at[row]).tolist(), strict=True):
        spans[r].append((a, b, "hex"))
    start, end, w_start, w_end = _candidates(data, at)

    def placed(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int, int]]:
        row = np.searchsorted(at, start, side="right") - 1
        return list(zip(row.tolist(), (start - at[row]).tolist(), (end - at[row]).tolist(), strict=True))

    found = placed(start, end)
    base, label = np.zeros(len(found), bool), np.full(len(found), ORDINARY)
    of_row, mine, k = -1, [], 0
    for i, (r, a, b) in enumerate(found):
        if r != of_row:
            of_row, mine, k = r, sorted(spans[r]), 0
        while k < len(mine) and mine[k][1] <= a:  # candidates come in order, and spans that overlap touch the same one
            k += 1
        for s, e, kind in mine[k:]:
            if s >= b:
                break
            if e > a:
                base[i] = True
                if kind != "hex" or not texts[r][s:e].isdigit():
                    label[i] = SECRET
    return Scan(spans, found, base, label, placed(w_start, w_end), texts)


# ---- the network -----------------------------------------------------------------

def _coded(text: bytes, start: int, end: int) -> np.ndarray:
    """Character codes of a candidate and its context, each region with codes of its own."""
    left, right = text[max(0, start - CONTEXT): start], text[end: end + CONTEXT]
    out = np.full(2 * CONTEXT + end - start, _PAD, dtype=np.int64)
    codes = _CODE[np.frombuffer(left + text[start:end] + right, dtype=np.uint8)]
    out[CONTEXT - len(left): CONTEXT - len(left) + len(codes)] = codes
    out[CONTEXT: CONTEXT + end - start] += _CODES
    out[CONTEXT + end - start:] += 2 * _CODES
    return out


def _blank(codes: np.ndarray) -> np.ndarray:
    """The same candidate with nothing around it."""
    out = codes.copy()
    out[:CONTEXT] = _PAD
    out[len(out) - CONTEXT:] = _PAD + 2 * _CODES
    return out


class Network:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.filters = rng.normal(0, 0.1, (WIDTH, 3 * _CODES, FILTERS)).astype(np.float32)
        self.filter_bias = np.zeros(FILTERS, dtype=np.float32)
        self.hidden = rng.normal(0, 0.3, (FILTERS, HIDDEN)).astype(np.float32)
        self.hidden_bias = np.zeros(HIDDEN, dtype=np.float32)
        self.out = rng.normal(0, 0.3, HIDDEN).astype(np.float32)
        self.out_bias = np.zeros(1, dtype=np.float32)
        self.calibration = (1.0, 0.0)
        self.thresholds = (0.5, 0.5)  # of candidates after an assignment mark, and of the others

    @property
    def parameters(self) -> list[np.ndarray]:
        return [self.filters, self.filter_bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def _answers(self, codes: np.ndarray) -> np.ndarray:
        n = len(codes) - WIDTH + 1
        made = np.broadcast_to(self.filter_bias, (n, FILTERS)).copy()
        for k in range(WIDTH):
            made += self.filters[k][codes[k: k + n]]
        return made

    def pooled(self, examples: Sequence[np.ndarray], places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Largest answer of each filter over each whole example, and where it is."""
        best = np.full((len(examples), FILTERS), -np.inf, dtype=np.float32)
        where = np.zeros((len(examples), FILTERS), dtype=np.int64) if places else None
        for i, codes in enumerate(examples) if places else ():
            made = self._answers(codes)
            where[i] = made.argmax(axis=0)
            best[i] = made[where[i], np.arange(FILTERS)]
        if places:
            return best, where
        held: list[tuple[int, np.ndarray]] = []
        size = 0

        def flush():
            made = self._answers(np.concatenate([c for _, c in held]))
            ends = np.cumsum([len(c) for _, c in held])
            marks = np.stack([ends - [len(c) for _, c in held], ends - WIDTH + 1], axis=1).ravel()[:-1]
            tops = np.maximum.reduceat(made, marks, axis=0)[::2]
            np.maximum.at(best, [i for i, _ in held], tops)

        for i, codes in enumerate(examples):
            for a in range(0, len(codes) - WIDTH + 1, HELD):  # a very long one in overlapping stretches
                part = codes[a: a + HELD + WIDTH - 1]
                if held and size + len(part) > HELD:
                    flush()
                    held, size = [], 0
                held.append((i, part))
                size += len(part)
        if held:
            flush()
        return best, None

    def logits(self, examples: Sequence[np.ndarray]) -> np.ndarray:
        if not len(examples):
            return np.zeros(0)
        top = np.maximum(self.pooled(examples)[0], 0)
        layer = np.maximum(top @ self.hidden + self.hidden_bias, 0)
        return (layer @ self.out + self.out_bias[0]).astype(np.float64)

    def probability(self, examples: Sequence[np.ndarray]) -> np.ndarray:
        a, b = self.calibration
        return 1 / (1 + np.exp(-np.clip(a * self.logits(examples) + b, -500, 500)))

    def secret(self, examples: Sequence[np.ndarray], marked: np.ndarray) -> np.ndarray:
        return self.probability(examples) >= np.where(marked, *self.thresholds)

    def gradients(self, examples: Sequence[np.ndarray], label: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        best, where = self.pooled(examples, places=True)
        top = np.maximum(best, 0)
        layer = np.maximum(top @ self.hidden + self.hidden_bias, 0)
        p = 1 / (1 + np.exp(-np.clip(layer @ self.out + self.out_bias[0], -60, 60)))
        d = ((p - label) * weight / weight.sum()).astype(np.float32)
        d_layer = np.outer(d, self.out) * (layer > 0)
        d_top = (d_layer @ self.hidden.T) * (best > 0)
        d_filters = np.zeros_like(self.filters)
        lengths = np.array([len(c) for c in examples])
        flat, first = np.concatenate(examples), (np.cumsum(lengths) - lengths)[:, None]
        for k in range(WIDTH):
            np.add.at(d_filters[k], (flat[first + where + k], np.arange(FILTERS)[None, :]), d_top)
        return [d_filters, d_top.sum(axis=0), top.T @ d_layer, d_layer.sum(axis=0), layer.T @ d, d.sum(keepdims=True)]

    def fit(self, examples: list[np.ndarray], label: np.ndarray, weight: np.ndarray, seed: int = 11) -> None:
        rng, t = np.random.default_rng(seed), 0
        mean, square = ([np.zeros_like(p) for p in self.parameters] for _ in range(2))
        for _ in range(EPOCHS):
            order = rng.permutation(len(examples))
            for at in range(0, len(order), BATCH):
                pick, t = order[at: at + BATCH], t + 1
                grads = self.gradients([examples[i] for i in pick], label[pick], weight[pick])
                for p, g, m, v in zip(self.parameters, grads, mean, square, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)

    def calibrate(self, examples: list[np.ndarray], label: np.ndarray, marked: np.ndarray, recall: float) -> None:
        """Scale and shift by the held-out findings (Newton steps on smoothed labels), then the thresholds."""
        x, n1 = self.logits(examples), label.sum()
        want = np.where(label > 0, (n1 + 1) / (n1 + 2), 1 / (len(label) - n1 + 2))
        theta, design = np.array([1.0, 0.0]), np.stack([x, np.ones_like(x)], axis=1)

        def loss(t: np.ndarray) -> float:
            z = design @ t
            return float((np.logaddexp(0, z) - want * z).sum())

        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(design @ theta, -500, 500)))
            step = np.linalg.solve((design.T * (p * (1 - p))) @ design + 1e-6 * np.eye(2), design.T @ (p - want))
            while loss(theta - step) > loss(theta) and np.abs(step).max() > 1e-9:
                step = step / 2
            theta = theta - step
            if np.abs(step).max() < 1e-9:
                break
        if np.isfinite(theta).all() and theta[0] > 0:
            self.calibration = (float(theta[0]), float(theta[1]))
        p = self.probability(examples)

        def threshold(group: np.ndarray) -> float:
            own = np.sort(p[group & (label > 0)])
            if not len(own):
                return 0.5
            # a share of ``recall`` lies at or above it; never higher than an even chance
            return float(min(0.5, own[int(np.floor((1 - recall) * len(own)))]))

        self.thresholds = (threshold(marked), threshold(~marked))


# ---- labelled findings -----------------------------------------------------------

def _spellings(secret: bytes) -> list[bytes]:
    """The same secret as it stands, in capitals, and in both kinds of base64."""
    plain = base64.b64encode(hashlib.sha256(secret).digest()[: max(9, min(30, len(secret) * 3 // 4))])
    return [secret, secret.upper(), plain, base64.urlsafe_b64encode(hashlib.sha256(b"u" + secret).digest()[:24]).rstrip(b"=")]


def _compounds(word: bytes) -> list[bytes]:
    """A run of letters as it stands, and as a name in code, a dated name and a file's path."""
    k, h = len(word) // 2, hashlib.sha256(word).digest()
    a, b = word[:k].strip(b"/+=_.-") or b"a", word[k:].strip(b"/+=_.-") or b"b"
    return [word, a.lower() + b.capitalize() + word[:3].capitalize(), b"%s_%s_%d" % (a, b, h[0] % 100),
            b"%s-%s-%d.%d.%d" % (a, b, h[1] % 12, h[2] % 40, h[3] % 100), b"%s/%d/%s.%s" % (a, 1990 + h[4] % 40, b, word[:3])]


def is_marked(text: bytes, start: int) -> bool:
    """Whether an assignment mark stands right before a candidate, but for quotes and spaces."""
    return text[max(0, start - CONTEXT): start].rstrip(b" \"'")[-1:] in (b":", b"=")


_FINDING = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("text", T.BinaryType()),
                         T.StructField("start", T.IntegerType()), T.StructField("length", T.IntegerType())])


def labelled(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(label, text, start, length) of the documents' labelled findings: a candidate with its context."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, got in scan(batch.column(0)):
                made = []
                findings = [*zip(got.found, got.label.tolist(), strict=True), *((w, WORD) for w in got.words)]
                for (r, a, b), label in findings:
                    if b - a <= TRAIN_LENGTH:
                        lo = max(0, a - CONTEXT)
                        made.append((label, got.texts[r][lo: b + CONTEXT], a - lo, b - a))
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(
                        zip(*made, strict=True), (pa.int32(), pa.binary(), pa.int32(), pa.int32()), strict=True)],
                        names=_FINDING.names)

    return docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(find, _FINDING)


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", train_docs: int = TRAIN_DOCS,
          train_findings: int = TRAIN_FINDINGS, recall: float = RECALL) -> Network | None:
    """The network of a table's labelled findings, or None where they are too few.

    Bounded: documents are chosen by a hash of their identifier, about
    ``train_docs`` of them, and of each class the ``train_findings`` findings
    of the smallest hash reach the driver.
    """
    share = min(1.0, train_docs / max(1, docs.count()))
    picked = docs.where(F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(1 << 20)) < int(share * (1 << 20)))
    findings = labelled(picked, text_col).distinct().withColumn("h", F.xxhash64("text", "start"))
    sample = []
    for label in (ORDINARY, SECRET, WORD):
        sample += findings.where(F.col("label") == label).orderBy("h", "text", "start").limit(train_findings).collect()
    return fit_findings([(r.label, bytes(r.text), r.start, r.length) for r in sample], recall)


def fit_findings(findings: list[tuple[int, bytes, int, int]], recall: float = RECALL) -> Network | None:
    """Trained on two thirds of the findings, calibrated on the others (by a hash of the candidate)."""
    n1 = sum(label == SECRET for label, *_ in findings)
    if min(n1, len(findings) - n1) < MIN_FINDINGS:
        return None
    rows: dict[bool, list] = {True: [], False: []}
    for label, text, start, length in findings:
        own = text[start: start + length]
        held = hashlib.sha256(own).digest()[0] % 3 == 0
        kinds = _spellings(own) if label == SECRET else _compounds(own) if label == WORD else [own]
        for spelt in kinds:
            full = text[:start] + spelt + text[start + length:]
            codes = _coded(full, start, start + len(spelt))
            rows[held].append((codes, label == SECRET, 1.0 / len(kinds), is_marked(full, start)))
            rows[held].append((_blank(codes), label == SECRET, 1.0 / len(kinds), False))
    if any(len({label for _, label, *_ in part}) < 2 for part in rows.values()):
        return None
    made = {h: (([r[0] for r in part]), *(np.array([r[k] for r in part]) for k in (1, 2, 3))) for h, part in rows.items()}
    net = Network()
    codes, label, weight, _ = made[False]
    ones = label.astype(bool)
    weight = np.where(ones, weight / weight[ones].sum(), weight / weight[~ones].sum())  # both classes count alike
    net.fit(codes, label.astype(np.float32), weight.astype(np.float32) * len(codes))
    codes, label, _, marked = made[True]
    net.calibrate(codes, label, marked.astype(bool), recall)
    return net


# ---- the operator ----------------------------------------------------------------

def _listed(spans: list[tuple[int, int, str]], text: bytes) -> list[str]:
    """kind:start:end in code points, by start, then kind."""
    if not spans:
        return []
    points = np.concatenate([[0], np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)])
    rows = sorted((int(points[a]), KINDS.index(kind), int(points[b])) for a, b, kind in spans)
    return [f"{KINDS[k]}:{a}:{b}" for a, k, b in rows]


_OUT = [("n_assign", T.LongType()), ("n_access", T.LongType()), ("n_hex", T.LongType()), ("n_cnn", T.LongType()),
        ("base_sha256", T.StringType()), ("spans", T.StringType())]


def scan_secrets(docs: DataFrame, net: Network | None, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with n_assign, n_access, n_hex, n_cnn, base_sha256 and spans."""
    def make():
        def work(columns):
            out: list[list] = [[] for _ in _OUT]
            for _, got in scan(columns[0]):
                free = [f for f, base in zip(got.found, got.base, strict=True) if not base]
                extra: list[list[tuple[int, int, str]]] = [[] for _ in got.texts]
                if net is not None and free:
                    marked = np.array([is_marked(got.texts[r], a) for r, a, _ in free])
                    for at in range(0, len(free), 4096):
                        part = free[at: at + 4096]
                        codes = [_coded(got.texts[r], a, b) for r, a, b in part]
                        for (r, a, b), yes in zip(part, net.secret(codes, marked[at: at + 4096]), strict=True):
                            if yes:
                                extra[r].append((a, b, "cnn"))
                for text, base, more in zip(got.texts, got.spans, extra, strict=True):
                    for k, kind in enumerate(RULES):
                        out[k].append(sum(s[2] == kind for s in base))
                    out[3].append(len(more))
                    out[4].append(hashlib.sha256(",".join(_listed(base, text)).encode()).hexdigest())
                    out[5].append(",".join(_listed(base + more, text)))
            return [pa.array(c, pa.int64() if t == T.LongType() else pa.string()) for c, (_, t) in zip(out, _OUT, strict=True)]
        return work

    return add_columns(docs, [text_col], _OUT, make, drop=[text_col])
