"""Hard negatives by threshold joins over an index that leaves out what norms already bound.

Every anchor is scored against all rows, a block of rows at a time. Inside a
block the join is a threshold join: components are put in order of rising
weight, and at a threshold t = s * |anchor| a row's longest leading run of
components with a norm below s is left out of the index, for by
Cauchy-Schwarz it cannot reach t by itself. The postings of the rest are
summed from the last component down; after each step a pair goes when its
partial score and the product of the remaining norms cannot reach t. Pairs
that stay get their whole score in integers. The threshold starts high and is
lowered until an anchor's windows are full or nothing is left below.

First the ``positives`` best rows of the anchor's own label are found, then,
for each of them, the best rows of other labels whose score lies between
``low`` and ``high`` per cent of the positive's.

A block holds ``BLOCK_ROWS`` rows whatever their labels or vectors are, so
copies and frequent labels make no large group; the anchors, a hundredth of
the rows, are sent to every block and pass through it in batches.

Defined results: rows with a null label, a null vector or a component that is
null or not finite take no part, nor do rows with a component whose floor is
2**24 or more in size (scores of such rows could pass 64 bits). Vectors of
different lengths are compared as if the shorter one went on with zeros. A row
without an id can be a positive or a negative, after all others of its score.
Repeated rows are rows of their own. An anchor without another row of its
label has no result; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import cut

#: Rows a block holds; at 64 components about 20 MB in a worker.
BLOCK_ROWS = 8192
#: Anchors scored at once, and components summed between two prunings.
BATCH, STEP = 64, 16
#: First threshold as a share of the largest norm, the factor of each lowering, and the share where all is scored.
START, FACTOR, END = 0.9, 0.75, 0.08
LARGEST = 1 << 24
_NO_ID = np.iinfo(np.int64).max


def prepare(rows: DataFrame, *, vec_id: str = "vec_id", label: str | Column = "label", vector: str = "embedding",
            anchor: Column | None = None, scale: int = 256) -> DataFrame:
    """(row, vec_id, label, v, anchor) of the rows that take part, written once so that ``row`` stays fixed."""
    label = F.col(f"`{label}`") if isinstance(label, str) else label
    unit = F.transform(F.col(f"`{vector}`"), lambda x: F.lit(float(scale)) * x.cast("double"))
    rows = rows.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"),
                       unit.alias("u"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    fine = F.forall("u", lambda x: F.coalesce((x >= -LARGEST) & (x < LARGEST), F.lit(False)))  # no nan, no infinity
    rows = rows.where(F.col("label").isNotNull() & F.col("u").isNotNull() & fine)
    whole = F.transform("u", lambda x: F.floor(x).cast("int"))
    return cut(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", whole.alias("v"), "anchor"),
               "hard-negative-rows")


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Integer vectors as rows, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten()).astype(np.int64)
    out = np.zeros((len(size), max(1, int(size.max(initial=0)))), dtype=np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return out


def _widened(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


class Index:
    """Postings of a block's components at threshold share ``s``; None leaves nothing out."""

    def __init__(self, x: np.ndarray, norms: np.ndarray, s: float | None):
        width = x.shape[1]
        out = np.zeros(len(x), dtype=np.int64)
        if s is not None:
            out = (norms[:, 1:] < s * (1 - 1e-9)).sum(axis=1)  # norms of leading runs only rise
        self.order = np.argsort(out, kind="stable")
        self.out = out[self.order]
        self.value = x[self.order].astype(np.float64)
        self.value[np.arange(width) < self.out[:, None]] = 0
        # postings of component j are those of the first ends[j] rows
        self.ends = np.searchsorted(self.out, np.arange(width), side="right")
        self.n_postings = int(self.ends.sum())


class Block:
    def __init__(self, row: np.ndarray, vec_id: np.ndarray, label: np.ndarray, x: np.ndarray):
        self.row, self.vec_id, self.label, self.x = row, vec_id, label, x
        self.weight = np.argsort((x.astype(np.float64) ** 2).sum(axis=0), kind="stable")
        self.x = np.ascontiguousarray(x[:, self.weight])
        self.norms = leading_norms(self.x)
        self.top = float(self.norms[:, -1].max(initial=0.0))
        self.made: dict[float | None, Index] = {}

    def index(self, s: float | None) -> Index:
        if s not in self.made:
            self.made[s] = Index(self.x, self.norms, s)
        return self.made[s]

    def shares(self) -> list[float | None]:
        out, s = [], START
        while s > END:
            out.append(s * self.top)
            s *= FACTOR
        return [*out, None]

    def join(self, q: np.ndarray, s: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of all pairs with score >= s * |anchor|; of all pairs where s is None."""
        index, width = self.index(s), self.x.shape[1]
        q_norms, qf = leading_norms(q), q.astype(np.float64)
        least = np.full(len(q), -np.inf) if s is None else s * q_norms[:, -1]
        n = int(index.ends[-1]) if width else 0
        rows, partial = np.arange(n), np.zeros((len(q), n))
        alive = np.ones((len(q), n), dtype=bool)
        slack = 1e-9 * (1.0 + q_norms[:, -1] * self.top)
        for j1 in range(width, 0, -STEP):
            j0 = max(0, j1 - STEP)
            c = int(np.searchsorted(rows, index.ends[j1 - 1]))
            partial[:, :c] += qf[:, j0:j1] @ index.value[rows[:c], j0:j1].T
            if s is None:
                continue
            left = np.maximum(j0, index.out[rows])  # components 0 to left - 1 are not in the sum yet
            most = partial + q_norms[:, left] * self.norms[index.order[rows], left]
            alive &= most >= (least - slack)[:, None]
            stay = alive.any(axis=0)
            if 2 * int(stay.sum()) < len(rows):
                rows, partial, alive = rows[stay], partial[:, stay], alive[:, stay]
        at, col = np.nonzero(alive)
        found = index.order[rows[col]]
        score = np.empty(len(at), dtype=np.int64)
        for k in range(0, len(at), 1 << 14):  # whole scores, exactly
            part = slice(k, k + (1 << 14))
            score[part] = np.einsum("ij,ij->i", q[at[part]], self.x[found[part]])
        keep = score >= least[at]
        return at[keep], found[keep], score[keep]

    def best(self, found: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
        return np.lexsort((self.row[found], self.vec_id[found], -score))[:k]

    def search(self, a: dict, k: int, same: bool) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(anchor, window, rows, scores): the best ``k`` of every window; ``same``: of the anchor's label,
        without bounds and without the anchor itself, else of other labels within the window's bounds."""
        q = np.ascontiguousarray(a["x"][:, self.weight])
        norm = leading_norms(q)[:, -1]
        open_ = [[(0, None, None)] if same else [(w, lo, hi) for w, (lo, hi) in enumerate(a["windows"][i])]
                 for i in range(len(q))]
        for s in self.shares():
            ask = np.array([i for i, w in enumerate(open_) if w and (s is None or (norm[i] > 0 and (
                same or s * norm[i] <= max(hi for _, _, hi in w))))], dtype=np.int64)
            if not len(ask):
                continue
            at, found, score = self.join(q[ask], s)
            ends = np.searchsorted(at, np.arange(len(ask) + 1))
            for n, i in enumerate(ask):
                f, sc = found[ends[n]: ends[n + 1]], score[ends[n]: ends[n + 1]]
                own = self.label[f] == a["label"][i]
                mine = own & (self.row[f] != a["row"][i]) if same else ~own
                f, sc = f[mine], sc[mine]
                wait = []
                for w, lo, hi in open_[i]:
                    inside = np.ones(len(f), bool) if same else (sc >= lo) & (sc <= hi)
                    if s is None or inside.sum() >= k or (not same and s * norm[i] <= lo):
                        pick = self.best(f[inside], sc[inside], k)
                        yield int(i), w, f[inside][pick], sc[inside][pick]
                    else:
                        wait.append((w, lo, hi))
                open_[i] = wait


def leading_norms(x: np.ndarray) -> np.ndarray:
    """Norm of the first j components, for j from 0."""
    out = np.zeros((x.shape[0], x.shape[1] + 1))
    np.sqrt(np.cumsum(x.astype(np.float64) ** 2, axis=1), out=out[:, 1:])
    return out


_FOUND = T.StructType([T.StructField(n, t) for n, t in (
    ("anchor_row", T.LongType()), ("anchor_id", T.LongType()), ("window", T.IntegerType()),
    ("found_id", T.LongType()), ("found_row", T.LongType()), ("score", T.LongType()))])


def _finder(k: int, same: bool):
    """Reads blocks in order, each one's rows before its anchors; holds one block and one batch of anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block_no, parts, block = None, [], None
        for batch in batches:
            number, kind = np.asarray(batch.column("block")), np.asarray(batch.column("kind"))
            edge = np.flatnonzero((np.diff(number) != 0) | (np.diff(kind) != 0)) + 1
            edge = [0, *edge.tolist(), batch.num_rows]
            for lo, hi in zip(edge[:-1], edge[1:], strict=True):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                if number[lo] != block_no:
                    block_no, parts, block = number[lo], [], None
                if kind[lo] == 0:
                    parts.append(_columns(part))
                elif parts or block:
                    if block is None:
                        width = max(p["x"].shape[1] for p in parts)
                        block = Block(*(np.concatenate([p[c] for p in parts]) for c in ("row", "vec_id", "label")),
                                      np.concatenate([_widened(p["x"], width) for p in parts]))
                        parts = []
                    for at in range(0, part.num_rows, BATCH):
                        yield from _answers(block, _columns(part.slice(at, BATCH)), k, same)
    return run


def _columns(part: pa.RecordBatch) -> dict:
    out = {"row": np.asarray(part.column("row")), "label": np.asarray(part.column("label")),
           "vec_id": np.asarray(part.column("vec_id").fill_null(int(_NO_ID))), "x": _matrix(part.column("v"))}
    out["windows"] = [[(w["lo"], w["hi"]) for w in ws or ()] for ws in part.column("windows").to_pylist()]
    return out


def _answers(block: Block, a: dict, k: int, same: bool) -> Iterator[pa.RecordBatch]:
    width = max(a["x"].shape[1], block.x.shape[1])
    if width > block.x.shape[1]:  # the anchors' further components meet zeros
        a = a | {"x": a["x"][:, :block.x.shape[1]]}
    a = a | {"x": _widened(a["x"], block.x.shape[1])}
    cols: list[list[np.ndarray]] = [[] for _ in range(6)]
    for i, w, found, score in block.search(a, k, same):
        n = len(found)
        for c, v in zip(cols, (np.full(n, a["row"][i]), np.full(n, a["vec_id"][i]), np.full(n, w, np.int32),
                               block.vec_id[found], block.row[found], score), strict=True):
            c.append(v)
    if cols[0]:
        made = [np.concatenate(c) for c in cols]
        ids = pa.array(made[3], mask=made[3] == _NO_ID)
        yield pa.RecordBatch.from_arrays([*map(pa.array, made[:3]), ids, *map(pa.array, made[4:])], names=_FOUND.names)


def _search(rows: DataFrame, anchors: DataFrame, blocks: int, k: int, same: bool) -> DataFrame:
    """The best ``k`` of each block for every anchor's windows, then the best ``k`` of all, ranked from 1."""
    columns = ["row", "vec_id", "label", "v", "windows"]
    none = F.lit(None).cast(anchors.schema["windows"].dataType).alias("windows")
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    both = rows.withColumn("windows", none).select(block.alias("block"), F.lit(0).alias("kind"), *columns).unionByName(
        anchors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), *columns))
    found = (both.repartition(blocks, "block").sortWithinPartitions("block", "kind")
             .mapInArrow(_finder(k, same), _FOUND))
    best = Window.partitionBy("anchor_row", "window").orderBy(
        F.desc("score"), F.asc_nulls_last("found_id"), F.asc("found_row"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mine(rows: DataFrame, *, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of prepared rows."""
    blocks = max(1, -(-rows.count() // block_rows))
    span = "array<struct<lo:bigint,hi:bigint>>"
    anchors = rows.where("anchor").withColumn("windows", F.lit(None).cast(span))
    near = _search(rows, anchors, blocks, positives, same=True)
    near = cut(near.select("anchor_row", F.col("rank").alias("positive"), F.col("found_id").alias("positive_id"),
                           F.col("score").alias("positive_score")), "hard-negative-positives")
    # integer bounds of low * positive <= 100 * score <= high * positive; a negative positive has none
    lo = F.expr(f"-((-{low} * positive_score - pmod(-{low} * positive_score, 100)) DIV 100)")
    hi = F.expr(f"({high} * positive_score - pmod({high} * positive_score, 100)) DIV 100")
    spans = (near.withColumn("w", F.struct(F.col("positive"), lo.alias("lo"), hi.alias("hi")))
             .groupBy("anchor_row").agg(F.sort_array(F.collect_list("w")).alias("ws")))  # at most ``positives`` each
    spans = spans.select(F.col("anchor_row").alias("row"), F.transform(
        "ws", lambda w: F.struct(w["lo"].alias("lo"), w["hi"].alias("hi"))).cast(span).alias("windows"))
    far = _search(rows, anchors.drop("windows").join(spans, "row"), blocks, negatives, same=False)
    far = far.withColumn("positive", F.col("window") + 1)
    return far.join(near, ["anchor_row", "positive"]).select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
