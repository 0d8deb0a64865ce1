"""Benchmark decontamination by a broadcast set of test n-grams.

The benchmark's items are normalised to words, and every window of ``size``
consecutive words goes into a hash set that is sent to the tasks (an item of
fewer words is one window). Tasks hash every window of the training texts
with array operations, look the hashes up, and verify each hit on the words
themselves. There is no shuffle: a document is decided where it is read. The
set is arrays, sorted by hash: one hash, one place in the items' text and a
list of items for each distinct window, about ten bytes a byte of text.

The set is broadcast up to ``BROADCAST_BYTES`` of measured benchmark text.
Beyond, Spark writes the windows as a table, and a filter of fixed size (a bit
for each of ``2 ** FILTER_BITS`` hash values) is all that tasks hold: the
documents' windows that pass it are joined with the table by a shuffle, on the
words themselves, and come back to their documents as hit places and items.
Both ways give the same rows.

Defined results: a null text has no words; an item without words has no
window; a null item_id is left out; repeated item_ids count once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import cut
from .words import ALNUM, Words, slices, window_hashes

WINDOW = 10
#: Largest benchmark text whose set is broadcast; about ten times that in a worker.
BROADCAST_BYTES = 8 << 20
#: Text bytes of items that are put into the set at once.
ITEM_SLICE = 1 << 18
FILTER_BITS = 24
_SET_BITS = 20


def _windows(words: Words, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(k, hashes, first words, rows) of the windows within rows: of ``size`` words, or all of a shorter row's."""
    h, count = words.hashes(), np.diff(words.ptr)
    for k in sorted({min(size, int(c)) for c in np.unique(count) if c}):
        w = window_hashes(h, k)
        at = np.arange(len(w))
        row = np.searchsorted(words.ptr, at, side="right") - 1
        inside = (at + k <= words.ptr[row + 1]) & ((count[row] == k) if k < size else True)
        yield k, w[inside], at[inside], row[inside]


class _Sized:
    """The distinct windows of one length, by hash: where each stands in the text, and its items."""

    def __init__(self, hashes: np.ndarray, places: np.ndarray, items: np.ndarray, text_at):
        order = np.lexsort((items, hashes))
        hashes, places, items = hashes[order], places[order], items[order]
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = hashes[1:] != hashes[:-1]
        group = np.cumsum(new) - 1
        first = places[new]
        self.other: dict[int, list[tuple[bytes, np.ndarray]]] = {}  # other windows that share a hash: hardly ever any
        odd = np.zeros(len(hashes), dtype=bool)
        for i in np.flatnonzero(~new).tolist():
            if places[i] != first[group[i]] and text_at(places[i]) != text_at(first[group[i]]):
                odd[i] = True
        for text in {text_at(p) for p in places[odd]}:
            mine = [i for i in np.flatnonzero(odd).tolist() if text_at(places[i]) == text]
            self.other.setdefault(int(hashes[mine[0]]), []).append((text, np.unique(items[mine])))
        keep = ~odd
        keep[1:] &= new[1:] | (items[1:] != items[:-1]) | odd[:-1]  # an item once
        self.hashes, self.places = hashes[new], first
        self.items = items[keep]
        self.ends = np.searchsorted(group[keep], np.arange(len(self.hashes) + 1)).astype(np.int32)
        self.filter = np.zeros(1 << _SET_BITS, dtype=bool)
        self.filter[self.hashes >> np.uint64(64 - _SET_BITS)] = True

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for x in (self.hashes, self.places, self.items, self.ends))


class WindowSet:
    """The windows of a benchmark: arrays sorted by hash, and one copy of the items' words."""

    def __init__(self, ids: np.ndarray, texts: pa.Array, size: int):
        self.ids, held, base = ids, {}, 0
        data: list[bytes] = []
        starts, ends = [], []
        for words in slices(texts, ALNUM, ITEM_SLICE):
            for k, h, at, row in _windows(words, size):
                held.setdefault(k, []).append((h, (at + sum(map(len, starts))).astype(np.int32),
                                               (row + words.first).astype(np.int32)))
            data.append(words.data.tobytes())
            starts.append((words.start + base).astype(np.int32))
            ends.append((words.end + base).astype(np.int32))
            base += len(words.data)
        self.data = b"".join(data)
        self.start, self.end = (np.concatenate(x) if x else np.zeros(0, np.int32) for x in (starts, ends))
        del data, starts, ends
        self.by_size = {}
        for k in sorted(held):
            parts = held.pop(k)
            self.by_size[k] = _Sized(*(np.concatenate([p[c] for p in parts]) for c in range(3)),
                                     lambda place, k=k: self.text(int(place), k))

    def text(self, place: int, k: int) -> bytes:
        return b" ".join(self.data[s:e] for s, e in zip(self.start[place: place + k].tolist(),
                                                        self.end[place: place + k].tolist(), strict=True))

    @property
    def nbytes(self) -> int:
        return len(self.data) + self.start.nbytes + self.end.nbytes + sum(x.nbytes for x in self.by_size.values())

    def scan(self, words: Words, hit: np.ndarray, found: dict[int, set[int]]) -> None:
        """Marks hit words in ``hit`` and adds item numbers by row to ``found``."""
        h = words.hashes()
        for k, known in self.by_size.items():
            w = window_hashes(h, k)
            at = np.flatnonzero(known.filter[w >> np.uint64(64 - _SET_BITS)])
            slot = np.searchsorted(known.hashes, w[at])
            slot[slot == len(known.hashes)] = 0
            right = known.hashes[slot] == w[at] if len(known.hashes) else np.zeros(0, bool)
            at, slot = at[right], slot[right]
            row = np.searchsorted(words.ptr, at, side="right") - 1
            inside = at + k <= words.ptr[row + 1]
            for i, r, g in zip(at[inside].tolist(), row[inside].tolist(), slot[inside].tolist(), strict=True):
                text = words.joined(i, i + k)
                if text == self.text(int(known.places[g]), k):
                    ids = known.items[known.ends[g]: known.ends[g + 1]]
                else:
                    ids = next((ids for other, ids in known.other.get(int(w[i]), ()) if other == text), None)
                    if ids is None:
                        continue
                hit[i:i + k] = True
                found.setdefault(r, set()).update(ids.tolist())


def _digested(ids) -> str:
    return hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()


_MARKS = [T.StructField(c, T.LongType()) for c in ("_n_words", "_n_hit", "_n_items")] + [T.StructField("_sha", T.StringType())]


def _decided(batch: pa.RecordBatch, text_out: str, per_row) -> pa.RecordBatch:
    """A batch with its marks; ``per_row`` gives the hit mask and the item ids of a slice's rows."""
    texts, n_words, n_hit, n_items, sha, cut_texts = batch.column("_t"), [], [], [], [], []
    for words in slices(texts, ALNUM):
        hit, items = per_row(words)
        for r in range(words.rows):
            own = hit[words.ptr[r]: words.ptr[r + 1]]
            ids = items.get(r, ())
            n_words.append(len(own))
            n_hit.append(int(own.sum()))
            n_items.append(len(ids))
            sha.append(_digested(ids))
            if text_out == "cut":
                whole = texts[words.first + r].as_py()
                cut_texts.append(_without(whole, words, r, own) if n_hit[-1] else whole)
    out = {c: batch.column(c) for c in batch.schema.names if c not in ("_hits", "_items")}
    if text_out == "drop":
        del out["_t"]
    elif text_out == "cut":
        out["_t"] = pa.array(cut_texts, pa.string())
    out |= {"_n_words": pa.array(n_words, pa.int64()), "_n_hit": pa.array(n_hit, pa.int64()),
            "_n_items": pa.array(n_items, pa.int64()), "_sha": pa.array(sha, pa.string())}
    return pa.RecordBatch.from_arrays(list(out.values()), names=list(out))


def _by_set(ids: np.ndarray, texts: pa.Array, size: int, text_out: str):
    """One scan of whole texts with the broadcast set."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = WindowSet(ids, texts, size)

        def per_row(words: Words):
            hit, found = np.zeros(len(words.start), dtype=bool), {}
            windows.scan(words, hit, found)
            return hit, {r: set(windows.ids[list(items)].tolist()) for r, items in found.items()}

        for batch in batches:
            yield _decided(batch, text_out, per_row)
    return scan


# ---- beyond the bound: windows as a table ------------------------------------------

_WINDOW = "k int, h bigint, words binary"


def _item_windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in slices(batch.column(1), ALNUM, ITEM_SLICE):
                for k, h, at, row in _windows(words, size):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(h), k, np.int32)), pa.array(h.view(np.int64)),
                         pa.array([words.joined(i, i + k) for i in at.tolist()], pa.binary()),
                         batch.column(0).take(pa.array(row + words.first))], names=["k", "h", "words", "item"])
    return run


def _passing(sizes: list[int], bits: np.ndarray):
    """Windows of the documents that pass the filter: (row, place, k, hash, words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in slices(batch.column(1), ALNUM):
                h = words.hashes()
                for k in sizes:
                    w = window_hashes(h, k)
                    bit = w >> np.uint64(64 - FILTER_BITS)
                    at = np.flatnonzero(bits[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)
                    row = np.searchsorted(words.ptr, at, side="right") - 1
                    inside = at + k <= words.ptr[row + 1]
                    at, row = at[inside], row[inside]
                    if len(at):
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array(row + words.first)), pa.array((at - words.ptr[row]).astype(np.int64)),
                             pa.array(np.full(len(at), k, np.int32)), pa.array(w[at].view(np.int64)),
                             pa.array([words.joined(i, i + k) for i in at.tolist()], pa.binary())],
                            names=["row", "at", "k", "h", "words"])
    return run


def _by_table(text_out: str):
    """Marks of rows that bring their hit places (place * 64 + k) and items along."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, lists = batch.column("_hits"), batch.column("_items")

            def per_row(words: Words, hits=hits, lists=lists):
                hit, items = np.zeros(len(words.start), dtype=bool), {}
                for r in range(words.rows):
                    places = hits[words.first + r].as_py()
                    for p in places or ():
                        at = int(words.ptr[r]) + p // 64
                        hit[at: at + p % 64] = True
                    if places:
                        items[r] = lists[words.first + r].as_py()
                return hit, items

            yield _decided(batch, text_out, per_row)
    return scan


def _joined(rows: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """``rows`` with ``_hits`` and ``_items``, by a shuffled join of windows; nothing but the filter is broadcast."""
    windows = cut(items.mapInArrow(_item_windows(size), f"{_WINDOW}, item bigint").distinct(), "benchmark-windows")
    high = f"shiftrightunsigned(h, {64 - FILTER_BITS})"
    held = windows.groupBy(F.expr(f"shiftrightunsigned({high}, 3)").alias("byte")).agg(
        F.expr(f"bit_or(shiftleft(1, CAST({high} & 7 AS INT)))").alias("bits")).toArrow()  # 2 ** 21 rows at most
    bits = np.zeros(1 << FILTER_BITS - 3, dtype=np.uint8)
    bits[held["byte"].to_numpy()] = held["bits"].to_numpy()
    sizes = sorted(r.k for r in windows.select("k").distinct().collect())  # ``size`` rows at most
    rows = cut(rows.withColumn("_row", F.monotonically_increasing_id()), "benchmark-rows")
    passing = rows.select("_row", "_t").mapInArrow(_passing(sizes, bits), f"row bigint, at bigint, {_WINDOW}")
    # the words are compared, so a hash or a filter bit that says too much does no harm; AQE splits a passage that
    # very many documents hold
    met = passing.join(windows.hint("merge"), ["k", "h", "words"]).select("row", (F.col("at") * 64 + F.col("k")).alias("hit"), "item")
    met = met.groupBy("row").agg(F.collect_set("hit").alias("_hits"), F.collect_set("item").alias("_items"))
    return rows.join(met, rows["_row"] == met["row"], "left").drop("_row", "row")


def _without(whole: str, words, r: int, hit: np.ndarray) -> str:
    """The text without its hit words; a removed stretch becomes one space."""
    data, base, a = whole.encode(), int(words.offsets[r]), int(words.ptr[r])
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    parts, at = [], 0
    for i, j in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        parts.append(data[at: int(words.start[a + i]) - base])
        at = int(words.end[a + j - 1]) - base
    return b" ".join([*parts, data[at:]]).decode()


def _marked(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text: str,
            size: int, broadcast_bytes: int, text_out: str) -> tuple[DataFrame, dict[str, str]]:
    """The marked rows under names of their own, and those names by input column."""
    if not 0 < size < 64:
        raise ValueError("a window has 1 to 63 words")
    items = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("i"), F.col(f"`{item_text}`").alias("t")
                             ).where("i IS NOT NULL AND t IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    names = {c: f"_c{k}" for k, c in enumerate(docs.columns) if c != text_col}
    rows = docs.select(*(F.col(f"`{c}`").alias(a) for c, a in names.items()), F.col(f"`{text_col}`").alias("_t"))
    kept = [*names.values(), *(["_t"] if text_out != "drop" else [])]
    after = T.StructType([rows.schema[c] for c in kept] + _MARKS)
    if total <= broadcast_bytes:
        held = items.toArrow()  # no more than ``broadcast_bytes``, by measure
        texts = held["t"].combine_chunks() if held.num_rows else pa.array([], pa.string())
        return rows.mapInArrow(_by_set(held["i"].to_numpy(), texts, size, text_out), after), names
    return _joined(rows, items, size).mapInArrow(_by_table(text_out), after), names


def mark_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                       item_col: str = "item_id", item_text: str = "text", size: int = WINDOW,
                       broadcast_bytes: int = BROADCAST_BYTES, remove_spans: bool = False) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items_sha256 and contaminated.

    The text column is dropped, or with ``remove_spans`` has the hit words cut
    out. Input columns of the new columns' names are replaced.
    """
    rows, names = _marked(docs, benchmark, text_col, item_col, item_text, size, broadcast_bytes,
                          "cut" if remove_spans else "drop")
    new = {"n_words": F.col("_n_words"), "n_hit": F.col("_n_hit"), "n_items": F.col("_n_items"),
           "items_sha256": F.col("_sha"), "contaminated": F.col("_n_hit") > 0}
    text = [F.col("_t").alias(text_col)] if remove_spans else []
    return rows.select(*(F.col(a).alias(c) for c, a in names.items() if c not in new), *text,
                       *(v.alias(k) for k, v in new.items()))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                      item_col: str = "item_id", item_text: str = "text", size: int = WINDOW,
                      broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window; the same columns."""
    rows, names = _marked(docs, benchmark, text_col, item_col, item_text, size, broadcast_bytes, "keep")
    return rows.where("_n_hit = 0").select(*(F.col(names.get(c, "_t")).alias(c) for c in docs.columns))
