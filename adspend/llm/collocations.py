"""Phrase collocations by weighted acyclic automata.

1. Every shard of texts becomes a count transducer: its windows of up to four
   words are sorted, and states are added where a window departs from the one
   before it. A state stands for the words on its path (language first), its
   weight is how often these words occur in a row in the shard. So one window
   a word position counts the phrases of all lengths.
2. Shards are cut at splitters, sampled from the windows, and union-ed by
   prefix range: equal paths fall together and their weights are summed. A
   splitter may lie inside a phrase's windows, so a very common word or pair
   is dealt over as many ranges as it fills; the phrases at a range's two ends
   are the only ones that can go on in another range and are summed after.
3. A candidate's parts are looked up by composing them with the transducer of
   the frequent phrases: all parts of a frequent phrase are frequent too.

Words, pieces, counts and the score are as ``mine`` states; counts are exact
integers at every step and products are taken in decimals. Defined results: a
null text counts as empty, a null language is ``und``. Rows count as often as
they are repeated. An empty table, or one without frequent phrases, gives an
empty result. Only the text and language columns are read, so further columns
of any name do no harm.
"""

from __future__ import annotations

import struct
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import cut
from .words import LOWER, utf8

#: Words in the longest phrase.
LONGEST = 4
#: Text bytes of one shard; about 25 bytes of memory each while it is sorted.
SHARD_BYTES = 4 << 20
#: Text bytes whose windows make one prefix range, on average.
RANGE_BYTES = 8 << 20
#: States that are held before they are union-ed into one transducer.
HELD_STATES = 2_000_000
#: Windows sampled for the splitters (they decide the balance, not the result).
SAMPLE = 20_000
#: Frequent phrases in one lookup bucket, and the tasks that share a bucket's lookups.
BUCKET, SHARES = 100_000, 4
NO_LANG = "und"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09]] = True
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORD = ~(_SPACE | _BREAK)


# ---- transducers -----------------------------------------------------------------

def _small(x: np.ndarray) -> np.ndarray:
    top = int(x.max(initial=0))
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def _binary(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def _ranked(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(distinct words in byte order, each word's place among them)."""
    coded = words.dictionary_encode()
    order = np.asarray(pc.sort_indices(coded.dictionary)).astype(np.int64)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), place[np.asarray(coded.indices)]


class Transducer:
    """Levels of states (language, then up to four words), each level in the order of its paths.

    Level k has ``label`` (places in ``vocab``, which is in byte order), ``up``
    (places in level k - 1) and ``weight``.
    """

    def __init__(self, vocab: pa.Array, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.vocab, self.levels = vocab, levels

    @property
    def states(self) -> int:
        return sum(len(label) for label, _, _ in self.levels)

    @classmethod
    def of_windows(cls, vocab: pa.Array, columns: Sequence[np.ndarray], count: np.ndarray) -> Transducer:
        """From distinct sorted windows; ``columns`` hold places in ``vocab`` plus one, 0 past a window's end."""
        new = np.zeros(len(count), dtype=bool)
        new[:1] = True
        levels, above = [], np.zeros(len(count), dtype=np.int64)
        for column in columns:
            new[1:] |= column[1:] != column[:-1]  # where a window departs from the one before it
            starts = np.flatnonzero(new)
            is_state = column[starts] > 0
            weight = np.add.reduceat(count, starts) if len(starts) else count
            state = np.cumsum(is_state) - 1
            levels.append(((column[starts][is_state] - 1).astype(np.int32), above[starts][is_state].astype(np.int32),
                           weight[is_state]))
            above = state[np.cumsum(new) - 1]
        return cls(vocab, levels)

    def pack(self) -> bytes:
        used = np.unique(np.concatenate([label for label, _, _ in self.levels])).astype(np.int64)
        vocab = self.vocab.take(pa.array(used))
        at = np.asarray(pc.binary_length(vocab)).astype(np.int64)
        arrays = [np.frombuffer(b"".join(vocab.to_pylist()), dtype=np.uint8), _small(at)]
        n_above = 1
        for label, up, weight in self.levels:
            arrays += [_small(np.searchsorted(used, label)), _small(np.bincount(up, minlength=n_above)), _small(weight)]
            n_above = len(label)
        return b"".join(struct.pack("<BQ", a.itemsize, len(a)) + a.tobytes() for a in arrays)

    @classmethod
    def unpack(cls, packed: bytes) -> Transducer:
        arrays, at = [], 0
        while at < len(packed):
            size, n = struct.unpack_from("<BQ", packed, at)
            arrays.append(np.frombuffer(packed, dtype=f"<u{size}", count=n, offset=at + 9))
            at += 9 + size * n
        data, sizes, *rest = arrays
        vocab = _binary(np.concatenate([[0], np.cumsum(sizes.astype(np.int64))]), data)
        levels = [(label.astype(np.int32), np.repeat(np.arange(len(kids), dtype=np.int32), kids.astype(np.int64)),
                   weight.astype(np.int64))
                  for label, kids, weight in zip(rest[::3], rest[1::3], rest[2::3], strict=True)]
        return cls(vocab, levels)

    def path(self, level: int, states: np.ndarray) -> list[pa.Array]:
        """Labels on the way to some states of a level, language first."""
        out = []
        for k in range(level, -1, -1):
            label, up, _ = self.levels[k]
            out.append(self.vocab.take(pa.array(label[states])))
            states = up[states]
        return out[::-1]

    def weights_of(self, parts: Sequence[pa.Array], size: np.ndarray) -> np.ndarray:
        """Composition with given paths: the weight each path ends with, 0 where it isn't accepted.

        ``parts[k]`` holds the paths' labels at level k (null past the end); path i has ``size[i]`` labels.
        """
        n = len(size)
        state, out = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        for k, ((label, up, weight), part) in enumerate(zip(self.levels, parts, strict=True)):
            word = np.asarray(pc.fill_null(pc.index_in(part, value_set=self.vocab), -1)).astype(np.int64)
            arcs, want = (up.astype(np.int64) << 32) | label, (state << 32) | word
            at = np.minimum(np.searchsorted(arcs, want), max(len(arcs) - 1, 0))
            ok = (state >= 0) & (word >= 0) & (arcs[at] == want if len(arcs) else False)
            state = np.where(ok, at, -1)
            ends = ok & (size == k + 1)
            out[ends] = weight[at[ends]]
        return out


def union(parts: Sequence[Transducer]) -> Transducer:
    """One transducer with the weights of equal paths summed."""
    if len(parts) == 1:
        return parts[0]
    vocab, place = _ranked(pa.concat_arrays([p.vocab for p in parts]))
    first = np.cumsum([0, *(len(p.vocab) for p in parts)])
    levels, above = [], [np.zeros(1, dtype=np.int64) for _ in parts]
    for k in range(len(parts[0].levels)):
        arcs = np.concatenate([(above[i][up] << 32) | place[first[i] + label]
                               for i, (label, up, _) in enumerate(p.levels[k] for p in parts)])
        arcs, state = np.unique(arcs, return_inverse=True)
        weight = np.zeros(len(arcs), dtype=np.int64)
        np.add.at(weight, state, np.concatenate([p.levels[k][2] for p in parts]))
        levels.append(((arcs & 0xFFFFFFFF).astype(np.int32), (arcs >> 32).astype(np.int32), weight))
        above = np.split(state, np.cumsum([len(p.levels[k][0]) for p in parts])[:-1])
    return Transducer(vocab, levels)


# ---- texts to windows ------------------------------------------------------------

def _shards(column: pa.Array, shard_bytes: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, starts of rows in them, row numbers). A text beyond a shard is cut at a piece's end."""
    data, at = utf8(column)
    row, here = 0, 0
    n_rows = len(at) - 1
    while row < n_rows:
        stop = here + shard_bytes
        last = int(np.searchsorted(at, stop, side="right")) - 1
        last = min(max(last, row), row + 50_000)
        if last > row:  # whole rows, the first one perhaps begun
            end, nxt = int(at[last]), last
        else:
            tail = data[stop: int(at[row + 1])]
            found = np.flatnonzero(_BREAK[tail[:shard_bytes]])
            k = int(found[0]) if len(found) else -1
            if k < 0 and len(tail) > shard_bytes:
                found = np.flatnonzero(_BREAK[tail])
                k = int(found[0]) if len(found) else -1
            end, nxt = (stop + k, row) if k >= 0 else (int(at[row + 1]), row + 1)
        rows = np.arange(row, max(nxt, row + 1))
        yield LOWER[data[here:end]], np.maximum(at[rows] - here, 0), rows
        row, here = nxt, end


def _windows(data: np.ndarray, starts: np.ndarray, lang: np.ndarray) -> tuple[pa.Array, list[np.ndarray], np.ndarray] | None:
    """(vocabulary, columns w1 to w4 with the language's code first, counts) of the distinct windows, sorted."""
    inside = _WORD[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = starts[(starts > 0) & (starts < len(data))]
    before[edges] = False
    after[edges - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    if not len(start):
        return None
    row = np.searchsorted(starts, start, side="right") - 1
    piece = np.searchsorted(np.flatnonzero(_BREAK[data]), start) + row
    vocab, word = _ranked(_binary(np.concatenate([[0], np.cumsum(end - start)]), data[inside]))
    word = (word + 1).astype(np.uint64)
    code = lang[row].astype(np.uint64)
    n = len(word)

    def ahead(x: np.ndarray, k: int) -> np.ndarray:
        """What stands k words later in the same piece, else 0."""
        out = np.zeros(n, dtype=np.uint64)
        if n > k:
            out[:-k] = np.where(piece[k:] == piece[:-k], x[k:], 0)
        return out

    pairs, pair = np.unique((code << np.uint64(48)) | (word << np.uint64(24)) | ahead(word, 1), return_inverse=True)
    pair = pair.astype(np.uint64)
    keys = np.sort((pair << np.uint64(32)) | ahead(pair + np.uint64(1), 2))
    firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    keys, count = keys[firsts], np.diff(np.append(firsts, n))
    head = pairs[(keys >> np.uint64(32)).astype(np.int64)]
    tail = np.concatenate([np.zeros(1, np.uint64), pairs])[(keys & np.uint64(0xFFFFFFFF)).astype(np.int64)]
    low = np.uint64((1 << 24) - 1)
    columns = [head >> np.uint64(48), (head >> np.uint64(24)) & low, head & low, (tail >> np.uint64(24)) & low, tail & low]
    return vocab, [c.astype(np.int64) for c in columns], count.astype(np.int64)


def _sorted_shards(batch: pa.RecordBatch, shard_bytes: int):
    """Windows of a batch of (lang, text), shard by shard: languages are part of the vocabulary, in front."""
    langs, code = _ranked(batch.column(0).fill_null(NO_LANG).cast(pa.large_binary()))
    for data, starts, rows in _shards(batch.column(1), shard_bytes):
        used, local = np.unique(code[rows], return_inverse=True)
        found = _windows(data, starts, local)
        if found:
            vocab, columns, count = found
            own = langs.take(pa.array(used))
            columns = [columns[0] + 1, *(np.where(c > 0, c + len(used), 0) for c in columns[1:])]
            yield pa.concat_arrays([own, vocab]), columns, count


def _word_of(vocab: pa.Array, columns: Sequence[np.ndarray], i: int) -> tuple[bytes, ...]:
    return tuple(vocab[int(c[i]) - 1].as_py() if c[i] else b"" for c in columns)


class _Ordered(Sequence):
    """A shard's windows as tuples of words, made when asked for."""

    def __init__(self, vocab, columns):
        self.vocab, self.columns = vocab, columns

    def __len__(self):
        return len(self.columns[0])

    def __getitem__(self, i):
        return _word_of(self.vocab, self.columns, i)


# ---- Spark jobs ------------------------------------------------------------------

_PIECE = T.StructType([T.StructField("range", T.IntegerType()), T.StructField("packed", T.BinaryType())])
_WORDS = [f"w{k + 1}" for k in range(LONGEST)]
_PATH = ["lang", *_WORDS]
_COUNT = T.StructType([*(T.StructField(c, T.StringType()) for c in _PATH), T.StructField("words", T.IntegerType()),
                       T.StructField("a", T.LongType()), T.StructField("edge", T.BooleanType())])
_SPLIT = T.StructType([T.StructField("path", T.ArrayType(T.BinaryType()))])


def _splitters(docs: DataFrame, ranges: int, n_rows: int, n_bytes: int) -> list[tuple[bytes, ...]]:
    """``ranges - 1`` windows that part a sample of all windows evenly."""
    if ranges < 2:
        return []
    share = min(1.0, 4000 / n_rows)
    every = max(1, int(n_bytes * share / 6 / SAMPLE))  # about six bytes a word

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for vocab, columns, _ in _sorted_shards(batch, SHARD_BYTES):
                picks = range(every // 2, len(columns[0]), every)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([list(_word_of(vocab, columns, i)) for i in picks], pa.list_(pa.binary()))], names=["path"])

    picked = docs.sample(share, seed=1).mapInArrow(sample, _SPLIT).limit(2 * SAMPLE).collect()
    paths = sorted({tuple(map(bytes, r.path)) for r in picked})
    return sorted({paths[len(paths) * k // ranges] for k in range(1, ranges)}) if paths else []


def _shard_pieces(splitters: list[tuple[bytes, ...]], shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for vocab, columns, count in _sorted_shards(batch, shard_bytes):
                ordered = _Ordered(vocab, columns)
                cuts = [0, *(bisect_left(ordered, s) for s in splitters), len(count)]
                for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    if lo < hi:
                        piece = Transducer.of_windows(vocab, [c[lo:hi] for c in columns], count[lo:hi])
                        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([piece.pack()], pa.binary())],
                                                         names=_PIECE.names)
    return run


def _range_counts(least: int):
    """Sums the pieces of each range; emits the phrases that occur ``least`` times and those at the range's ends."""
    def frequent(t: Transducer) -> Iterator[pa.RecordBatch]:
        for level, (label, _, weight) in enumerate(t.levels):
            keep = np.ones(len(label), bool) if level == 0 else weight >= least
            edge = np.zeros(len(label), bool)
            edge[:1] = edge[-1:] = True
            if level == 0:
                edge[:] = True  # a language's words
            states = np.flatnonzero(keep | edge)
            for at in range(0, len(states), 50_000):
                part = states[at: at + 50_000]
                path = [c.cast(pa.large_string()).cast(pa.string()) for c in t.path(level, part)]
                path += [pa.nulls(len(part), pa.string())] * (len(_PATH) - len(path))
                yield pa.RecordBatch.from_arrays(
                    [*path, pa.array(np.full(len(part), level, np.int32)), pa.array(weight[part]), pa.array(edge[part])],
                    names=_COUNT.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, []
        for batch in batches:
            for k, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if held and k != here:
                    yield from frequent(union(held))
                    held = []
                here = k
                held.append(Transducer.unpack(packed.as_py()))
                if len(held) > 1 and sum(t.states for t in held) > max(HELD_STATES, 2 * held[0].states):
                    held = [union(held)]
        if held:
            yield from frequent(union(held))
    return run


def phrase_counts(docs: DataFrame, least: int, *, text_col: str = "text", lang_col: str = "lang",
                  shard_bytes: int = SHARD_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(lang, w1 to w4, words, a) of all phrases of 1 to 4 words that occur ``least`` times or more, as a written
    table; the rows with ``words`` = 0 hold each language's number of words."""
    docs = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANG)).alias("lang"),
                       F.col(f"`{text_col}`").alias("text")).where("text <> ''")
    size = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    ranges = max(1, -(-(size.b or 0) // range_bytes))
    splitters = _splitters(docs, ranges, size.n, size.b or 0)
    pieces = docs.mapInArrow(_shard_pieces(splitters, shard_bytes), _PIECE)
    counts = cut(pieces.repartition(ranges, "range").sortWithinPartitions("range")
                 .mapInArrow(_range_counts(least), _COUNT), "phrase-counts")
    ends = (counts.where("edge").groupBy(*_PATH, "words").agg(F.sum("a").alias("a"))
            .where((F.col("a") >= least) | (F.col("words") == 0)))
    return cut(counts.where("NOT edge").drop("edge").unionByName(ends), "phrases")


def _composed(schema: T.StructType, name: str):
    """Reads buckets in order, each one's frequent phrases before its lookups."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, automaton = None, [], None
        for batch in batches:
            bucket, kind = np.asarray(batch.column("bucket")), np.asarray(batch.column("kind"))
            edge = np.flatnonzero((np.diff(bucket) != 0) | (np.diff(kind) != 0)) + 1
            edge = [0, *edge.tolist(), batch.num_rows]
            for lo, hi in zip(edge[:-1], edge[1:], strict=True):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                if bucket[lo] != here:
                    here, held, automaton = bucket[lo], [], None
                if kind[lo] == 0:
                    held.append(part)
                    continue
                if automaton is None:
                    automaton = _of_phrases(held)
                    held = []
                words = [part.column(c).cast(pa.large_binary()) for c in _PATH]
                size = 1 + np.asarray(part.column("n_part")).astype(np.int64)
                found = pa.array(automaton.weights_of(words, size))
                yield pa.RecordBatch.from_arrays([found if f == name else part.column(f) for f in schema.names],
                                                 names=schema.names)
    return run


def _of_phrases(parts: list[pa.RecordBatch]) -> Transducer:
    """The transducer of phrases with their counts at the paths' ends (0 at states that are none's end)."""
    paths = [pa.concat_arrays([p.column(c).cast(pa.large_binary()) for p in parts]) for c in _PATH]
    count = np.concatenate([np.asarray(p.column("a")) for p in parts])
    vocab, place = _ranked(pc.fill_null(pa.concat_arrays(paths), b""))
    n = len(count)
    columns = [np.where(np.asarray(c.is_valid()), place[k * n:(k + 1) * n] + 1, 0) for k, c in enumerate(paths)]
    order = np.lexsort(columns[::-1])
    columns, count = [c[order] for c in columns], count[order]
    t = Transducer.of_windows(vocab, columns, count)
    # a state's own weight is that of the phrase which ends there, and that one comes first among its paths
    depth = sum((c > 0).astype(np.int64) for c in columns)
    new, levels = np.zeros(n, bool), []
    new[:1] = True
    for k, (column, level) in enumerate(zip(columns, t.levels, strict=True)):
        new[1:] |= column[1:] != column[:-1]
        starts = np.flatnonzero(new)
        starts = starts[column[starts] > 0]
        levels.append((level[0], level[1], np.where(depth[starts] == k + 1, count[starts], 0)))
    return Transducer(vocab, levels)


def look_up(asked: DataFrame, counts: DataFrame, buckets: int, name: str = "f") -> DataFrame:
    """``asked`` with ``name``: how often the phrase of ``n_part`` words in w1 to w4 occurs. Lookups of one phrase are
    dealt over ``SHARES`` tasks, so one that very many candidates share fills none of them alone."""
    home = F.pmod(F.xxhash64(*_PATH), F.lit(buckets)) * SHARES
    rest = [c for c in asked.columns if c not in _PATH]
    share = F.pmod(F.xxhash64(*rest), F.lit(SHARES))
    asked_rows = asked.select((home + share).alias("bucket"), F.lit(1).alias("kind"), *_PATH, *rest)
    known = counts.where("words > 0").select(home.alias("home"), *_PATH, "a").withColumn(
        "share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    known = known.select((F.col("home") + F.col("share")).alias("bucket"), F.lit(0).alias("kind"), *_PATH, "a")
    both = known.unionByName(asked_rows, allowMissingColumns=True)
    schema = T.StructType([*asked.schema.fields, T.StructField(name, T.LongType())])
    return (both.repartition(buckets * SHARES, "bucket").sortWithinPartitions("bucket", "kind")
            .mapInArrow(_composed(schema, name), schema))


def _parts(candidates: DataFrame) -> DataFrame:
    """Both parts of every cut of every candidate: (lang, w1 to w4, n_part) with the candidate, the cut and the side."""
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    words = F.array(*_WORDS)
    first = cuts.select("lang", *(F.when(F.col("k") > i, F.col(w)).alias(w) for i, w in enumerate(_WORDS)),
                        F.col("k").alias("n_part"), "phrase", "a", "k", F.lit(True).alias("first"))
    rest = cuts.select("lang", *(F.get(words, F.col("k") + i).alias(w) for i, w in enumerate(_WORDS)),
                       (F.col("words") - F.col("k")).alias("n_part"), "phrase", "a", "k", F.lit(False).alias("first"))
    return first.unionByName(rest)


def _inner(longer: DataFrame) -> DataFrame:
    """Every run of 2 or more words inside candidates of 3 or 4, with the candidate's count."""
    def joined(i: int, j: int):
        return F.when(F.col("words") >= j, F.concat_ws(" ", *_WORDS[i:j]))
    runs = [(i, j) for m in range(2, LONGEST) for i in range(LONGEST - m + 1) for j in (i + m,)]
    runs = F.array(*(F.when(F.col("words") > j - i, joined(i, j)) for i, j in runs))
    return longer.select("lang", F.explode(runs).alias("phrase"), F.col("a").alias("around")).where("phrase IS NOT NULL")


def mine(docs: DataFrame, *, least: int = 30, covered: int = 80, factor: int = 2_000_000, top: int = 2000,
         text_col: str = "text", lang_col: str = "lang", **sizes) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's ``top`` collocations.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends,
    these into words at spaces and tabs. A candidate has 2 to 4 words and
    occurs ``a >= least`` times; cut after its first k words, its parts occur
    ``l`` and ``r`` times, and it scores ``floor(factor * a / (l + r))``. The
    lowest-scoring cut counts, of equal ones the shortest first part. A
    candidate goes if a longer one holds its words and occurs ``covered`` per
    cent as often. ``n`` is the language's number of words.
    """
    counts = phrase_counts(docs, least, text_col=text_col, lang_col=lang_col, **sizes)
    buckets = max(1, -(-counts.count() // BUCKET))
    candidates = counts.where("words > 1").withColumn("phrase", F.concat_ws(" ", *_WORDS))
    found = look_up(_parts(candidates), counts, buckets)
    ks = range(1, LONGEST)
    sides = [F.max(F.when((F.col("k") == k) & (F.col("first") == side), F.col("f"))).alias(f"{'l' if side else 'r'}{k}")
             for k in ks for side in (True, False)]
    scored = found.groupBy("lang", "phrase", "a").agg(*sides)
    cut_k = [F.when(F.col(f"l{k}").isNotNull(), F.struct(
        F.expr(f"CAST(a AS DECIMAL(20,0)) * {factor} DIV (CAST(l{k} AS DECIMAL(20,0)) + r{k})").alias("score"),
        F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in ks]
    scored = scored.select("lang", "phrase", "a", F.least(*cut_k).alias("s"))
    # the most frequent longer candidate around each phrase
    around = _inner(candidates.where("words > 2")).groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    wide = "DECIMAL(20,0)"
    own = scored.join(around, ["lang", "phrase"], "left").where(
        F.expr(f"around IS NULL OR 100 * CAST(around AS {wide}) < {covered} * CAST(a AS {wide})"))
    best = Window.partitionBy("lang").orderBy(F.desc("s.score"), F.desc("a"), F.asc("phrase"))
    ranked = own.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    total = counts.where("words = 0").select("lang", F.col("a").alias("n"))
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", F.col("s.l").alias("l"),
        F.col("s.r").alias("r"), "n", F.col("s.score").alias("score"))
