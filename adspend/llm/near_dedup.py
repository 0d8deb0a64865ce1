"""Near-dedup by a chosen-path set similarity join.

A document's set holds its distinct five-word shingles, as 64-bit hashes of the
words' bytes (all words, if fewer). Documents are linked where
100 * intersection >= ``percent`` * union, on whole sets.

1. Equal sets are one class; only a class's representative (its smallest
   identifier) goes on, so copies are never paired with each other. Classes are
   numbered, and the numbers stand for them in all that follows: two sets under
   one identifier are two vertices.
2. ``TREES`` independent trees branch every representative by the smallest of
   its shingles under the tree's hash; the chance that a linked pair shares no
   first node is (1 - similarity) ** TREES, below 3e-7 at 0.85. Nodes are
   counted, not collected; a node alone is done.
3. A node's pivot is its smallest identifier. All rows that share a node with a
   pivot form its group. A group of at most ``SMALL`` rows is compared
   exhaustively: 128 minwise values stand in for a set first, and pairs that
   could be similar enough are compared on whole sets, texts being fetched for
   those rows only. Rows already linked, directly or not, are not compared
   again, so a dense group costs its size, not its square.
4. Larger groups are dealt into chunks, each compared together with the pivot.
   That joins the bulk of a large group of near copies. What then stays apart
   is searched further: a group whose rows are all in one component is done; one
   of at most ``WHOLE`` rows is compared exhaustively, block by block; a larger
   one with a dominant component compares the others with it, by blocks, and
   goes on with the others alone; any other branches again, by ``WAYS`` minwise
   values of the level's own, so that a level misses a linked pair no more often
   than the trees do, until its nodes are small enough. A node whose branches
   would take as many comparisons as it takes itself (a passage that fills most
   of its documents), or that is still larger at ``DEPTH``, is compared by blocks
   all the same. Nothing is capped.
5. Components are found from the links by label propagation with pointer
   jumping, in tables.

Defined results: a row without words has an empty set and is linked with
nothing; neither is a row without an identifier, which stays. Rows that repeat
an identifier are judged each by its own text, and go or stay by it. Ties fall
to the smallest identifier. Identifiers may be of any type that can be ordered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import cut
from .words import NOT_SPACE, mix, slices, window_hashes

SHINGLE = 5
PERCENT = 85
TREES = 8
VALUES = 128             # minwise values kept of a set, 16 bits each
ROUGH = 32               # of them looked at first
SMALL = 256              # rows of a group that are compared in one go
SHINGLES = 4_000_000     # and shingles of a group, all its sets together
BLOCK = 1024             # rows of a block of a large group
WHOLE = 16 * BLOCK       # rows of a group that is compared without branching
DEPTH = 8                # of branching
WAYS = TREES             # branches of a row at each level; DEPTH levels have values of their own
_ROWS = 128              # documents whose minwise values are made at once

_rng = np.random.default_rng(20240229)  # fixed: tasks must agree on the hash functions
_TREE_A = _rng.integers(1, 2**63, TREES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE_A = _rng.integers(1, 2**31, VALUES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


# sets and sketches

def shingle_sets(column: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for words in slices(column, NOT_SPACE):
        h = words.hashes()
        w = window_hashes(h, size)
        for r in range(words.rows):
            a, b = int(words.ptr[r]), int(words.ptr[r + 1])
            if b - a >= size:
                yield np.unique(w[a: b - size + 1])
            elif b > a:
                yield window_hashes(h[a:b], b - a)
            else:
                yield np.zeros(0, dtype=np.uint64)


def _digest(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def _sketches(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Smallest shingle per tree (64 bits) and minwise values (16 bits) of non-empty sets."""
    trees = np.zeros((len(sets), TREES), dtype=np.uint64)
    values = np.zeros((len(sets), VALUES), dtype=np.uint32)
    for at in range(0, len(sets), _ROWS):
        part = sets[at: at + _ROWS]
        x = np.concatenate(part)
        start = np.concatenate(([0], np.cumsum([len(s) for s in part])[:-1]))
        for k, a in enumerate(_TREE_A):
            trees[at: at + len(part), k] = np.minimum.reduceat(mix(x * a) if k else x, start)
        low = (x >> np.uint64(32)).astype(np.uint32) ^ x.astype(np.uint32)
        for k, a in enumerate(_VALUE_A):
            h = low * a
            h ^= h >> np.uint32(15)
            values[at: at + len(part), k] = np.minimum.reduceat(h, start)
    return trees, (values ^ (values >> np.uint32(16))).astype("<u2")


_SKETCH = [T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()),
           T.StructField("trees", T.ArrayType(T.LongType())), T.StructField("sketch", T.BinaryType())]


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            batch = whole.slice(at, 1024)
            sets = list(shingle_sets(batch.column(1)))
            full = [k for k, s in enumerate(sets) if len(s)]
            trees, values = [None] * len(sets), [None] * len(sets)
            if full:
                t, v = _sketches([sets[k] for k in full])
                for j, k in enumerate(full):
                    trees[k], values[k] = t[j].view(np.int64), v[j].tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_digest(s) for s in sets], pa.binary()),
                 pa.array(trees, pa.list_(pa.int64())), pa.array(values, pa.binary())],
                names=["id", "n", "digest", "trees", "sketch"])


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(_sketch_batches, T.StructType([T.StructField("id", rows.schema["id"].dataType), *_SKETCH]))


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _small(batches):
        digests = pa.array([_digest(s) for s in shingle_sets(batch.column("_text"))], pa.binary())
        rest = [c for c in batch.schema.names if c != "_text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), digests], names=[*rest, "_digest"])


# comparing groups

def _alike(sketch: np.ndarray, n: np.ndarray, label: np.ndarray, side: np.ndarray, percent: int
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a group's rows that may be similar enough and are not yet joined, and their agreement.

    Pairs on one side of a pair of blocks (1 or 2) are left to other blocks.
    """
    s = percent / 100
    least = s * VALUES - 4 * (VALUES * s * (1 - s)) ** 0.5
    rough = s * ROUGH - 5 * (ROUGH * s * (1 - s)) ** 0.5  # a quarter of the values turns most pairs away
    begin = np.ascontiguousarray(sketch[:, :ROUGH])
    left, right, agreed = [], [], []
    for i in range(len(n) - 1):
        j = np.arange(i + 1, len(n))
        fits = (label[j] != label[i]) & (np.minimum(n[j], n[i]) * 100 >= percent * np.maximum(n[j], n[i]))
        fits &= (side[j] == 0) | (side[j] != side[i])
        j = j[fits]
        if len(j):
            j = j[(begin[j] == begin[i]).sum(axis=1) >= rough]
        if len(j):
            same = (sketch[j] == sketch[i]).sum(axis=1)
            ok = same >= least
            if ok.any():
                left.append(np.full(int(ok.sum()), i))
                right.append(j[ok])
                agreed.append(same[ok])
    if not left:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    return np.concatenate(left), np.concatenate(right), np.concatenate(agreed)


_GROUP = [T.StructField("group", T.LongType()), T.StructField("side", T.IntegerType()), T.StructField("id", T.LongType()),
          T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()),
          T.StructField("sketch", T.BinaryType()), T.StructField("label", T.LongType())]
_GROUP_NAMES = [f.name for f in _GROUP]


def _by_group(batches: Iterator[pa.RecordBatch], rows_of) -> Iterator[list[tuple]]:
    """The rows of one group after the other; batches are sorted by the first column."""
    current, held = None, []
    for batch in batches:
        for row in rows_of(batch):
            if held and row[0] != current:
                yield held
                held = []
            current = row[0]
            held.append(row)
    if held:
        yield held


def _arrays(rows: list[tuple]) -> tuple[np.ndarray, ...]:
    return (np.stack([np.frombuffer(r[5], "<u2") for r in rows]), np.array([r[3] for r in rows]),
            np.array([r[6] for r in rows]), np.array([r[1] for r in rows]))


def _candidates(percent: int):
    """The rows of each group that may have a partner; groups are renamed by what they hold."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]

        def made():
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                              names=_GROUP_NAMES)

        for rows in _by_group(batches, lambda b: zip(*(c.to_pylist() for c in b.columns), strict=True)):
            if len(rows) < 2:
                continue
            sketch, n, label, side = _arrays(rows)
            i, j, _ = _alike(sketch, n, label, side, percent)
            chosen = [rows[k] for k in np.unique(np.concatenate([i, j]))]
            if chosen:
                # the same rows found by several trees are one group
                key = hashlib.blake2b(digest_size=8)
                for r in sorted(chosen, key=lambda r: (r[4], r[1])):
                    key.update(r[4] + bytes([r[1]]))
                name = int.from_bytes(key.digest(), "little", signed=True)
                out.extend((name, *r[1:]) for r in chosen)
            if len(out) >= 4096:
                yield made()
        if out:
            yield made()
    return find


def _verify(percent: int):
    """Links within each group, on whole sets; one link at most between two parts that grow together."""
    def rows_of(batch: pa.RecordBatch):
        for *row, shingles in zip(*(batch.column(k).to_pylist() for k in range(7)), shingle_sets(batch.column(7)),
                                  strict=True):
            if _digest(shingles) == row[4]:  # else a row of another text under the same identifier
                yield *row, shingles

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _by_group(_small(batches), rows_of):
            rows = list({r[4]: r for r in found}.values())
            if len(rows) < 2:
                continue
            sketch, n, label, side = _arrays(rows)
            i, j, agreed = _alike(sketch, n, label, side, percent)
            part = {x: x for x in label.tolist()}

            def root(x, part=part):
                while part[x] != x:
                    part[x] = x = part[part[x]]
                return x

            links = []
            for k in np.argsort(-agreed, kind="stable"):
                a, b = rows[i[k]], rows[j[k]]
                x, y = root(a[6]), root(b[6])
                if x == y:
                    continue
                both = len(np.intersect1d(a[7], b[7], assume_unique=True))
                if 100 * both >= percent * (len(a[7]) + len(b[7]) - both):
                    links.append((a[2], b[2]))
                    part[max(x, y)] = min(x, y)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links, strict=True)],
                                                 names=["a", "b"])
    return verify


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield batch.slice(at, 256)


def _near(groups: DataFrame, percent: int) -> DataFrame:
    """The rows of ``groups`` that may have a partner in their group, as a written table."""
    rows = groups.select(*_GROUP_NAMES).repartition("group").sortWithinPartitions("group", "side", "id")
    near = rows.mapInArrow(_candidates(percent), T.StructType(_GROUP)).dropDuplicates(["group", "side", "id", "digest"])
    return cut(near, "near-candidates")


def _links(near: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """a, b: links between the rows of each group of ``near``."""
    rows = near.join(texts, "id").select(*_GROUP_NAMES, "text")
    rows = rows.repartition("group").sortWithinPartitions("group", "side", "id")
    return cut(rows.mapInArrow(_verify(percent), "a bigint, b bigint"), "near-links")


def components(links: DataFrame) -> DataFrame:
    """v, label: the smallest vertex that can be reached, for every vertex of a link."""
    sides = links.where("a <> b").select("a", "b").unionByName(links.where("a <> b").select(
        F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    sides = cut(sides, "near-sides")
    labels = cut(sides.groupBy(F.col("a").alias("v")).agg(F.least(F.col("v"), F.min("b")).alias("label")), "near-labels")
    while True:
        near = sides.join(labels.withColumnRenamed("v", "b"), "b").groupBy(F.col("a").alias("v")).agg(
            F.min("label").alias("near"))
        step = labels.join(near, "v").select("v", "label", F.least("label", "near").alias("to"))
        jump = labels.select(F.col("v").alias("to"), F.col("label").alias("far"))
        step = cut(step.join(jump, "to").select("v", F.col("far").alias("label"), (F.col("far") != F.col("label")).alias(
            "moved")), "near-labels")
        labels = step.select("v", "label")
        if step.where("moved").isEmpty():
            return labels


# the join

def _node(*parts: Column) -> Column:
    return F.xxhash64(*parts)


def _value(place: Column) -> Column:
    return F.substring(F.col("sketch"), place * 2 + 1, F.lit(2))


def _chunk(ids: Column, chunks: Column) -> Column:
    return F.pmod(F.xxhash64(ids, F.lit(7)), chunks)


def _first_nodes(reps: DataFrame) -> DataFrame:
    """node, id, n, pivot: the first node of each tree, where more than one row is in it."""
    rows = reps.select("id", "n", F.posexplode("trees").alias("tree", "token"))
    rows = rows.select(_node("tree", "token").alias("node"), "id", "n")
    sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("rows"), F.min("id").alias("pivot")).where("rows > 1")
    return rows.join(sizes.select("node", "pivot"), "node").select("node", "id", "n", "pivot")


def _blocks(rows: DataFrame, left: Column, right: Column, count: Column, block: int) -> DataFrame:
    """Every left row with every right row of a node, in groups of a block of each.

    ``count`` is the node's number of blocks. A row on both sides meets each
    other block, and its own, once.
    """
    own = _chunk(F.col("id"), count).cast("int")
    every = F.sequence(F.lit(0), count - 1)
    both = left & right

    def place(side, low, high):
        return F.struct(F.lit(side).alias("side"), low.alias("l"), high.alias("r"))

    # both: block pairs (l, r) with l <= r, its own pair as one side; else left blocks by right blocks
    one = F.transform(every, lambda k: F.struct(
        F.when(k == own, 0).when(own < k, 1).otherwise(2).alias("side"), F.least(own, k).alias("l"),
        F.greatest(own, k).alias("r")))
    of = F.when(both, one).when(left, F.transform(every, lambda k: place(1, own, k))).when(
        right, F.transform(every, lambda k: place(2, k, own)))
    out = rows.withColumn("p", F.explode(of))
    return out.select(_node(F.col("node"), F.lit(-1), F.col("p.l"), F.col("p.r")).alias("group"),
                      F.col("p.side").alias("side"), "id", "n", "digest", "sketch", "label")


def _search_large(rows: DataFrame, whole: int, block: int, depth: int) -> list[DataFrame]:
    """Groups to compare for the rows (node, id, n, digest, sketch, label) of large groups."""
    groups: list[DataFrame] = []
    for level in range(depth + 1):
        by_label = rows.groupBy("node", "label").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
        stats = by_label.groupBy("node").agg(F.sum("c").alias("rows"), F.sum("s").alias("all_n"),
                                             F.count(F.lit(1)).alias("labels"), F.max("c").alias("most"))
        first = by_label.join(stats, "node").where("c = most").groupBy("node").agg(F.min("label").alias("main"))
        stats = stats.join(first, "node").where("labels > 1")  # else the node is one component already
        place = F.pmod(F.lit(level * WAYS) + F.col("j"), F.lit(VALUES)).cast("int")
        child = F.when(F.col("j") < 0, _node(F.col("node"), F.lit(-2))).otherwise(
            _node(F.col("node"), F.col("j"), _value(place)))
        ways = F.array(*(F.lit(j) for j in range(WAYS)))
        # comparisons of a node's branches, to be set against its own
        wide = stats.where((F.col("rows") > whole) & (F.col("most") * 2 < F.col("rows"))).select("node")
        work = rows.join(wide, "node", "left_semi").withColumn("j", F.explode(ways)).groupBy(
            "node", child.alias("child")).agg(F.count(F.lit(1)).cast("double").alias("c")).groupBy("node").agg(
            F.sum(F.col("c") * F.col("c")).alias("work"))
        if level < depth:
            stats = stats.join(work, "node", "left")
        else:
            stats = stats.withColumn("work", F.lit(None).cast("double"))
        kind = F.when((F.col("rows") <= whole) | F.lit(level == depth), "blocks").when(
            F.col("most") * 2 >= F.col("rows"), "ruled").when(
            F.col("work") < F.col("rows").cast("double") * F.col("rows"), "branch").otherwise("blocks")
        count = F.greatest(F.ceil(F.col("rows") / block), F.ceil(F.col("all_n") / SHINGLES), F.lit(1)).cast("int")
        rows = cut(rows.join(stats.select("node", "main", kind.alias("kind"), count.alias("count")), "node"), "near-nodes")
        main, every, count = F.col("label") == F.col("main"), F.lit(True), F.col("count")
        groups.append(_blocks(rows.where("kind = 'blocks'"), every, every, count, block))
        ruled = rows.where("kind = 'ruled'")
        groups.append(_blocks(ruled, ~main, main, count, block))
        more = rows.where("kind <> 'blocks'").where(~main | (F.col("kind") == "branch"))
        if level == depth or more.isEmpty():
            break
        ways = F.when(F.col("kind") == "ruled", F.array(F.lit(-1))).otherwise(ways)
        rows = more.withColumn("j", F.explode(ways)).withColumn("node", child).select(
            "node", "id", "n", "digest", "sketch", "label")
    return groups


def _numbered(named: DataFrame) -> DataFrame:
    """One row per set: a number ``id``, the smallest identifier ``first`` that has it, its size and sketch. Written
    once, so that numbers stay."""
    reps = named.groupBy("digest").agg(F.min("id").alias("first"), F.first("n").alias("n"), F.first("trees").alias("trees"),
                                       F.first("sketch").alias("sketch"))
    return cut(reps.select(F.monotonically_increasing_id().alias("id"), "*"), "near-classes")


def _classified(docs: DataFrame, id_col: str, text_col: str, percent: int, small: int, whole: int, block: int,
                depth: int) -> DataFrame:
    """id, n, digest and component_id of every row."""
    texts = docs.select(F.col(f"`{id_col}`").alias("first"), F.col(f"`{text_col}`").alias("text"))
    rows = cut(sketches(docs, id_col, text_col), "near-sketches")
    reps = _numbered(rows.where("digest IS NOT NULL AND id IS NOT NULL"))
    held = reps.select("id", "digest", "sketch")
    # groups: all rows that share a node with a pivot, in chunks that each hold the pivot too
    pairs = cut(_first_nodes(reps).select("pivot", "id", "n").distinct(), "near-pairs")
    sizes = pairs.groupBy("pivot").agg(F.greatest(F.ceil(F.count(F.lit(1)) / small), F.ceil(F.sum("n") / SHINGLES)
                                                  ).cast("int").alias("chunks"))
    sizes = cut(sizes, "near-pivots")
    pivot = F.col("id") == F.col("pivot")
    of = F.when(pivot, F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(
        F.array(_chunk(F.col("id"), F.col("chunks")).cast("int")))
    groups = pairs.join(sizes, "pivot").withColumn("chunk", F.explode(of)).select(
        _node("pivot", "chunk").alias("group"), "id", "n")
    groups = groups.join(held, "id").select("group", F.lit(0).alias("side"), "id", "n", "digest", "sketch",
                                            F.col("id").alias("label"))
    near = _near(groups, percent)
    large = sizes.where("chunks > 1").select("pivot")
    some = pairs.join(large, "pivot", "left_semi")
    # whole texts are moved once, and only those of rows that may be compared are kept; the identifiers
    # grow with the documents, so this is a shuffled join at every size. Other texts of the same identifier
    # come along and are told apart by their digests.
    wanted = near.select("id").unionByName(some.select("id")).distinct()
    wanted = reps.select("id", "first").join(wanted, "id", "left_semi").hint("merge")
    texts = cut(texts.join(wanted, "first").select("id", "text"), "near-texts")
    links = _links(near, texts, percent)
    if not large.isEmpty():
        known = components(links).withColumnRenamed("v", "id")
        some = some.select(_node("pivot", F.lit(-3)).alias("node"), "id", "n").join(held, "id").join(
            known, "id", "left").withColumn("label", F.coalesce("label", "id"))
        found = _search_large(some, whole, block, depth)
        more = found[0]
        for g in found[1:]:
            more = more.unionByName(g)
        links = links.unionByName(_links(_near(more, percent), texts, percent))
    # only classes with links have a label
    labels = components(links).join(reps.select(F.col("id").alias("v"), "first"), "v")
    best = labels.groupBy("label").agg(F.min("first").alias("best"))
    linked = labels.join(best, "label").select("v", "best")
    classes = reps.select("digest", "first", F.col("id").alias("v")).join(linked, "v", "left").select(
        "digest", F.coalesce("best", "first").alias("component_id"))
    out = rows.select("id", "n", "digest").join(classes, "digest", "left")
    return out.withColumn("component_id", F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")))


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                 small: int = SMALL, whole: int = WHOLE, block: int = BLOCK, depth: int = DEPTH) -> DataFrame:
    """One row per document: the identifier, n_shingles, component_id and kept."""
    out = _classified(docs, id_col, text_col, percent, small, whole, block, depth)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                      F.col("component_id").eqNullSafe(F.col("id")).alias("kept"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
               small: int = SMALL, whole: int = WHOLE, block: int = BLOCK, depth: int = DEPTH) -> DataFrame:
    """``docs`` without the rows that another document of their class stands for; the same columns.

    A row goes by its identifier and its set. Where all rows of an identifier
    go, as nearly always, the identifier decides; sets are made again only for
    rows whose identifier has one text that goes and one that stays.
    """
    rows = _classified(docs, id_col, text_col, percent, small, whole, block, depth)
    rows = rows.where("id IS NOT NULL").select("id", "digest", (F.col("component_id") == F.col("id")).alias("stays"))
    gone = cut(rows.where("NOT stays").select("id", "digest").distinct(), "near-gone")
    both = cut(rows.where("stays").join(gone.select("id").distinct(), "id", "left_semi").select("id").distinct(), "near-both")
    own = F.col(f"`{id_col}`")
    left = docs.join(gone.select(F.col("id").alias("_gone")).distinct(), own == F.col("_gone"), "left_anti")
    if both.isEmpty():
        return left
    kinds = docs.schema
    mixed = docs.join(both.select(F.col("id").alias("_both")), own == F.col("_both"), "left_semi")
    named = mixed.select(*(F.col(f"`{c}`").alias(f"_c{k}") for k, c in enumerate(docs.columns)), F.col(f"`{text_col}`").alias("_text"))
    out = T.StructType([*named.drop("_text").schema.fields, T.StructField("_digest", T.BinaryType())])
    named = named.mapInArrow(_digest_batches, out)
    go = gone.select(F.col("id").alias("_gone"), F.col("digest").alias("_set"))
    stay = named.join(go, (F.col(f"_c{docs.columns.index(id_col)}") == F.col("_gone")) & (F.col("_digest") == F.col("_set")),
                      "left_anti")
    return left.union(stay.select(*(F.col(f"_c{k}").cast(f.dataType).alias(f.name) for k, f in enumerate(kinds.fields))))
