"""Embedding near-duplicates by sorted projection passes.

Each pass gives every vector a key of concatenated random-hyperplane bits, sorts the vectors of a label
by it and compares each with the ``window`` vectors before it. Links found by any pass are united. The
links of one component are then completed: all its pairs are compared exactly, block by block, so
that ``n_links`` counts every link between vectors of a component.

The passes carry vectors rounded to one byte a number with the norm of the rounding error. That error
bounds the true cosine from both sides: pairs surely above the threshold link, pairs surely below do
not, and the few between are decided on the full vectors.

Copies (equal label and embedding) are one vector with a count throughout. Vectors that are null,
zero, or hold null or non-finite numbers, and vectors without a label, link with nothing; vectors of
different lengths never link. A null id takes part; the least id ignores it.

Two vectors agree on a hyperplane bit with chance ``p = 1 - angle / pi``, and sorted neighbours among N
spread vectors share about ``log2(N / window)`` bits. A group therefore takes as many passes as leave a
pair at the threshold unseen with chance ``MISS``, whatever its size (``passes_for``); ``PASSES`` of them
are sorted at a time, so a large group costs more rounds, not larger ones.

A link between two dense groups can stand among thousands of pairs that only just miss the threshold, where no
order of the vectors makes it stand out. Windows therefore also report near misses (``NEAR`` below the threshold) of
vectors that have links. Components that a near miss joins are then compared in full, in blocks (``_bridges``): a
component meets all vectors of its smaller neighbours at once. Two unlinked vectors need none of this; the window
has compared them.

What windows can miss is measured by the tests (recall against brute force). Completing a component
compares all its pairs: its cost grows with the square of a component's distinct vectors, spread over
blocks of ``BLOCK``; copies add nothing to it.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centroidal.llm.components import components
from centroidal.llm.frames import dropped, map_batches, written

THRESHOLD = 0.93
PASSES, WINDOW, BITS = 6, 32, 62
MISS = 0.01
NEAR = 0.1
BLOCK = 1024
SEED = 20


@cache
def _planes(dim: int, k: int) -> np.ndarray:
    return np.random.default_rng(SEED + k).standard_normal((dim, BITS))


def passes_for(rows: Column, threshold: float = THRESHOLD, least: int = PASSES, window: int = WINDOW,
               miss: float = MISS) -> Column:
    """Passes for a group of so many spread vectors, ``least`` or more: a pair at the threshold stays out
    of every window with chance ``miss``."""
    same = max(0.5, 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi)
    met = F.pow(F.lit(same), F.greatest(F.lit(0.0), F.log2(rows / F.lit(window))))
    # a window that holds the whole group meets every pair in any pass
    more = F.when(met < 1, F.ceil(F.lit(math.log(miss)) / F.log1p(-met)).cast("int"))
    return F.greatest(F.lit(least), more)


def unit(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision and which rows are vectors at all; all rows of one length."""
    x = np.array([[np.nan if v is None else v for v in r] for r in rows], dtype=np.float64)
    top = np.abs(x).max(axis=1, initial=0.0)
    good = np.isfinite(top) & (top > 0)
    x = x[good] / top[good, None]
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True)), good


_ROW = "g long, pass int, h long, k long, v binary, scale double, err double"


def _pass_rows(start: int, stop: int):
    """Every vector once a pass from ``start`` up to ``stop`` or its own number of passes (the fourth
    column): its group, sort key, rounded form and rounding error."""
    def fn(b: pa.RecordBatch) -> pa.RecordBatch:
        g, k = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        rows = b.column(2).to_pylist()
        own = b.column(3).to_numpy(zero_copy_only=False)
        lengths = np.array([len(r) for r in rows])
        out: list[list] = [[] for _ in range(7)]
        for dim in np.unique(lengths):
            at = np.flatnonzero(lengths == dim)
            x, good = unit([rows[i] for i in at])
            at = at[good]
            scale = np.abs(x).max(axis=1) / 127
            v = np.rint(x / scale[:, None]).astype(np.int8)
            err = np.sqrt(((x - v * scale[:, None]) ** 2).sum(axis=1))
            blobs = [r.tobytes() for r in v]
            for p in range(start, stop):
                in_pass = np.flatnonzero(own[at] > p)
                bits = x[in_pass] @ _planes(int(dim), p) > 0
                h = (bits * (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))).sum(axis=1)
                for col, values in zip(out, (g[at][in_pass], np.full(len(in_pass), p), h, k[at][in_pass], [blobs[i] for i in in_pass],
                                             scale[in_pass], err[in_pass])):
                    col.append(values)
        cols = [sum(map(list, c), []) if i == 4 else np.concatenate(c) if c else [] for i, c in enumerate(out)]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                          names=["g", "pass", "h", "k", "v", "scale", "err"])
    return fn


def _window_links(g, p, k, v, scale, err, window: int, first: int, threshold: float):
    """Links among sorted rows, each from ``first`` on with up to ``window`` rows before it: the sure ones, those to
    be decided, and near misses. Sure links that earlier ones of these rows already connect are left out, and so are
    near misses between rows without links and all but one between the same two trees of links."""
    n = len(k)
    x = v.astype(np.float32) * scale[:, None].astype(np.float32)
    sure_at, open_pairs, near = [], [], []
    parent = np.arange(n)
    for d in range(1, min(window, n - 1) + 1):
        i = np.arange(max(d, first), n)
        i = i[(g[i] == g[i - d]) & (p[i] == p[i - d])]
        if not len(i):
            continue
        dots = np.einsum("ij,ij->i", x[i], x[i - d]).astype(np.float64)
        slack = err[i] + err[i - d] + 1e-5  # |x.y - x'.y'| <= |x - x'| + |y - y'| for |x| = |y| = 1, |x'| <= 1 + err
        slack = slack + err[i] * err[i - d]
        sure = dots - slack >= threshold
        between = ~sure & (dots + slack >= threshold)
        s = i[sure]
        sure_at.append(np.stack([s, s - d], axis=1))
        new = s[parent[s] == s]
        parent[new] = new - d
        open_pairs.append(np.stack([i[between], i[between] - d], axis=1))
        close = ~sure & ~between & (dots >= threshold - NEAR)
        near.append(np.stack([i[close], i[close] - d], axis=1))
    if not sure_at:
        return (np.zeros((0, 2), np.int64),) * 3
    tree = np.flatnonzero(parent != np.arange(n))
    pairs = [np.stack([tree, parent[tree]], axis=1)]
    root = parent
    while (up := root[root]).tolist() != root.tolist():
        root = up
    rest = np.concatenate(sure_at)
    rest = rest[root[rest[:, 0]] != root[rest[:, 1]]]
    # one link for each pair of trees is enough
    _, once = np.unique(np.stack([root[rest[:, 0]], root[rest[:, 1]]], axis=1), axis=0, return_index=True)
    pairs.append(rest[once])
    linked = np.bincount(root, minlength=n)[root] > 1
    near = np.concatenate(near)
    near = near[(root[near[:, 0]] != root[near[:, 1]]) & (linked[near[:, 0]] | linked[near[:, 1]])]
    _, once = np.unique(np.stack([root[near[:, 0]], root[near[:, 1]]], axis=1), axis=0, return_index=True)
    return k[np.concatenate(pairs)], k[np.concatenate(open_pairs)], k[near[once]]


def _arrays(b) -> list[np.ndarray]:
    v = [np.frombuffer(x, np.int8) for x in b.column("v").to_pylist()]
    return [*(b.column(c).to_numpy(zero_copy_only=False) if isinstance(b, pa.RecordBatch) else b.column(c).to_numpy()
              for c in ("g", "pass", "k")), v, *(
                  b.column(c).to_numpy(zero_copy_only=False) if isinstance(b, pa.RecordBatch) else b.column(c).to_numpy()
                  for c in ("scale", "err"))]


def _links_of(cols, window, first, threshold):
    """Window links of rows whose vectors may differ in length (never within one group)."""
    g, p, k, v, scale, err = cols
    found = tuple([np.zeros((0, 2), np.int64)] for _ in range(3))
    width = np.array([len(x) for x in v])
    for a, b in zip(*(lambda e: (e[:-1], e[1:]))(np.concatenate([[0], np.flatnonzero(np.diff(width)) + 1, [len(v)]]))):
        if b - a > 1:
            for kind, pairs in zip(found, _window_links(g[a:b], p[a:b], k[a:b], np.stack(v[a:b]), scale[a:b], err[a:b], window,
                                                        max(0, first - a), threshold)):
                kind.append(pairs)
    return tuple(np.concatenate(kind) for kind in found)


#: Kinds of rows that the passes give: links, pairs to be decided on the full vectors, near misses; and, for the next
#: partition, the tail of a partition and the head of the one after.
SURE, OPEN, CLOSE, TAIL, HEAD = range(5)
_LINK = f"kind int, a long, b long, part long, {_ROW}"


def _pass_links(rows: DataFrame, window: int, threshold: float) -> DataFrame:
    """``kind, a, b`` of all passes. Rows that neighbouring partitions must compare come along first, as TAIL of
    partition ``part`` and HEAD of ``part + 1``. Written; nothing is read from its own tables afterwards."""
    ordered = rows.repartitionByRange("g", "pass", "h", "k").sortWithinPartitions("g", "pass", "h", "k") \
        .select(F.spark_partition_id().cast("long").alias("part"), "*")
    names = ["kind", "a", "b", "part", "g", "pass", "h", "k", "v", "scale", "err"]
    schema = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("part", pa.int64()), ("g", pa.int64()),
                        ("pass", pa.int32()), ("h", pa.int64()), ("k", pa.int64()), ("v", pa.binary()),
                        ("scale", pa.float64()), ("err", pa.float64())])

    def link_batch(kind: int, pairs: np.ndarray) -> pa.RecordBatch:
        n = len(pairs)
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind), pa.int32()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1]),
                                           *(pa.nulls(n, f.type) for f in list(schema)[3:])], names=names)

    def edge_batch(kind: int, part, t: pa.Table) -> list[pa.RecordBatch]:
        n = len(t)
        t = t.combine_chunks()
        return pa.table([pa.array(np.full(n, kind), pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
                         pa.array(np.full(n, part), pa.int64()), *t.select(["g", "pass", "h", "k", "v", "scale", "err"]).columns],
                        schema=schema).to_batches()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, head, part = None, None, None
        for b in batches:
            if not b.num_rows:
                continue
            part = b.column(0)[0].as_py()
            t = pa.Table.from_batches([b]).drop_columns(["part"])
            first = 0 if kept is None else len(kept)
            t = t if kept is None else pa.concat_tables([kept, t])
            if head is None:
                head = t.slice(0, window)
            elif len(head) < window:
                head = pa.concat_tables([head, t.slice(first, window - len(head))])
            for kind, pairs in enumerate(_links_of(_arrays(t), window, first, threshold)):
                yield link_batch(kind, pairs)
            kept = t.slice(max(0, len(t) - window))
        if kept is not None:
            yield from edge_batch(TAIL, part, kept)
            yield from edge_batch(HEAD, part - 1, head)

    found = written(rows.sparkSession, ordered.mapInArrow(run, _LINK), "pass-links")

    def across(group: pa.Table) -> pa.Table:
        order = np.lexsort([group.column(c).to_numpy() for c in ("k", "h", "pass", "g", "kind")])
        group = group.take(pa.array(order))
        tail = int((group.column("kind").to_numpy() == TAIL).sum())
        kinds = _links_of(_arrays(group), window, tail, threshold) if 0 < tail < len(group) else (np.zeros((0, 2), np.int64),) * 3
        pairs = np.concatenate(kinds)
        return pa.table({"kind": pa.array(np.repeat([SURE, OPEN, CLOSE], [len(x) for x in kinds]), pa.int32()),
                         "a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})

    edges = found.filter(F.col("kind") >= TAIL).groupBy("part").applyInArrow(across, "kind int, a long, b long")
    links = written(rows.sparkSession, found.filter(F.col("kind") < TAIL).select("kind", "a", "b").unionByName(edges).distinct(), "window-links")
    dropped(found)
    return links


def _exact(links: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose cosine in double precision reaches the threshold."""
    def ok(b: pa.RecordBatch) -> pa.RecordBatch:
        x, y = b.column(2).to_pylist(), b.column(3).to_pylist()
        keep = [float(unit([p])[0][0] @ unit([q])[0][0]) >= threshold for p, q in zip(x, y)]
        return b.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    a = vectors.select(F.col("k").alias("a"), F.col("embedding").alias("x"))
    b = vectors.select(F.col("k").alias("b"), F.col("embedding").alias("y"))
    return map_batches(links.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "x", "y"), ok, "a long, b long")


def _bridges(near: DataFrame, linked: DataFrame, vectors: DataFrame, threshold: float, block: int) -> DataFrame:
    """``a, b``: links between components that near misses join, one at least for each vector that has any. ``linked``:
    ``k, root``; vectors without a link are components of their own. Of two components the larger one meets the
    vectors of the smaller, together with those of its other smaller neighbours, in blocks of both."""
    sizes = linked.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    ends = near.select("a", "b")
    for end in ("a", "b"):
        of = linked.select(F.col("k").alias(end), F.col("root").alias(f"root_{end}"))
        size = sizes.select(F.col("root").alias(f"root_{end}"), F.col("size").alias(f"size_{end}"))
        ends = ends.join(of, end, "left").withColumn(f"root_{end}", F.coalesce(f"root_{end}", end)) \
            .join(size, f"root_{end}", "left").withColumn(f"size_{end}", F.coalesce(f"size_{end}", F.lit(1)))
    first = F.struct("size_a", "root_a") > F.struct("size_b", "root_b")
    pairs = ends.filter("root_a <> root_b").select(
        F.when(first, F.col("root_a")).otherwise(F.col("root_b")).alias("big"),
        F.when(first, F.col("root_b")).otherwise(F.col("root_a")).alias("root"), F.greatest("size_a", "size_b").alias("size")).distinct()
    pairs = written(near.sparkSession, pairs.filter("size > 1"), "near-components")
    every = vectors.select("k", "embedding").join(linked, "k", "left").withColumn("root", F.coalesce("root", "k"))
    partners = pairs.join(every, "root").select("big", "k", "embedding")
    shape = pairs.groupBy("big").agg(F.ceil(F.max("size") / block).cast("int").alias("rows_in")) \
        .join(partners.groupBy("big").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("cols_in")), "big")

    def part(n: str) -> Column:
        return F.pmod(F.xxhash64("k", F.lit(SEED)), F.col(n)).cast("int")

    rows = every.join(shape, F.col("root") == F.col("big")).select(
        "big", "k", "embedding", part("rows_in").alias("i"), F.explode(F.sequence(F.lit(0), F.col("cols_in") - 1)).alias("j"), F.lit(0).alias("side"))
    cols = partners.join(shape, "big").select(
        "big", "k", "embedding", F.explode(F.sequence(F.lit(0), F.col("rows_in") - 1)).alias("i"), part("cols_in").alias("j"), F.lit(1).alias("side"))

    def meet(group: pa.Table) -> pa.Table:
        side, k = group.column("side").to_numpy(), group.column("k").to_numpy()
        out = [np.zeros((0, 2), np.int64)]
        if 0 < side.sum() < len(side):
            x, _ = unit(group.column("embedding").to_pylist())
            big, small = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            for s in range(0, len(small), block):
                c = small[s:s + block]
                hit = x[c] @ x[big].T >= threshold
                has = hit.any(axis=1)
                out.append(np.stack([k[c[has]], k[big[hit[has].argmax(axis=1)]]], axis=1))
        pairs = np.concatenate(out)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    return rows.unionByName(cols).repartition("big", "i", "j").groupBy("big", "i", "j").applyInArrow(meet, "a long, b long")


def _complete(members: DataFrame, threshold: float, block: int) -> DataFrame:
    """``k, linked``: for each distinct vector of a component the rows that it links to, its own copies
    left out. Blocks of a component meet pairwise; a group holds two blocks at most."""
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    m = members.join(sizes, "root").withColumn("blocks", F.ceil(F.col("size") / block).cast("int")) \
        .withColumn("own", F.pmod(F.xxhash64("k", F.lit(SEED)), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = m.select("root", "k", "copies", "embedding", F.col("own").alias("i"), other.alias("j"), F.lit(0).alias("side"))
    right = m.filter("blocks > 1").select("root", "k", "copies", "embedding", other.alias("i"), F.col("own").alias("j"), F.lit(1).alias("side"))

    def meet(group: pa.Table) -> pa.Table:
        side = group.column("side").to_numpy()
        k, copies = group.column("k").to_numpy(), group.column("copies").to_numpy()
        x, _ = unit(group.column("embedding").to_pylist())
        rows = np.flatnonzero(side == 0)
        cols = np.flatnonzero(side == 1) if (side == 1).any() else rows
        linked = np.zeros(len(rows), np.int64)
        for s in range(0, len(rows), block):
            r = rows[s:s + block]
            hit = (x[r] @ x[cols].T >= threshold) & (k[r][:, None] != k[cols][None, :])
            linked[s:s + block] = hit @ copies[cols]
        return pa.table({"k": pa.array(k[rows], pa.int64()), "linked": pa.array(linked)})

    # dealt by block: the rows come from a join on the root, whose partitioning a grouping by (root, i, j) would keep
    return left.unionByName(right).repartition("root", "i", "j").groupBy("root", "i", "j").applyInArrow(meet, "k long, linked long") \
        .groupBy("k").agg(F.sum("linked").alias("linked"))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, passes: int = PASSES, window: int = WINDOW, block: int = BLOCK,
                    miss: float = MISS) -> DataFrame:
    """``id, n_links, component_id`` for every row of ``vectors``: how many other rows it links to, and
    the least id that links reach, itself included. ``passes`` is the least number of passes of a group
    and the number sorted at a time; larger groups take as many as ``miss`` asks for."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("embedding"), F.col(label_col).alias("label"))
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(
        ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        & F.exists("embedding", lambda v: v != 0), F.lit(False))
    keyed = rows.withColumn("k", F.when(usable, F.xxhash64("label", "embedding")))
    distinct = written(spark, keyed.filter("k is not null").groupBy("k", "label", "embedding")
                       .agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
                       .withColumn("g", F.xxhash64("label", F.size("embedding"))), "vectors")
    # only groups of many rows take more than the least number of passes, so there are few of them
    large = distinct.groupBy("g").agg(F.count(F.lit(1)).alias("n")) \
        .select("g", passes_for(F.col("n"), threshold, passes, window, miss).alias("own")).filter(F.col("own") > passes)
    large = written(spark, large, "large-groups")
    most = large.agg(F.max("own")).first()[0] or passes
    sorted_in = distinct.select("g", "k", "embedding").join(F.broadcast(large), "g", "left") \
        .select("g", "k", "embedding", F.coalesce("own", F.lit(passes)).alias("own"))
    rounds = []
    for start in range(0, most, passes):
        spread = map_batches(sorted_in.filter(F.col("own") > start), _pass_rows(start, start + passes), _ROW)
        rounds.append(_pass_links(spread, window, threshold))
    links = reduce(DataFrame.unionByName, rounds).distinct()
    exact = _exact(links.filter(F.col("kind") == OPEN), distinct, threshold)
    found = links.filter(F.col("kind") == SURE).select("a", "b").union(exact)
    linked = written(spark, components(found, "a", "b").withColumnRenamed("node", "k"), "vector-components")
    bridges = written(spark, _bridges(links.filter(F.col("kind") == CLOSE), linked, distinct, threshold, block), "bridges")
    whole = components(linked.select(F.col("k").alias("a"), F.col("root").alias("b")).union(bridges), "a", "b")
    linked = written(spark, whole.withColumnRenamed("node", "k"), "joined-components")
    dropped(*rounds, large)
    members = distinct.join(linked, "k")
    degrees = _complete(members.select("root", "k", "copies", "embedding"), threshold, block)
    least = members.groupBy("root").agg(F.min("least").alias("component"))
    of_linked = linked.join(least, "root").join(degrees, "k", "left").select("k", "component", "linked")
    known = distinct.select("k", "least", "copies").join(of_linked, "k", "left").select(
        "k", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "least").alias("component_id"))
    full = keyed.filter("k is not null").select("id", "k").join(known, "k").select("id", "n_links", "component_id")
    alone = keyed.filter("k is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return full.unionByName(alone)
