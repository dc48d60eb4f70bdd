"""N-gram Jaccard join with multiple-global-order prefix filtering.

A document's set is its distinct 5-word shingles (with fewer words, the whole sequence; without words,
empty and linked with nothing). Two documents link when ``|A n B| >= t |A u B|``; the result is exact
up to collisions of 64-bit hashes.

1. One pass hashes every document into a set digest and counts shingles per hash cell in a sketch of
   fixed size. Documents with equal digests are copies and go on as one set.
2. A global token order puts shingles of rarer cells first (ties by a hash), so passages that many
   documents share come last. Sets that link must share a token among the first ``n - ceil(t n) + 1``
   of each under any global order; the first order's prefixes are the join keys.
3. In each token's bucket the most central set - the one with the least share of rarer tokens of its own,
   as the original among edited copies - is compared with the others (wave 1); links join sets into
   components, and every pair of a bucket that is not yet in one component follows (wave 2). Pairs in
   one component are known to be connected, so no group of copies is expanded into all its pairs,
   and no pair that could join two components is left out. Lengths and token positions bound the
   overlap before a pair is emitted, small bitmaps of the sets after that.
4. Full sets are fetched for the pairs left. A pair must also share prefix tokens under two more global
   orders; only pairs that pass all the filters are verified on their full sets.
5. On request (``count_links``) every document's links are counted, those inside components too, which 3 leaves out.

Null ids: a document without id has the least id of its copies and links, null if there is none.
Repeated rows are copies of each other. Sketch, thresholds and filters are the same at every size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from centroidal.llm.components import components
from centroidal.llm.frames import as_bytes, fresh, mix64, pieces, written

WORDS = 5
#: Similarity as a ratio of whole numbers: 80/100.
NUM, DEN = 80, 100
CELL_BITS, SLICES = 21, 64
#: Words hashed at a time in a task.
GROUP_WORDS = 100_000
#: Bits of the filter for wanted documents: 2^FILTER_BITS / 64 rows at most are broadcast.
FILTER_BITS = 26
#: Counting links: sets and tokens of a block, and tokens of a matrix.
LINK_BLOCK, LINK_BLOCK_TOKENS, LINK_TOKENS = 512, 1 << 20, 4096
#: Seeds of the token orders: the join order, then the orders that only filter.
ORDERS = (11, 12, 13)

_PLACE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                   0xE7037ED1A0B428DB], dtype=np.uint64)


def shingles(texts: list[bytes | None], k: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; word hashes of a group of texts are combined at
    once."""
    group: list[list[bytes]] = []
    size = 0
    for text in texts:
        group.append(text.lower().split() if text else [])
        size += len(group[-1])
        if size >= GROUP_WORDS:
            yield from _group_shingles(group, size, k)
            group, size = [], 0
    yield from _group_shingles(group, size, k)


def _group_shingles(group: list[list[bytes]], size: int, k: int) -> Iterator[np.ndarray]:
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(group)), dtype=np.uint64, count=size)
    m = max(0, size - k + 1)
    x = np.full(m, k, dtype=np.uint64)
    for i in range(k):
        x += h[i:i + m] * _place(i)
    x = mix64(x)
    at = 0
    for words in group:
        n = len(words)
        if n >= k:
            own = np.sort(x[at:at + n - k + 1])
            first = np.empty(len(own), bool)
            first[0] = True
            np.not_equal(own[1:], own[:-1], out=first[1:])
            yield own[first]
        elif n:  # the whole sequence, told apart from longer ones by its length
            yield mix64(sum((h[at + i:at + i + 1] * _place(i) for i in range(n)), np.full(1, n, np.uint64)))
        else:
            yield np.zeros(0, np.uint64)
        at += n


def _place(i: int) -> np.uint64:
    """An odd factor for a word's place in its shingle."""
    return _PLACE[i % len(_PLACE)] + np.uint64(2 * (i // len(_PLACE)))


def digests(sets: list[np.ndarray]) -> np.ndarray:
    """Two 64-bit digests of each set (n x 2, signed, as Spark has them)."""
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    out = np.zeros((len(sets), 2), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        x = np.concatenate([sets[i] for i in full])
        starts = np.cumsum(sizes[full]) - sizes[full]
        for seed in (1, 2):
            out[full, seed - 1] = mix64(np.add.reduceat(mix64(x, seed), starts) + sizes[full].astype(np.uint64), seed)
    return out.view(np.int64)


def bitmaps(sets: list[np.ndarray]) -> list[bytes]:
    """A bit for each token's hash, at least two bits a token, so that what one set lacks of another's
    bits bounds their overlap. A map of half the size is every two neighbouring bits joined."""
    out = []
    for x in sets:
        size = max(6, int(2 * len(x) - 1).bit_length()) if len(x) else 6
        bits = np.zeros(1 << size, np.uint8)
        bits[mix64(x, 3) >> np.uint64(64 - size)] = 1
        out.append(np.packbits(bits).tobytes())
    return out


def may_overlap(n_a: int, n_b: int, a: bytes, b: bytes) -> bool:
    """Whether two bitmaps leave room for the overlap that the sizes require."""
    x, y = (np.unpackbits(np.frombuffer(v, np.uint8)) for v in (a, b))
    while len(x) != len(y):
        if len(x) > len(y):
            x = x.reshape(-1, 2).max(axis=1)
        else:
            y = y.reshape(-1, 2).max(axis=1)
    room = min(n_a - int((x > y).sum()), n_b - int((y > x).sum()))
    return (NUM + DEN) * room >= NUM * (n_a + n_b)


def required(n: int | np.ndarray):
    """Least overlap of a set of ``n`` with any set it links to."""
    return -(-NUM * n // DEN)


def token_order(x: np.ndarray, classes: np.ndarray, seed: int) -> np.ndarray:
    """Positions of the tokens of a set under a global order: rare cells first, then by a hash."""
    key = (classes[x >> np.uint64(64 - CELL_BITS)].astype(np.uint64) << np.uint64(58)) | (mix64(x, seed) >> np.uint64(6))
    return np.argsort(key, kind="stable")


def prefix(x: np.ndarray, classes: np.ndarray, seed: int) -> np.ndarray:
    """The tokens of which a linked set must share one, in order."""
    return x[token_order(x, classes, seed)[:len(x) - int(required(len(x))) + 1]]


# --- pass 1: digests and sketch ---------------------------------------------------------------------

_SIGNATURES = "id {id}, n long, s long, s2 long, bits binary, slice int, counts binary"


def _signatures(docs: DataFrame) -> DataFrame:
    """Per document its set size and digests; per task its sketch in slices."""
    id_type = docs.schema[0].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, np.int64)
        ids = None
        names = ["id", "n", "s", "s2", "bits", "slice", "counts"]
        for b in pieces(batches):
            ids = b.column(0).type
            sets = list(shingles(as_bytes(b.column(1))))
            if any(map(len, sets)):
                cells += np.bincount(np.concatenate(sets) >> np.uint64(64 - CELL_BITS), minlength=len(cells))
            n, both = pa.array([len(x) for x in sets], pa.int64()), digests(sets)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), n, pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(bitmaps(sets), pa.binary()),
                 pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())], names=names)
        if ids is not None:
            none = [pa.nulls(SLICES, ids), *(pa.nulls(SLICES, pa.int64()) for _ in range(3)), pa.nulls(SLICES, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*none, pa.array(range(SLICES), pa.int32()),
                 pa.array([zlib.compress(c.tobytes(), 1) for c in cells.reshape(SLICES, -1)], pa.binary())], names=names)

    return docs.mapInArrow(run, _SIGNATURES.format(id=id_type))


def _sum_slices(rows: DataFrame, keys: list[str]) -> DataFrame:
    def add(group: pa.Table) -> pa.Table:
        total = 0
        for v in group.column("counts").to_pylist():
            total = total + np.frombuffer(zlib.decompress(v), np.int64)
        return pa.table({**{k: group.column(k).slice(0, 1) for k in keys},
                         "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    return rows.select(*keys, "counts").groupBy(*keys).applyInArrow(
        add, ", ".join(f"{k} int" for k in keys) + ", counts binary")


def token_classes(signatures: DataFrame) -> np.ndarray:
    """Order of magnitude of each cell's count over all documents (2^CELL_BITS bytes, whatever the
    input): task sketches are added up in two steps, so that no task gets those of all."""
    parts = signatures.filter("slice is not null").withColumn("part", F.pmod(F.xxhash64("counts"), F.lit(64)).cast("int"))
    summed = _sum_slices(_sum_slices(parts, ["slice", "part"]), ["slice"]).collect()
    cells = np.zeros((SLICES, (1 << CELL_BITS) // SLICES), np.int64)
    for r in summed:
        cells[r["slice"]] = np.frombuffer(zlib.decompress(r["counts"]), np.int64)
    return np.ceil(np.log2(cells.ravel() + 1)).astype(np.uint8)


# --- pass 2: prefix rows ----------------------------------------------------------------------------

def _prefix_rows(docs: DataFrame, sent) -> DataFrame:
    """``t`` token, ``s`` set, ``n`` its size, ``q`` tokens of the set from this one on; each set once a
    task."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, seen = sent.value, set()
        for b in pieces(batches):
            t, s, n, q = [], [], [], []
            sets = list(shingles(as_bytes(b.column(0))))
            for x, d in zip(sets, digests(sets)[:, 0].tolist()):
                if not len(x) or d in seen:
                    continue
                seen.add(d)
                p = prefix(x, classes, ORDERS[0])
                t.append(p)
                s.append(np.full(len(p), d, np.int64))
                n.append(np.full(len(p), len(x), np.int32))
                q.append((len(x) - np.arange(len(p))).astype(np.int32))
            if t:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(t).view(np.int64)), *(
                    pa.array(np.concatenate(c)) for c in (s, n, q))], names=["t", "s", "n", "q"])
    return docs.mapInArrow(run, "t long, s long, n int, q int")


def _set_rows(docs: DataFrame, sent) -> DataFrame:
    """Full sets with their prefixes under the filtering orders, each set once a task."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, seen = sent.value, set()
        for b in pieces(batches):
            rows = []
            sets = list(shingles(as_bytes(b.column(0))))
            for x, d in zip(sets, digests(sets)[:, 0].tolist()):
                if not len(x) or d in seen:
                    continue
                seen.add(d)
                rows.append((d, *((prefix(x, classes, o) & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes() for o in ORDERS[1:]), x.tobytes()))
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *(pa.array(c, pa.binary()) for c in cols[1:])],
                                                 names=["s", "p2", "p3", "tokens"])
    return docs.mapInArrow(run, "s long, p2 binary, p3 binary, tokens binary")


# --- waves: pairs of buckets ------------------------------------------------------------------------

def _may_link(n_a, q_a, n_b, q_b):
    """Length and position filter at a common token: what is left of both sets can still hold the
    overlap that their sizes require (valid at the pair's first common token)."""
    need = -(-NUM * (n_a + n_b) // (NUM + DEN))
    return (NUM * np.maximum(n_a, n_b) <= DEN * np.minimum(n_a, n_b)) & (np.minimum(q_a, q_b) >= need)


def _bucket_pairs(s, n, q, c, hubs_only: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidates of one bucket (rows sorted by set)."""
    if hubs_only:
        hub = int(np.argmax(q / n))
        ok = _may_link(n[hub], q[hub], n, q)
        ok[hub] = False
        yield np.full(int(ok.sum()), s[hub]), s[ok]
        return
    if (c == c[0]).all():
        return
    order = np.lexsort((s, n))
    s, n, q, c = s[order], n[order], q[order], c[order]
    longest = np.searchsorted(n, n * DEN // NUM, "right")
    for i in range(len(s)):
        j = slice(i + 1, longest[i])
        ok = (c[j] != c[i]) & _may_link(n[i], q[i], n[j], q[j])
        if ok.any():
            yield np.full(int(ok.sum()), s[i]), s[j][ok]


def _pairs(buckets: DataFrame, hubs_only: bool) -> DataFrame:
    """Distinct candidate pairs ``a < b`` over all buckets; buckets stream through sorted partitions."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None

        def pairs(cols, edges):
            a, b = [], []
            for i, j in zip(edges[:-1], edges[1:]):
                if j - i > 1:
                    for x, y in _bucket_pairs(*(v[i:j] for v in cols[1:]), hubs_only):
                        a.append(x)
                        b.append(y)
            if a:
                both = np.sort(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=1)
                both = np.unique(both, axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            if kept is not None:
                cols = [np.concatenate(x) for x in zip(kept, cols)]
            edges = np.concatenate([[0], np.flatnonzero(np.diff(cols[0])) + 1])
            yield from pairs(cols, edges)
            kept = [c[edges[-1]:] for c in cols]
        if kept is not None:
            yield from pairs(kept, [0, len(kept[0])])

    return buckets.select("t", "s", "n", "q", "c").repartition("t").sortWithinPartitions("t", "s") \
        .mapInArrow(run, "a long, b long").distinct()


def _with_sets(pairs: DataFrame, sets: DataFrame, cols: list[str]) -> DataFrame:
    left = sets.select(F.col("s").alias("a"), *[F.col(c).alias(f"a_{c}") for c in cols])
    right = sets.select(F.col("s").alias("b"), *[F.col(c).alias(f"b_{c}") for c in cols])
    return pairs.join(left, "a").join(right, "b").select("a", "b", *[f"{x}_{c}" for c in cols for x in "ab"])


def _u64(v: bytes) -> np.ndarray:
    return np.frombuffer(v, np.uint64)


def _keep_pairs(df: DataFrame, ok) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [ok(*row) for row in zip(*(c.to_pylist() for c in b.columns[2:]))]
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    return df.mapInArrow(run, "a long, b long")


def _share_prefixes(a2: bytes, b2: bytes, a3: bytes, b3: bytes) -> bool:
    return all(np.isin(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)).any() for x, y in ((a2, b2), (a3, b3)))


def _linked(a: bytes, b: bytes) -> bool:
    x, y = _u64(a), _u64(b)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return DEN * both >= NUM * (len(x) + len(y) - both)


def _verified(candidates: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs that share a prefix token under every further order, and then really link."""
    passed = _keep_pairs(_with_sets(candidates, sets, ["p2", "p3"]), _share_prefixes)
    return _keep_pairs(_with_sets(passed, sets, ["tokens"]), _linked).distinct()


def _fetch_sets(rows: DataFrame, reps: DataFrame, pairs: DataFrame, sent) -> DataFrame:
    """Full sets of the members of ``pairs``. A filter of fixed size over the documents that stand for
    them goes first, so that only texts which may be wanted are shuffled to the exact join."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("s")).distinct().join(reps, "s") \
        .select(F.col("rep").alias("want")).distinct()
    bit = F.xxhash64("want").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    words = wanted.select(F.shiftright(bit, 6).alias("word"), F.expr("shiftleft(1L, cast({} & 63 as int))".format(
        f"(xxhash64(want) & {(1 << FILTER_BITS) - 1})")).alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    mine = f"(xxhash64(id) & {(1 << FILTER_BITS) - 1})"
    maybe = rows.withColumn("word", F.expr(f"shiftright({mine}, 6)")).join(F.broadcast(words), "word") \
        .filter(F.expr(f"(bits & shiftleft(1L, cast({mine} & 63 as int))) <> 0")).select("id", "text")
    # an inner join with distinct ids: the optimizer would move a semi join below the filter
    texts = maybe.join(wanted, F.col("id").eqNullSafe(F.col("want"))).select("text")
    return _set_rows(texts, sent)


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """Tokens that each pair of sets has in common, from products of incidence matrices, some thousand tokens at a time."""
    sizes = np.array([len(x) for x in sets])
    tokens, number, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.cumsum(times > 1) - 1  # only tokens of two sets or more count
    row, column = np.repeat(np.arange(len(sets)), sizes)[times[number] > 1], rank[number[times[number] > 1]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(sets), len(sets)), np.float64)
    for start in range(0, int(rank[-1]) + 1, LINK_TOKENS):
        a, b = np.searchsorted(column, [start, start + LINK_TOKENS])
        x = np.zeros((len(sets), LINK_TOKENS), np.float32)
        x[row[a:b], column[a:b] - start] = 1
        both += x @ x.T
    both[np.arange(len(sets)), np.arange(len(sets))] = sizes
    return both


def _link_counts(rows: DataFrame, reps: DataFrame, linked: DataFrame, sent, block: int, block_tokens: int) -> DataFrame:
    """``s, links``: documents of other sets that link to each set of a component. A component's sets are dealt to blocks of
    at most about ``block`` sets and ``block_tokens`` tokens; every two blocks meet in one task, which compares all."""
    spark = rows.sparkSession
    members = reps.join(linked.withColumnRenamed("node", "s"), "s").select("s", "root", "n", "copies")
    sets = written(spark, _fetch_sets(rows, reps, members.select(F.col("s").alias("a"), F.col("s").alias("b")), sent).select("s", "tokens")
                   .dropDuplicates(["s"]), "member-sets")
    shape = members.groupBy("root").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("n") / block_tokens)).cast("int").alias("blocks"))
    dealt = members.join(sets, "s").join(shape, "root").withColumn("own", F.pmod(F.xxhash64("s", F.lit(ORDERS[0])), "blocks").cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("root", "s", "copies", "tokens", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def meet(group: pa.Table) -> pa.Table:
        tokens = [_u64(t) for t in group.column("tokens").to_pylist()]
        n, copies = np.array([len(t) for t in tokens]), group.column("copies").to_numpy()
        own, s = group.column("own").to_numpy(), group.column("s").to_numpy()
        both = _shared(tokens)
        hit = DEN * both >= NUM * (n[:, None] + n[None, :] - both)
        if group.column("i")[0].as_py() != group.column("j")[0].as_py():
            hit &= own[:, None] != own[None, :]  # pairs within a block meet in a group of their own
        np.fill_diagonal(hit, False)
        return pa.table({"s": pa.array(s), "links": pa.array(hit @ copies)})

    return dealt.repartition("root", "i", "j").groupBy("root", "i", "j").applyInArrow(meet, "s long, links long") \
        .groupBy("s").agg(F.sum("links").alias("links"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_links: bool = False,
                       link_block: int = LINK_BLOCK, link_block_tokens: int = LINK_BLOCK_TOKENS) -> DataFrame:
    """``id, n, s, component`` per document: its id, set size, set digest (copies have the same) and the
    least id that links reach (its own id for an empty set). With ``count_links`` also ``n_links``: the other documents
    that it links to, copies included. That compares all different sets of a component, in blocks, so its cost grows
    with the square of a component's different sets."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    signatures = written(spark, _signatures(rows), "signatures")
    sent = spark.sparkContext.broadcast(token_classes(signatures))
    own = signatures.filter("slice is null").select("id", "n", "s", "s2", "bits")
    reps = written(spark, own.filter("n > 0").groupBy("s", "s2").agg(
        F.min("id").alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits")), "sets")

    # Buckets of two sets or more: one shuffle by token serves the deduplication and the count.
    prefixes = _prefix_rows(rows.select("text"), sent).repartition("t").dropDuplicates(["t", "s"])
    buckets = prefixes.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("t"))).filter("size > 1").drop("size")
    buckets = written(spark, buckets, "buckets")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        pairs = written(spark, _keep_pairs(_with_sets(pairs, reps, ["n", "bits"]), may_overlap), f"{name}-pairs")
        sets = written(spark, _fetch_sets(rows, reps, pairs, sent), f"{name}-sets")
        return written(spark, _verified(pairs, sets), f"{name}-links")

    hubs = verified(_pairs(buckets.withColumn("c", F.col("s")), hubs_only=True), "hub")
    joined = written(spark, components(hubs, "a", "b"), "hub-components")
    mixed = buckets.join(joined, F.col("s") == F.col("node"), "left").withColumn("c", F.coalesce("root", "s"))
    rest = verified(_pairs(mixed, hubs_only=False), "rest")
    stars = joined.select(F.col("node").alias("a"), F.col("root").alias("b"))
    linked = written(spark, components(stars.union(rest), "a", "b"), "components")

    # The least document id of each set's component, back to all documents by set digest.
    named = reps.select("s", "s2", "rep").join(linked.withColumnRenamed("node", "s"), "s", "left").withColumn("root", F.coalesce("root", "s"))
    least = named.groupBy("root").agg(F.min("rep").alias("component"))
    of_set = named.join(least, "root").select("s", "s2", "component")
    none = own.filter("n = 0").select("id", "n", "s", F.col("id").alias("component"))
    if count_links:
        copies = own.filter("n > 0").groupBy("s", "s2").agg(F.count(F.lit(1)).alias("copies"))
        links = written(spark, _link_counts(rows, reps.join(copies, ["s", "s2"]), linked, sent, link_block, link_block_tokens), "link-counts")
        of_set = of_set.join(copies, ["s", "s2"]).join(links, "s", "left") \
            .select("s", "s2", "component", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
        none = none.withColumn("n_links", F.lit(0).cast("long"))
    full = own.filter("n > 0").join(of_set, ["s", "s2"]).select("id", "n", "s", *[c for c in of_set.columns if c not in ("s", "s2")])
    return full.unionByName(none)


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of linked documents: the one with the least id, rows without
    an id last (they go by a hash of their text). Rows that share an id but not the text are documents
    of their own; rows that repeat both stand once. Documents with empty sets are linked with nothing
    and stay. Columns stay as they are."""
    key, row = fresh(docs, "group_key"), fresh(docs, "row_key")
    of_row = F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    keyed = docs.select(
        F.struct(F.col(f"`{id_col}`").isNull().alias("missing"), F.col(f"`{id_col}`").alias("id"), of_row.alias("row")).alias(key),
        F.col(f"`{text_col}`").alias("text"))
    chosen = jaccard_components(keyed, key, "text").filter("id.row = component.row").select(F.col("id.row").alias(row)).distinct()
    kept = docs.withColumn(row, of_row).join(chosen, row, "left_semi")
    return kept.dropDuplicates([row]).select(*[F.col(f"`{c}`") for c in docs.columns])
