"""Prefix trie of turn sequences: every distinct prefix with the interval of its members among the sorted sequences.

A turn becomes a token of 16 bytes (of the SHA-256 of speaker and text), a sequence the bytes of its tokens; sorted by
these bytes, the sequences that begin with a given prefix stand side by side. ``lcp`` is a sequence's number of tokens
shared with the sequence before it. A sequence's candidates are its prefixes longer than its lcp: exactly the nodes that
begin there. Each candidate of depth d searches the first place after it (and its parent the last place before it)
whose lcp is below d, by halving steps over a sparse table of range minima of the lcps: no stack, no order
among candidates. What a node reports comes from prefix sums at both ends of its interval and from range minima of ids.

The sorted sequences lie in blocks, the partitions of a range sort (equal sequences are told apart by their ids, so a
large group of copies is cut as well). A search that leaves its block goes on over a sparse table of the blocks' minima
and ends at a record of the block it finds: a block keeps a record for each place where its running minimum of
lcps, from either end, falls. These records and one summary a block are all that is shared; they grow with the
number of blocks and the longest prefix common to neighbouring blocks, not with the sequences.

One sequence's tokens and sizes are one row (24 bytes a turn); a block's, some 200,000 turns or the largest sequence,
are one task's arrays. The range sort samples keys as every Spark sort does.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from centroidal.llm.frames import dropped, written

TOKEN = 16
BLOCK_TURNS = 200_000
#: Characters of ids that are hashed at a time where the members that end at a node lie in several blocks.
CHUNK_CHARS = 1 << 16
FAR = np.iinfo(np.int64).max


def turn_sequences(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """``id, tokens``: each conversation's turns in order as ``array<struct<turn, token, size>>``, size in bytes of text.

    Ordered by turn number, null first, and among equal numbers by token. A null speaker or text is empty; repeated
    rows are turns of their own; rows without an id belong to no conversation and go.
    """
    who = F.coalesce(turns[speaker_col].cast("string"), F.lit(""))
    text = F.coalesce(turns[text_col].cast("string"), F.lit(""))
    # the length of the speaker tells where its text begins
    token = F.substring(F.sha2(F.concat_ws(":", F.octet_length(who).cast("string"), who, text), 256), 1, 2 * TOKEN)
    rows = turns.filter(turns[id_col].isNotNull()).select(
        turns[id_col].cast("long").alias("id"),
        F.struct(turns[turn_col].cast("long").alias("turn"), token.alias("token"), F.octet_length(text).alias("size")).alias("t"))
    return rows.groupBy("id").agg(F.sort_array(F.collect_list("t")).alias("tokens"))


def with_borrowed_heads(sequences: DataFrame, source: Column, length: Column, longest: int) -> DataFrame:
    """Each sequence with its first ``length`` tokens replaced by those of the sequence ``source`` (an expression of
    ``id``): all if that has fewer, none if it does not exist. ``longest`` bounds ``length``."""
    heads = sequences.select(F.col("id").alias("source"), F.slice("tokens", 1, longest).alias("head"))
    own = sequences.withColumn("source", source).withColumn("h", length.cast("int"))
    rest = F.slice("tokens", F.col("h") + 1, F.greatest(F.size("tokens"), F.lit(1)))
    return own.join(heads, "source", "left").select("id", F.concat(
        F.slice(F.coalesce("head", F.slice("tokens", 1, 0)), 1, F.col("h")), rest).alias("tokens"))


# --- range minima -----------------------------------------------------------------------------------

class SparseTable:
    """Minima of all ranges of a power of two; any range is covered by two, any search by halving steps."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 << len(self.rows) <= 2 * len(values):
            last, step = self.rows[-1], 1 << len(self.rows) - 1
            self.rows.append(np.minimum(last[:-step], last[step:]))

    def least(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Minimum of ``values[start:end]`` for each pair; FAR for an empty range."""
        out = np.full(len(start), FAR, np.int64)
        level = np.frexp(np.maximum(end - start, 0))[1] - 1
        for k, row in enumerate(self.rows):
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(row[start[at]], row[end[at] - (1 << k)])
        return out

    def first_below(self, start: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The least place ``>= start`` whose value is below ``bound``; the length if there is none."""
        at = start.copy()
        for k, row in reversed([*enumerate(self.rows)]):
            can = np.flatnonzero(at + (1 << k) <= len(self.rows[0]))
            step = can[row[at[can]] >= bound[can]]
            at[step] += 1 << k
        return at

    def last_below(self, start: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The greatest place ``<= start`` whose value is below ``bound``; -1 if there is none."""
        at = start.copy()
        for k, row in reversed([*enumerate(self.rows)]):
            can = np.flatnonzero(at - (1 << k) + 1 >= 0)
            step = can[row[at[can] - (1 << k) + 1] >= bound[can]]
            at[step] -= 1 << k
        return at


def shared_tokens(a: bytes, b: bytes) -> int:
    """Leading tokens that two sequences share."""
    n = min(len(a), len(b)) // TOKEN
    if a[:n * TOKEN] == b[:n * TOKEN]:
        return n
    x, y = (np.frombuffer(s, "V16", n) for s in (a, b))
    return int(np.argmax(x != y))


# --- blocks -----------------------------------------------------------------------------------------

def _lcps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted rows of a block with their lcp (-1 in the first row); keys are kept in the first and last row."""
    before, held = None, None
    for batch in batches:
        keys = batch.column("key").to_pylist()
        lcp = []
        for key in keys:
            lcp.append(-1 if before is None else shared_tokens(before, key))
            before = key
        edge = [keys[0] if held is None else None] + [None] * (len(keys) - 1) if keys else []
        out = batch.drop_columns(["key"]).append_column("lcp", pa.array(lcp, pa.int32())).append_column("edge", pa.array(edge, pa.binary()))
        if not keys:
            continue
        if held is not None:
            yield held
        if len(keys) > 1:
            yield out.slice(0, len(keys) - 1)
        held = out.slice(len(keys) - 1)
    if held is not None:
        yield held.set_column(held.schema.names.index("edge"), "edge", pa.array([before], pa.binary()))


@dataclass
class Block:
    """One block's arrays; ``lcp`` of its first row as given by the block before."""
    ids: np.ndarray
    lcp: np.ndarray
    size: np.ndarray       # tokens of each sequence
    total: np.ndarray      # bytes of each sequence
    new: np.ndarray        # bytes of the tokens beyond the lcp
    leaf: np.ndarray       # 1 where a childless node's last member stands
    sizes: np.ndarray      # bytes of all tokens, sequence after sequence
    first: np.ndarray      # place of each sequence's first token in sizes

    @classmethod
    def of(cls, rows: pa.Table, boundary: int, next_boundary: int) -> Block:
        ids = rows.column("id").to_numpy()
        lcp = rows.column("lcp").to_numpy().astype(np.int64)
        lcp[0] = boundary
        sizes = rows.column("sizes").combine_chunks()
        offsets = sizes.offsets.to_numpy().astype(np.int64)
        values = sizes.values.to_numpy(zero_copy_only=False).astype(np.int64)
        cum = np.concatenate([[0], np.cumsum(values)])
        size, first = np.diff(offsets), offsets[:-1]
        total = cum[offsets[1:]] - cum[first]
        new = cum[offsets[1:]] - cum[first + np.maximum(lcp, 0)]
        leaf = (np.append(lcp[1:], next_boundary) < size).astype(np.int64)
        return cls(ids, lcp, size, total, new, leaf, values, first)

    def sums(self) -> np.ndarray:
        """Sums before each place: rows, bytes, new bytes, leaves."""
        columns = np.stack([np.ones(len(self.ids), np.int64), self.total, self.new, self.leaf])
        return np.concatenate([np.zeros((4, 1), np.int64), np.cumsum(columns, axis=1)], axis=1)


def falls(values: np.ndarray) -> np.ndarray:
    """Places where the running minimum falls, the first place included."""
    least = np.minimum.accumulate(values)
    return np.flatnonzero(np.append(True, least[1:] < least[:-1]))


@dataclass
class Outline:
    """What all tasks know of all blocks: a summary each and the records of falling minima."""
    before: np.ndarray      # (4, blocks + 1) sums before each block
    least: SparseTable      # of the blocks' least lcp
    least_id: SparseTable   # of the blocks' least id
    bounds: np.ndarray      # lcp of each block's first row, and -1 at the end
    left: list[tuple[np.ndarray, np.ndarray, np.ndarray]]   # a block's falls from the left: place, lcp, least id before
    sums: list[np.ndarray]                                  # and the block's sums there, (4, falls)
    right: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # falls from the right: place, lcp, least id from there on

    def after(self, block: int, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For prefixes that reach over the end of ``block``: the sums (4, n) before the first place whose lcp is below
        ``depth``, and the least id between."""
        start = np.full(len(depth), block + 1)
        found = self.least.first_below(start, depth)
        sums, ids = np.empty((4, len(depth)), np.int64), self.least_id.least(start, found)
        for b in np.unique(found):
            at = np.flatnonzero(found == b)
            sums[:, at] = self.before[:, [b]]
            if b < len(self.left):
                _, lcp, least = self.left[b]
                k = np.searchsorted(-lcp, -depth[at], side="right")  # lcps fall: the first below the depth
                sums[:, at] += self.sums[b][:, k]
                ids[at] = np.minimum(ids[at], least[k])
        return sums, ids

    def until(self, block: int, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For prefixes that begin before ``block``: the global place where they begin, and the least id from there to
        the block."""
        start = np.full(len(depth), block - 1)
        found = self.least.last_below(start, depth)
        place, ids = np.empty(len(depth), np.int64), self.least_id.least(found + 1, start + 1)
        for b in np.unique(found):
            at = np.flatnonzero(found == b)
            where, lcp, least = self.right[b]
            k = np.searchsorted(-lcp, -depth[at], side="right")
            place[at] = self.before[0, b] + where[k]
            ids[at] = np.minimum(ids[at], least[k])
        return place, ids


KINDS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
NODE = {"kind": "string", "first": "long", "depth": "int", "id": "long", "parent_id": "long", "n_members": "long",
        "n_children": "long", "n_leaves": "long", "saved_bytes": "long", "ends": "string", "place": "long"}
SUMMARY = {"block": "int", "sums": "array<long>", "least_id": "long", "left": "array<long>", "left_lcp": "array<long>",
           "left_id": "array<long>", "left_sums": "array<long>", "right": "array<long>", "right_lcp": "array<long>", "right_id": "array<long>"}


def _summary(rows: pa.Table, number: int, bounds: np.ndarray) -> Iterator[dict]:
    """What other blocks need to know of a block."""
    block = Block.of(rows, int(bounds[number]), int(bounds[number + 1]))
    sums, ids = block.sums(), block.ids
    left, right = falls(block.lcp), len(ids) - 1 - falls(block.lcp[::-1])
    before = np.concatenate([[FAR], np.minimum.accumulate(ids)])
    onward = np.minimum.accumulate(ids[::-1])[::-1]
    row = {"block": number, "sums": sums[:, -1], "least_id": ids.min(), "left": left, "left_lcp": block.lcp[left], "left_id": before[left],
           "left_sums": sums[:, left].ravel(), "right": right, "right_lcp": block.lcp[right], "right_id": onward[right]}
    yield {name: [value] for name, value in row.items()}


def _outline(summaries: list, bounds: np.ndarray) -> Outline:
    totals = np.array([s["sums"] for s in summaries], np.int64).T
    left = [tuple(np.array(s[c], np.int64) for c in ("left", "left_lcp", "left_id")) for s in summaries]
    right = [tuple(np.array(s[c], np.int64) for c in ("right", "right_lcp", "right_id")) for s in summaries]
    return Outline(
        before=np.concatenate([np.zeros((4, 1), np.int64), np.cumsum(totals, axis=1)], axis=1),
        least=SparseTable(np.array([lcp[-1] for _, lcp, _ in left], np.int64)),
        least_id=SparseTable(np.array([s["least_id"] for s in summaries], np.int64)),
        bounds=bounds, left=left, right=right,
        sums=[np.array(s["left_sums"], np.int64).reshape(4, -1) for s in summaries])


def _nodes(rows: pa.Table, number: int, outline: Outline) -> Iterator[dict]:
    """The nodes that begin in a block, the attachments to nodes that began earlier, and the ends of its sequences."""
    block = Block.of(rows, int(outline.bounds[number]), int(outline.bounds[number + 1]))
    n, base, sums = len(block.ids), outline.before[:, [number]], block.sums()
    table, table_id = SparseTable(block.lcp), SparseTable(block.ids)

    def members(at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums at the right end of the prefixes of that depth, and their least id from ``at`` on."""
        end = table.first_below(at + 1, depth)
        ids, right = table_id.least(at, end), sums[:, end] + base
        out = np.flatnonzero(end == n)
        if len(out):
            right[:, out], beyond = outline.after(number, depth[out])
            ids[out] = np.minimum(ids[out], beyond)
        return right, ids

    def begins(at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The global place where the prefixes of that depth begin, and their least id before ``at``."""
        start = table.last_below(at, depth)
        ids, place = table_id.least(np.maximum(start, 0), at), base[0, 0] + start
        out = np.flatnonzero(start < 0)
        if len(out):
            place[out], before = outline.until(number, depth[out])
            ids[out] = np.minimum(ids[out], before)
        return place, ids

    # candidates: sequence i has one of each depth lcp + 1 .. size, the very first sequence also the root
    count = block.size - block.lcp
    at = np.repeat(np.arange(n), count)
    depth = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + block.lcp[at] + 1
    right, ids = members(at, depth)
    here = sums[:, at] + base
    cum = np.concatenate([[0], np.cumsum(block.sizes)])
    above = cum[block.first[at] + np.maximum(depth - 1, 0)] - cum[block.first[at]]  # bytes of the tokens above the node
    n_members = right[0] - here[0]
    every = right[1] - here[1] - n_members * above
    distinct = block.total[at] - above + right[2] - here[2] - block.new[at]
    # the parent: the candidate before it, or a node that began earlier
    top = np.flatnonzero(depth == block.lcp[at] + 1)
    parent = np.concatenate([[0], ids[:-1]]) if len(ids) else ids
    attached = top[block.lcp[at[top]] >= 0]
    where, before = begins(at[attached], depth[attached] - 1)
    parent[attached] = np.minimum(before, members(at[attached], depth[attached] - 1)[1])
    yield {"kind": np.full(len(at), "node"), "first": here[0], "depth": depth, "id": ids, "parent_id": np.ma.array(parent, mask=depth == 0),
           "n_members": n_members, "n_children": (block.size[at] > depth).astype(np.int64), "n_leaves": right[3] - here[3],
           "saved_bytes": every - distinct}
    if len(attached):
        pairs, times = np.unique(np.stack([where, depth[attached] - 1]), axis=1, return_counts=True)
        yield {"kind": np.full(len(times), "child"), "first": pairs[0], "depth": pairs[1], "n_children": times}
    # runs of equal sequences; one that touches the block's border may go on in another block
    heads = np.flatnonzero(np.append(True, (block.lcp[1:] < block.size[1:]) | (block.size[1:] != block.size[:-1])))
    tails = np.append(heads[1:], n)
    place = begins(heads, block.size[heads])[0]
    texts = np.array([str(i) for i in block.ids], object)
    ends, parts = [], []
    for k, (start, end) in enumerate(zip(heads, tails)):
        if 0 < start and end < n:
            ends.append((k, hashlib.sha256(",".join(texts[start:end]).encode()).hexdigest()))
            continue
        per = max(1, CHUNK_CHARS // 20)
        parts += [(k, ",".join(texts[c:min(c + per, end)]), int(base[0, 0] + c)) for c in range(start, end, per)]
    for kind, found in (("ends", ends), ("part", parts)):
        at = np.array([f[0] for f in found], int)
        yield {"kind": np.full(len(at), kind), "first": place[at], "depth": block.size[heads[at]], "ends": [f[1] for f in found],
               "place": [f[2] for f in found] if kind == "part" else None}


def _hash_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a node from its sorted parts, which pass one batch at a time."""
    key, digest = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"first": [key[0]], "depth": pa.array([key[1]], pa.int32()), "ends": [digest.hexdigest()]})

    for batch in batches:
        for first, depth, text in zip(*(batch.column(c).to_pylist() for c in ("first", "depth", "ends"))):
            if key == (first, depth):
                digest.update(b",")
            else:
                if key is not None:
                    yield done()
                key, digest = (first, depth), hashlib.sha256()
            digest.update(text.encode())
    if key is not None:
        yield done()


def _by_block(frame: DataFrame, numbers: dict[int, int], make: Callable[[pa.Table, int], Iterator[dict]], fields: dict[str, str]) -> DataFrame:
    """The columns that ``make(rows in order, number of the block)`` yields, for every block; a block is one task."""
    schema = pa.schema([(name, KINDS[kind]) for name, kind in fields.items()])

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        tables = []
        for columns in make(rows.sort_by("place"), numbers[key[0].as_py()]):
            size = len(columns[schema.names[0]])
            tables.append(pa.Table.from_arrays([pa.array(columns[f.name], f.type) if columns.get(f.name) is not None else pa.nulls(size, f.type)
                                                for f in schema], schema=schema))
        return pa.concat_tables(tables)

    # by ranges of block numbers, not their hashes: one block a task
    return frame.repartitionByRange(len(numbers), "part").groupBy("part").applyInArrow(run, ", ".join(f"{n} {k}" for n, k in fields.items()))


def prefix_trie(sequences: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per distinct prefix of ``sequences`` (``id`` unique and not null, ``tokens`` as of ``turn_sequences``),
    the empty one included: ``id`` (smallest member), ``depth, parent_id, n_members, n_children, n_leaves, saved_bytes,
    ends_sha256, first`` (the interval of its members is ``first .. first + n_members - 1`` among the sorted sequences).

    ``saved_bytes``: over the node's subtree, itself included, (members - 1) times the bytes of the node's last turn;
    ``ends_sha256``: of the comma-joined ids of the sequences that end at the node, ascending. An empty table has no
    node. Ties do not exist: equal sequences are ordered by id.
    """
    spark = sequences.sparkSession
    rows = written(spark, sequences.select(
        "id", F.unhex(F.array_join(F.transform("tokens", lambda t: t["token"]), "")).alias("key"),
        F.transform("tokens", lambda t: t["size"]).alias("sizes")), "trie-sequences")
    turns = rows.agg(F.sum(F.size("sizes") + F.lit(1))).first()[0]
    if turns is None:
        return spark.createDataFrame([], "id long, depth int, parent_id long, n_members long, n_children long, n_leaves long, "
                                         "saved_bytes long, ends_sha256 string, first long")
    # a block for each task that the session would deal to, more where blocks grow too large
    wanted = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns * 100 // block_turns))
    blocks = int(max(wanted, -(-turns // block_turns)))
    ordered = rows.repartitionByRange(blocks, "key", "id").sortWithinPartitions("key", "id") \
        .mapInArrow(_lcps, "id long, sizes array<int>, lcp int, edge binary")
    ordered = written(spark, ordered.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")), "trie-sorted")
    dropped(rows)

    # blocks are numbered without gaps; a block's first lcp is that of its first key and the last key before it
    edges = ordered.filter(F.col("edge").isNotNull()).groupBy("part").agg(
        F.min_by("edge", "place").alias("head"), F.max_by("edge", "place").alias("tail"))
    line = Window.orderBy("part")  # one row a block

    def boundary(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = zip(b.column("tail").to_pylist(), b.column("head").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("part"), pa.array([-1 if t is None else shared_tokens(t, h) for t, h in pairs], pa.int32())],
                                             names=["part", "bound"])

    known = edges.select("part", "head", F.lag("tail").over(line).alias("tail")).mapInArrow(boundary, "part int, bound int").orderBy("part").collect()
    numbers = {r["part"]: k for k, r in enumerate(known)}
    bounds = np.array([r["bound"] for r in known] + [-1], np.int64)
    members = ordered.drop("edge")
    summaries = _by_block(members, numbers, lambda rows, number: _summary(rows, number, bounds), SUMMARY)
    shared = spark.sparkContext.broadcast(_outline(summaries.orderBy("block").collect(), bounds))
    found = written(spark, _by_block(members, numbers, lambda rows, number: _nodes(rows, number, shared.value), NODE), "trie-nodes")
    dropped(ordered)

    hashed = found.filter("kind = 'part'").repartition("first", "depth").sortWithinPartitions("first", "depth", "place") \
        .select("first", "depth", "ends").mapInArrow(_hash_parts, "first long, depth int, ends string")
    rows = found.filter("kind != 'part'").drop("kind", "place").unionByName(hashed, allowMissingColumns=True)
    of = {c: F.max(c).alias(c) for c in ("id", "parent_id", "n_members", "n_leaves", "saved_bytes")}
    return rows.groupBy("first", "depth").agg(
        *of.values(), F.sum("n_children").alias("n_children"),
        F.coalesce(F.max("ends"), F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")) \
        .select("id", "depth", "parent_id", "n_members", "n_children", "n_leaves", "saved_bytes", "ends_sha256", "first")
