"""Benchmark decontamination with suffix arrays over the training text.

Every shard (the documents of a piece of about 2 MB) gets the sorted array of its word suffixes, from every
position that holds a benchmark word, and each suffix of every benchmark item is bisected in it. Between which
items' suffixes a training suffix falls tells its longest match of up to ``window`` words; at the few places that reach
that length the match is followed on through the sorted suffixes of the items, word by word, to its true end. A
document's words that lie in an occurrence of an item's window (``window`` consecutive words; a shorter item is one
window) are hit. The longest verbatim match of a document and its place are reported down to a single word.

The benchmark is sent to the tasks in blocks of at most about ``BLOCK_BYTES`` of text (64 bytes a word there), a pass per
block in one chain without a shuffle; documents never move. Nothing is expanded per place of a window in the benchmark: an
instruction that thousands of items share is one window with thousands of owners. Null texts have no words and are never hit.
A null item id takes part and is listed as ``null``; items that repeat an id count once; a document longer than a piece
makes a shard of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centroidal.llm.frames import fresh, pieces, scan_words

WINDOW = 10
BLOCK_BYTES = 16_000_000
#: Words sorted at a time in a task (a longer document makes a shard of its own).
SHARD_WORDS = 1_000_000


def suffix_order(x: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``x`` in the order of the words that follow from there on, right at least for the first ``depth``
    (doubling: ranks by one word, then by 2, 4, 8 ...)."""
    rank = np.unique(x, return_inverse=True)[1].astype(np.int64)
    done = 1
    while done < depth and len(x) and rank.max() + 1 < len(x):
        after = np.concatenate([rank[done:] + 1, np.zeros(min(done, len(x)), np.int64)])
        rank = np.unique(rank * (len(x) + 1) + after, return_inverse=True)[1].astype(np.int64)
        done *= 2
    return np.argsort(rank, kind="stable")


def _rows(x: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """The ``window`` words from each position on, zeros behind the end."""
    padded = np.concatenate([x, np.zeros(window, x.dtype)])
    return np.stack([padded[at + k] for k in range(window)], axis=1).astype(">u4") if len(at) else np.zeros((0, window), ">u4")


def _keys(rows: np.ndarray) -> np.ndarray:
    """Rows of big-endian words as byte strings that sort like them."""
    return np.ascontiguousarray(rows).view(f"S{rows.shape[1] * 4}").ravel() if len(rows) else np.zeros(0, "S4")


class TestSuffixes:
    """The sorted suffixes and the windows of a block of benchmark items, ready for bisection."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.ids = sorted({i for i, _ in items})
        number = {i: k for k, i in enumerate(self.ids)}
        texts, owners, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
        for item, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in scan_words(text)]
            if words:
                texts.append(np.array([*words, 0]))  # a 0 behind each item
                owners.append(np.full(len(words) + 1, number[item]))
                sizes.append(len(words))
        self.words, owner = np.concatenate(texts), np.concatenate(owners)
        gaps = np.flatnonzero(self.words == 0)
        begins = np.concatenate([[0], gaps + 1])[:len(gaps)]
        left = gaps[np.searchsorted(gaps, np.arange(len(self.words)))] - np.arange(len(self.words)) if len(gaps) else gaps
        order = suffix_order(self.words, max(sizes, default=0) + 1)
        self.at = order[self.words[order] > 0]
        self.owner = owner[self.at]
        self.rows = _rows(self.words, self.at, window)
        self.keys = _keys(self.rows)
        # windows: equal beginnings stand together in the array; shorter items are windows as a whole
        full = np.flatnonzero(left[self.at] >= window)
        new = np.concatenate([[True], self.keys[full][1:] != self.keys[full][:-1]]) if len(full) else np.zeros(0, bool)
        short = begins[left[begins] < window] if len(begins) else begins
        low = _rows(self.words, short, window)
        ends = np.arange(window) >= left[short][:, None]
        self.low = np.concatenate([self.keys[full][new], _keys(np.where(ends, 0, low).astype(">u4"))]) if len(self.at) else self.keys
        self.high = np.concatenate([self.keys[full][new], _keys(np.where(ends, 0xFFFFFFFF, low).astype(">u4"))]) if len(self.at) else self.keys
        self.length = np.concatenate([np.full(int(new.sum()), window), left[short]]).astype(np.int64)
        self.owners = np.concatenate([self.owner[full], owner[short]])
        self.first = np.concatenate([np.flatnonzero(new), len(full) + np.arange(len(short) + 1)]).astype(np.int64)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Words as vocabulary numbers, 0 for words of no item."""
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), dtype=np.int64, count=len(words))

    def owners_of(self, windows: np.ndarray) -> np.ndarray:
        """Items that hold any of the windows."""
        return np.unique(np.concatenate([self.owners[self.first[w]:self.first[w + 1]] for w in windows]))


def _lexicographic(rows: np.ndarray, vocabulary: int) -> np.ndarray:
    """The order of rows of words: as many words to an integer as fit, then one sort by those."""
    per = max(1, 62 // max(1, int(vocabulary).bit_length()))
    columns = []
    for k in range(0, rows.shape[1], per):
        key = np.zeros(len(rows), np.int64)
        for column in rows[:, k:k + per].T:
            key = key * (vocabulary + 1) + column
        columns.append(key)
    return np.lexsort(columns[::-1])


def _common(rows: np.ndarray, tests: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """Benchmark words that each row has in common with the beginning of its picked row of ``tests`` (none if -1 or
    beyond the last)."""
    alive = (pick >= 0) & (pick < len(tests))
    pick = np.clip(pick, 0, max(0, len(tests) - 1))
    out = np.zeros(len(rows), np.int64)
    for k in range(rows.shape[1]):
        alive = alive & (rows[:, k] == tests[pick, k]) & (rows[:, k] != 0)
        out += alive
    return out


def _followed(x: np.ndarray, at: np.ndarray, keys: np.ndarray, tests: TestSuffixes) -> np.ndarray:
    """Length of the longest match at each of the places whose first ``window`` words stand in the benchmark: the range
    of items' suffixes that go on like the document is narrowed word by word."""
    lo, hi = np.searchsorted(tests.keys, keys, "left"), np.searchsorted(tests.keys, keys, "right")
    length = np.full(len(at), tests.window)
    going, depth = np.arange(len(at)), tests.window
    while len(going):
        word = x[np.minimum(at[going] + depth, len(x) - 1)]

        def bound(after: bool) -> np.ndarray:
            a, b = lo[going].copy(), hi[going].copy()
            while (a < b).any():
                mid = (a + b) // 2
                there = tests.words[np.minimum(tests.at[np.minimum(mid, len(tests.at) - 1)] + depth, len(tests.words) - 1)]
                right = ((there <= word) if after else (there < word)) & (a < b)
                a, b = np.where(right, mid + 1, a), np.where(right | (a >= b), b, mid)
            return a

        left, right = bound(False), bound(True)
        on = (right > left) & (word > 0)
        going = going[on]
        lo[going], hi[going] = left[on], right[on]
        length[going] += 1
        depth += 1
    return length


def occurrences(x: np.ndarray, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All places of all windows in a shard (position, window number), and the longest match at each position. ``x``:
    word numbers of the shard's documents, a 0 after each."""
    none, matched = np.zeros(0, np.int64), np.zeros(len(x), np.int64)
    at = np.flatnonzero(x)
    if not len(tests.at) or not len(at):
        return none, none, matched
    rows = _rows(x, at, tests.window)
    order = _lexicographic(rows, len(tests.vocabulary))  # the shard's suffix array
    rows, at = rows[order], at[order]
    keys = _keys(rows)
    # every suffix of the items is bisected; the two around a training suffix share most words with it
    below = np.searchsorted(np.searchsorted(keys, tests.keys, "left"), np.arange(len(keys)), "right") - 1
    best = np.maximum(_common(rows, tests.rows, below), _common(rows, tests.rows, below + 1))
    deep = np.flatnonzero(best == tests.window)
    best[deep] = _followed(x, at[deep], keys[deep], tests)
    matched[at] = best
    lo, hi = np.searchsorted(keys, tests.low, "left"), np.searchsorted(keys, tests.high, "right")
    n = np.maximum(0, hi - lo)
    hit = np.flatnonzero(n)
    n = n[hit]
    windows = np.repeat(hit, n)
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return at[np.repeat(lo[hit], n) + inside], windows, matched


def _least_owners(x: np.ndarray, at: np.ndarray, length: np.ndarray, tests: TestSuffixes) -> np.ndarray:
    """For a match at each place the least item that holds it."""
    short = np.minimum(length, tests.window)
    rows = _rows(x, at, tests.window)
    behind = np.arange(tests.window) >= short[:, None]
    lo = np.searchsorted(tests.keys, _keys(np.where(behind, 0, rows).astype(">u4")), "left")
    hi = np.searchsorted(tests.keys, _keys(np.where(behind, 0xFFFFFFFF, rows).astype(">u4")), "right")
    out = np.empty(len(at), np.int64)
    for k, (a, b) in enumerate(zip(lo, hi)):
        for depth in range(tests.window, int(length[k])):  # longer matches: those of the range that go on
            there = tests.words[tests.at[a:b] + depth]
            a, b = a + np.searchsorted(there, x[at[k] + depth], "left"), a + np.searchsorted(there, x[at[k] + depth], "right")
        out[k] = tests.owner[a:b].min()
    return out


def search_shard(docs: list[np.ndarray], tests: TestSuffixes) -> tuple[list[np.ndarray], list[np.ndarray], list[tuple]]:
    """Per document: hit word intervals (n x 2), item numbers, and the longest match (words, start word,
    item number) or (0, None, None)."""
    sizes = np.array([len(d) + 1 for d in docs])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    x = np.zeros(starts[-1], np.int64)
    for d, s in zip(docs, starts):
        x[s:s + len(d)] = d
    at, windows, matched = occurrences(x, tests)
    hits = [np.zeros((0, 2), np.int64)] * len(docs)
    items: list[np.ndarray] = [np.zeros(0, np.int64)] * len(docs)
    longest: list[tuple] = [(0, None, None)] * len(docs)
    most = np.maximum.reduceat(matched, starts[:-1])
    some = np.flatnonzero(most)
    if len(some):
        top = np.flatnonzero((matched == np.repeat(most, sizes)) & (matched > 0))
        place = top[np.searchsorted(top, starts[some])]
        for d, p, n, item in zip(some, place, most[some], _least_owners(x, place, most[some], tests)):
            longest[d] = int(n), int(p - starts[d]), int(item)
    if not len(at):
        return hits, items, longest
    covered = np.zeros(len(x) + 1, np.int64)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + tests.length[windows], -1)
    edge = np.diff(np.concatenate([[0], (np.cumsum(covered) > 0).astype(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    of = np.searchsorted(starts, begin, "right") - 1
    for d in np.unique(of):
        mine = of == d
        hits[d] = np.stack([begin[mine], end[mine]], axis=1) - starts[d]
    of = np.searchsorted(starts, at, "right") - 1
    pairs = np.unique(np.stack([of, windows]), axis=1)
    cuts = np.flatnonzero(np.diff(pairs[0])) + 1
    for d, mine in zip(pairs[0][np.concatenate([[0], cuts])], np.split(pairs[1], cuts)):
        items[d] = tests.owners_of(mine)
    return hits, items, longest


_FOUND = [("n_words", pa.int64()), ("hits", pa.list_(pa.int64())), ("items", pa.list_(pa.string())),
          ("longest", pa.int64()), ("longest_start", pa.int64()), ("longest_item", pa.string())]
FOUND_SCHEMA = ("n_words long, hits array<long>, items array<string>, longest long, longest_start long, "
                "longest_item string")


def search_batch(texts: list[bytes | None], tests: TestSuffixes) -> list[tuple]:
    """Rows of ``FOUND_SCHEMA`` for the texts; ``hits``: start and end words of hit stretches in turn."""
    out, shard, words = [], [], 0

    def flush() -> None:
        for d, h, i, (n, start, item) in zip(shard, *search_shard(shard, tests)):
            out.append((len(d), h.ravel().tolist(), [tests.ids[k] for k in i], n, start,
                        None if item is None else tests.ids[item]))

    for t in texts:
        d = tests.numbers(scan_words(t or b""))
        shard.append(d)
        words += len(d) + 1
        if words >= SHARD_WORDS:
            flush()
            shard, words = [], 0
    if shard:
        flush()
    return out


def _joined(a: tuple, b: tuple) -> tuple:
    """A document's findings in two blocks of the benchmark as one."""
    marks = np.array(a[1] + b[1], dtype=np.int64).reshape(-1, 2)
    marks = marks[np.argsort(marks[:, 0], kind="stable")]
    spans: list[list[int]] = []
    for s, e in marks.tolist():
        if spans and s <= spans[-1][1]:
            spans[-1][1] = max(e, spans[-1][1])
        else:
            spans.append([s, e])
    best = min(a, b, key=lambda r: (-r[3], r[4] or 0, r[5] or ""))
    return a[0], [x for s in spans for x in s], sorted({*a[2], *b[2]}), *best[3:]


def benchmark_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                     block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark in blocks of about ``block_bytes`` of text, so that the driver and each broadcast hold
    no more than one."""
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("id"),
                            F.encode(F.col(text_col), "UTF-8").alias("text")).filter("text is not null")
    total = rows.agg(F.sum(F.length("text") + 16)).first()[0] or 0
    n = -(-int(total) // block_bytes)
    for k in range(n):
        block = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k) if n > 1 else rows
        yield sorted((r["id"], bytes(r["text"])) for r in block.collect())


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", window: int = WINDOW, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (as they are; default all) with one more, ``found`` (underscores
    in front where ``docs`` has that name): a struct of ``FOUND_SCHEMA``. One row per input row.

    ``found.hits``: alternating start and end words of the hit stretches; ``found.items``: sorted ids of
    items with an occurring window; ``found.longest*``: longest verbatim match, its first word in the
    document and its item (ties: the first in the document).
    """
    spark = docs.sparkSession
    text_name, found_name = fresh(docs, "leak_text"), fresh(docs, "found")
    rows = docs.select(*[F.col(f"`{c}`") for c in (keep if keep is not None else docs.columns)],
                       F.encode(F.col(text_col), "UTF-8").alias(text_name),
                       F.lit(None).cast(f"struct<{', '.join(x.replace(' ', ':', 1) for x in FOUND_SCHEMA.split(', '))}>")
                       .alias(found_name))
    schema = rows.schema
    width = len(schema) - 2
    kind = pa.struct(_FOUND)

    def one_block(sent):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tests = sent.value
            for b in pieces(batches):
                texts, before = b.column(width).to_pylist(), b.column(width + 1).to_pylist()
                found = search_batch(texts, tests)
                found = [f if a is None else _joined(tuple(a[n] for n, _ in _FOUND), f) for a, f in zip(before, found)]
                cols = list(zip(*found)) or [()] * len(_FOUND)
                struct = pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, _FOUND)], fields=list(kind))
                yield pa.RecordBatch.from_arrays([*b.columns[:width + 1], struct], schema=pa.schema(
                    [*list(b.schema)[:width + 1], pa.field(b.schema.names[width + 1], kind)]))
        return run

    blocks = 0
    for items in benchmark_blocks(benchmark, item_col, item_text_col):
        rows = rows.mapInArrow(one_block(spark.sparkContext.broadcast(TestSuffixes(items, window))), schema)
        blocks += 1
    if not blocks:  # no benchmark: words are counted all the same
        rows = rows.mapInArrow(one_block(spark.sparkContext.broadcast(TestSuffixes([], window))), schema)
    return rows.drop(text_name)


def n_hit(found) -> F.Column:
    """Number of hit words of a ``found`` struct's stretches."""
    return F.aggregate(F.transform(found["hits"], lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)),
                       F.lit(0).cast("long"), lambda a, x: a + x)


def remove_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold an item's window; columns stay as they are."""
    found = find_leaks(docs, benchmark, text_col, window=window)
    return found.filter(F.size(found[found.columns[-1]]["hits"]) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
