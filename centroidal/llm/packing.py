"""Hierarchical multi-length packing: documents as token sequences of several context sizes without padding.

Every document is tokenized and ended by ``end_id``. Whole windows of the longest tier are cut off a long
document; what is left of it is routed to the shortest tier (context size, a power of two) that holds it. Tiers are
packed from the longest to the shortest: each window opens with the longest document routed there, and its gap is
filled from shorter documents, the longest that fits first. When none fits, the shortest document gives its
beginning, and its rest is routed anew. So every sequence is exactly as long as its tier. What cannot fill a
window waits for the next unit of the same task; at the end of a task the last tokens (fewer than the longest tier)
become sequences whose lengths are powers of two, which need no padding either.

A task packs its own partition, about ``UNIT_TOKENS`` tokens at a time, so nothing is shuffled, memory is bounded by
a unit and the largest document, and a hot source is spread as its files are. Ids come from the partition number and
a running count: a task that runs again gives the same rows, as long as its input has the same order (a file scan has).

Sequences of a tier are dealt to step groups of ``STEP_TOKENS`` tokens in a serpentine over their attention cost (the
sum of squared piece lengths), so that the steps of a tier have equal shapes and nearly equal cost.

A null or empty text is the end id alone; a null id is kept; repeated rows are packed as often as they stand; an empty
table gives no row. Long texts are encoded word by word: only a text without white space is one call.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_right, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from centroidal.llm.frames import pieces

TIERS = (512, 1024, 2048, 4096)
UNIT_TOKENS, STEP_TOKENS = 1 << 20, 1 << 16
#: Entries of each of an encoder's memories; as many older ones are kept besides.
CACHE_WORDS = 400_000

Piece = tuple[int, int, int]  # document, start, length


def byte_alphabet() -> dict[int, str]:
    """The characters that stand for bytes in byte-level vocabularies: printable bytes are themselves, the others
    follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + k) for k, b in enumerate(others)}}


class _Memo(dict):
    """What ``make`` gave for the keys of late. When the memory is full it becomes the old one, where keys are still
    found until the next is full, so frequent keys stay."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= CACHE_WORDS:
            self.old = dict(self)
            self.clear()
        if len(key) <= 64:
            self[key] = value
        return value


#: Letters (lower case) and numbers of ASCII and Latin-1, and what a text of these and other signs of both does not hold.
LETTERS, NUMBERS = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾"
ODD = re.compile(r"[^ \n\t\r!-~¡-¿À-ÖØ-öø-ÿ]|<\|")


class WordEncoder:
    """Ids of texts, as little-endian 32-bit bytes, by a tokenizer file that drops white space and knows word ends.

    No id spans white space there, so a text is the concatenation of its words. Text of ASCII and Latin-1 needs no
    normalising but lower case; its parts go to the model one by one and are remembered. A word with any other
    character, or with the beginning of a mark of special ids, goes through the whole tokenizer.
    """

    #: Fixed value: the parts that the tokenizer's file splits text into, for the characters above.
    PARTS = re.compile(rf"[{LETTERS}]+|[{NUMBERS}]|'(?:[stmd]|re|ve|ll)|[^ \n\t\r{LETTERS}{NUMBERS}]+")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task is the unit of parallel work
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.alphabet = byte_alphabet()
        self.parts, self.words = _Memo(self._part), _Memo(self._word)

    def _part(self, part: str) -> bytes:
        tokens = self.model.tokenize(part.encode().decode("latin-1").translate(self.alphabet))
        return np.array([t.id for t in tokens], "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, self.PARTS.findall(text.lower())))

    def _word(self, word: str) -> bytes:
        if ODD.search(word):
            return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        return self._plain(word)

    def __call__(self, text: str) -> bytes:
        if not ODD.search(text):
            return self._plain(text)
        for white in "\n\t\r":
            text = text.replace(white, " ")
        return b"".join(map(self.words.__getitem__, text.split(" ")))


def cut_powers(items: list[Piece]) -> list[list[Piece]]:
    """The items one after another, cut into sequences whose lengths are falling powers of two."""
    total, out, queue = sum(n for _, _, n in items), [], items[::-1]
    for power in reversed(range(total.bit_length())):
        room, sequence = total & (1 << power), []
        while room:
            doc, start, n = queue.pop()
            sequence.append((doc, start, min(n, room)))
            if n > room:
                queue.append((doc, start + room, n - room))
            room -= sequence[-1][2]
        if sequence:
            out.append(sequence)
    return out


def pack(items: Iterable[Piece], tiers: tuple[int, ...] = TIERS) -> tuple[list[list[Piece]], list[Piece]]:
    """Sequences that fill their tier exactly, and the items (less than a window in sum) that are left."""
    longest, out, pool = tiers[-1], [], []
    for doc, start, n in items:
        whole = n // longest
        out += [[(doc, start + k * longest, longest)] for k in range(whole)]
        if n % longest:
            pool.append((n % longest, doc, start + whole * longest))
    pool.sort()
    total = sum(n for n, _, _ in pool)
    for shorter, tier in reversed([*zip((0, *tiers), tiers)]):
        while total >= tier and shorter < pool[-1][0] <= tier:  # routed to this tier
            n, doc, start = pool.pop()
            window, gap = [(doc, start, n)], tier - n
            while gap:
                fits = bisect_right(pool, gap, key=lambda item: item[0])
                n, doc, start = pool.pop(fits - 1 if fits else 0)
                window.append((doc, start, min(n, gap)))
                if n > gap:  # none fits: the shortest gives its beginning
                    insort(pool, (n - gap, doc, start + gap))
                gap -= window[-1][2]
            total -= tier
            out.append(window)
    return out, [(doc, start, n) for n, doc, start in pool]


def step_groups(sequences: list[list[Piece]], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A group for each sequence: groups hold sequences of one length, about ``step_tokens`` tokens of them, and are
    balanced by attention cost."""
    lengths = np.array([sum(n for _, _, n in s) for s in sequences], np.int64)
    cost = np.array([sum(n * n for _, _, n in s) for s in sequences], np.float64)
    group, first = np.zeros(len(sequences), np.int64), 0
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        rows = rows[np.argsort(-cost[rows], kind="stable")]
        count = max(1, round(len(rows) * int(length) / step_tokens))
        lap, at = np.divmod(np.arange(len(rows)), count)
        group[rows] = first + np.where(lap % 2 == 0, at, count - 1 - at)
        first += count
    return group.tolist()


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    """One encoder a Python worker; its memory of words serves all of the worker's tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                   tiers: tuple[int, ...] = TIERS, unit_tokens: int = UNIT_TOKENS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece: ``id, start, length, ids, doc_tokens, sequence_id, offset, tier, step_group``.

    ``ids``: little-endian 32-bit ids of the piece (binary); ``start``: the document's ids before it; ``offset``: its
    place in its sequence; ``tier``: the sequence's length. ``tiers`` are powers of two, ascending; the tokenizer's
    file must be at the same path on all machines.
    """
    if list(tiers) != sorted(set(tiers)) or any(t < 1 or t & (t - 1) for t in tiers):
        raise ValueError("tiers are ascending powers of two")
    end = np.array([end_id], "<u4").tobytes()
    source = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    schema = T.StructType([source.schema["id"]] + [T.StructField(n, t) for n, t in (
        ("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()), ("doc_tokens", T.LongType()),
        ("sequence_id", T.LongType()), ("offset", T.LongType()), ("tier", T.IntegerType()), ("step_group", T.LongType()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, base = _encoder(tokenizer_path), TaskContext.get().partitionId() << 32
        n_sequences = n_groups = held = 0
        names: dict[int, pa.Scalar] = {}  # documents of the unit: name, ids
        texts: dict[int, bytes] = {}
        waiting: list[Piece] = []

        def rows(sequences: list[list[Piece]]) -> Iterator[pa.RecordBatch]:
            nonlocal n_sequences, n_groups
            groups, columns, size = step_groups(sequences, step_tokens), [[] for _ in schema], 0
            for k, (sequence, group) in enumerate(zip(sequences, groups)):
                offset, tier = 0, sum(n for _, _, n in sequence)
                for doc, start, n in sequence:
                    row = (names[doc], start, n, texts[doc][4 * start:4 * (start + n)], len(texts[doc]) // 4,
                           base + n_sequences + k, offset, tier, base + n_groups + group)
                    for column, value in zip(columns, row):
                        column.append(value)
                    offset += n
                size += tier
                if size >= unit_tokens or k == len(sequences) - 1:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(columns, kinds)], names=schema.names)
                    columns, size = [[] for _ in schema], 0
            n_sequences, n_groups = n_sequences + len(sequences), n_groups + max(groups, default=-1) + 1

        count, kinds = 0, None
        for batch in pieces(batches):
            if kinds is None:
                kinds = [batch.schema.field("id").type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            for name, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                names[count], texts[count] = name, encode(text.as_py() or "") + end
                waiting.append((count, 0, len(texts[count]) // 4))
                held, count = held + waiting[-1][2], count + 1
                if held >= unit_tokens:
                    full, waiting = pack(waiting, tiers)
                    yield from rows(full)
                    left, held = {doc for doc, _, _ in waiting}, sum(n for _, _, n in waiting)
                    names, texts = ({d: kept[d] for d in left} for kept in (names, texts))
        full, waiting = pack(waiting, tiers)
        if kinds is not None:
            yield from rows(full + cut_powers(waiting))

    return source.mapInArrow(run, schema)
