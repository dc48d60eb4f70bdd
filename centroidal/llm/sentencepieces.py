"""SentencePiece encoding and decoding as shortest paths in a weighted finite-state transducer.

The model file is compiled into three machines: the normaliser (blank to U+2581 and a leading one),
the piece lexicon, and byte fallback for characters that the lexicon lacks. An input is composed with
them lazily into a lattice of arcs (start, end, piece, weight), and the path of least total weight
(tropical semiring: add along a path, take the minimum over paths) is the encoding.

For a unigram model an arc weighs minus the piece's score. A BPE model's merge order is not additive,
but its encodings form a regular language: a piece sequence is the encoding exactly when each
neighbouring pair is the encoding of that pair's own text. That acceptor of pairs is composed in as
weights 0 and infinity, so one finite path is left. Pairs are decided once, by merging their text.

Ids equal those of the SentencePiece library. Null text: null ids; empty text: no ids. Decoding
gives back the text, but for U+2581 itself, which the format cannot tell from a blank.

Texts are cut where two neighbouring characters stand side by side in no piece (between words, and
between letters and marks); no piece can span such a cut, so the cuts change nothing.
Encodings of cut-out chunks are kept in a cache of bounded size.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from centroidal.llm.frames import map_batches

BLANK = "▁"
CACHE_CHUNKS, CACHE_PAIRS, CACHE_CHARS = 200_000, 300_000, 64
#: An arc for an unknown character weighs this much more than the worst piece.
UNKNOWN_PENALTY = 10.0


class PieceTransducer:
    """A compiled SentencePiece model: ``encode`` and ``decode``."""

    def __init__(self, pieces: list[tuple[str, float, str]], bpe: bool, byte_ids: dict[int, int], unknown_id: int,
                 dummy_prefix: bool = True, squeeze: bool = False):
        """``pieces``: (text, score, kind) by id, where only kind ``normal`` matches text."""
        self.pieces, self.bpe, self.byte_ids, self.unknown_id = pieces, bpe, byte_ids, unknown_id
        self.dummy_prefix, self.squeeze = dummy_prefix, squeeze
        self.ids = {p: i for i, (p, _, kind) in reversed(list(enumerate(pieces))) if kind == "normal"}
        self.score = {p: pieces[i][1] for p, i in self.ids.items()}
        self.worst = -min(self.score.values(), default=0.0)
        self.cost = [0.0 if bpe else -x for _, x, _ in pieces]
        self.size = [len(p) for p, _, _ in pieces]
        self.trie: dict = {}  # character -> [next node, id of the piece that ends here or -1]
        for p, i in self.ids.items():
            node = self.trie
            for c in p[:-1]:
                node = node.setdefault(c, [{}, -1])[0]
            node.setdefault(p[-1], [{}, -1])[1] = i
        # Neighbouring characters that some piece contains; between others a text may be cut.
        self.inside = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.chunk = self._chunk_pattern()
        blob = {i: bytes([b]) for b, i in byte_ids.items()}
        self.blobs = [blob.get(i, p.replace(BLANK, " ").encode() if kind == "normal" else b"")
                      for i, (p, _, kind) in enumerate(pieces)]
        self._chunks: dict[str, tuple[int, ...]] = {}
        self._pairs: dict[int, bool] = {}
        self._runs: dict[int, list[tuple[float, str, str]] | None] = {}

    @classmethod
    def load(cls, path: str) -> PieceTransducer:
        """Compile a SentencePiece model file. Its own normalisation rules must be the identity."""
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        kinds = ["unknown" if sp.is_unknown(i) else "control" if sp.is_control(i) else "byte" if sp.is_byte(i)
                 else "unused" if sp.is_unused(i) else "normal" for i in range(n)]
        pieces = [(sp.id_to_piece(i), sp.get_score(i), k) for i, k in enumerate(kinds)]
        byte_ids = {int(p[1:-1], 16): i for i, (p, _, k) in enumerate(pieces) if k == "byte"}
        probe = "ﬁ x  ½"
        dummy, squeeze = "".join(sp.encode("x", out_type=str)).startswith(BLANK), "  " not in sp.decode(sp.encode(probe))
        if not squeeze and sp.decode(sp.encode(probe)) != probe:
            raise ValueError("only models whose normaliser is the identity are supported")
        # Scores of a BPE model are minus the rank of the merge, hence whole numbers.
        bpe = all(float(s).is_integer() for _, s, k in pieces if k == "normal")
        return cls(pieces, bpe, byte_ids, sp.unk_id(), dummy, squeeze)

    # --- normaliser -----------------------------------------------------------------------------

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        text = text.replace(" ", BLANK)
        return BLANK + text if text and self.dummy_prefix else text

    def _chunk_pattern(self) -> re.Pattern:
        """Chunks that no piece can span: characters are grouped by standing side by side in some piece,
        and a chunk is blanks and then a run of one group, or one character of none."""
        if any(a != BLANK and b == BLANK for a, b in self.inside):
            return re.compile("(?s).+")
        head: dict[str, str] = {}

        def group(c: str) -> str:
            while (up := head.setdefault(c, c)) != c:
                head[c] = c = head[up]
            return c

        for a, b in self.inside:
            if a != BLANK:
                head[group(a)] = group(b)
        members: dict[str, list[str]] = {}
        for c in head:
            members.setdefault(group(c), []).append(c)
        runs = "|".join(f"[{''.join(map(re.escape, sorted(m)))}]+" for m in sorted(members.values(), key=len, reverse=True))
        return re.compile(f"(?s){BLANK}*(?:{runs + '|' if runs else ''}[^{BLANK}])|{BLANK}+")

    # --- lattice --------------------------------------------------------------------------------

    def _run(self, piece: int) -> list[tuple[float, str, str]] | None:
        """How merging by score, leftmost first, builds a piece from its characters: after each merge
        (its score, the first part, the last part), from the end back; None if it ends otherwise."""
        if piece in self._runs:
            return self._runs[piece]
        parts = list(self.pieces[piece][0])
        run = [(0.0, parts[0], parts[-1])]
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = self.score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            run.append((best, parts[0], parts[-1]))
        self._runs[piece] = run if len(parts) == 1 else None
        return self._runs[piece]

    def _decide(self, left: int, right: int) -> bool:
        """Whether merging the text of two pieces ends in just these two. Up to the first merge across
        their border both sides merge as they do alone, each step the best of the two next ones."""
        a, b = self._run(left), self._run(right)
        if a is None or b is None:
            return False
        i = j = 0
        while True:
            across = self.score.get(a[i][2] + b[j][1])
            more_a, more_b = i + 1 < len(a), j + 1 < len(b)
            if more_a and (not more_b or a[i + 1][0] >= b[j + 1][0]):
                if across is not None and across > a[i + 1][0]:
                    return False
                i += 1
            elif more_b:
                if across is not None and across >= b[j + 1][0]:
                    return False
                j += 1
            else:
                return across is None

    def _joins(self, left: int, right: int) -> bool:
        """Whether the acceptor of pairs lets a piece follow ``left`` (negative: the start of the text or
        an unknown character, across which nothing merges)."""
        key = left * len(self.pieces) + right if left >= 0 else -1 - right
        ok = self._pairs.get(key)
        if ok is None:
            ok = self._decide(left, right) if left >= 0 else self._run(right) is not None
            if len(self._pairs) >= CACHE_PAIRS:
                self._pairs.clear()
            self._pairs[key] = ok
        return ok

    def _arcs(self, text: str, start: int) -> list[int]:
        """Pieces that match at ``start``, longest last; -2 first where the character is unknown."""
        out = [] if text[start] in self.ids else [-2]
        node = self.trie
        for k in range(start, len(text)):
            step = node.get(text[k])
            if step is None:
                break
            node, piece = step
            if piece >= 0:
                out.append(piece)
        return out

    def shortest_path(self, text: str) -> list[int | str]:
        """Piece ids, or unknown characters as they are, of the least path through the lattice of a
        normalised text."""
        return self._only_path(text) if self.bpe else self._least_path(text)

    def _least_path(self, text: str) -> list[int | str]:
        """Relaxation in text order, for additive weights."""
        n = len(text)
        weight = [0.0] + [float("inf")] * n
        last, back = [-1] * (n + 1), [0] * (n + 1)
        for start in range(n):
            for piece in self._arcs(text, start):
                end = start + (self.size[piece] if piece >= 0 else 1)
                w = weight[start] + (self.cost[piece] if piece >= 0 else self.worst + UNKNOWN_PENALTY)
                if w < weight[end]:
                    weight[end], last[end], back[end] = w, piece, start
        out, at = [], n
        while at:
            out.append(last[at] if last[at] >= 0 else text[at - 1])
            at = back[at]
        return out[::-1]

    def _only_path(self, text: str) -> list[int | str]:
        """With weights 0 and infinity the first path of finite weight is the least one: the lattice is
        expanded depth first, longest piece first. A prefix has one encoding, so a position that led
        nowhere once never will."""
        n, v, size, pairs = len(text), len(self.pieces), self.size, self._pairs
        dead: set[int] = set()
        path: list[int] = []
        at, left = 0, -1
        todo = [self._arcs(text, 0)] if n else []
        while at < n:
            arcs = todo[-1]
            if not arcs:
                dead.add(at)
                todo.pop()
                gone = path.pop()
                at -= size[gone] if gone >= 0 else 1
                left = path[-1] if path else -1
                continue
            piece = arcs.pop()
            if piece >= 0:
                end = at + size[piece]
                if end in dead:
                    continue
                ok = pairs.get(left * v + piece if left >= 0 else -1 - piece)
                if ok is None:
                    ok = self._joins(left, piece)
                if not ok:
                    continue
            else:
                end = at + 1
            path.append(piece)
            at, left = end, piece
            if at < n:
                todo.append(self._arcs(text, at))
        if -2 not in path:
            return path
        out, at = [], 0
        for p in path:
            out.append(p if p >= 0 else text[at])
            at += size[p] if p >= 0 else 1
        return out

    def _to_ids(self, path: list[int | str]) -> list[int]:
        out: list[int] = []
        for p in path:
            if isinstance(p, int):
                out.append(p)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in p.encode("utf-8", "replace")]
            else:
                out.append(self.unknown_id)
        return out

    def _chunk_ids(self, chunk: str) -> tuple[int, ...]:
        ids = self._chunks.get(chunk)
        if ids is not None:
            return ids
        cuts = [k for k in range(1, len(chunk)) if chunk[k - 1:k + 1] not in self.inside]
        if cuts:
            parts = [chunk[a:b] for a, b in zip([0, *cuts], [*cuts, len(chunk)])]
            ids = tuple(i for part in parts for i in self._chunk_ids(part))
        else:
            ids = tuple(self._to_ids(self.shortest_path(chunk)))
        if len(chunk) <= CACHE_CHARS:
            if len(self._chunks) >= CACHE_CHUNKS:
                self._chunks.clear()
            self._chunks[chunk] = ids
        return ids

    def encode(self, text: str | None) -> list[int] | None:
        """Ids of a text; None for None."""
        if text is None:
            return None
        known, out = self._chunks, []
        for chunk in self.chunk.findall(self.normalise(text)):
            out += known.get(chunk) or self._chunk_ids(chunk)
        if not self.byte_ids:  # a run of unknown characters is one unknown piece
            out = [i for k, i in enumerate(out) if i != self.unknown_id or not k or out[k - 1] != i]
        return out

    def decode(self, ids) -> str | None:
        """Text of ids; None for None. Bytes that are not UTF-8 become U+FFFD."""
        if ids is None:
            return None
        blobs = self.blobs
        text = b"".join([blobs[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


@cache
def _loaded(path: str) -> PieceTransducer:
    return PieceTransducer.load(path)


def shipped(spark, model_path: str) -> str:
    """Make the model file (a local path on the driver, under 10 MB) known to all executors; returns
    the name to hand to :func:`transducer`."""
    spark.sparkContext.addFile(model_path)
    return model_path.rpartition("/")[2]


def transducer(name: str) -> PieceTransducer:
    """The compiled model in this Python process (compiled once)."""
    return _loaded(SparkFiles.get(name))


def encode_texts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids array<int>, n_tokens long, n_chars long, round_trip boolean`` of every whole text,
    one row per input row. ``round_trip``: decoding the ids gives the text (with U+2581 read as a
    blank). Null text: null ids, 0 tokens, 0 characters, a true round trip."""
    kept = docs.select(id_col, text_col)
    name = shipped(docs.sparkSession, model_path)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        t = transducer(name)
        texts = b.column(1).to_pylist()
        ids, lengths, back = [], [], []
        for text in texts:
            got = t.encode(text)
            back.append(t.decode(got) == (text and text.replace(BLANK, " ")))
            ids.append(np.asarray(got or (), dtype=np.int32))
            lengths.append(len(got or ()))
        missing = np.array([x is None for x in texts])
        ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends, mask=np.append(missing, False)) if missing.any() else ends,
                                         np.concatenate(ids))
        return pa.RecordBatch.from_arrays(
            [b.column(0), lists, pa.array(lengths, pa.int64()), pa.array([len(x or "") for x in texts], pa.int64()),
             pa.array(back)], names=[id_col, "ids", "n_tokens", "n_chars", "round_trip"])

    return map_batches(kept, batch, f"`{id_col}` {kept.schema[0].dataType.simpleString()}, ids array<int>, "
                                    "n_tokens long, n_chars long, round_trip boolean")


def decode_ids(tokens: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, text`` from rows of ids (null for null)."""
    kept = tokens.select(id_col, ids_col)
    name = shipped(tokens.sparkSession, model_path)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        t = transducer(name)
        return pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([t.decode(x) for x in b.column(1).to_pylist()], pa.string())], names=[id_col, "text"])

    return map_batches(kept, batch, f"`{id_col}` {kept.schema[0].dataType.simpleString()}, text string")
