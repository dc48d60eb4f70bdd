"""Prefix trie: nodes against brute force over all prefixes, with many small blocks and odd inputs."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from centroidal.llm import registry
from centroidal.llm.trie import FAR, SparseTable, falls, prefix_trie, shared_tokens, turn_sequences, with_borrowed_heads

FIELDS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute_trie(sequences):
    """``sequences``: id -> list of (token, size). Rows of FIELDS, from the definition."""
    members = {}
    for c, seq in sequences.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    below = {node: [node] for node in members}
    for node in sorted(members, key=len, reverse=True):
        if node:
            below[node[:-1]] += below[node]
    rows = set()
    for node, convs in members.items():
        ends = sorted(c for c in convs if len(sequences[c]) == len(node))
        rows.add((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children.get(node, [])),
                  sum(1 for v in below[node] if v not in children), sum((len(members[v]) - 1) * (v[-1][1] if v else 0) for v in below[node]),
                  hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return rows


def brute_rebuilt(turns):
    """The contract's conversations from (conv_id, turn, role, text) rows, ties by token as the operator has them."""
    own = {}
    for c, turn, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            token = hashlib.sha256(f"{len(role.encode())}:{role}:{text}".encode()).hexdigest()[:32]
            own.setdefault(c, []).append(((turn is not None, turn or 0), token, len(text.encode())))
    own = {c: [t[1:] for t in sorted(rows)] for c, rows in own.items()}
    out = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + seq[h:]
    return out


def as_frame(spark, sequences):
    rows = [(c, [(k, hashlib.sha256(t.encode()).hexdigest()[:32], n) for k, (t, n) in enumerate(seq)]) for c, seq in sequences.items()]
    return spark.createDataFrame(rows, "id long, tokens array<struct<turn: long, token: string, size: int>>")


def result(df):
    return [(r["id"], r["depth"], r["parent_id"], r["n_members"], r["n_children"], r["n_leaves"], r["saved_bytes"], r["ends_sha256"])
            for r in df.collect()]


def test_sparse_table_equals_loops():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 7, 64, 100):
        v = rng.integers(0, 6, n)
        t = SparseTable(v)
        for _ in range(60):
            a, b = sorted(rng.integers(0, n + 1, 2))
            d = int(rng.integers(0, 8))
            assert t.least(np.array([a]), np.array([b]))[0] == (v[a:b].min() if b > a else FAR)
            assert t.first_below(np.array([a]), np.array([d]))[0] == next((i for i in range(a, n) if v[i] < d), n)
            assert t.last_below(np.array([b - 1]), np.array([d]))[0] == next((i for i in range(b - 1, -1, -1) if v[i] < d), -1)
    assert falls(np.array([3, 3, 1, 2, 0, 0])).tolist() == [0, 2, 4]
    assert shared_tokens(b"a" * 32, b"a" * 16 + b"b" * 16) == 1 and shared_tokens(b"", b"a" * 16) == 0 and shared_tokens(b"a" * 16, b"a" * 48) == 1


@pytest.mark.parametrize("seed", range(3))
def test_trie_equals_brute_force_over_many_blocks(spark, seed):
    rng = random.Random(seed)
    sequences, size = {}, {w: rng.randrange(0, 30) for w in "abc"}
    for c in rng.sample(range(-50, 1000), 240):
        seq = [(w, size[w]) for w in rng.choices("abc", weights=(8, 1, 1), k=rng.choice((0, 1, 2, 3, 3, 5, 9)))]
        sequences[c] = seq
    sequences |= {2000 + k: [("a", size["a"])] * 4 for k in range(90)}  # a large group of copies
    sequences |= {3000 + k: [("a", size["a"])] * (40 - k) for k in range(5)}
    want = brute_trie(sequences)
    got = result(prefix_trie(as_frame(spark, sequences), block_turns=40))
    assert len(got) == len(want) and set(got) == want
    assert set(result(prefix_trie(as_frame(spark, sequences)))) == want


def test_trie_of_turnless_and_single_sequences(spark):
    for sequences in ({5: []}, {5: [], 3: [], 9: []}, {7: [("a", 2)]}, {1: [("a", 0)], 2: [("a", 0)], 3: []}):
        assert sorted(result(prefix_trie(as_frame(spark, sequences), block_turns=1)), key=str) == sorted(brute_trie(sequences), key=str)
    assert prefix_trie(as_frame(spark, {1: []}).limit(0)).count() == 0


def test_sequences_of_odd_rows(spark):
    rows = [(1, 2, "user", "b"), (1, None, None, None), (1, 2, "user", "b"), (1, 1, "user", "é"), (None, 1, "user", "lost"), (2, 1, "us", "er:x"),
            (3, 1, "user", ":x"), (4, 1, "", "x" * 100_000)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn int, role string, text string, tokens string")
    got = {r["id"]: [(t["token"], t["size"]) for t in r["tokens"]] for r in turn_sequences(df).collect()}
    assert [n for _, n in got[1]] == [0, 2, 1, 1] and got[1][2] == got[1][3] and got[2][0] != got[3][0] and len(got) == 4
    assert got[4][0][1] == 100_000


def test_borrowed_heads(spark):
    sequences = {0: [("a", 1), ("b", 1)], 1: [("c", 1)], 2: [("d", 1), ("e", 1), ("f", 1)], 7: [("g", 1), ("h", 1)]}
    def rebuilt(h):
        df = with_borrowed_heads(as_frame(spark, sequences), F.col("id") - F.col("id") % 5, F.lit(h), 8)
        names = {hashlib.sha256(w.encode()).hexdigest()[:32]: w for w in "abcdefgh"}
        return {r["id"]: "".join(names[t["token"]] for t in r["tokens"]) for r in df.collect()}
    assert rebuilt(0) == {0: "ab", 1: "c", 2: "def", 7: "gh"}
    assert rebuilt(1) == {0: "ab", 1: "a", 2: "aef", 7: "h"}
    assert rebuilt(3) == {0: "ab", 1: "ab", 2: "ab", 7: ""}


def test_op12_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    turns = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = [tuple(r[f] for f in FIELDS) for r in registry.op12_prefix_trie(spark, sf).collect()]
    want = brute_trie(brute_rebuilt(turns))
    assert len(got) == len(want) and set(got) == want
