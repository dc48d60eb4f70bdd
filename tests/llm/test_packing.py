"""Packing: the pieces against the tokenizer's own ids, exact sequences, balance, odd inputs."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from centroidal.llm import registry
from centroidal.llm.packing import WordEncoder, cut_powers, pack, pack_documents, step_groups

TOKENIZER = Tokenizer.from_file(registry.PACK_TOKENIZER)
ENCODER = WordEncoder(registry.PACK_TOKENIZER)


def brute_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [registry.PACK_END]


def check_pieces(rows, want, tiers):
    """``rows``: (document, start, length, ids, doc_tokens, sequence, offset); every id once, every sequence gapless."""
    by_doc, by_sequence = {}, {}
    for doc, start, n, ids, tokens, sequence, offset in rows:
        assert n > 0 and len(ids) == n
        by_doc.setdefault(doc, []).append((start, ids, tokens))
        by_sequence.setdefault(sequence, []).append((offset, n))
    assert by_doc.keys() == want.keys()
    for doc, parts in by_doc.items():
        ids = []
        for start, part, tokens in sorted(parts):
            assert start == len(ids) and tokens == len(want[doc])
            ids += part
        assert ids == want[doc]
    odd = 0
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= tiers[-1] and at & (at - 1) == 0
        odd += at not in tiers
    return odd


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.characters(min_codepoint=0x20, max_codepoint=0xFF), st.sampled_from("abcXYZ'st \n\t<|>éÉßµªº²0́̈İΣ­")), max_size=60))
def test_encoder_equals_the_tokenizer(text):
    assert np.frombuffer(ENCODER(text), "<u4").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_encoder_knows_special_ids_and_long_words():
    for text in ("a<|endoftext|>b <|startoftext|>", "x" * 5000, "It's we'LL", "日本語" * 300):
        assert np.frombuffer(ENCODER(text), "<u4").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_pack_fills_every_window(sizes):
    tiers = (4, 8, 16, 32)
    full, left = pack([(k, 0, n) for k, n in enumerate(sizes)], tiers)
    assert all(sum(n for _, _, n in s) in tiers for s in full) and sum(n for _, _, n in left) < 32
    every = [piece for s in full + cut_powers(left) for piece in s]
    cells = sorted((doc, start + k) for doc, start, n in every for k in range(n))
    assert cells == [(k, j) for k, n in enumerate(sizes) for j in range(n)]
    lengths = [sum(n for _, _, n in s) for s in cut_powers(left)]
    assert all(n & (n - 1) == 0 for n in lengths) and lengths == sorted(set(lengths), reverse=True)


def test_documents_that_fit_are_not_cut():
    full, left = pack([(0, 0, 20), (1, 0, 9), (2, 0, 3), (3, 0, 17)], (4, 8, 16, 32))
    assert full[0] == [(0, 0, 20), (1, 0, 9), (2, 0, 3)] and left == [(3, 0, 17)]


def test_step_groups_have_equal_shapes_and_cost():
    rng = np.random.default_rng(0)
    sequences = [[(k, 0, int(c)), (k, int(c), 64 - int(c))] for k, c in enumerate(rng.integers(1, 64, 64))] + [[(99, 0, 32)]] * 7
    groups = step_groups(sequences, step_tokens=512)
    cost = {}
    for s, g in zip(sequences, groups):
        length = sum(n for _, _, n in s)
        n, total = cost.get((g, length), (0, 0))
        cost[g, length] = n + 1, total + sum(n * n for _, _, n in s)
    assert len({g for g, _ in cost}) == len(cost)  # one length a group
    long = [v for (_, length), v in cost.items() if length == 64]
    assert {n for n, _ in long} == {8} and max(c for _, c in long) < 1.05 * min(c for _, c in long)


def test_pack_documents_equals_brute_force(spark):
    texts = {1: "short one", 2: None, 3: "", 4: "word soup " * 900, 5: "Étude ça; 12 <|endoftext|>" * 40, 6: "same text", 7: "same text"}
    rows = [(k, t, "x", 1) for k, t in texts.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string, ids int").repartition(2)
    tiers = (16, 32, 64)
    got = pack_documents(df, registry.PACK_TOKENIZER, registry.PACK_END, tiers=tiers, unit_tokens=300).collect()
    assert check_pieces([(r["id"], r["start"], r["length"], np.frombuffer(r["ids"], "<u4").tolist(), r["doc_tokens"], r["sequence_id"], r["offset"])
                         for r in got], {k: brute_ids(t) for k, t in texts.items()}, tiers) <= 2 * 6
    assert all(r["tier"] == sum(q["length"] for q in got if q["sequence_id"] == r["sequence_id"]) for r in got)
    assert len({(r["step_group"], r["tier"]) for r in got}) == len({r["step_group"] for r in got})
    again = pack_documents(df.filter("doc_id in (6, 7) or doc_id is null").union(spark.createDataFrame([(None, "a", "x", 1)] * 2, df.schema)).coalesce(1),
                           registry.PACK_TOKENIZER, registry.PACK_END).collect()
    assert sorted([r["id"] for r in again if r["start"] == 0], key=str) == [6, 7, None, None]
    assert pack_documents(df.limit(0), registry.PACK_TOKENIZER, registry.PACK_END).count() == 0
    with pytest.raises(ValueError):
        pack_documents(df, registry.PACK_TOKENIZER, 2, tiers=(3, 8))


def test_op13_covers_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = registry.op13_packing(spark, "/root/testdata/sf0.001").collect()
    ids = {r["doc_id"]: brute_ids(r["text"]) for r in docs.collect()}
    for r in got:
        part = np.array(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]], "<u4").tobytes()
        assert r["ids_crc32"] == zlib.crc32(part)
    assert check_pieces([(r["doc_id"], r["start"], r["length"], ids[r["doc_id"]][r["start"]:r["start"] + r["length"]], r["doc_tokens"],
                          r["sequence_id"], r["offset"]) for r in got], ids, (512, 1024, 2048, 4096)) <= 12 * docs.rdd.getNumPartitions()
