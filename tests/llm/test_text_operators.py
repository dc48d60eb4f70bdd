"""Licence scans, personal data, language ID, quality and SentencePiece against brute force, the
contract's own patterns, the public library and held-out rows."""

import hashlib
import math
import random
import re

import numpy as np
import pytest

from centroidal.llm import language, licences, pii, quality
from centroidal.llm.frames import crc_mod, scan_words, table
from centroidal.llm.registry import MODEL_PATH, op5_language, op10_quality
from centroidal.llm.sentencepieces import BLANK, PieceTransducer, decode_ids, encode_texts

SF = "/root/testdata/sf0.001"
EDGE = [None, "", " ", "\n\t", "x", "ünï", "a" * 200_000, "1 " * 50_000, "\x00\x01", "<|im_end|>", "same text", "same text"]


@pytest.fixture(scope="module")
def edge_docs(spark):
    rows = [(i if i != 3 else None, t, "e", 1.0, "z") for i, t in enumerate(EDGE)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, n_words string")


# --- licences ---------------------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_scan_words_follow_the_pattern():
    rnd = random.Random(1)
    for _ in range(300):
        t = "".join(rnd.choice("aBZ09 .-_é日İK\n\x7f\x80{") for _ in range(30))
        assert [w.decode() for w in scan_words(t.encode())] == WORD.findall(lowered(t))


def brute_base(text):
    words = WORD.findall(lowered(text))
    places = [(k, label) for p, label in licences.BASE_PHRASES.items() for k in range(len(words))
              if words[k:k + p.count(" ") + 1] == p.split()]
    starts = [k for k, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_base_places_equal_brute_force():
    rnd = random.Random(2)
    parts = ["CC BY", "cc", "by", "general", "General Public License", "all rights", "reserved", "é", ",", "x-y", "\n", "cc.by"]
    for _ in range(400):
        t = " ".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))
        assert licences.scan(t.encode())[:5] == brute_base(t)


@pytest.mark.parametrize("text,postfix,grade", [
    ("MIT OR Apache-2.0", ["mit", "apache-2.0", "or"], 0),
    ("GPL-2.0-only AND (MIT OR GPL-3.0)", ["gpl-2.0-only", "mit", "gpl-3.0", "or", "and"], 2),
    ("MIT OR GPL-2.0 AND LGPL-2.1", ["mit", "gpl-2.0", "lgpl-2.1", "and", "or"], 0),
    ("GPL-2.0 WITH Classpath-exception-2.0 AND MIT", ["gpl-2.0", "classpath-exception-2.0", "with", "mit", "and"], 1),
    ("((MIT)) trailing words", ["mit"], 0),
    ("MIT OR\nApache-2.0", ["mit"], 0),
    ("MIT AND (OR", ["mit"], 0),
    ("GPL-2.0+ OR LGPL-2.1+", ["gpl-2.0-or-later", "lgpl-2.1-or-later", "or"], 1),
    ("Apache-2.0+ AND other+", ["apache-2.0", "other", "and"], 3),
])
def test_expressions(text, postfix, grade):
    ids, got = licences.parse_expression(text)
    assert got == postfix and licences.restricts(got) == grade


def test_expression_tags_and_labels():
    row = licences.scan(b"# SPDX-License-Identifier: (MIT OR GPL-3.0)\nLicense: unknown words\nlicence: isc")
    assert row[5] == "gpl-3.0,isc,mit" and row[7] == ["isc", "mit gpl-3.0 or"] and row[8] == "permissive" and 0.9 < row[6] <= 1
    assert licences.parse_expression("AND MIT") is None and licences.parse_expression("") is None


def test_scan_licences_keeps_every_row(edge_docs):
    rows = {r["doc_id"]: r for r in licences.scan_licences(edge_docs).collect()}
    assert len(rows) == len(EDGE) and rows[0]["n_words"] == 0 and rows[7]["n_words"] == 50_000 and rows[1]["score"] == 0


# --- personal data ----------------------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(t):
    n = lambda m: sum(c in "0123456789" for c in m[0])
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(t)
            if 12 <= n(m) <= 19 and pii.luhn("".join(c for c in m[0] if c.isdigit()))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 9 <= n(m) <= 15]
    return sorted(out)


def test_base_spans_equal_the_contract_patterns():
    rnd = random.Random(3)
    good = ["a.b@c.d", "x@y", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (988) 555-2485",
            "+1", "@", ".", "1", "22", "-", " ", "+", "(", "a", "é", "@b.co", "00001.2.3.4.5.6.7.8", "6044423740532315"]
    for _ in range(4000):
        t = "".join(rnd.choice(good) for _ in range(rnd.randint(0, 12)))
        assert [s for s in pii.find_spans(t) if s[1] < 4] == brute_spans(t), t


def test_added_spans_context_and_redaction():
    t = "IBAN DE89 3704 0044 0532 0130 00, ssn 078-05-1120; no 078-05-1121"
    assert [pii.KINDS[k] for _, k, _ in pii.find_spans(t)] == ["iban", "ssn", "ssn"] or \
        [pii.KINDS[k] for _, k, _ in pii.find_spans(t)] == ["iban", "ssn"]
    for text in ("IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX", "DE89370400440532013000 VISA", "NO9386011117947 X"):
        assert [text[a:b].replace(" ", "")[:4] for a, k, b in pii.find_spans(text) if k == 4] in (["DE89"], ["NO93"]), text
    assert [k for _, k, _ in pii.find_spans("DE893704004405320130001")] == []
    assert pii.find_spans("part 078-05-1120") == [] and pii.find_spans("DE88 3704 0044 0532 0130 00") == []
    s = pii.find_spans("call +1 (988) 555-2485")[0]
    assert pii.span_score("call +1 (988) 555-2485", *s) > pii.span_score("+1 (988) 555-2485", 0, 3, 17)
    assert pii.redact("to a.b@c.de and 1.2.3.4!") == "to [EMAIL] and [IP]!" and pii.redact(None) is None
    assert pii.find_spans("a" * 300_000 + "@") == [] and pii.find_spans("1" * 300_000) == []


def test_pii_rows_and_redacted_docs(edge_docs):
    rows = pii.pii_spans(edge_docs).collect()
    assert len(rows) == len(EDGE) and all(r["base_sha256"] == hashlib.sha256(b"").hexdigest() for r in rows)
    out = pii.redact_docs(edge_docs)
    assert out.schema == edge_docs.schema and sorted(map(str, out.collect())) == sorted(map(str, edge_docs.collect()))
    assert pii.pii_spans(edge_docs.limit(0)).count() == 0


# --- language ---------------------------------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    out = op5_language(spark, "/root/testdata/sf0.01").join(table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang"), "doc_id")
    held = out.filter("held_out").collect()
    assert len(held) > 200 and sum(r["lang"] == r["lang_pred"] for r in held) / len(held) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in held)


def test_bloom_filters_return_all_languages_of_a_gram():
    rng = np.random.default_rng(4)
    grams = rng.integers(1, 2**32, 5000).astype(np.uint64)
    for n in (3, 12, 70):  # one byte, one word and two words of bits
        langs = [f"l{k:02d}" for k in range(n)]
        of = rng.integers(0, n, 5000)
        f = language.LanguageFilters.build(langs, grams, of, 0)
        where = f._positions(grams, f.bits)
        width = f.tables[0].dtype.itemsize * 8
        for k in range(n):
            t = f.tables[k // width]
            mask = t[where[0]] & t[where[1]] & t[where[2]]
            has = (mask >> mask.dtype.type(k % width)) & mask.dtype.type(1) == 1
            assert has[of == k].all() and has[of != k].mean() < 0.02


def test_counts_equal_brute_force_over_pieces(monkeypatch):
    rng = random.Random(5)
    texts = [language.letters("".join(rng.choice("abc ") for _ in range(rng.choice([0, 1, 5, 90, 400])))) for _ in range(30)]
    known = np.unique(np.concatenate([language.grams(np.frombuffer(t, np.uint8), n) for t in texts[:9] for n in language.SIZES]))
    f = language.LanguageFilters.build(["a", "b"], known, np.zeros(len(known), int), 0)
    whole = f.counts(texts)
    monkeypatch.setattr(language, "PIECE", 64)
    cut = f.counts(texts)
    assert np.array_equal(whole[0], cut[0]) and np.array_equal(whole[1], cut[1])
    for t, found, total in zip(texts, *whole):
        x = [language.grams(np.frombuffer(t, np.uint8), n) for n in language.SIZES] if t else []
        assert total == sum(map(len, x)) and found[0] >= sum(np.isin(g, known).sum() for g in x)


def test_language_edges(spark, edge_docs):
    model = language.fit_languages(edge_docs)
    rows = {r["doc_id"]: r for r in language.identify_languages(edge_docs, model).collect()}
    assert len(rows) == len(EDGE) and {rows[i]["lang_pred"] for i in (0, 1, 2, 7, 8)} == {"und"} and rows[4]["lang_pred"] == "e"
    none = language.fit_languages(edge_docs.limit(0))
    assert none is None and {r["lang_pred"] for r in language.identify_languages(edge_docs, none).collect()} == {"und"}
    kept = language.keep_known_languages(edge_docs, model)
    ids = {r["doc_id"] for r in kept.collect()}
    assert kept.schema == edge_docs.schema and 6 in ids and not ids & {0, 1, 2, None, 7, 8}
    assert {r["doc_id"] for r in language.keep_known_languages(edge_docs, None).collect()} == {4, 5, 6, 9, 10, 11}


def test_many_languages(spark):
    rows = [(i, f"word{chr(97 + i % 26)} und so weiter {i}", f"l{i % 2500:04d}") for i in range(5000)]
    model = language.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.langs) == 2500 and model.default == 0


# --- quality ----------------------------------------------------------------------------------------

def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.1"
    out = op10_quality(spark, sf).join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id").filter("held_out").collect()
    right = sum((r["predicted"] == 1) == (r["quality"] == 1) for r in out) / len(out)
    bad = [r for r in out if r["quality"] == 0]
    assert right >= 0.97 and sum(r["predicted"] == 0 for r in bad) / len(bad) >= 0.9


def test_prior_and_training_on_known_mixtures():
    rng = np.random.default_rng(6)

    def draw(n, centre):
        return np.clip(rng.normal(centre, 0.08, (n, quality.N_BASE)), 0, 1)
    for prior in (0.3, 0.7):
        n = 4000
        u = np.vstack([draw(int(n * prior), 0.6), draw(n - int(n * prior), 0.4)])
        model = quality.train_pu(draw(3000, 0.6), lambda f, *args: f(u[:1000], *args) + f(u[1000:], *args))
        assert abs(model.prior - prior) < 0.1
        assert (model.scores(draw(500, 0.6)) >= 0.3).mean() > 0.95 and (model.scores(draw(500, 0.4)) >= 0.3).mean() < 0.05


def test_training_minimises_the_non_negative_risk():
    """Against plain gradient descent on the same risk, and against changes of the weights."""
    rng = np.random.default_rng(8)
    p, u = rng.normal(0.55, 0.2, (400, quality.N_BASE)), rng.normal(0.45, 0.2, (1500, quality.N_BASE))
    u[:600] += 0.1
    prior, k = 0.4, quality.N_FEATURES
    model = quality.train_pu(p, lambda f, *args: f(u, *args), prior)
    xp, xu = (quality.standardised(x, model.mean, model.scale) for x in (p, u))

    def risk(w):
        negative = np.logaddexp(0, xu @ w).mean() - prior * np.logaddexp(0, xp @ w).mean()
        return prior * np.logaddexp(0, -xp @ w).mean() + max(0.0, negative) + quality.DECAY / 2 * w[:k] @ w[:k], negative

    found = np.append(model.weights, model.bias)
    w = np.zeros(k + 1)
    for _ in range(4000):
        su = 1 / (1 + np.exp(-xu @ w))
        w -= 0.5 * (su @ xu / len(xu) - prior * xp.mean(0) + quality.DECAY * np.append(w[:k], 0.0))
        if risk(w)[1] < 0:
            break
    assert risk(found)[1] >= 0 and risk(found)[0] <= risk(w)[0] + 1e-6
    for _ in range(200):
        assert risk(found + rng.normal(0, 0.05, k + 1))[0] >= risk(found)[0] - 1e-6


def test_unlabelled_sums_cover_every_row(spark):
    rows = [(i, f"word{i % 7} " * (i % 11) + "!" * (i % 3)) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    base = np.array([quality.features(t) for _, t in rows])
    total = quality._summed(quality.map_batches(df.select("text"), quality._feature_batch, "x array<double>"))
    mean, scale, w = np.zeros(quality.N_FEATURES), np.ones(quality.N_FEATURES), np.linspace(-1, 1, quality.N_FEATURES + 1)
    assert np.allclose(total(quality.moment_sums), quality.moment_sums(base))
    assert np.allclose(total(quality.risk_sums, mean, scale, w), quality.risk_sums(base, mean, scale, w))
    t = np.linspace(-2, 2, 9)
    assert (total(quality.tail_counts, mean, scale, w, t) == quality.tail_counts(base, mean, scale, w, t)).all()


def test_quality_edges(spark, edge_docs):
    labels = spark.createDataFrame([(4, 1), (4, 1), (5, 0), (None, 1)], "doc_id long, quality int")
    model = quality.fit_quality(edge_docs, labels)
    rows = quality.score_quality(edge_docs, model).collect()
    assert len(rows) == len(EDGE) and all(math.isfinite(r["score"]) and 0 <= r["score"] <= 1 for r in rows)
    constant = quality.fit_quality(edge_docs, labels.limit(0))
    assert {r["score"] for r in quality.score_quality(edge_docs, constant).collect()} == {0.5}


# --- SentencePiece ----------------------------------------------------------------------------------

def test_ids_equal_the_library(spark):
    import sentencepiece

    ours, lib = PieceTransducer.load(MODEL_PATH), sentencepiece.SentencePieceProcessor(model_file=MODEL_PATH)
    rnd = random.Random(7)
    texts = ["", " ", "  lead", "a\tb\nc", "é 日本 😀", "▁a", "<s></s><0x0A>", "\x00", "aaaa" * 50, "....!!!", "ﬁ½", "x" * 3000]
    texts += ["".join(rnd.choice("abcdehilnorst .,\n!▁<>0日é") for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    texts += [r["text"] for r in table(spark, SF, "documents").select("text").collect()]
    for t in texts:
        ids = ours.encode(t)
        assert ids == lib.encode(t) and ours.decode(ids) == t.replace(BLANK, " ")


def test_unigram_weights_take_the_least_path():
    pieces = [("<unk>", 0.0, "unknown"), ("a", -1.5, "normal"), ("b", -1.2, "normal"), ("ab", -2.0, "normal"),
              ("aba", -3.1, "normal"), ("ba", -2.2, "normal"), (BLANK, -0.5, "normal")]
    t = PieceTransducer(pieces, bpe=False, byte_ids={}, unknown_id=0)

    def brute(s):
        if not s:
            return 0.0, []
        return min(((w - sc, [p, *rest]) for p, sc, k in pieces if k == "normal" and s.startswith(p)
                    for w, rest in [brute(s[len(p):])]), key=lambda x: x[0])
    rnd = random.Random(8)
    for _ in range(200):
        s = BLANK + "".join(rnd.choice("ab") for _ in range(rnd.randint(1, 9)))
        path = [pieces[i] for i in t.shortest_path(s)]
        assert "".join(p for p, _, _ in path) == s and math.isclose(-sum(x for _, x, _ in path), brute(s)[0])
    assert t.encode("azzb") == [6, 1, 0, 2]


def test_encode_and_decode_frames(edge_docs):
    out = encode_texts(edge_docs, MODEL_PATH)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert len(rows) == len(EDGE) and all(r["round_trip"] for r in rows.values())
    assert rows[0]["ids"] is None and rows[1]["ids"] == [] and rows[0]["n_tokens"] == 0
    back = {r["doc_id"]: r["text"] for r in decode_ids(out, MODEL_PATH).collect()}
    assert back == {i if i != 3 else None: t for i, t in enumerate(EDGE)}


def test_held_out_rows_are_those_of_the_contract(spark):
    import zlib
    docs = table(spark, SF, "documents").select("doc_id", crc_mod("doc_id", 4).alias("m")).collect()
    assert all(r["m"] == zlib.crc32(str(r["doc_id"]).encode()) % 4 for r in docs)
