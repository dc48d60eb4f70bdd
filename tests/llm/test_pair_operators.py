"""Jaccard join, decontamination and embedding near-duplicates against brute force."""

import random
import time
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from centroidal.llm import decontaminate as D
from centroidal.llm import embeddings as V
from centroidal.llm import jaccard as J
from centroidal.llm.components import components
from centroidal.llm.frames import scan_words, table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def least_reached(nodes, links):
    head = {n: n for n in nodes}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        head[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rnd = random.Random(1)
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(30)] + [(7, 7), (3, 4), (3, 4)]
    links += [(rnd.randint(200, 300), rnd.randint(200, 300)) for _ in range(60)]
    nodes = {n for pair in links for n in pair}
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == least_reached(nodes, links)
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


# --- Jaccard ----------------------------------------------------------------------------------------

def word_sets(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows):
    sets = {i: word_sets(t) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return least_reached(ids, links), sets


def planted(rnd):
    """Chains and stars of near copies, short texts, shared passages and copies in other case or spacing."""
    texts = [None, "", " \n", "One two", "one  TWO", "one two three four five", "one two three four five six"]
    common = [f"c{k}" for k in range(30)]
    for g in range(6):
        base = [f"g{g}w{k}" for k in range(60)]
        for _ in range(12):
            own = list(base)
            for _ in range(rnd.choice([0, 1, 1, 2, 3])):
                own[rnd.randrange(60)] = f"x{rnd.randrange(10 ** 6)}"
            texts.append(" ".join(own + rnd.choice([[], ["tail"], common])))
    texts += [" ".join(common + [f"u{k}"] * 3) for k in range(25)]
    texts += ["\t".join(common).upper()] * 9
    return texts


def test_jaccard_equals_brute_force(spark):
    rows = list(enumerate(planted(random.Random(2))))
    comps, sets = brute_components(rows)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, s string, n int").repartition(3)
    got = J.jaccard_components(df).collect()
    assert {r["id"]: r["component"] for r in got} == comps
    assert {r["id"]: r["n"] for r in got} == {i: len(s) for i, s in sets.items()}
    assert len(set(comps.values())) < len(rows) - 60  # there is something to find


@pytest.mark.parametrize("block,tokens", [(512, 1 << 20), (5, 1 << 20), (100, 300)])
def test_links_are_counted_in_full(spark, monkeypatch, block, tokens):
    monkeypatch.setattr(J, "LINK_TOKENS", 64)
    rows = list(enumerate(planted(random.Random(3))))
    sets = {i: word_sets(t) for i, t in rows}
    want = {i: sum(1 for j, b in sets.items() if i != j and a and b and 100 * len(a & b) >= 80 * len(a | b)) for i, a in sets.items()}
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, s string, copies int").repartition(3)
    got = J.jaccard_components(df, count_links=True, link_block=block, link_block_tokens=tokens).collect()
    assert {r["id"]: r["n_links"] for r in got} == want and sum(want.values()) > 400
    assert J.jaccard_components(df.limit(0), count_links=True).count() == 0


def test_jaccard_on_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    comps, sets = brute_components([(r["doc_id"], r["text"]) for r in docs.filter("doc_id < 400").collect()])
    got = {r["id"]: r["component"] for r in J.jaccard_components(docs.filter("doc_id < 400")).collect()}
    assert got == comps


def test_prefixes_of_linked_sets_meet_under_every_order():
    rng = np.random.default_rng(3)
    classes = rng.integers(0, 5, 1 << J.CELL_BITS).astype(np.uint8)
    for n in (1, 2, 5, 9, 40, 100):
        x = rng.integers(0, 2**63, n).astype(np.uint64)
        gone = int(n * 0.2)
        y = np.unique(np.concatenate([x[gone:], rng.integers(0, 2**63, 0).astype(np.uint64)]))
        x = np.unique(x)
        both = len(np.intersect1d(x, y))
        if 100 * both >= 80 * (len(x) + len(y) - both):
            for seed in J.ORDERS:
                assert np.isin(J.prefix(x, classes, seed), J.prefix(y, classes, seed)).any()


def test_keep_one_of_each(spark):
    long = " ".join(f"w{k}" for k in range(50))
    near = long.replace("w3 ", "other ")
    rows = [(1, near), (2, long), (2, long), (2, "not the same text at all here"), (None, long), (None, "alone with no id at all"),
            (3, None), (4, ""), (None, None), (None, "alone with no id at all")]
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, row_key int")
    kept = J.keep_one_of_each(df)
    assert kept.schema == df.schema
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [(1, near), (2, "not the same text at all here"), (None, "alone with no id at all"), (3, None), (4, ""), (None, None)], key=str)
    assert J.keep_one_of_each(df.limit(0)).count() == 0


# --- decontamination --------------------------------------------------------------------------------

def brute_hits(docs, items, window):
    wins = [(i, [w[k:k + window] for k in range(max(1, len(w) - window + 1))]) for i, t in items if (w := scan_words(t))]
    out = []
    for t in docs:
        w, hit, found = scan_words(t or b""), set(), set()
        for i, ws in wins:
            for x in ws:
                for k in range(len(w) - len(x) + 1):
                    if w[k:k + len(x)] == x:
                        hit.update(range(k, k + len(x)))
                        found.add(i)
        out.append((len(w), len(hit), sorted(found)))
    return out


def brute_longest(docs, items):
    """The longest run of words of a document that some item holds: (words, start, item), the first and least on ties."""
    out = []
    for t in docs:
        w, best = scan_words(t or b""), (0, None, None)
        for i, text in items:
            v = scan_words(text)
            for a in range(len(w)):
                for b in range(len(v)):
                    n = 0
                    while a + n < len(w) and b + n < len(v) and w[a + n] == v[b + n]:
                        n += 1
                    if n and (best[0] == 0 or (-n, a, i) < (-best[0], best[1], best[2])):
                        best = n, a, i
        out.append(best)
    return out


def hit_words(row):
    return sum(row[1][1::2]) - sum(row[1][::2])


def test_search_equals_brute_force(monkeypatch):
    rnd = random.Random(4)
    monkeypatch.setattr(D, "SHARD_WORDS", 100)
    for _ in range(80):
        voc = [b"a", b"b", b"c", b"d"][:rnd.randint(1, 4)]

        def text(n):
            return b" ".join(rnd.choice(voc) for _ in range(n))
        items = [(str(rnd.randint(0, 5)), text(rnd.choice([0, 1, 2, 3, 5, 8]))) for _ in range(rnd.randint(0, 5))]
        docs = [rnd.choice([None, b"", text(rnd.randint(0, 30))]) for _ in range(12)]
        window = rnd.choice([2, 3, 4])
        got = D.search_batch(docs, D.TestSuffixes(items, window))
        assert [(r[0], hit_words(r), r[2]) for r in got] == brute_hits(docs, items, window)
        assert [tuple(r[3:]) for r in got] == brute_longest(docs, items)


def test_an_instruction_of_many_items_is_one_window():
    shared = b"please read the text below with care and then answer this question in full"
    tests = D.TestSuffixes([(f"{k:05d}", shared + b" item %d" % k) for k in range(20_000)])
    docs = [b"some words before " + shared + b" and after %d" % k for k in range(300)] + [shared + b" item 77"]
    start = time.perf_counter()
    got = D.search_batch(docs, tests)
    assert time.perf_counter() - start < 20
    assert all(len(r[2]) == 20_000 and r[3:] == (14, 3, "00000") for r in got[:-1]) and got[-1][3:] == (16, 0, "00077")


def test_suffix_order_sorts_suffixes():
    rnd = random.Random(5)
    for _ in range(30):
        x = np.array([rnd.randint(0, 2) for _ in range(rnd.randint(1, 40))])
        assert D.suffix_order(x, 50).tolist() == sorted(range(len(x)), key=lambda i: x[i:].tolist())


def test_longest_match_and_place():
    items = [("7", b"p q r s t u v w x y z one two three"), ("8", b"r s t u v w x y z one nothing else")]
    doc = b"start here: r S t u v w x y z ONE two, other p q r s t u v w x y end"
    [(n, hits, found, longest, start, item)] = D.search_batch([doc], D.TestSuffixes(items, 10))
    assert (found, longest, start, item) == (["7", "8"], 11, 2, "7") and hits == [2, 13, 14, 24] and n == 25


def test_find_leaks_in_blocks_and_edges(spark, monkeypatch):
    bench = spark.createDataFrame([(1, "a b c"), (2, "c d e f"), (2, "a b"), (None, "q r"), (5, None), (6, "")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x a b c d e f y", "k"), (2, None, "k"), (3, "", "k"), (None, "q r q r", "k"), (4, "a x b", "k")],
                                 "doc_id long, text string, found string")
    whole = {r[0]: r[-1].asDict() for r in D.find_leaks(docs, bench, window=3, keep=["doc_id"]).collect()}
    monkeypatch.setattr(D, "BLOCK_BYTES", 25)
    assert D.benchmark_blocks.__defaults__[-1] != 25
    blocks = list(D.benchmark_blocks(bench, block_bytes=25))
    assert len(blocks) > 1 and sum(map(len, blocks)) == 5
    monkeypatch.setattr(D.benchmark_blocks, "__defaults__", ("item_id", "text", 25))
    cut = {r[0]: r[-1].asDict() for r in D.find_leaks(docs, bench, window=3, keep=["doc_id"]).collect()}
    assert whole == cut and whole[1]["items"] == ["1", "2"] and whole[1]["hits"] == [1, 7] and whole[None]["items"] == ["null"]
    assert whole[4]["hits"] == [] and whole[2]["n_words"] == 0
    kept = D.remove_leaks(docs, bench, window=3)
    assert kept.schema == docs.schema and {r["doc_id"] for r in kept.collect()} == {2, 3, 4}
    assert D.remove_leaks(docs, bench.limit(0)).count() == 5 and D.remove_leaks(docs.limit(0), bench).count() == 0


def test_given_passages_are_found(spark):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    got = {r["doc_id"]: r["found"] for r in D.find_leaks(docs, bench, keep=["doc_id"]).collect()}
    rows = [(r["doc_id"], r["text"].encode()) for r in docs.collect()]
    want = brute_hits([t for _, t in rows], [(str(r["item_id"]), r["text"].encode()) for r in bench.collect()], 10)
    assert {i: (f["n_words"], hit_words((0, f["hits"])), f["items"]) for i, f in got.items()} == \
        {i: w for (i, _), w in zip(rows, want)}


# --- embeddings -------------------------------------------------------------------------------------

def cosines(x):
    x = np.asarray(x, dtype=np.float64)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return x @ x.T


def test_embeddings_recall_and_edges(spark):
    rng = np.random.default_rng(5)
    rows, k = [], 0
    for label in (1, 2):
        for centre in rng.standard_normal((40, 16)):
            for _ in range(rng.integers(1, 30)):
                rows.append((k, (centre + 0.18 * rng.standard_normal(16)).astype(np.float32).tolist(), label))
                k += 1
    rows += [(k + j, rows[5][1], 1) for j in range(6)]  # copies
    plain = list(rows)
    odd = [(9001, None, 1), (9002, [0.0] * 16, 1), (9003, [float("nan")] * 16, 1), (9004, [None] * 16, 1),
           (9005, rows[0][1], None), (9006, [1.0, 2.0], 1), (9007, [], 1), (None, rows[5][1], 1), (9008, [float("inf")] * 16, 1)]
    df = spark.createDataFrame([(*r, "x") for r in plain + odd], "vec_id long, embedding array<float>, label int, k string").repartition(5)
    got = {r["id"]: r for r in V.near_duplicates(df, block=16).collect()}
    assert len(got) == len(plain) + len(odd)
    links, found, links_list = 0, 0, []
    for label in (1, 2):
        mine = [r for r in plain if r[2] == label]
        a = cosines([r[1] for r in mine]) >= 0.93
        np.fill_diagonal(a, False)
        extra = int(label == 1)  # the row without an id is one more copy of row 5
        for r, line in zip(mine, a):
            more = extra * int(r[1] == rows[5][1] or line[[i for i, m in enumerate(mine) if m[0] == 5][0]]) if extra else 0
            assert got[r[0]]["n_links"] <= line.sum() + more
            links, found = links + line.sum() + more, found + got[r[0]]["n_links"]
        links_list += [(mine[i][0], mine[j][0]) for i, j in zip(*np.nonzero(a))]
    assert links > 500 and found / links >= 0.9
    comps = least_reached([r[0] for r in plain], links_list)
    assert np.mean([got[i]["component_id"] == c for i, c in comps.items()]) >= 0.9
    for r in odd:
        if r[0] is not None:
            assert (got[r[0]]["n_links"], got[r[0]]["component_id"]) == (0, r[0])
    assert V.near_duplicates(df.limit(0)).count() == 0


def test_isolated_pairs_are_found_in_a_large_group(spark):
    """Six passes find about 0.9 of these pairs."""
    rng = np.random.default_rng(7)
    x = rng.standard_normal((6000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.standard_normal((600, 24))
    side -= (side * x[:600]).sum(axis=1, keepdims=True) * x[:600]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    x = np.concatenate([x, 0.932 * x[:600] + np.sqrt(1 - 0.932 ** 2) * side])
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>, label int")
    got = {r["id"]: r["component_id"] for r in V.near_duplicates(df, window=4).collect()}
    assert sum(got[6000 + i] == i for i in range(600)) >= 0.97 * 600


def test_single_links_between_dense_groups_are_found(spark):
    """Pairs of groups whose closest members just reach the threshold, among very many pairs that miss it."""
    rng, rows, labels, n = np.random.default_rng(9), [], 8, 500

    def ball(centre, noise):
        x = centre / np.linalg.norm(centre) + noise
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    for label in range(labels):
        spread = np.sqrt((0.04, 0.06)[label % 2] / 64)
        a, b, na, nb = rng.standard_normal(64), rng.standard_normal(64), *(spread * rng.standard_normal((2, n, 64)))
        first, low, high = ball(a, na), 0.0, 1.0
        for _ in range(40):
            mid = (low + high) / 2
            closest = (first @ ball(mid * a / np.linalg.norm(a) + (1 - mid) * b / np.linalg.norm(b), nb).T).max()
            low, high = (mid, high) if closest < 0.932 else (low, mid)
        second = ball(high * a / np.linalg.norm(a) + (1 - high) * b / np.linalg.norm(b), nb)
        assert 1 <= (first @ second.T >= 0.93).sum() <= 60
        rows += [(len(rows) + i, v, label) for i, v in enumerate(np.vstack([first, second]).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(6)
    got = {r["id"]: r["component_id"] for r in V.near_duplicates(df, block=128).collect()}
    joined = sum(got[2 * n * label] == got[2 * n * label + n] for label in range(labels))
    assert joined >= 0.9 * labels


def test_passes_grow_with_the_group(spark):
    sizes = [1, 32, 33, 1000, 10 ** 4, 10 ** 5, 10 ** 6, 10 ** 7]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in sizes], "n long").select(V.passes_for(F.col("n"))).collect()]
    p = 1 - np.arccos(0.93) / np.pi
    for n, passes in zip(sizes, got):
        seen = p ** max(0.0, np.log2(n / 32))
        assert passes >= 6 and (1 - seen) ** passes <= 0.01 and (passes == 6 or (1 - seen) ** (passes - 1) > 0.01)
    assert got == sorted(got)


@pytest.mark.parametrize("window", [1, 4])
def test_window_links_span_what_all_pairs_connect(window):
    rng = np.random.default_rng(6)
    x = np.sort(rng.standard_normal((60, 8)).round(0), axis=0) + 0.01 * rng.standard_normal((60, 8))
    u, _ = V.unit(x.tolist())
    scale = np.abs(u).max(1) / 127
    v = np.rint(u / scale[:, None]).astype(np.int8)
    err = np.sqrt(((u - v * scale[:, None]) ** 2).sum(1))
    k = np.arange(60)
    sure, between, near = V._window_links(np.zeros(60), np.zeros(60), k, v, scale, err, window, 0, 0.93)
    want = [(i, i - d) for d in range(1, window + 1) for i in range(d, 60) if u[i] @ u[i - d] >= 0.93]
    exact = [(a, b) for a, b in between if u[a] @ u[b] >= 0.93]
    assert all(u[a] @ u[b] >= 0.93 for a, b in sure) and all(0.82 <= u[a] @ u[b] < 0.93 for a, b in near)
    assert least_reached(k, [*map(tuple, sure), *map(tuple, exact)]) == least_reached(k, want)
