"""Chat formatting, main text of pages, the pipeline, and the queries against their statements."""

import random
import time

import duckdb
import pytest

import corpus_pipeline
from centroidal.llm import registry
from centroidal.llm.chat import END, START, perspectives
from centroidal.llm.frames import table
from centroidal.llm.pages import PageWeights, extract_pages, fit_page_weights, main_text, tokenize

SF = "/root/testdata/sf0.001"


# --- chat -------------------------------------------------------------------------------------------

def brute_view(turns, me):
    text, mask = "", []
    for turn, who, content in sorted(turns, key=lambda t: ((t[0] is not None, t[0] or 0), (t[1] is not None, t[1] or ""), t[2] or "")):
        clean = (content or "").replace("<|", "< ").replace("|>", " >")
        role = "system" if who == "system" else "assistant" if who == me else f"user name={who if who is not None else 'unknown'}"
        text += f"{START}{role}\n"
        if who == me:
            mask.append((len(text), len(text) + len(clean + END)))
        text += clean + END
    return text, mask


def test_perspectives_equal_brute_force(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 2, "bob", None), (1, 3, "cy", "é日"),
            (1, 3, "ann", "tie"), (1, 4, None, "who?"), (2, 0, "system", "only"), (None, 0, "ann", "no id"), (None, 1, "bob", "x"),
            (3, 5, "ann", ""), (3, None, "ann", "no turn")]
    rows += [(4, k, ("ann", "bob")[k % 2], f"t{k}") for k in range(25)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn int, role string, text string, part string")
    got = {(r["conv_id"], r["perspective"], r["part"]): r for r in perspectives(df, turns_per_part=10).collect()}
    want = {}
    for conv in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == conv]
        for me in {r[2] for r in mine} - {None, "system"}:
            parts = {}
            for r in mine:
                parts.setdefault(-1 if r[1] is None else r[1] // 10, []).append(r[1:])
            for part, turns in parts.items():
                want[conv, me, part] = brute_view(turns, me)
    assert set(got) == set(want)
    for key, (text, mask) in want.items():
        r = got[key]
        assert r["rendered"] == text and [tuple(m) for m in r["mask"]] == mask and r["n_masked"] == sum(b - a for a, b in mask)
    assert perspectives(df.limit(0)).count() == 0


def test_large_parts_are_cut_into_pieces(spark):
    rows = [(None, None, ("ann", "bob", None, "system")[k % 4], f"t{k % 37}é" * (k % 5)) for k in range(900)]  # null ids and turns
    rows += [(1, 3, "ann", "again and again")] * 500 + [(1, 3, "bob", "x" * 5000), (1, 3, "cy", "")]  # one turn number, one row
    rows += [(2, k, ("ann", "bob")[k % 2], "short") for k in range(5)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(5)
    got = {}
    for r in perspectives(df, piece_bytes=4096).collect():
        got.setdefault((r["conv_id"], r["perspective"], r["part"]), {})[r["piece"]] = r
    assert {k[0]: len(v) > 20 for k, v in got.items()} == {None: True, 1: True, 2: False}
    assert set(got) == {(c, w, p) for c, p, ws in ((None, -1, "ann bob"), (1, 0, "ann bob cy"), (2, 0, "ann bob")) for w in ws.split()}
    for (conv, me, _), cut in got.items():
        text, mask = brute_view([r[1:] for r in rows if r[0] == conv], me)
        at, spans = 0, []
        for piece in sorted(cut):
            r = cut[piece]
            assert r["n_turns"] <= 16 and r["n_masked"] == sum(b - a for a, b in r["mask"])
            spans += [(at + a, at + b) for a, b in r["mask"]]
            at += len(r["rendered"])
        assert "".join(cut[p]["rendered"] for p in sorted(cut)) == text and spans == mask


def test_chat_plan_is_native(spark):
    plan = registry.op1_chat(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def norm(rows):
    return sorted(tuple(None if v != v else v for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_statement_gives_the_query(spark, name):
    df = registry.QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages", "benchmark", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = con.execute(registry.ORACLES[name])
    cols = [d[0] for d in got.description]
    assert sorted(cols) == sorted(df.columns)
    assert norm(tuple(r) for r in df.select(*cols).collect()) == norm(got.fetchall())


# --- pages ------------------------------------------------------------------------------------------

WEIGHTS = PageWeights({"p": 1.0, "h1": 0.9, "li": -0.6, "a": -0.8, "div": 0.1, "body": 0.1}, {"p": -0.02, "h1": -0.02, "div": -0.3})

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><a href=x>Menu</a></nav>
<div class="cookie-notice"><p>We use cookies and many many words here</p></div>
<article><h1>Head&amp;line</h1><p>One <b>bo</b>ld&nbsp;word<br>two<p>Three<aside><p>related</p></aside><!-- <p>no</p> -->
<script>var t="</p>";</script><p>Fo&#117;r &am x</p><form><p>Sign up</p></form><div class="comments"><p>first! nice post all of you</p></div>
</article><footer><p>&copy; foot</p></footer></body></html>"""


def test_main_text_of_a_page():
    assert main_text(PAGE, WEIGHTS) == "Head&line One bold word two Three Four &am x"
    assert main_text(None, WEIGHTS) == main_text("", WEIGHTS) == main_text("<p></p>", WEIGHTS) == ""
    assert main_text("<p>plain < b and <3", WEIGHTS).startswith("plain")
    assert main_text("</p></div><p>a</b> c", WEIGHTS) == "a c" and main_text("<p>x<!-- open", WEIGHTS) == "x"


def test_region_is_the_best_contiguous_one():
    words = {"p": 1.0, "li": -1.0}
    w = PageWeights(words, {"p": -0.1, "li": -0.1, "ul": -0.1})
    assert main_text("<p>a b</p><ul><li>n n n n n</li></ul><p>c d e</p>", w) == "c d e"
    assert main_text("<p>a b c</p><ul><li>n</li></ul><p>c d e</p>", w) == "a b c n c d e"


@pytest.mark.parametrize("page", [
    '<body class="single right-sidebar">{}</body>', '<div class="content-with-sidebar">{}</div>', '<article class="post no-comments">{}</article>',
    '<div id="page" class="header-fixed">{}</div>', '<main class="search-results-none related">{}</main>',
    '<body class="has-sidebar"><article>{}</article><div class="comments"><p>nice post</p></div></body>',
    '<div class="sidebar-left-layout"><div class="sidebar"><p>see also</p></div>{}<div class="comment"><p>short one</p></div></div>',
    '<article>{}</article><div class="comments"><article class="comment">' + "<p>a long answer by a reader</p>" * 20 + "</article></div>"])
def test_names_do_not_drop_what_holds_the_main_text(page):
    text = " ".join(f"word{k} soup" for k in range(15))
    weights = PageWeights({"p": 0.9, "div": 0.2, "article": 0.3, "main": 0.3, "body": 0.1}, {"p": -0.02, "div": -0.05})
    assert main_text(page.format(f"<p>{text}</p>"), weights) == text


def test_region_equals_brute_force_over_all_regions():
    rnd = random.Random(4)
    weights = PageWeights({"p": 0.7, "li": -0.6, "div": 0.1, "h2": 0.4}, {"p": -0.3, "li": -0.2, "div": -0.1, "h2": -0.1})
    for _ in range(300):
        page = "".join(f"<{t}>" + "w " * rnd.randint(0, 4) + (f"</{t}>" if rnd.random() < 0.8 else "") for t in rnd.choices(["p", "li", "div", "h2"], k=8))
        tokens = tokenize(page).tokens
        value = [weights.word(k) * len(x.split()) if kind == "w" else weights.tag(k) if kind == "t" else 0.0 for kind, k, x, _ in tokens]
        best = max((sum(value[a:b]) for a in range(len(value)) for b in range(a + 1, len(value) + 1)), default=0.0)
        regions = {" ".join("".join(x if kind == "w" else " " for kind, _, x, _ in tokens[a:b]).split())
                   for a in range(len(value)) for b in range(a + 1, len(value) + 1) if sum(value[a:b]) >= best - 1e-9} if best > 1e-9 else {""}
        assert main_text(page, weights) in regions


@pytest.mark.parametrize("page", ["<b>" * 40_000 + "</i>" * 40_000, "<div>" * 40_000 + "</p>" * 40_000, "<div><p><b>x" * 30_000, "<a><b><i>" * 60_000])
def test_parsing_open_tags_is_linear(page):
    start = time.perf_counter()
    tokenize(page)
    assert time.perf_counter() - start < 12  # seconds here; minutes for a scan of the open elements at each tag


def test_long_and_deep_pages():
    assert main_text("<p>" + "w " * 100_000, WEIGHTS).count("w") == 100_000
    assert main_text("<div>" * 20_000 + "<p>x y</p>", WEIGHTS) == "x y"
    assert tokenize("<" * 5000).tokens is not None


def test_given_pages(spark):
    pages = table(spark, SF, "pages")
    rows = extract_pages(pages.withColumn("n_chars", pages["page_id"]), fit_page_weights(pages)).collect()
    assert len(rows) == pages.count() and all(r["text"] and r["n_chars"] == len(r["text"]) for r in rows)
    assert not any("©" in r["text"] for r in rows)
    odd = spark.createDataFrame([(1, None, None), (None, "u", ""), (2, "u", "<p>a")], "page_id long, url string, html string")
    assert {r["text"] for r in extract_pages(odd, fit_page_weights(odd)).collect()} == {"", "a"}
    assert extract_pages(odd.limit(0), fit_page_weights(odd.limit(0))).count() == 0


def test_weights_come_from_the_marked_pages_of_many(spark):
    marked = [(f"<div class=c{k}>menu {k}</div><{m}><p class=k{k}>the text {k}</p></{m}>",) for k in "abcdefghijklmnopqrst" for m in ("article", "MAIN")]
    other = [(f"<div class=article><p>other {k} article</p></div><!-- <main> -->",) for k in range(600)]
    fit = fit_page_weights(spark.createDataFrame(marked + other, "html string"), sample_pages=40)
    assert fit == fit_page_weights(spark.createDataFrame(marked, "html string")) and len(fit.words) >= 40


# --- pipeline ---------------------------------------------------------------------------------------

def test_stages_keep_the_columns_and_take_effect(spark, tmp_path):
    given = table(spark, SF, "documents")
    extra = [(-1, None, "en", "s", 0), (-2, "123 456", "en", "s", 7), (None, "und dieser Text hat keine Nummer", "de", "s", 9),
             (-4, "mail me at a.b@c.example now and then please my dear friend", "en", "s", 10)]
    docs = given.union(spark.createDataFrame(extra, given.schema)).withColumnRenamed("n_chars", "found")
    now, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        before = now
        path = str(tmp_path / name)
        stage(spark, before, SF).write.parquet(path)
        now = spark.read.parquet(path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert now.schema.fieldNames() == docs.columns
        seen[name] = {r["doc_id"] for r in now.select("doc_id").collect()}
        if name == "pii":
            texts = [r["text"] for r in now.filter("text like '%[EMAIL]%'").collect()]
            assert any("mail me at [EMAIL] now" in t for t in texts) and now.count() == before.count()
    assert {-1, -2} & seen["language_id"] == set() and -4 in seen["sentencepiece"]
    ids = {r["doc_id"] for r in given.select("doc_id").collect()}
    assert seen["language_id"] >= ids and seen["jaccard_join"] < seen["language_id"] | {None}
    assert now.filter("not round_trip").count() == 0 and now.count() > 100


def test_run_applies_all_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "decontaminate", "pii", "sentencepiece"]
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "ids", "n_tokens"} <= set(out.columns) and 100 < out.count() <= 200


def test_run_equals_brute_force(spark):
    import sentencepiece
    from test_pair_operators import brute_components, brute_hits
    from test_text_operators import brute_spans

    rows = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    bench = [(str(r["item_id"]), r["text"].encode()) for r in table(spark, SF, "benchmark").collect()]
    group, _ = brute_components(list(rows.items()))
    kept = [i for i in rows if group[i] == i]
    clean = [i for i, (_, hit, _) in zip(kept, brute_hits([rows[i].encode() for i in kept], bench, 10)) if not hit]
    lib = sentencepiece.SentencePieceProcessor(model_file=registry.MODEL_PATH)
    want = {}
    for i in clean:
        text, at = "", 0
        for start, kind, end in brute_spans(rows[i]):
            text += rows[i][at:start] + f"[{('EMAIL', 'IP', 'CARD', 'PHONE')[kind]}]"
            at = end
        want[i] = lib.encode(text + rows[i][at:])
    assert {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, SF).collect()} == want
