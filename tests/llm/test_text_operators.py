"""Quality, language, decontamination, HTML, BPE, quotations and token counts."""

import hashlib
import itertools
import random

import duckdb
import pytest

from llm_fixtures import docs_of, real_docs  # noqa: F401 - fixtures
from parley.llm import bpe, decontaminate, html_extract, langid, oracle, quality, quotations, queries, token_counts

LONG = "thing " * 60_000
ODD = [(900, None, "en"), (901, "", None), (902, " \t\n ", "en"), (903, "1234 !!", "en"), (904, "a", None), (905, LONG, "en"),
       (905, LONG, "en"), (None, "and the thing", "en"), (906, "日本語の文章です", None)]


# --- quality -------------------------------------------------------------------------------------------------------
def test_kneser_ney_probabilities_sum_to_one(spark, docs_of, real_docs, monkeypatch):
    import numpy as np

    monkeypatch.setattr(quality, "ORDER", 3)
    texts = docs_of([(d, t) for d, t, _ in real_docs[:30]])
    rows = texts.select("text").mapInArrow  # noqa: F841 - the default order is bound in ngram_keys
    monkeypatch.setattr(quality.ngram_keys, "__defaults__", (3,))
    p = np.exp(-quality.dense(quality.gather(*quality.train(texts))).astype(float)).reshape(-1, 64)
    assert np.allclose(p.sum(1), 1, atol=1e-3)


def test_quality_rejects_junk_and_keeps_clean(spark, docs_of, real_docs):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r.doc_id: r.kept for r in quality.quality(d, quality.trusted_ids(labels)).collect()}
    good = [got[r.doc_id] for r in labels.collect() if r.quality == 1]
    bad = [got[r.doc_id] for r in labels.collect() if r.quality == 0]
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.4


def test_quality_edge_cases(spark, docs_of, real_docs):
    rows = [(d, t, lang) for d, t, lang in real_docs[:80]]
    df = docs_of(rows + ODD, extra=("perplexity", "kept", "threshold", "_l", "id"))
    good = docs_of(rows).select("doc_id")
    got = [r for r in quality.quality(df, good).collect()]
    assert len(got) == len(rows) + len(ODD)
    by = {r.doc_id: r for r in got}
    assert by[900].perplexity is None and not by[900].kept and not by[901].kept and not by[902].kept
    kept = quality.keep_quality(df, good)
    assert kept.columns[0] == "doc_id" and set(kept.columns) == set(df.columns)
    assert any(r.doc_id is None for r in kept.collect())
    untrained = quality.quality(df, docs_of([])).collect()  # no trusted text
    assert all(r.kept == (r.perplexity is not None) for r in untrained)
    assert quality.quality(docs_of([]), good).count() == 0


# --- language ------------------------------------------------------------------------------------------------------
def test_language_held_out_accuracy_and_edges(spark, docs_of):
    got = queries.op3_langid(spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in got if r.held_out and truth[r.doc_id]]
    assert len(got) == len(truth)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    train = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(train)
    assert set(model.langs) == {v for v in truth.values() if v}
    by = {(r.doc_id, r.lang_pred, r.score) for r in langid.predict(docs_of(ODD, extra=("lang_pred", "score")), model).collect()}
    names = {d: lang for d, lang, _ in by}
    assert names[900] == names[901] == names[902] == names[903] == "und"
    assert names[904] in model.langs and names[905] == "en" and names[906] in model.langs
    assert langid.predict(docs_of([]), model).count() == 0
    assert {r.lang_pred for r in langid.predict(docs_of(ODD), langid.fit(docs_of([]))).collect()} == {"und"}


def test_filter_returns_all_languages_of_an_ngram(spark, docs_of):
    model = langid.fit(docs_of([(1, "aaa bbb", "xx"), (2, "bbb ccc", "yy"), (3, "zzz", None)]))
    key, _, _ = langid.grams(["aaa", "bbb", "ccc"])
    masks = [int(langid.np.bitwise_and.reduce([model.table[s[i]] for s in langid.slots(key)])) for i in range(len(key))]
    assert masks[1] == 0b01 and masks[4] == 0b11 and masks[7] == 0b10


def test_more_languages_than_bits_of_a_mask(spark, docs_of):
    names = [f"l{i:03}" for i in range(150)]
    word = {n: "".join(chr(0x4E00 + 40 * i + j) for j in range(6)) for i, n in enumerate(names)}
    model = langid.fit(docs_of([(i, word[n], n) for i, n in enumerate(names)]))
    assert model.langs == names
    got = langid.predict(docs_of([(i, f"{word[n]} {word[n]}") for i, n in enumerate(names)]), model).collect()
    assert {names[r.doc_id]: r.lang_pred for r in got} == {n: n for n in names}


# --- decontamination -----------------------------------------------------------------------------------------------
def test_masks_hit_every_pattern_of_two_substitutions():
    w = decontaminate.WINDOW
    assert decontaminate.allowed(w) == (w, 2)
    for bad in itertools.chain([()], itertools.combinations(range(w), 1), itertools.combinations(range(w), 2)):
        assert any(not any(s + o in bad for o in m) for m in decontaminate.MASKS for s in range(w - m[-1]))


def slow_contamination(docs, items):
    import re

    toks = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = {}
    for d, t in docs:
        a, hits = toks(t), []
        for i, x in items:
            b = toks(x)
            if not b:
                continue
            w, subs = decontaminate.allowed(len(b))
            if any(sum(a[p + k] == b[q + k] for k in range(w)) >= w - subs
                   for p in range(len(a) - w + 1) for q in range(len(b) - w + 1)):
                hits.append(i)
        out[d] = sorted(hits)
    return out


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 700])
def test_contamination_against_brute_force(spark, docs_of, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 3, 5, 8, 11, 13, 20, 40])))) for i in range(25)] + [(90, None), (91, "")]
    rows = []
    for d in range(60):
        text = rng.choices(vocab, k=rng.randint(0, 60))
        w = items[rng.randrange(25)][1].split()
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = "other"
        at = rng.randint(0, len(text))
        rows.append((d, ", ".join([*text[:at], *w, *text[at:]]).upper()))
    rows += [(900, None), (901, ""), (902, "w1 " * 5000)]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = {r.doc_id: r["items"] for r in decontaminate.contamination(docs_of(rows, extra=("items", "best", "id")), bench).collect()}
    assert got == slow_contamination(rows, items)


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 100])
def test_contamination_of_null_and_repeated_ids(spark, docs_of, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    items = [(i, " ".join(f"w{i}x{j}" for j in range(8))) for i in range(12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(None, items[3][1]), (None, "clean"), (5, f"{items[1][1]} {items[2][1]}"), (5, "clean"), (5, items[9][1]), (5, items[9][1])]
    got = decontaminate.contamination(docs_of(rows), bench).collect()
    assert sorted((str(r.doc_id), r["items"], r.best_share) for r in got) == [
        ("5", [], 0.0), ("5", [1, 2], 1.0), ("5", [9], 1.0), ("5", [9], 1.0), ("None", [], 0.0), ("None", [3], 1.0)]


def test_contamination_empty_sides_and_drop(spark, docs_of):
    bench = spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs_of([]), bench).count() == 0
    df = docs_of([(1, "x one two three FOUR five six, seven y"), (2, "clean"), (None, None), (2, "clean")], extra=("contaminated",))
    assert not any(r.contaminated for r in decontaminate.contamination(df, none).collect())
    left = decontaminate.drop_contaminated(df, bench)
    assert left.columns == df.columns and sorted(str(r.doc_id) for r in left.collect()) == ["2", "2", "None"]


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 64])
def test_contamination_joins_seeds_of_texts_and_items(spark, docs_of, monkeypatch, block):
    """Seeds meet in a shuffle join, the benchmark's texts are not collected, and a row of many places is one row."""
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontaminate, "RECORD_PLACES", 7)
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([2, 4, 6, 9, 10, 12, 13, 30])))) for i in range(30)]
    header = " ".join(f"h{n}" for n in range(13))
    items += [(100 + i, f"{header} question v{i}") for i in range(40)]
    rows = [(d, " ".join(rng.choices(vocab, k=rng.randint(0, 90)))) for d in range(40)]
    rows += [(50, f"{header} and " * 500), (51, "w3"), (52, "h0 h1 h2 h3 h4 h5 h6 h7 other words")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    sent = []
    collect = type(bench).collect
    monkeypatch.setattr(type(bench), "collect", lambda df: sent.append(df.columns) or collect(df))
    made = decontaminate.contamination(docs_of(rows), bench)
    left = decontaminate.drop_contaminated(docs_of(rows, extra=("_row", "_H", "__near")), bench)
    assert ["i", "t"] not in sent and all("text" not in c and "near" not in c for c in sent)
    monkeypatch.undo()
    assert "SortMergeJoin" in made._jdf.queryExecution().sparkPlan().toString()
    want = slow_contamination(rows, items)
    got = made.collect()
    assert len(got) == len(rows) and {r.doc_id: r["items"] for r in got} == want
    assert left.columns == docs_of(rows, extra=("_row", "_H", "__near")).columns
    assert sorted((r.doc_id, r.text) for r in left.collect()) == sorted(r for r in rows if not want[r[0]])


# --- HTML ----------------------------------------------------------------------------------------------------------
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>x</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- ad --><div class="ad-slot">Buy</div><header><h1>Site</h1></header>
%s<aside>Side</aside><section id="comments"><p>First!</p></section><div class="cookie-notice">OK?</div>
<form><input value="q"><button>Go</button></form><footer>&copy; us</footer></body></html>"""


def test_extract_pages(spark):
    one = PAGE % '<article><h1>A &amp; B</h1><p><b>Bold &eacute;<br><p>Two\n  lines&nbsp;here <a href="x">link</a>.</p></article>'
    two = PAGE % '<div class="post-12 body"><p>Only a div with much more text than the rest.</p><p>Second.</p></div>'
    three = PAGE % '<div class="post-99 body"><p>Short.</p></div><div class="teaser"><p>Another container with longer text.</p></div>'
    rows = [(1, "http://a.example/1", one), (2, "https://B.example:80/x", two), (3, "http://b.example/y", three), (4, None, None),
            (5, "bad url", ""), (6, "http://a.example/2", "<article><p>Cut off &amp; <b>te"), (6, "http://a.example/2", "<p>x<"),
            (7, "http://b.example/z", "plain text")]
    df = spark.createDataFrame([(*r, "h", "p") for r in rows], "page_id long, url string, html string, host string, path string")
    got = sorted((r.page_id, r.url or "", r.text, r.n_chars) for r in html_extract.extract(df).collect())
    text = {(p, len(t)): t for p, _, t, _ in got}
    assert len(got) == len(rows) and all(n == len(t) for _, _, t, n in got)
    by = {p: t for p, _, t, _ in got if p != 6}
    assert by[1] == "A & B\nBold é\nTwo lines here link."
    assert by[2] == "Only a div with much more text than the rest.\nSecond."
    assert by[3] == "Short."  # the host's path, not the page's own longest container
    assert by[4] == by[5] == "" and by[7] == "plain text"
    assert "Cut off & te" in text.values()
    assert html_extract.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("page, want", [
    ("<article><p>one</p><svg class='i'/><p>two</p><object data='x'/><p>three</p></article>", "one two three"),
    ("<article><p>one <svg><title/><path/><g>no</g></svg> two</p><math><mi>x</mi></math><p>three</p></article>", "one two three"),
    ("<article><p>one</p><svg><path><p>two</p></article>", "one two"),
    ("<article><p>one</p><svg><foreignObject><div><p>no</p></div></foreignObject></svg><p>two</p></article>", "one two"),
    ("<article><p>one</p><div><object><p>no</div><p>two</p><noscript><p>no</p></noscript><p>three</p></article>", "one two three"),
    ("<article><p>one</p><template><p>no<template>no</template></p>no</template><p>two</p></article>", "one two"),
    ("<article><p title=don't>one</p><p>it's two</p><p don't>three</p><p title=\"a > b\" id='>'>four</p></article>",
     "one it's two three four"),
    ("<article><p>one</p><!--><p>two</p><!---><p>three</p><!-- no --><p>four</p></article>", "one two three four"),
    ("<article><p>one</p><script>var a='<p>no</p>';</script><p>two</p><style/>no", "one two")])
def test_markup_drops_nothing_else(page, want):
    assert " ".join(t for _, _, t, _ in html_extract.blocks(page)).split() == want.split()


def test_extract_keeps_text_beside_the_longest_container_and_both_templates(spark):
    body = "A sentence of the text. " * 30
    post = '<html><body><div class=post><h1>T</h1><div class=body><p>%s</p></div><blockquote>Quote.</blockquote></div></body></html>'
    parts = "<html><body><div class=story>" + "".join(f"<section class=s{c}><p>Part {c}. {body}</p></section>" for c in "abc")
    mixed = parts + "</div><div class=post><p>Small teaser.</p></div></body></html>"
    once = "<html><body><div class=once><p>%s</p></div><div class=post><p>Small teaser.</p></div></body></html>" % body
    rows = [(n, "http://a/1", post % (body * 4)) for n in range(4)] + [(n, "http://a/2", mixed) for n in range(4, 6)] + [(6, "http://a/3", once)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for n in range(4):
        assert got[n].startswith("T\nA sentence") and got[n].endswith("\nQuote.")
    for n in (4, 5):
        assert [t[:6] for t in got[n].split("\n")] == ["Part a", "Part b", "Part c"]
    assert got[6] == body.strip()


WORDS = "The text of the page goes on for a while, and then on. "


@pytest.mark.parametrize("page", [
    "<div class='content no-sidebar'>%s</div>", "<div class='post ad-free'>%s</div>", "<div class='post category-social tag-search'>%s</div>",
    "<article><section class='related-work'>%s</section></article>", "<article>%s</article>", "<div class='search-results-page search'>%s</div>",
    "<div id='noticeBoard' class='hasSidebar'>%s</div>"])
def test_a_word_in_a_class_does_not_delete_the_article(page):
    body = f"<p>{WORDS * 3}</p><p class='share-price'>12 dollars</p><p>{WORDS}</p>"
    full = ("<html><body><nav>Menu</nav>" + page % body + "<div class='share-buttons'>Tell all</div><div class='user-comments'><p>First!</p></div>"
            "<div class='cookieNotice'>OK?</div><ul class='related-work-list'><li><a href=x>One link and another</a></li></ul></body></html>")
    assert [b[2] for b in html_extract.blocks(full)] == [(WORDS * 3).strip(), "12 dollars", WORDS.strip()]


def test_a_long_comment_list_goes_and_a_page_of_notices_stays():
    talk = "<section id='comments'>" + f"<p>{WORDS * 2}</p>" * 3 + "</section>"
    assert [b[2] for b in html_extract.blocks(f"<body><article><p>{WORDS * 3}</p></article>{talk}</body>")] == [(WORDS * 3).strip()]
    only = f"<body><div class=notices><p>{WORDS * 9}</p><div class=ad>Buy</div></div><div>x</div></body>"
    assert [b[2] for b in html_extract.blocks(only)] == [(WORDS * 9).strip(), "x"]


@pytest.mark.parametrize("templates", [2, 30])
def test_hosts_with_many_templates_lose_no_paragraph(spark, templates):
    """Every page's container holds all its paragraphs, whatever container other pages of the host have."""
    rows, want = [], {}
    for n in range(templates * 2):
        parts = [f"Page {n}, paragraph {k}. {WORDS}" for k in range(1 + n % 5)]
        body = "".join(f"<p>{p}</p>" for p in parts)
        rows.append((n, "http://a/x", f"<html><body><nav>Menu</nav><div class=t{'abcdefghij'[n % templates % 10] * (1 + n % templates // 10)}>{body}</div>"
                                      "<div class=lead><p>Read on.</p></div><footer>End</footer></body></html>"))
        want[n] = parts
    lead = "<html><body><div class=lead><p>%s</p></div>%s</body></html>"
    rows += [(1000 + n, "http://b/x", lead % (f"Lead {n}. {WORDS}", "")) for n in range(20)]
    story = [f"Paragraph {k}. {WORDS}" for k in range(9)]
    rows.append((2000, "http://b/y", lead % (WORDS * 2, "<div class=story>" + "".join(f"<p>{p}</p>" for p in story) + "</div>")))
    got = {r.page_id: r.text.split("\n") for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows)
    for n, parts in want.items():
        assert got[n][: len(parts)] == [p.strip() for p in parts] and set(got[n][len(parts):]) <= {"Read on."}
    assert got[2000] == [(WORDS * 2).strip(), *[p.strip() for p in story]]      # all ten paragraphs
    assert all(got[1000 + n] == [f"Lead {n}. {WORDS}".strip()] for n in range(20))


def test_extract_given_pages_keeps_the_article(spark):
    got = queries.op5_html_extract(spark, "/root/testdata/sf0.001").collect()
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    for r in got:
        body = re.search(r"<article>(.*?)(</article>|\Z)", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", body)]
        assert r.text.replace("\n", " ").split() == " ".join(p for p in parts if p).split()


# --- BPE -----------------------------------------------------------------------------------------------------------
def test_bpe_equals_the_library(spark, docs_of, real_docs):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    rng = random.Random(1)
    pool = [chr(c) for c in range(0x20, 0x250)] + list("\x00\t\n\x0b\x1c\x85 ​ 　Σςİ中ひ한½Ⅷ🙂́﻿") + [
        "<|endoftext|>", "<|STARTOFTEXT|>", "<|", "don't", "'S", "ΑΣ ", "aaaaaaaa", "1234"]
    texts = [t for _, t, _ in real_docs] + ["".join(rng.choices(pool, k=rng.randint(0, 30))) for _ in range(3000)]
    texts += [None, "", "a" * 30_000, LONG, "the", "the"]
    rows = list(enumerate(texts)) + [(None, "null id")]
    got = {r.doc_id: r for r in bpe.encode_table(docs_of(rows, extra=("id", "ids", "n_tokens")), path).collect()}
    assert len(got) == len(rows)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for d, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want = (len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids, skip_special_tokens=False)))
        assert (got[d].n_tokens, got[d].ids_sha256, got[d].decoded_sha256) == want, t
    assert bpe.encode_table(docs_of([]), path).count() == 0
    row = bpe.encode_table(docs_of([(1, "Hello world")]), path, texts=True).first()
    assert row.decoded == lib.decode([int(i) for i in row.ids.split()], skip_special_tokens=False)


# --- quotations ----------------------------------------------------------------------------------------------------
CHAT = [
    (1, 0, "user", "First question?\nSecond line."),
    (1, 1, "assistant", "An answer\nof two lines."),
    (1, 2, "user", "Ann wrote:\n> An  Answer\n>of two lines.\n>> first question?\nThanks."),
    (1, 3, "user", "> Thanks.\nYou are welcome.\n> nobody said this"),
    (1, 4, "user", " > First question?\n > an answer\nmixed: the latest of equal counts"),
    (1, 5, "user", ">\n> \n5 > 4"),
    (2, 0, "user", "Thanks."), (2, 1, "user", "> An answer\nother conversation"),
    (None, 0, "user", "hello"), (None, 1, None, "> hello\nhi"), (3, None, "user", "> hello"), (3, 1, "user", None), (3, 2, "user", ""),
    (4, 0, "user", "same"), (4, 0, "user", "same"), (4, 1, "user", "> same\nx"), (4, 1, "user", "> same\nx"),
    (5, 0, "user", "line\n" * 3000), (5, 1, "user", "> line\n" * 3000)]


def test_quotations(spark):
    df = spark.createDataFrame([(*r, "x", 1) for r in CHAT], "conv_id long, turn long, role string, text string, thread string, depth int")
    rows = quotations.link_quotes(df.repartition(4)).collect()
    got = {(r.conv_id, r.turn): r for r in rows}
    assert len(rows) == len(CHAT)
    r = got[1, 2]
    assert (r.reply_to, r.thread, r.depth, r.n_quoted, r.n_linked, r.text) == (1, 1, 1, 3, 3, "Thanks.")
    assert (got[1, 3].reply_to, got[1, 3].thread, got[1, 3].depth) == (2, 1, 2)
    assert got[1, 4].reply_to == 1 and got[1, 5].reply_to is None and got[1, 5].text == "5 > 4"
    assert got[2, 1].reply_to is None and got[None, 1].reply_to == 0 and got[3, None].reply_to is None
    assert got[5, 1].n_linked == 3000 and got[4, 1].reply_to == 0
    order = [(r.conv_id, r.thread, r.depth, r.turn) for r in rows if r.conv_id == 1]
    assert order == sorted(order)
    assert quotations.link_quotes(df.limit(0)).count() == 0


def test_quotations_sql(spark, tmp_path):
    df = spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string")
    con = duckdb.connect()
    con.register("conversations", df.toArrow())
    rel = con.sql(oracle.QUOTES)
    got = quotations.link_quotes(df).select(*rel.columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, rel.fetchall()))


def test_quotations_plan_is_native(spark):
    df = quotations.link_quotes(spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# --- token counts --------------------------------------------------------------------------------------------------
def test_token_counts_add_up_and_follow_the_rule(spark, docs_of, real_docs):
    path = queries.tokenizer_path("byte_bpe_50k.tiktoken")
    enc, _ = token_counts.encoder(path)
    rows = [(d, t) for d, t, _ in real_docs[:60]] + [(900, None), (901, ""), (902, "a\n\n\n\nb\n"), (903, "é🙂\n🙂" * 20), (904, LONG), (905, "\n")]
    for rule in token_counts.RULES:
        got = token_counts.token_counts(docs_of(rows, extra=("section", "id")), path, rule=rule).collect()
        total = {}
        for r in got:
            total[r.doc_id] = total.get(r.doc_id, 0) + r.n_tokens
        for d, t in rows:
            assert total[d] == len(enc.encode_ordinary(t or "")), d
            own = sorted((r.char_start, r.char_end) for r in got if r.doc_id == d)
            assert own[0][0] == 0 and own[-1][1] == len(t or "") and all(a[1] == b[0] for a, b in zip(own, own[1:]))
    # a token over the bound goes to the section with most of its characters
    s = token_counts.np.array([0, 2, 5])
    own, cross = token_counts.attribute(s, token_counts.np.array([2, 5, 6]), token_counts.np.array([0, 3]), "majority")
    assert own.tolist() == [0, 1, 1] and cross.tolist() == [False, True, False]
    own, _ = token_counts.attribute(s, token_counts.np.array([2, 5, 6]), token_counts.np.array([0, 3]), "first")
    assert own.tolist() == [0, 0, 1]
    fields = token_counts.token_counts(docs_of([(1, "x y")]).selectExpr("doc_id", "text", "'q' as lang"), path,
                                       fields=("lang", "text"), sections="field").collect()
    assert sorted((r.field, r.char_start, r.char_end) for r in fields) == [("lang", 0, 2), ("text", 2, 5)]
    assert token_counts.token_counts(docs_of([]), path).count() == 0


@pytest.mark.parametrize("space", [" ", "\n", " \n\t", "\u3000 ", "\r\n"])
def test_token_counts_of_long_white_space(spark, space):
    path = queries.tokenizer_path("byte_bpe_50k.tiktoken")
    enc, _ = token_counts.encoder(path)
    rnd = random.Random(1)
    for n in (4990, 5000, 5003, 20_000):      # short enough for the encoder itself
        run = (space * n)[:n]
        for text in (run, run + "word", "word" + run, f"a{run}b{run}", f"a {run} 'll{run[:7]}x", f"{run}1{run}.", f"é{run}日本{run}\n"):
            assert token_counts.encode(enc, text).tolist() == enc.encode(text, disallowed_special=())
    mixed = "".join(rnd.choice(" \n\t\u2003") for _ in range(20_000))
    assert token_counts.encode(enc, f"x{mixed}y").tolist() == enc.encode(f"x{mixed}y", disallowed_special=())
    long = (space * 3_000_000)[:3_000_000]
    ids = token_counts.encode(enc, f"a{long}b")
    assert enc.decode(ids.tolist()) == f"a{long}b"
    rows = token_counts.section_counts((long,), path)
    assert sum(r[4] for r in rows) == len(token_counts.encode(enc, long))


@pytest.mark.parametrize("block", [8 << 20, 200])
def test_contamination_of_any_item_ids(spark, docs_of, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    words = " ".join(f"w{n}" for n in range(20))
    docs = docs_of([(1, f"before {words} after"), (2, "clean text of nothing at all"), (3, "other " + " ".join(f"v{n}" for n in range(20)))])
    items = [("gsm-1", words), (None, words), (None, " ".join(f"v{n}" for n in range(20))), ("gsm-1", "unseen words are in here too")]
    got = {r.doc_id: r for r in decontaminate.contamination(docs, spark.createDataFrame(items, "item_id string, text string")).collect()}
    assert got[1].contaminated and got[1].n_items == 2 and got[1]["items"] == ["gsm-1", None]
    assert not got[2].contaminated and got[3].contaminated and got[3]["items"] == [None]
    kept = decontaminate.drop_contaminated(docs, spark.createDataFrame(items, "item_id string, text string"))
    assert [r.doc_id for r in kept.collect()] == [2]


def plain_attribution(fields, enc, sections, rule):
    """Tokens of each section, one token and one character at a time."""
    text = "\n".join(fields)
    starts, at = [], 0
    for f in fields:
        starts.append((at, len(starts)))
        at += len(f) + 1
    bounds = [s for s, _ in starts]
    if sections == "line":
        bounds = sorted({*bounds, *[n + 1 for n, c in enumerate(text) if c == "\n" and n + 1 < len(text)]})
    of_byte = [n for n, c in enumerate(text) for _ in c.encode()]
    section = lambda char: max(n for n, b in enumerate(bounds) if b <= char)
    counts, crossing, byte = [0] * len(bounds), [0] * len(bounds), 0
    for token in enc.encode(text, disallowed_special=()):
        size = len(enc.decode_single_token_bytes(token))
        chars = sorted(set(of_byte[byte: byte + size]))
        byte += size
        own = [section(c) for c in chars]
        to = own[0] if rule == "first" else max(sorted(set(own)), key=lambda s: (own.count(s), -s))
        counts[to] += 1
        crossing[to] += len(set(own)) > 1
    return bounds, counts, crossing


@pytest.mark.parametrize("sections", ["line", "field"])
@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts_equal_plain_attribution(sections, rule):
    path = queries.tokenizer_path("byte_bpe_50k.tiktoken")
    enc, _ = token_counts.encoder(path)
    rnd = random.Random(7)
    cases = [("a\n\n\n  b",), ("",), ("\n",), ("x\n",), ("", ""), ("one two", "", "\n\nthree"), ("é🎉\n日本\n\n\n", "語\n\n")]
    cases += [tuple("".join(rnd.choice("ab \n\n\té日🎉.'ll") for _ in range(rnd.randint(0, 40))) for _ in range(rnd.randint(1, 3))) for _ in range(150)]
    for fields in cases:
        got = token_counts.section_counts(fields, path, sections, rule)
        bounds, counts, crossing = plain_attribution(fields, enc, sections, rule)
        assert [(r[2], r[4], r[5]) for r in got] == list(zip(bounds, counts, crossing)), fields


def test_quotations_sql_with_quoted_lines(spark, tmp_path):
    """The query's SQL on a table whose messages quote each other (the given conversations hold no quoted line)."""
    rnd = random.Random(11)
    rows = []
    for conv in range(12):
        said = []
        for turn in range(8):
            own = [f"line {rnd.randrange(30)} of {turn}", "", f"  more {rnd.randrange(9)} "][: rnd.randint(1, 3)]
            quoted = []
            for t in rnd.sample(range(turn), min(turn, rnd.randint(0, 2))):
                quoted += ["On a day someone wrote:"] * rnd.randint(0, 1)
                quoted += [f"{'>' * rnd.randint(1, 2)} {x.strip()}" for x in said[t][: rnd.randint(1, 3)]]
            said.append(own)
            rows.append((conv if conv else None, turn, rnd.choice(["user", "assistant"]), "\n".join([*quoted, *own])))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.toPandas().to_parquet(tmp_path / "conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT conv_id::bigint AS conv_id, turn, role, text FROM read_parquet('{tmp_path}/conversations.parquet')")
    got = quotations.link_quotes(df)
    want = con.sql(oracle.ORACLE["op9_quotations"])
    order = sorted(want.columns)
    key = lambda row: tuple(None if v is None or v != v else v for v in row)
    rows_got = sorted((key(tuple(r[c] for c in order)) for r in got.collect()), key=repr)
    rows_want = sorted((key(tuple(r[want.columns.index(c)] for c in order)) for r in want.fetchall()), key=repr)
    assert rows_got == rows_want and sum(r[order.index("n_linked")] for r in rows_got) > 20


def slow_model(texts, order=4):
    """Interpolated modified Kneser-Ney by definition, over dictionaries: a function from a text to its perplexity."""
    import math
    from collections import Counter

    def grams(text):
        s = [quality.BREAK] * (order - 1) + quality.symbols([text])[0][1:].tolist()
        return [tuple(s[n: n + order]) for n in range(len(s) - order + 1)]

    counts = {order: Counter(g for t in texts for g in grams(t))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    cut, total, mass = {}, {}, {}
    for k, c in counts.items():
        of = Counter(c.values())
        cut[k] = quality.discounts(of[1], of[2], of[3], of[4])
        total[k], mass[k] = Counter(), Counter()
        for g, n in c.items():
            total[k][g[:-1]] += n
            mass[k][g[:-1]] += cut[k][min(n, 3) - 1]

    def p(g):
        k = len(g)
        if not k:
            return 1 / 64
        h = g[:-1]
        if not total[k][h]:
            return p(g[1:])
        n = counts[k][g]
        return (max(n - cut[k][min(n, 3) - 1], 0) if n else 0) / total[k][h] + mass[k][h] / total[k][h] * p(g[1:])

    return lambda text: math.exp(sum(-math.log(max(p(g), 1e-12)) for g in grams(text)) / len(grams(text)))


def test_quality_perplexity_against_the_definition(spark, docs_of, real_docs):
    rows = [(d, (t or "")[:400], lang) for d, t, lang in real_docs[:25] if t]
    others = [(1000, "zzz qqq zzz"), (1001, "The The The"), (1002, "Да нет"), (1003, "x"), (1004, "12 34!?\n\n  A")]
    perplexity = slow_model([t for _, t, _ in rows])
    got = {r.doc_id: r.perplexity for r in quality.quality(docs_of(rows + others), docs_of(rows).select("doc_id")).collect()}
    for r in rows + others:
        assert got[r[0]] == pytest.approx(perplexity(r[1]), rel=2e-3), r[1][:40]


def test_language_scores_against_plain_counts(spark, docs_of, real_docs):
    """The filters' corrected counts against sets of n-grams by definition."""
    from collections import Counter, defaultdict

    import numpy as np

    rows = [(d, t, lang) for d, t, lang in real_docs if t and lang]
    train, held = rows[::2], rows[1::2]
    model = langid.fit(docs_of(train))
    count = defaultdict(Counter)
    for _, t, lang in train:
        count[lang].update(langid.grams([t])[0].tolist())
    share = {lang: {g: n / sum(c.values()) for g, n in c.items() if n / sum(c.values()) >= langid.MIN_SHARE} for lang, c in count.items()}
    top = Counter()
    for own in share.values():
        for g, x in own.items():
            top[g] = max(top[g], x)
    sets = {lang: {g for g, x in own.items() if x >= top[g] * langid.MIN_RATIO} for lang, own in share.items()}
    names, scores = model.predict([t for _, t, _ in held])
    for (_, t, _), name, score in zip(held, names, scores):
        grams = langid.grams([t])[0].tolist()
        hits = np.array([sum(g in sets[lang] for g in grams) for lang in model.langs], float)
        if hits.sum() < 20:
            continue
        assert score == pytest.approx(hits.max() / hits.sum(), abs=0.03)
        if np.sort(hits)[-1] > 1.1 * np.sort(hits)[-2]:
            assert name == model.langs[int(hits.argmax())]
    assert sum(n == lang for n, (_, _, lang) in zip(names, held)) > 0.95 * len(held)


def test_quality_alphabet_is_open():
    """No two characters outside a-z have the same symbols; accents and case are folded as before."""
    chars = [c for r in ((0x21, 0x7F), (0x391, 0x3D0), (0x3B1, 0x3CA), (0x430, 0x460), (0x5D0, 0x5EB), (0xFB0, 0x1010), (0x4E00, 0x4F00),
                         (0x1F600, 0x1F640), (0x3FFF0, 0x40010), (0xE0061, 0xE0070)) for c in map(chr, range(*r))]
    chars = [c for c in chars if not c.isspace() and not c.isdigit()]
    spelt = {}
    for c in chars:
        spelt.setdefault(tuple(quality.symbols([c])[0][1:].tolist()), []).append(c)
    assert all(len({c.lower() for c in same}) == 1 or same[0] in "0123456789" for same in spelt.values())
    plain = lambda t: quality.symbols([t])[0][1:].tolist()
    assert plain("éÉ a1") == [5, quality.UPPER, 5, quality.BLANK, 1, quality.DIGIT]
    assert plain("Да") == [quality.UPPER, *plain("д"), *plain("а")] and plain("日本") == plain("日") + plain("本")
    sym, owner = quality.symbols(["Яz", "", "😀", "!~"])
    parts = [sym[owner == n].tolist() for n in range(4)]
    assert parts == [quality.symbols([t])[0].tolist() for t in ("Яz", "", "😀", "!~")]


def test_quality_scores_by_joins_in_any_script(spark, docs_of, monkeypatch):
    """The model does not pass the driver, the split into blocks changes nothing, and junk in another script is seen."""
    rnd = random.Random(5)
    words = "это было очень давно когда вода была чистой и дети играли возле старого дома у реки".split()
    rows = [(n, " ".join(rnd.choices(words, k=60)), "ru") for n in range(80)]
    letters = "абвгдежзийклмнопрстуфхцчшщъыьэюя"
    junk = [(1000 + n, " ".join("".join(rnd.choices(letters, k=5)) for _ in range(60)), "ru") for n in range(5)]
    rows += [(rows[0][0], *rows[0][1:]), (None, rows[1][1], "ru")]
    docs, good = docs_of(rows + junk), docs_of(rows[:80]).select("doc_id")

    def no_gather(*_):
        raise AssertionError("the model is gathered")

    monkeypatch.setattr(quality, "gather", no_gather)
    result = lambda: sorted((repr(r.doc_id), r.perplexity, r.kept) for r in quality.quality(docs, good).collect())
    one = result()
    assert [k for i, _, k in one if i.startswith("10") and len(i) == 4] == [False] * 5
    assert sum(k for _, _, k in one) >= len(rows) - 1
    monkeypatch.setattr(quality, "BLOCK_BYTES", 4000)
    assert result() == one


def test_quality_keys_by_definition():
    """The n-grams of many texts at once are those of each text alone, read by definition."""
    rnd = random.Random(11)
    chars = "ab zZ\n1!\x7fÉДд日😀\ud800ß\U00040000"
    for order in (1, 2, 3, 4):
        texts = ["".join(rnd.choices(chars, k=rnd.choice([0, 1, 2, 3, 40]))) for _ in range(60)]
        want = []
        for n, t in enumerate(texts):
            s = [quality.BREAK] * (order - 1) + quality.symbols([t])[0][1:].tolist()
            for at in range(len(s) - order + 1):
                key = 0
                for x in s[at: at + order]:
                    key = key * 64 + x
                want.append((key, n))
        key, owner = quality.ngram_keys(texts, order)
        assert list(zip(key.tolist(), owner.tolist())) == want


def test_quality_sorts_and_searches_different_ngrams_only(monkeypatch):
    """CPU time: no step sorts or searches once per symbol, and counts and perplexities are those of plain numpy."""
    import numpy as np
    import pyarrow as pa

    rnd = random.Random(7)
    words = "the river runs Down to the sea and Back again 12 times".split()
    texts = [" ".join(rnd.choices(words, k=400)) for _ in range(60)] + ["", "  "]
    key, owner = quality.ngram_keys(texts)
    different, count = np.unique(key, return_counts=True)
    shards, most = 4, []
    keys = quality._wanted_by(texts)
    p, w = np.where(keys % 3, (keys % 89 + 1) / 100, np.nan).astype(np.float32), ((keys % 7 + 1) / 10).astype(np.float32)
    top, cost = quality.costs(keys, p, w)
    nats = np.bincount(owner, cost[np.searchsorted(top, key)], len(texts))
    want = np.exp(np.minimum(nats / np.maximum(np.bincount(owner, minlength=len(texts)), 1), 50)).tolist()
    shard = keys % quality.PRIME % shards
    rows = pa.table({"doc_id": list(range(len(texts))), "_text": texts, "_block": [0] * len(texts)})
    answers = pa.table({"shard": list(range(shards)), "p": [p[shard == n].tobytes() for n in range(shards)],
                        "w": [w[(shard == n) & (keys < quality.ORDER << (6 * quality.ORDER))].tobytes() for n in range(shards)]})

    def watched(name):
        plain = getattr(np, name)

        def call(*args, **kw):
            most.append(max(np.size(x) for x in args))
            return plain(*args, **kw)

        monkeypatch.setattr(np, name, call)

    for name in ("unique", "sort", "argsort", "searchsorted", "union1d"):
        watched(name)
    counted = pa.Table.from_batches(quality._count(iter([pa.record_batch({"text": texts})])))
    asked = quality._asking(shards)(rows)
    got = quality._scoring(shards, 1)(rows, answers)
    monkeypatch.undo()
    assert (counted["g"].to_pylist(), counted["c"].to_pylist()) == (different.tolist(), count.tolist())
    assert sorted(np.concatenate([np.frombuffer(b, quality.key_type()) for b in asked["keys"].to_pylist()])) == keys.tolist()
    assert got["perplexity"].to_pylist() == [*want[:-2], None, None]
    upper = sum(c.isupper() for t in texts for c in t)
    assert max(most) <= max(upper, len(keys)) < len(key) / 5
