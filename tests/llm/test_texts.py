"""Operators on single texts: pieces, page text, quality statistics, token files."""

import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.data import edge_docs, edge_rows, no_docs, sentence, text
from tradewind.llm import html_text, line_quality, pieces, token_files

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "a", " ", "  ", "   x", " hi  there\n\tx ﬁ é é ①", "▁x", "x\x00y", None, "\n\n", "日本語 12.5", "🙂🙂 a🙂b", "<s> </s> <0x0A>", "a" * 300,
       "  " * 50 + "b" + " " * 7, "don't stop...!!!", "́", "=" * 40, "https://www.example.com/a?b=c&d=e", "aaa bbb\r\nccc", "ÀÉÎõü ß"]


# -- 1: pieces


def same_pieces(texts):
    model, library = pieces.Pieces(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids, counts = model(pa.array(texts, pa.string()))
    ends = np.concatenate([[0], np.cumsum(counts)])
    for t, a, b, decoded in zip(texts, ends[:-1], ends[1:], model.decode(ids, counts), strict=True):
        assert ids[a:b].tolist() == library.encode(t or ""), t
        assert decoded == (t or "").replace("▁", " ")


def test_pieces_equal_the_library():
    r = random.Random(1)
    same_pieces(ODD)
    same_pieces(["".join(r.choice("abcdethe ing ou▁ \n.,éüß日z'01") for _ in range(r.randint(0, 60))) for _ in range(1500)])
    same_pieces([text(i) for i in range(50)])


def test_pieces_with_a_full_cache():
    model = pieces.Pieces(MODEL, most=3)
    first = model(pa.array(["some words here", "and more of them"]))
    again = model(pa.array(["some words here", "and more of them"]))
    assert first[0].tolist() == again[0].tolist()


def test_suffix_ranges():
    index = pieces.SuffixIndex(b"banana bandana")
    assert sorted(index.order[:2].tolist()) == [6, 13] or len(index.order) == 14
    order = sorted(range(14), key=lambda i: b"banana bandana"[i:])
    assert index.order.tolist() == order


def test_encode_frame(spark):
    docs = edge_docs(spark)
    got = pieces.encode(docs, MODEL)
    assert got.columns[:len(docs.columns)] == docs.columns and got.columns[-4:] == ["_pieces", "_n_pieces", "_ids_crc32", "_round_trip"]
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = got.collect()
    assert len(rows) == len(edge_rows())
    for row in rows:
        ids = library.encode(row["text"] or "")
        assert row["_pieces"] == ids and row["_n_pieces"] == len(ids) and row["_round_trip"]
        assert row["_ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
    assert pieces.encode(no_docs(spark), MODEL).count() == 0


# -- 2: pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><a href=/>Site</a></header><nav><ul><li><a href=a>One</a></li></ul></nav><div class="cookie-notice">We use cookies here</div>
<div id=content><h1>The title</h1><div class="body"><p>First para with <b>bold</b> and a <a href=x>link</a> &amp; more text.
<p>Second   one,<br>broken.<ul><li>item a<li>item b</ul><blockquote>Quoted &lt;tag&gt; words</blockquote></div></div>
<aside>Aside text</aside><section id="comments"><p>A reader said this at some length, and more.</p></section>
<form>Sign <input name=x> <button>up</button></form><footer>&copy; Site</footer></body></html>"""
PAGE_TEXT = "The title\nFirst para with bold and a link & more text.\nSecond one, broken.\nitem a\nitem b\nQuoted <tag> words"


def test_main_text():
    assert html_text.main_text(PAGE) == PAGE_TEXT
    article = PAGE.replace("<div id=content>", "<article>").replace("</div></div>", "</div></article>")
    assert html_text.main_text(article) == PAGE_TEXT


@pytest.mark.parametrize(("html", "want"), [
    (None, ""), ("", ""), ("just text", "just text"), ("<p>a", "a"), ("a < b <c", "a < b <c"), ("<script>var a='<p>x</p>'", ""),
    ("<!-- <p>no</p> --><p>yes", "yes"), ("<p title='a>b'>c</p>", "c"), ("&#233;&eacute;&amp;lt;&nbsp;x", "éé&lt; x"),
    ("<div>" * 5000 + "deep" + "</div>" * 5000, "deep"), ("<p>a</p>" * 3, "a\na\na"), ('<p "unclosed>x</p><p>y', "x\ny"),
    ("<article><header><h1>H</h1></header><p>b</p><footer>no</footer></article>", "H\nb"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
])
def test_page_cases(html, want):
    assert html_text.main_text(html) == want


@pytest.mark.parametrize("open_tag", [f"<div id=page class='{c}'>" for c in ("has-sidebar", "with-sidebar", "no-comments", "content-search", "share-article")]
                         + ["<form action=x method=post>", "<div role=form>", "<div class='has-sidebar'><form id=aspnetForm>"])
def test_a_name_does_not_drop_the_article(open_tag):
    paragraphs = [text(i, 4).replace("\n", " ") for i in range(3)]
    page = f"""<html><body><nav><a href=/>Site</a></nav>{open_tag}<div><h1>The title</h1>{''.join(f'<p>{p}' for p in paragraphs)}</div>
<div class=sidebar><p>Other things to read</div><form>Sign <input name=x></form></body></html>"""
    assert html_text.main_text(page) == "\n".join(["The title", *paragraphs])


def test_a_long_advert_beside_a_short_article():
    assert html_text.main_text(f"<div class=ad>{sentence(1)}</div><article><h1>Title</h1><p>Short.</article>") == "Title\nShort."


def test_extract_frame(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "old", 5), (2, None, None, "old", 5), (2, None, None, "old", 5), (None, "u", "x" * 100_000, None, None)],
                                  "page_id long, url string, html string, text string, n_chars int")
    got = {(r["page_id"], r["url"], r["text"], r["n_chars"]) for r in html_text.extract(pages).collect()}
    assert got == {(1, "u", PAGE_TEXT, len(PAGE_TEXT)), (2, None, "", 0), (None, "u", "x" * 100_000, 100_000)}
    assert html_text.extract(pages).count() == 4 and html_text.extract(pages.limit(0)).count() == 0


# -- 3: quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def statistics(t):
    w = WORD.findall(t)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    seen = Counter(windows)
    covered = {i + j for i, x in enumerate(windows) if seen[x] > 1 for j in range(3)}
    kept = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(kept) - len(set(kept)), len(covered)


def test_statistics(spark):
    r = random.Random(2)
    texts = [t or "" for t in ODD] + ["".join(r.choice("ab \n#&\t\x1f") for _ in range(r.randint(0, 300))) for _ in range(300)]
    texts += ["a b c a b c", "a a a a", "one two three", "a b c d " * 50, "x"]
    got = line_quality.judge(spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for row in got.collect():
        assert tuple(row[n] for n in names) == statistics(texts[row["doc_id"]]), texts[row["doc_id"]]


def test_frequent_lines(spark):
    """Against a count of documents per host and line."""
    share = "Subscribe to our letter on page {} now and never miss it again dear reader of ours"
    rows = [(i, share.format(i) + "\n" + text(i), "hot") for i in range(40)] + [(100 + i, share.format(7), "cold") for i in range(3)]
    rows += [(200 + i, "\n".join([share.format(1)] * 5), "hot") for i in range(2)] + [(300, text(1), "hot"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in line_quality.judge(docs, max_docs=20, min_words=10, max_repeat_percent=100).collect()}
    assert all(got[i]["n_frequent_lines"] == 1 and got[i]["kept"] for i in range(40))  # the digits differ, the line is one
    assert all(got[100 + i]["n_frequent_lines"] == 0 and got[100 + i]["kept"] for i in range(3))  # few of that host
    assert all(got[200 + i]["n_left_words"] == 0 and not got[200 + i]["kept"] for i in range(2))  # depleted
    assert got[300]["kept"] and not got[None]["kept"] and got[None]["base_failed"]


def test_frequent_lines_of_a_large_host(spark):
    """A line in 30 documents is frequent, whether its host has 40 documents or 4,000."""
    line = "Subscribe to our letter and never miss it again dear reader of ours"
    rows = [(n + i, line if i < 30 else sentence((n, i).__repr__()), f"host {n}") for n in (40, 4000) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = line_quality.judge(docs, min_words=5, max_repeat_percent=100).filter("n_frequent_lines > 0").collect()
    assert len(got) == 60 and all(r["n_frequent_lines"] == 1 and r["n_left_words"] == 0 and not r["kept"] for r in got)


def test_frequent_lines_are_taken_out(spark):
    line = "Subscribe to our letter on page {} now"
    rows = [(i % 5, f"{line.format(i)}\n\n{text(i)}\n  {line.format(1).upper()}", None if i % 2 else "s") for i in range(60)] + [(9, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_frequent_lines", F.lit("own"))
    got = line_quality.remove_frequent(docs).collect()
    assert Counter(r["text"] for r in got) == Counter([f"\n{text(i)}" for i in range(60)] + [None])
    assert Counter((r["n_frequent_lines"], r["_n_frequent_lines"]) for r in got) == {("own", 2): 60, ("own", 0): 1}
    judged = line_quality.judge(docs, min_words=10, max_repeat_percent=100).collect()
    assert all(r["n_left_words"] == len(WORD.findall(r["left_text"] or "")) and "letter" not in (r["left_text"] or "") for r in judged)
    assert len(judged) == 61 and sum(r["kept"] for r in judged) == 60


def test_quality_edges(spark):
    got = line_quality.judge(edge_docs(spark)).collect()
    assert len(got) == len(edge_rows())
    assert sorted(r["n_words"] for r in got) == sorted(len(WORD.findall(t or "")) for _, t, *_ in edge_rows())
    assert line_quality.judge(no_docs(spark)).count() == 0


# -- 4: token files


def test_file_gives_any_token():
    rng = np.random.default_rng(1)
    for top in (2, 256, 257, 65_536, 70_000, 2**32):
        ids = rng.integers(0, top, 3000).astype(np.uint32)
        file = token_files.TokenFile(token_files.build_file([1, None, -7], [10, 0, 2990], ids))
        assert (file.ids() == ids).all() and file.doc_ids == [1, None, -7] and file.firsts.tolist() == [0, 10, 10, 3000]
        assert [file[i] for i in range(0, 3000, 17)] == ids[::17].tolist()
    assert len(token_files.TokenFile(token_files.build_file([], [], np.array([], np.uint32))).ids()) == 0
    with pytest.raises(ValueError, match="token file"):
        token_files.TokenFile(b"x" * 100)


def test_word_encoder_equals_the_library():
    texts = [t or "" for t in ODD] + ["a\x1cb c", "<|endoftext|>x <|endoftext|>", "don't  's\t't", "İSTANBUL ΣΑΣ", "Élan, vital!? ok... x:y a_b", "x&&& Y%%%$$$",
                                      "foo<|endoftext|>bar A<|", "ÀÉ[]^_`{|}~", *[text(i) for i in range(20)]]
    ids, counts = token_files.WordEncoder(WORDS)(pa.array(texts))
    at = 0
    for t, n, want in zip(texts, counts, Tokenizer.from_file(WORDS).encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids[at:at + n].tolist() == want.ids, t
        at += n


def test_write_and_read(spark, tmp_path):
    token_files.write(edge_docs(spark), str(tmp_path / "a"), lambda: token_files.word_encoder(WORDS), 2, file_ids=500)
    got = token_files.read(spark, str(tmp_path / "a")).orderBy("start").collect()
    tokenizer, want = Tokenizer.from_file(WORDS), []
    for k, t, *_ in edge_rows():
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((k, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=str) == sorted(want, key=str)
    order = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in got]
    assert order == sorted(order)
    assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got]])[:-1].tolist()
    token_files.write(no_docs(spark), str(tmp_path / "b"), lambda: token_files.word_encoder(WORDS), 2)
    assert token_files.read(spark, str(tmp_path / "b")).count() == 0


@pytest.mark.parametrize("html", ["<div>" * 100_000 + "</section>" * 100_000, '<a "' * 500_000, '<a ">" ' * 250_000, "<b><div>" + "<i>" * 150_000 + "</b>" * 150_000,
                                  "<div>" * 150_000 + "<td>" * 150_000, "<li><b>" * 150_000, "<ul>" * 80_000 + "</li><li>" * 80_000, "<!--" * 500_000])
def test_long_broken_pages_take_linear_time(html):
    start = time.process_time()
    html_text.main_text(html)
    assert time.process_time() - start < 30
