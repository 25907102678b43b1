"""WARC round trip through byte ranges; main text of pages."""

import hashlib
import itertools
import random
import time
import zlib

import numpy as np
import pytest

from readerflow.llm import op4_warc as op4
from readerflow.llm import op5_html_extract as op5


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 3) for r in rows], "page_id long, url string, html string, digest string, n int")


def _rows():
    rng = random.Random(1)
    big, other = "<p>gleich</p>" * 100, "é" * 600
    rows = [(i, f"http://x.example/{i}", "".join(rng.choice("abc<>é\r\n") for _ in range(rng.choice([0, 10, 3000])))) for i in range(60)]
    rows += [(100, "u", big), (101, "u", big), (102, None, big), (103, "u\r\nWARC-Type: response", other), (104, "http://ö/ü", other), (105, "u", "short"), (106, "u", "short"), (107, "u", None), (108, "u", "")]
    # a payload that holds a whole archive record, which must not be taken for one
    inner = op4._member(7, "http://inner/", "inner payload", "0", None, 6)
    rows += [(109, "u", inner.decode("latin-1") * 3), (110, "u", "y" * 2_000_000), (None, "u", big), (None, "u", "no id")]
    return rows


@pytest.mark.parametrize("split", [700, 1 << 20])
def test_round_trip(spark, tmp_path, split):
    rows = _rows()
    manifest = op4.write_archives(op4.plan_records(_pages(spark, rows)).repartition(3), f"file://{tmp_path}/a{split}", roll_bytes=20_000)
    got = op4.read_archives(manifest, split_bytes=split, with_payload=True).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r["page_id"], []).append(r)
    for i, _, html in rows:
        data = (html or "").encode()
        r = next(x for x in by_id[None if i is None else str(i)] if x["payload_digest"] == hashlib.sha1(data).hexdigest())
        assert r["payload_bytes"] == len(data)
        assert r["record_type"] == "revisit" or bytes(r["payload"]) == data
    kind = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in got if r["page_id"]}
    assert kind["100"] == kind["101"] == ("revisit", "102") and kind["102"] == ("response", None)
    assert kind["103"] == ("revisit", "104") and kind["105"] == kind["106"] == ("response", None)
    assert {(r["record_type"], r["refers_to"]) for r in by_id[None]} == {("revisit", "102"), ("response", None)}


def test_ids_of_any_text_come_back(spark, tmp_path):
    ids = ["a:1", "null", "", "x>y", "%41", "é ü", "a\r\nWARC-Type: revisit", "1"]
    rows = [(i, f"http://x/{k}", f"page {k}") for k, i in enumerate(ids)] + [(None, "u", "none"), ("b:1", "u", "z" * 2000), ("b:2", "u", "z" * 2000)]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = op4.read_archives(op4.write_archives(op4.plan_records(pages), f"{tmp_path}/a")).collect()
    assert sorted(str(r["page_id"]) for r in got) == sorted(str(i) for i, _, _ in rows)
    assert sum(r["page_id"] is None for r in got) == 1
    assert {r["page_id"]: r["refers_to"] for r in got if r["refers_to"]} == {"b:1": "b:2"}


def test_uncommitted_files_are_not_read(spark, tmp_path):
    manifest = op4.write_archives(op4.plan_records(_pages(spark, _rows()[:5])), f"{tmp_path}/a")
    (tmp_path / "a" / "stray.warc.gz").write_bytes(b"\x1f\x8b\x08junk")
    assert op4.read_archives(manifest).count() == 5


def test_false_magic_is_rejected(tmp_path):
    good = op4._member(1, "u", "payload", hashlib.sha1(b"payload").hexdigest(), None, 6)
    broken = bytearray(good)
    broken[-6] ^= 1  # checksum
    path = tmp_path / "x.warc.gz"
    path.write_bytes(b"\x1f\x8b\x08 no member " + good + zlib.compress(b"not a record", wbits=31) + bytes(broken) + good)
    assert len(list(op4.read_range(str(path), 0, path.stat().st_size))) == 2


def test_empty_pages(spark, tmp_path):
    manifest = op4.write_archives(op4.plan_records(_pages(spark, [])), f"{tmp_path}/a")
    assert op4.read_archives(manifest).count() == 0


# --- main text

@pytest.fixture(scope="module")
def trees():
    return op5.fit_trees()


def _text(html, trees):
    page = op5.parse(html)
    x, _ = op5.features([page])
    return op5.page_text(page, op5.decode(page, trees.logits(x)))


def test_layouts_held_out(trees):
    rng, right = random.Random(12345), 0
    for _ in range(200):
        html = op5.training_page(rng)
        page = op5.parse(html)
        right += _text(html, trees) == op5.page_text(page, [k == 1 for k in page.keep])
    assert right >= 170


def test_decoding_is_hierarchical(trees):
    rng = random.Random(77)
    for _ in range(50):
        page = op5.parse(op5.training_page(rng))
        kept = op5.decode(page, [rng.uniform(-4, 4) for _ in page.tag])
        assert all(kept[u] for k, u in zip(kept, page.parent) if k and u >= 0)


def test_page_with_everything(trees):
    html = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
    <header class="site-header"><a href="/">Home</a></header><nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav>
    <div class="cookie-notice"><p>We use cookies on this page.</p></div><div class="ad">Buy &amp; save now</div>
    <article><h1>A &lt;title&gt;</h1><p>First   paragraph of the\n article, with <b>bold <i>text</i></b> &eacute;&#233;.<br>After the break it goes on for a while, as articles do.
    <p>Second paragraph, not closed before, and long enough to be a paragraph of its own in this article.</p>
    <!-- a <p>comment</p> --><script>document.write("<p>no</p>")</script><p>Third one is here to end the article with some more words in it.</p></article>
    <aside class="sidebar"><h3>Related</h3><a href="/x">Other</a></aside>
    <section class="comments"><h3>Comments</h3><div class="comment"><p>I liked it very much, thank you.</p></div></section>
    <form><p>Subscribe</p><input></form><footer>&copy; 2024</footer></body></html>"""
    assert _text(html, trees) == (
        "A <title>\nFirst paragraph of the article, with bold text éé. After the break it goes on for a while, as articles do.\n"
        "Second paragraph, not closed before, and long enough to be a paragraph of its own in this article.\n"
        "Third one is here to end the article with some more words in it.")


@pytest.mark.parametrize("html, want", [
    ('<p>a</p><svg viewBox="0 0 1 1"/><p>bbb</p>', "a bbb"),
    ("<video-player src=x></video-player><p>bbb</p>", "bbb"),
    ("<button-bar>z</button-bar><article><p>bbb</p></article>", "z bbb"),
    ("<article><p>so <math><mi>x</mi></math> is</p></article>", "so x is"),
    ("<script-box>in</script-box><p>bbb</p>", "in bbb"),
    *((f"<p>a</p><{t}>in<p>bbb</p>", "a in bbb") for t in "noscript template svg iframe object select button math canvas audio video".split()),
    *((f"<p>a</p><{t} x=1>in<p>no</p></{t} ><p>bbb</p>", "a bbb") for t in "script style textarea title".split()),
])
def test_only_raw_text_is_no_text(html, want):
    assert " ".join(" ".join(x for _, _, x in op5.parse(html).pieces).split()) == want


@pytest.mark.parametrize("html, want", [
    ('<p>a</p><a title="x > y" href=z>b</a> c', "ab c"), ("<p title='it\">a</p>b", "ab"), ('<p x="a>b</p> c <i>d', "b c d"), ("<p>1 < 2 and <b>3</b> <3</p>", "1 < 2 and 3 <3"),
    ('<a t="1>2" u=\'3\'>k</a><p v="open>l</p><a w=\'>m', "klm"), ("<!-- a <b> <p>x", ""), ("<p>a<!-- x --><?php y ?>b<!DOCTYPE z>c", "abc"), ("a</>b</ c>d", "a</>b</ c>d"), ("x <title>t</titles> u</title >v", "x v"),
])
def test_tags(html, want):
    assert " ".join("".join(x for _, _, x in op5.parse(html).pieces).split()) == want


@pytest.mark.parametrize("unit, tail", [
    ("<script ", ""), ("<script ", ">"), ('<a x="', ""), ('<a x="', ">"), ("<a x=\"'", "'>"), ('<a x=">', "'"), ("<a '", '"">'), ("<", ""), ("<!--", ""), ("</script ", ""), ("<title>", ""), ("</i>", ""), ("<b></i>", ""), ("<p><b></i>", ""),
    ("<li><b>", ""), ("<a b='><c d=\">", ""),
])
def test_time_is_linear(unit, tail):
    def seconds(n):
        t = time.perf_counter()
        op5.parse(unit * (n // len(unit)) + tail)
        return time.perf_counter() - t

    seconds(1000)
    assert seconds(1 << 20) < 8


def test_many_open_tags_before_stray_ends():
    for html in ("<b>" * 150_000 + "</i>" * 150_000, "<i><div>" + "<b>" * 150_000 + "</i>" * 150_000, "<p><table>" + "<b>" * 150_000 + "<p></p>" * 100_000):
        t = time.perf_counter()
        op5.parse(html)
        assert time.perf_counter() - t < 10


def test_parts_of_forms_go(trees):
    body = " ".join(["This is a sentence of the article that goes on for some words."] * 6)
    html = f"""<html><body><nav><a href=/>Home</a></nav><article><h1>A heading of it</h1><p>{body} <button>Share this</button></p><noscript>Please enable scripts.</noscript>
    <p>{body}</p><label>Size</label><select><option>One<option>Two</select><p>{body}</p></article><form><p>Mail</p><button>Send</button></form></body></html>"""
    assert _text(html, trees) == "\n".join(["A heading of it", body, body, body])


def test_decoding_is_the_best_labelling(trees):
    """Against all labellings of small trees in which nothing below a dropped node is kept."""
    rng = random.Random(5)
    for _ in range(60):
        page = op5.parse("<body>" + "".join(rng.choice(["<div>", "</div>", "<section>", "</section>", "x"]) for _ in range(14)))
        n = len(page.tag)
        z = np.array([rng.uniform(-3, 3) for _ in range(n)])
        value = lambda kept: sum(-np.logaddexp(0, -v) if k else -np.logaddexp(0, v) for k, v in zip(kept, z))
        fair = [kept for kept in itertools.product([False, True], repeat=n) if all(not k or u < 0 or kept[u] for k, u in zip(kept, page.parent))]
        assert abs(value(op5.decode(page, z)) - max(map(value, fair))) < 1e-9


def test_odd_pages(spark, trees):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    rows = [(1, None, None), (2, "u", ""), (3, "u", "   "), (4, "u", "<"), (5, "u", "<p"), (6, "u", "</p></div><article>"), (7, "u", deep), (8, "u", "<p>" + "word " * 200_000), (9, "u", "<a b='"), (9, "u", "<a b='"), (None, "u", "<p>x</p>")]
    out = op5.extract_text(_pages(spark, rows), trees).collect()
    assert len(out) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in out)
    assert {r["text"] for r in out if r["page_id"] in (1, 2, 3)} == {""}
    assert op5.extract_text(_pages(spark, []), trees).count() == 0


def test_given_pages(spark, trees):
    import html as h
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r["text"] for r in op5.extract_text(pages, trees).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = (" ".join(h.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert got[r["page_id"]] == "\n".join(b for b in blocks if b)
