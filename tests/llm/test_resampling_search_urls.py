"""Importance resampling, ranked search and url filters against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from brute_path import brute

from readerflow.llm import op11_importance as op11
from readerflow.llm import op12_lexical_search as op12
from readerflow.llm import op13_url_filters as op13
from readerflow.llm.terms import Terms, count_terms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
VOCAB = [f"w{i}" for i in range(120)] + ["Äpfel", "ÄPFEL", "naïve", "9", "UPPER", "x" * 40, "x" * 41, "日本語"]


def _terms(text):
    return TERM.findall((text or "").translate(brute.ASCII_LOWER))


def _say(rng, n):
    return "".join(rng.choice(VOCAB) + rng.choice([" ", "  ", "\n", ", ", "-", "_"]) for _ in range(n))


def _rows(rng, n=60):
    rows = [(i, _say(rng, rng.choice([0, 1, 5, 19, 20, 21, 60, 200]))) for i in range(n)]
    long = " ".join(rng.choice(VOCAB) for _ in range(150_000)) + " " + "y" * 100_000
    return rows + [(100, None), (101, ""), (102, "--- \n"), (103, rows[7][1]), (103, rows[7][1]), (None, rows[8][1]), (104, long), (105, "a\0b \x7fc")]


# --- terms

def test_terms_equal_pattern():
    texts = ["Ab-c9 Ä", None, "", "x", "ends", " _ ", "日本 GO", "a\nb"]
    t = Terms(pa.array(texts))
    assert [[bytes(t.data[b:e]).decode().translate(brute.ASCII_LOWER) for b, e, d in zip(t.begin, t.end, t.doc) if d == k] for k in range(len(texts))] == [_terms(x) for x in texts]
    assert count_terms(pa.array(texts)).tolist() == [len(_terms(x)) for x in texts] == t.count.tolist()
    assert count_terms(pa.array(["zz", *texts, "q"]).slice(1, len(texts))).tolist() == t.count.tolist()


# --- importance resampling

def test_keys_are_xxhash64():
    rng = random.Random(1)
    words = [bytes(rng.choices(range(1, 256), k=n)) for n in list(range(0, 70)) * 3]
    data = np.frombuffer(b"".join(words), np.uint8)
    end = np.cumsum([len(w) for w in words])
    s = op11.Spans(data, end - [len(w) for w in words], end)
    assert s.keys().tolist() == [xxhash.xxh64_intdigest(w) for w in words]
    i, j = np.divmod(np.arange(len(words) ** 2), len(words))
    assert s.same(i, j).tolist() == [words[a] == words[b] for a, b in zip(i.tolist(), j.tolist())]
    a, b = np.array([1, 2 ** 31]), np.array([7, 5])
    assert op11.pair_keys(a, b).tolist() == [xxhash.xxh64_intdigest(int(x).to_bytes(4, "little") + int(y).to_bytes(4, "little")) for x, y in zip(a, b)]


def test_intern_keeps_colliding_keys_apart():
    items = np.array([random.Random(k).randrange(40) for k in range(500)])
    slot, example = op11.intern((items % 3).astype(np.uint64), lambda a, b: items[a] == items[b])
    assert (items[example][slot] == items).all() and len(example) == len(set(items.tolist()))
    slot, example = op11.intern(np.zeros(0, np.uint64), None)
    assert len(slot) == len(example) == 0


def _features(text):
    w = _terms(text)
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def _resample(rows, target, buckets, percent, min_words):
    s, t = Counter(), Counter()
    for c, texts in ((s, [x for _, x in rows]), (t, target)):
        for x in texts:
            c.update(zlib.crc32(g.encode()) % buckets for g in _features(x))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + buckets) / ((s[b] + 1) * (sum(t.values()) + buckets)))) for b in range(buckets)]
    out = []
    for i, x in rows:
        f = _features(x)
        weight = sum(gain[zlib.crc32(g.encode()) % buckets] for g in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(_terms(x)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(fit):
        r.append(k + 1 if k < percent * len(fit) // 100 else None)
    return sorted((str(r[0]), *r[1:5], r[5] if len(r) > 5 else None) for r in out)


@pytest.mark.parametrize("buckets,percent", [(10_000, 25), (7, 100), (50, 60)])
def test_resample_equals_brute_force(spark, documents, buckets, percent):
    rng = random.Random(2)
    rows, target = _rows(rng), [_say(rng, 30) for _ in range(5)] + [None, ""]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = op11.resample(documents(rows), bench, buckets=buckets, percent=percent)
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got.collect()) == _resample(rows, target, buckets, percent, 20)


def test_resample_batches_agree(documents, spark, monkeypatch):
    rows = _rows(random.Random(3), 30)
    bench = spark.createDataFrame([(1, rows[6][1])], "item_id long, text string")
    key = lambda df: sorted(map(str, df.collect()))
    whole = key(op11.resample(documents(rows), bench))
    monkeypatch.setattr(op11, "SLICE", 500)
    assert key(op11.resample(documents(rows).repartition(7), bench)) == whole


def test_resample_empty(documents, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert op11.resample(documents([]), none).count() == 0
    got = op11.resample(documents([(1, "a " * 30), (2, None)]), none, percent=100)
    assert sorted((r["doc_id"], r["rank"]) for r in got.collect()) == [(1, 1), (2, None)]


# --- ranked search

def _search(rows, items, k=20):
    docs = [(i, Counter(_terms(x))) for i, x in rows]
    docs = [(i, c, c.total()) for i, c in docs if c]
    n_docs, total = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in {x for x in items if x[1]}:
        scored = []
        for i, c, n in docs:
            m = 100 - 25 + 25 * n * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in _terms(text) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def _items(rng, rows):
    items = [(k, _say(rng, rng.choice([1, 3, 10, 40]))) for k in range(20)] + [(50, rows[5][1]), (51, None), (52, ""), (53, "..."), (54, "unheard of"), (55, "w1 " * 500)]
    return items + [(56, "w1 w2"), (56, "w1 w2"), (56, "w3 w4"), (None, "w5")]


@pytest.mark.parametrize("block,items_a_part,step", [(200_000, 128, 64), (100, 3, 2)])
def test_search_equals_brute_force(spark, documents, monkeypatch, block, items_a_part, step):
    monkeypatch.setattr(op12, "ITEMS", items_a_part)
    monkeypatch.setattr(op12, "STEP", step)
    rng = random.Random(4)
    rows = _rows(rng)
    items = _items(rng, rows)
    table = spark.createDataFrame([(*x, 1, "z") for x in items], "item_id long, text string, doc_id long, rank string")
    for k in (20, 3):
        got = op12.search(documents(rows).repartition(5), table, k=k, block_chars=block).collect()
        assert sorted(map(tuple, got), key=str) == _search(rows, items, k)


def test_bounds_hold_and_spare_work(documents):
    """Every bound is at least the score, and most documents are never scored."""
    rng = random.Random(5)
    texts = [" ".join(f"t{rng.randrange(4000)}" for _ in range(100)) for _ in range(400)]
    doc, h, tf, n = op12.term_counts(pa.array(texts))
    m = 75 + 25 * n * len(texts) // int(n.sum())
    where, spot, top = op12.sketch(doc, h, op12.impacts(tf, m[doc]))
    item, ih, count, _ = op12.term_counts(pa.array(texts[:3] + ["t1 t2 t3"]))
    df = Counter(h.tolist())
    q = op12.Queries([0, 1, 2, 3], item, ih, np.array([op12.term_weight(len(texts), df[x]) for x in ih.tolist()]) * count)
    bounds = q.bounds(len(texts), where, spot, top)
    batch = op12.Batch(q, np.searchsorted(doc, np.arange(len(texts) + 1)), h, tf, m)
    exact = np.stack([batch.exact(i, np.arange(len(texts))) for i in range(4)], 1)
    assert (bounds >= exact).all() and (exact[[0, 1, 2], [0, 1, 2]] == exact[:, :3].max(0)).all()
    best = op12.Best(4, 1)
    assert best.search(batch, bounds, list(range(len(texts)))) < 4 * len(texts) * 0.75
    assert [r[0][1] for r in best.rows[:3]] == [0, 1, 2]


def test_search_empty(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert op12.search(documents([(1, "a b")]), none).count() == 0
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert op12.search(documents([]), some).count() == 0
    got = op12.search(documents([(1, "A"), (2, "a"), (3, "c")]), some).collect()
    assert [(r["rank"], r["doc_id"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1), (2, 2)]


# --- url filters

def _judge(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group().translate(brute.ASCII_LOWER)
    path = re.match(r"[^/?#]*([^?#]*)", rest).group(1)
    fit = [(len(h + p), h.count("."), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)] if host else []
    best = max(fit, default=None)
    return host, path, best and best[2], best[3] if best else default


URLS = [None, "", "nourl", "http://", "http:///es/x", "HTTP://WWW.Example.ORG/es/1?q=/x#y", "http://example.org", "http://example.org?x", "http://example.org/es", "http://badexample.org/es/",
        "https://a.b.c.example.org:80/en/1", "http://org/", "http://com/fr/", "http://x.com/de/", "http://x.com/fr/de/", "x://y://z.org/a", "http://.org/", "http://a..org/b", "http://äö.org/ü", "http://com./fr/",
        "http://u@example.org/es/", "http://example.org/en/12\n3", "http://deep." + "s." * 3000 + "org/p", "http://x.org/" + "p" * 100_000]


@pytest.mark.parametrize("chunks", [1, 3, 16])
def test_urls_equal_brute_force(spark, chunks):
    rng = random.Random(6)
    hosts = ["org", "com", "example.org", "a.example.org", "b.a.example.org", "x.com", "äö.org"]
    paths = ["", "/", "/e", "/es/", "/es/1", "/es/12", "/en/1", "/ü"]
    urls = URLS + [f"http://{rng.choice(['', 'www.', 'm.'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '1', '/2', '?q'])}" for _ in range(300)] + ["http://www.example.org/es/1"] * 300
    pages = spark.createDataFrame([(k if k % 50 else None, u, "clash", "more") for k, u in enumerate(urls)], "page_id long, url string, rule string, host string")
    some = [(h, p, rng.choice(["allow", "block"])) for h in hosts for p in paths if rng.random() < 0.5]
    for rules in (list(op13.RULES), some):
        got = op13.judge_urls(pages, op13.rule_table(spark, rules), chunks=chunks).collect()
        want = [(None if k % 50 == 0 else k, *_judge(u, rules)) for k, u in enumerate(urls)]
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_url_rules_odd(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    rules = spark.createDataFrame([("A.org", "/x", "allow"), ("a.org", "/x", "block"), (None, "/", "block"), ("org", None, "allow"), ("a.org", "/", None)], "host string, path string, verdict string")
    assert [tuple(r) for r in op13.judge_urls(pages, rules).collect()] == [(1, "a.org", "/x", "a.org/x", "block")]
    assert op13.keep_allowed(pages, rules).count() == 0
    assert [tuple(r) for r in op13.judge_urls(pages, rules.limit(0), default="block").collect()] == [(1, "a.org", "/x", None, "block")]
    assert op13.judge_urls(pages.limit(0), rules).count() == 0


def test_urls_native(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = op13.judge_urls(pages, op13.rule_table(spark, op13.RULES))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
