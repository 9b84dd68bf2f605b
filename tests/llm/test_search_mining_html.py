"""Operators 11 to 13: HTML extraction, phrase mining, ranked search."""

import html as entities
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reelspark.llm import html_text, phrase_mining, queries, ranked_search

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- 11

ARTICLE = "One sentence, with a comma, and enough letters to count as a paragraph."
OTHER = "A second paragraph follows it, again of more than a few words."

PAGES = {
    "menus, headers, footers, sidebars and adverts": (
        f"<html><head><title>T</title><style>p{{}}</style></head><body><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav><div id=page-sidebar><p>{OTHER}</p></div>"
        f"<article><h1>Head &amp; line</h1><p>{ARTICLE}</p><aside>Other news</aside><div class='ad'>Buy, buy, buy!</div><p>{OTHER}</p></article><footer><p>{ARTICLE}</p></footer></body></html>",
        f"Head & line\n{ARTICLE}\n{OTHER}",
    ),
    "no article element": (
        f"<body><div class=menu><a href=1>a</a> <a href=2>b</a></div><div><div><h2>Title</h2><p>{ARTICLE}<p>{OTHER}</div></div><div><a href=x>{ARTICLE}</a></div>",
        f"Title\n{ARTICLE}\n{OTHER}",
    ),
    "siblings of the best container": (
        f"<body><main><section><p>{ARTICLE} {ARTICLE}</p></section><section><p>{OTHER}</p></section></main><div class='cookie-notice'><p>{ARTICLE} {ARTICLE} {ARTICLE}</p></div>",
        f"{ARTICLE} {ARTICLE}\n{OTHER}",
    ),
    "reader comments": (
        f"<body><article><p>{ARTICLE}</p></article><section id=comments><article class=comment><p>{OTHER} {ARTICLE} {ARTICLE}</p></article></section>",
        ARTICLE,
    ),
    "forms, notices, scripts and hidden text": (
        f"<article><p>{ARTICLE}</p><form><label>Mail</label><input><button>Go</button></form><noscript>No script</noscript><p hidden>Not shown</p><p style='color:red; display: none'>Nor this</p>"
        f"<script>if (a < b) document.write('<p>no</p>')</script><div role=alert>Watch out</div><p>{OTHER}</article>",
        f"{ARTICLE}\n{OTHER}",
    ),
    "a list that is a menu, and one that is not": (
        f"<article><p>{ARTICLE}</p><ul><li><a href=1>First link</a><li><a href=2>Second link</a></ul><ul><li>Item <a href=3>three</a> is text</li><li>Item four</ul></article>",
        f"{ARTICLE}\nItem three is text\nItem four",
    ),
    "white space, references, line breaks and unclosed tags": (
        f"<ARTICLE><P>{ARTICLE}\n  <b>bold</B>er&nbsp;&eacute;&#x41;&#66; x<br>y <i>z<p title='a > b' data-x=\"<p>\">{OTHER}<!-- <p>gone</p> --> a < b & c<table><tr><td>1<td>2<tr><td>3</table>",
        f"{ARTICLE} bolder éAB x y z\n{OTHER} a < b & c\n1\n2\n3",
    ),
    "an article of one word": ("<body><p>Loud advert, with commas, many, many commas.</p><article><p>Word</p></article>", "Word"),
    "text alone": ("plain words", "plain words"),
    "an unclosed comment and an unclosed tag": (f"<article><p>{ARTICLE}</p><!-- rest <p>{OTHER}", ARTICLE),
    "an unclosed script": (f"<article><p>{ARTICLE}</p><script>x <p>{OTHER}</p>", ARTICLE),
    "a tag that never ends": (f"<article><p>{ARTICLE}</p>more <a href='", f"{ARTICLE}\nmore"),
    "nothing but a menu": ("<nav><a href=1>one</a></nav><footer>two</footer>", ""),
    "nested and stray end tags": (f"</div></p><article><div><p>{ARTICLE}</div></span></section><p><em>{OTHER}</p></em></article></div>", f"{ARTICLE}\n{OTHER}"),
    "headers inside the article": (f"<header>Site</header><article><header><h1>Title</h1></header><p>{ARTICLE}</p><footer>Tags</footer></article>", f"Title\n{ARTICLE}"),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text_of_made_pages(name):
    source, want = PAGES[name]
    assert html_text.main_text(source) == want


def test_main_text_of_all_pages_of_the_table(spark):
    rows = queries.QUERIES["op11_html_extraction"](spark, "/root/testdata/sf0.01").collect()
    pages = {r.page_id: r for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        own = pages[r.page_id].html
        inner = own[own.index("<article>") + 9 : own.index("</article>")]
        parts = [" ".join(entities.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(x for x in parts if x) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_reading_is_linear_and_never_fails():
    pick = random.Random(11)
    pieces = ["<p>", "</p>", "<div class='a b'>", "</div>", "<a href=x>", "</a>", "<table>", "<tr>", "<td>", "</table>", "<li>", "<ul>", "</ul>", "<", ">", "'", '"', "<!--", "-->", "text, ", "&amp;", "<script>", "</script>", "<b", "</", "<h1>", "</h2>", "<br/>", "é"]
    for _ in range(3000):
        html_text.main_text("".join(pick.choice(pieces) for _ in range(pick.randint(0, 40))))
    for long in ("<div>" * 20_000 + "x", "<b>" * 20_000 + "</i>" * 20_000, "<p>a" * 20_000, "<a " * 50_000, '<a b="' * 20_000, "<li>" * 20_000):
        html_text.main_text(long)


def test_html_of_edge_rows(spark):
    rows = [(1, "<p>a</p>", "x", "y"), (1, "<p>a</p>", "x", "y"), (2, None, None, None), (3, "", "x", "y"), (None, "<p>" + "long words, " * 20_000, "z", None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, TEXT string, N_Chars string")
    found = html_text.extract(pages)
    assert found.columns == ["page_id", "html", "text", "n_chars"]
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in found.collect())
    assert got[1:] == [(1, "a", 1), (1, "a", 1), (2, "", 0), (3, "", 0)] and got[0][2] == 20_000 * 12 - 1
    assert html_text.extract(pages.where("false")).count() == 0


# --- 12


def brute_phrases(rows, support, longest):
    """Counts of all phrases by language, the frequent ones kept; and each language's words."""
    counts, words = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            own = re.findall(r"[^\x20\x09]+", piece)
            words[lang or "und"] += len(own)
            for n in range(1, longest + 1):
                for k in range(len(own) - n + 1):
                    counts[lang or "und", tuple(own[k : k + n])] += 1
    return {k: v for k, v in counts.items() if v >= support}, words


def brute_collocations(frequent, words, top):
    out = []
    for (lang, phrase), a in frequent.items():
        if len(phrase) < 2:
            continue
        if any(len(p) > len(phrase) and g == lang and 100 * f >= 50 * a and any(p[k : k + len(phrase)] == phrase for k in range(len(p))) for (g, p), f in frequent.items()):
            continue
        cuts = []
        for k in range(1, len(phrase)):
            left, right = frequent[lang, phrase[:k]], frequent[lang, phrase[k:]]
            cuts.append((10**6 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.append((lang, -score, -a, " ".join(phrase).encode(), left, right))
    rows = []
    for lang in words:
        for rank, (_, score, a, phrase, left, right) in enumerate(sorted(r for r in out if r[0] == lang)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, words[lang], -score))
    return sorted(rows)


def prose(pick, number):
    names = ["the", "of", "new", "York", "time", "ÉT", "a-b", "x'y", "\x00z", "long\xa0word"] + [f"w{k}" for k in range(60)]
    weights = [20, 15, 8, 8, 6, 3, 3, 2, 1, 2] + [1] * 60
    return "".join(w + pick.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]) for w in pick.choices(names, weights, k=number))


@pytest.mark.parametrize("fraction, longest", [(0.05, 3), (0.25, 3), (1, 3), (0.1, 5)])
def test_mining_against_brute_force_whatever_the_sample_holds(spark, fraction, longest):
    pick = random.Random(12)
    rows = [(pick.choice(["en", "en", "fr", None]), prose(pick, pick.randint(0, 60))) for _ in range(150)]
    rows += [("en", "ice cream van sells ice cream van ice cream van")] * 9 + [("de", None), ("de", ""), ("fr", "..! ,"), ("xx", "ab ab ab ab ab ab ab ab ab ab ab ab")]
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("F", F.lit(1)).repartition(5)
    frequent, steps = phrase_mining.mine(docs, support=10, longest=longest, fraction=fraction)
    want, words = brute_phrases(rows, 10, longest)
    got = {(r.lang, tuple(r.phrase.split(" "))): r.f for r in frequent.where("n > 0").collect()}
    assert got == want and 1 <= steps <= longest + 1
    assert steps == 1 if fraction == 1 else steps > 1
    assert {r.lang: r.f for r in frequent.where("n = 0").collect() if r.f} == {k: v for k, v in words.items() if v}
    found = phrase_mining.collocations(frequent, top=25).collect()
    assert sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found) == brute_collocations(want, words, 25)


def test_full_filters_only_cost_time(spark, monkeypatch):
    monkeypatch.setattr(phrase_mining, "LEAST_BITS", 15)
    monkeypatch.setattr(phrase_mining, "MOST_BITS", 15)
    pick = random.Random(13)
    rows = [("en", prose(pick, 50)) for _ in range(60)]
    frequent, _ = phrase_mining.mine(spark.createDataFrame(rows, "lang string, text string"), support=4)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in frequent.where("n > 0").collect()} == brute_phrases(rows, 4, 3)[0]


@pytest.mark.parametrize("at_once", [1, 300, 1 << 20])
def test_runs_of_hashes_add_up(monkeypatch, at_once):
    monkeypatch.setattr(phrase_mining, "RUN_HASHES", at_once)
    rng = np.random.default_rng(at_once)
    slices = [(n, rng.choice(rng.integers(0, 2**64, 700, np.uint64), size)) for n in (1, 2) for size in (0, 1, 5000, 900)]
    slices += [(1, slices[2][1][:50]), (2, slices[2][1]), (1, np.array([0, 2**64 - 1] * 3, np.uint64))]
    runs = pa.Table.from_batches([r for n, hashes in slices for r in phrase_mining._runs(n, hashes)]).sort_by([("n", "ascending"), ("bucket", "ascending")])
    times = Counter((n, h) for n, hashes in slices for h in hashes.tolist())
    found = [r for b in phrase_mining._sums(iter(runs.to_batches(max_chunksize=64)), 4) for r in b.to_pylist()]
    assert len(found) == len({(r["n"], r["hash"]) for r in found})
    assert {(r["n"], r["hash"] % 2**64) for r in found} == {k for k, f in times.items() if f >= 4}


def test_spark_moves_runs_of_hashes(spark):
    """A row for each beginning of a slice, not for each phrase, and the same hashes whatever the partitions."""
    words = [" ".join(f"w{(k * 7919 + j * j) % 40000}" for j in range(2000)) for k in range(20)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 20, "text": words})
    hashes = phrase_mining.Words(batch).hashes[phrase_mining.Words(batch).number]
    rows = [r for part in (hashes[:9000], hashes[9000:], hashes[:5]) for b in phrase_mining._runs(1, part) for r in b.to_pylist()]
    assert len(rows) <= 2 * 2**phrase_mining.RUN_BITS + 5 < len(hashes)
    runs = spark.createDataFrame([tuple(r.values()) for r in rows], phrase_mining._RUNS)
    times = Counter([*hashes.tolist(), *hashes[:5].tolist()])
    got = [r.hash % 2**64 for r in phrase_mining.often(runs.repartition(7), 2).collect()]
    assert len(got) == len(set(got)) and set(got) == {h for h, f in times.items() if f >= 2}


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 3 * 10**12 + 7, 3 * 10**12 + 11, 5 * 10**12 + 1
    rows = [("en", 2, "x y", a), ("en", 1, "x", left), ("en", 1, "y", right), ("en", 0, "", 10**13)]
    (r,) = phrase_mining.collocations(spark.createDataFrame(rows, "lang string, n int, phrase string, f long")).collect()
    assert r.score == 10**6 * a * a // (left * right) and (r.a, r.l, r.r, r.n) == (a, left, right, 10**13)


def test_mining_of_empty_tables(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert phrase_mining.collocations(phrase_mining.mine(none)[0]).count() == 0
    null = spark.createDataFrame([(None, None)], "lang string, text string")
    assert phrase_mining.collocations(phrase_mining.mine(null)[0]).count() == 0
    for bad in ({"longest": 1}, {"support": 0}, {"fraction": 0}):
        with pytest.raises(ValueError):
            phrase_mining.mine(none, **bad)


# --- 13


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_search(docs, items, k=10):
    own = [(i, Counter(terms_of(t))) for i, t in docs]
    some = [c for _, c in own if c]
    number, total = len(some), sum(sum(c.values()) for c in some)
    df = Counter(t for c in some for t in c)
    out = []
    for q, (item, text) in enumerate(items):
        scored = []
        for i, c in own:
            if c:
                m = 25 + 75 * sum(c.values()) * number // total
                score = sum(times * math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, times in Counter(terms_of(text)).items() if t in c)
                if score > 0:
                    scored.append((-score, i is None, i))
        out += [(item, q, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return out


def spoken(pick, number):
    return " ".join(pick.choices(["the", "Of", "and", "alpha", "BETA", "größe", "x1"] + [f"t{k}" for k in range(40)], [30, 20, 10, 3, 3, 2, 2] + [1] * 40, k=number))


@pytest.mark.parametrize("block, words", [(1 << 19, 10**6), (200, 10**6), (1 << 19, 30)])
def test_search_against_brute_force(spark, monkeypatch, block, words):
    monkeypatch.setattr(ranked_search, "BLOCK_ENTRIES", block)
    pick = random.Random(14)
    docs = [(k, spoken(pick, pick.randint(0, 80))) for k in range(500)] + [(1000 + k, "copy of the beta text t1") for k in range(300)]
    docs += [(None, "copy of the beta text t1"), (None, "t3 t4"), (7, spoken(pick, 30)), (2000, None), (2001, ""), (2002, "?!"), (2003, "the " * 20_000)]
    items = [(k, spoken(pick, pick.randint(1, 25))) for k in range(15)] + [(20, "copy beta t1"), (21, None), (22, "!"), (23, "absent"), (None, "t3 t3 t4"), (0, "alpha")]
    found = ranked_search.search(spark.createDataFrame(docs, "doc_id long, text string").withColumn("RANK", F.lit(1)).repartition(4), spark.createDataFrame(items, "item_id long, text string"), max_item_words=words)
    got = sorted((r.item_id is None, r.item_id or 0, r["rank"], r.doc_id is None, r.doc_id or 0, r.score) for r in found.collect())
    assert got == sorted((item is None, item or 0, rank, i is None, i or 0, s) for item, _, rank, i, s in brute_search(docs, items))


def test_bounds_hold_and_spare_documents():
    pick = random.Random(15)
    texts = [spoken(pick, pick.randint(5, 60)) for _ in range(4000)]
    items = ranked_search.Items.of(pa.array(["alpha größe t1 t2", "t5 t6 t7"]))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    (ids, lengths, sizes, term, tf), count = ranked_search._vectors(batch, items.hashes)
    block = ranked_search.Vectors(ids, lengths, np.concatenate([[0], np.cumsum(sizes)]), term, tf)
    df = np.bincount(term, minlength=len(items.hashes))
    found = ranked_search.Statistics(int((count > 0).sum()), int(count.sum()), df)
    rank = np.argsort(np.argsort(-df, kind="stable"), kind="stable")
    tree, weight = ranked_search.Tree(block, rank, found), ranked_search.weights(found)
    assert sorted(tree.docs.tolist()) == list(range(len(ids)))
    for n in range(2):
        own = np.zeros(len(items.hashes), np.int64)
        own[items.term[items.at[n] : items.at[n + 1]]] = weight[items.term[items.at[n] : items.at[n + 1]]]
        scores = np.add.reduceat(own[tree.term] * tree.part, tree.at[:-1])
        for node in range(len(tree.low)):
            assert tree.bounds(node, node + 1, own)[0] >= scores[tree.low[node] : tree.high[node]].max()
        best = ranked_search.Best(10)
        assert tree.search(own, best) < 0.5 * len(ids)
        assert best.scores.tolist() == sorted(scores.tolist(), reverse=True)[:10]


def test_search_of_empty_tables(spark):
    docs, items = (spark.createDataFrame([(1, "one two")], f"{name} long, text string") for name in ("doc_id", "item_id"))
    assert ranked_search.search(docs.where("false"), items).count() == 0
    assert ranked_search.search(docs, items.where("false")).count() == 0
    assert [tuple(r)[:3] for r in ranked_search.search(docs, items).collect()] == [(1, 1, 1)]
