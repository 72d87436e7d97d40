"""Page text, Merkle manifest, ranked search."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from math import floor, log

import numpy as np
import pytest
from pyspark.sql import functions as F

from urlgauge.llm import merkle, page_text, ranked_search
from urlgauge.llm.page_text import Page

from .conftest import TEXTS, rows_of


# Page text

def text(html):
    return Page(html).text(set(), set())


@pytest.mark.parametrize("html, wanted", [
    ("", ""),
    ("<p>a<p>b <b>c</b>d</p>e", "a\nb cd\ne"),
    ("<article><h1>T</h1><p>1 &lt; 2&nbsp;&amp; &#x33;<ul><li>a<li> b \n c</ul><table><tr><td>1<td>2<tr><td>3</table></article>out",
     "T\n1 < 2 & 3\na\nb c\n1 2\n3"),
    ("<p>one<br>two<hr>three", "one two\nthree"),
    ("<div class='site-footer'>x</div><p id=cookieNotice>y</p>z", "z"),
    ("<script>if (a<b) {'</p>'}</script>x<style>y", "x"),
    ("<!-- <p>no</p> --><p title='a > b'>q</p><scr", "q"),
    ("<body class='has-sidebar'><main><nav>n</nav><div>m</div></main><div>o</div></body>", "m"),
    ("<article><header><h1>t</h1></header><p>b</p><section class=comments><article>c</article></section><footer>f</footer></article>", "t\nb"),
    ("<header>h</header><div role=navigation>n</div><div hidden>i</div><div><h1>t</h1><form>f</form><aside>s</aside></div>", "t"),
    ("<main><article>a</article><article>b</article></main><article>teaser</article>", "a\nb"),
    ("a < b &am &quo; &amp", "a < b &am &quo; &"),
    ("<p class=adverb>stays</p><p class='x ad'>goes</p>", "stays"),
    ("<div style='display: none'>i</div><article></article>t", "t"),
])
def test_text_of(html, wanted):
    assert text(html) == wanted


@pytest.mark.parametrize("html", ["<div>" * 20_000 + "x", "<a 'b " * 20_000, "<p>" * 30_000, "</div>" * 30_000,
                                  '<x ="' * 20_000, "word " * 200_000, "<b class=x>" * 2_000 + "</i>" * 2_000])
def test_long_and_broken_pages_end(html):
    text(html)


def site(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars string, host string, slots int")


def test_templates_are_told_by_recurrence(spark):
    """No tag or class word says what these blocks are. The quoted passage and the copied article stay."""
    rows = []
    for n in range(12):
        own = "copied article" if n in (3, 4, 5) else f"article {n} of its own"
        quote = "<p>a passage that many quote</p>" if n % 3 == 0 else ""
        rows.append((n, "https://U@Host.example:80/x", f"<div class=x1>Fixed line</div><div class=x2>Offer {n % 4}</div>"
                     f"<div class=x3><h1>{own}</h1>{quote}<p>{own} goes on</p></div>", None, None, None, None))
    rows.append((99, "https://other.example/", "<div class=x1>Fixed line</div><p>t</p>", None, None, None, None))
    got = {r["page_id"]: r["text"] for r in page_text.main_text(site(spark, rows)).collect()}
    for n in range(12):
        own = "copied article" if n in (3, 4, 5) else f"article {n} of its own"
        assert got[n] == "\n".join([own] + ["a passage that many quote"] * (n % 3 == 0) + [f"{own} goes on"])
    assert got[99] == "Fixed line\nt"


def test_odd_pages(spark):
    rows = [(1, None, None, "c", "c", "c", 1), (None, "no scheme", "", None, None, None, None), (2, "http://h/", "<p>x</p>", None, None, None, None),
            (2, "http://h/", "<p>x</p>", None, None, None, None), (3, "http://h/", "w " * 300_000, None, None, None, None)]
    got = page_text.main_text(site(spark, rows)).collect()
    assert got[0].__fields__ == ["page_id", "url", "text", "n_chars"]
    assert Counter((r["page_id"], r["text"], r["n_chars"]) for r in got) == Counter(
        [(1, "", 0), (None, "", 0), (2, "x", 1), (2, "x", 1), (3, ("w " * 300_000).strip(), 599_999)])
    assert page_text.main_text(site(spark, [])).count() == 0


# Merkle manifest

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(*values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(digests):
    """All levels, from the leaves to one node."""
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def plain_proofs(rows, shown):
    """rows: (doc_id, text, lang, source, n_chars)."""
    groups = defaultdict(list)
    for at, (i, t, lang, source, n) in enumerate(rows):
        groups[source].append((i is not None, i or 0, plain_leaf(i, source, lang, n, t), at))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([g[2] for g in sorted(groups[s])]) for s in order}
    over = plain_tree([trees[s][-1][0] for s in order])
    for s in order:
        for place, (_, _, leaf, at) in enumerate(sorted(groups[s])):
            i, t, lang, source, n = rows[at]
            fold, siblings = plain_leaf(i, source, lang, n, shown(i, t)), []
            for levels, number in ((trees[s], place), (over, order.index(s))):
                for level in levels[:-1]:
                    run = level[number // 16 * 16:number // 16 * 16 + 16]
                    siblings += run[:number % 16] + run[number % 16 + 1:]
                    fold, number = H(*run[:number % 16], fold, *run[number % 16 + 1:]), number // 16
            yield i, leaf, trees[s][-1][0], over[-1][0], H(*siblings), fold, fold == over[-1][0]


def lowered(i, t):
    altered = t is not None and i is not None and zlib.crc32(str(i).encode()) % 5 == 0
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) if altered else t


def verified(df):
    altered = merkle.leaf_digest(text=F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return Counter(map(tuple, merkle.verify(df, F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, altered)).collect()))


def test_proofs_of_odd_rows(spark, odd, none):
    rows = [r[:5] for r in rows_of(TEXTS)] + [(None,) * 5]
    assert verified(odd) == Counter(plain_proofs(rows, lowered))
    assert merkle.verify(none).count() == 0
    single = odd.where("doc_id = 7")
    (row,) = merkle.verify(single).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"]
    assert row["proof_sha256"] == H() and row["verified"]


def test_proofs_of_many_levels(spark):
    """A source of 300 rows (three levels), one of 17, and 18 small ones, so that the tree of sources has two levels."""
    rows = [(i, f"Text {i}", "en", "hot", 1) for i in range(300)] + [(1000 + i, "T", None, "seventeen", 2) for i in range(17)]
    rows += [(2000 + i, None if i % 2 else "Z", "de", f"s{i}", i) for i in range(18)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    got, wanted = verified(df), Counter(plain_proofs(rows, lowered))
    assert got == wanted and 0 < sum(not r[-1] for r in got) < len(rows)
    nodes = merkle.build(df).nodes
    linked = nodes.alias("n").join(nodes.alias("p"), F.col("n.parent") == F.col("p.node"))
    assert linked.where("element_at(p.children, n.place + 1) <> n.digest").count() == 0
    assert nodes.where("parent is null").count() == 1 and linked.count() == nodes.count() - 1
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") != "-1"


# Ranked search

def plain_terms(t):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")]


def plain_search(docs, items, k=50):
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    documents, total = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    for item, t in items:
        found = []
        for i, c in counts:
            n = sum(c.values())
            score = sum(floor(1000 * log((2 * documents + 2) / (2 * df[w] + 1))) *
                        (10 ** 9 * c[w] // (1000 * c[w] + 20 * (50 + 50 * n * documents // total)))
                        for w in set(plain_terms(t)) if c[w])
            if score:
                found.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(found)[:k]):
            yield item, rank + 1, i, -score


def test_search_of_odd_rows(spark, odd, none):
    items = [(1, "Alpha BETA one"), (1, "Alpha BETA one"), (2, None), (None, "the id, a text; two"), (3, "é 😀 ß"), (4, "..."), (5, "word " * 50_000)]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1)).withColumn("rank", F.lit(1))
    docs = [(i, t) for i, t, *_ in TEXTS] + [(None, None)]
    for k in (50, 2):
        got = ranked_search.search(odd, asked, k)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and dict(got.dtypes)["rank"] == "int"
        assert Counter(map(tuple, got.collect())) == Counter(plain_search(docs, items, k))
    assert ranked_search.search(none, asked).count() == 0 and ranked_search.search(odd, asked.limit(0)).count() == 0


def test_blocks_change_nothing(spark, docs, sf_dir, monkeypatch):
    """Items in several passes; `search` runs in the driver's process here only up to the tasks, so blocks are tried below."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    whole = Counter(map(tuple, ranked_search.search(docs, items, 7).collect()))
    monkeypatch.setattr(ranked_search, "ITEM_BYTES", 2_000)
    assert Counter(map(tuple, ranked_search.search(docs, items, 7).collect())) == whole


@pytest.mark.parametrize("seed", range(12))
def test_intervals_close_on_the_best(seed):
    """Random lists with many ties against full sums; entries are read from the top only."""
    rng = np.random.default_rng(seed)
    n, k = 5_000, 20
    full, lists, entries = np.zeros(n, np.int64), [], 0
    for _ in range(rng.integers(1, 9)):
        docs = rng.choice(n, rng.integers(1, n), replace=False)
        impact = np.sort(rng.integers(1, 30 if seed % 2 else 10 ** 9, len(docs)))[::-1]
        full[docs] += impact
        lists.append((docs, impact))
    for least in (1, int(np.sort(full)[-5])):
        found, score = ranked_search.nra(lists, n, k, least)
        bar = max(least, 1, int(np.sort(full)[-k]))
        assert set(found.tolist()) == set(np.flatnonzero(full >= bar).tolist())
        assert (full[found] == score).all()


def test_reading_stops_early():
    """One list decides: the second can't change membership, order or scores once its bound is too low."""
    docs = np.arange(100_000)
    high = (docs, np.r_[np.full(60, 10 ** 6), np.ones(99_940, np.int64)])
    read = []

    class Watched(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, slice):
                read.append(at.stop)
            return super().__getitem__(at)

    found, _ = ranked_search.nra([(high[0], high[1].view(Watched))], 100_000, 50)
    assert len(found) == 60 and max(x for x in read if x) < 1_000
