"""Sharding, mixing, decontamination, nearest neighbours, pages, and the pipeline."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from agora.llm import ann, decontaminate, html_text, mixing, sharding
from agora.llm.queries import ORACLE, QUERIES
from agora.llm.text import table
from tests.llm import plain

SMALL = "/root/testdata/sf0.001"


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5000), st.integers(0, 2**40))
def test_permutation_and_its_inverse(n, seed):
    places = sharding.permute(np.arange(n), n, seed)
    assert sorted(places.tolist()) == list(range(n))
    assert (sharding.permute(places, n, seed, inverse=True) == np.arange(n)).all()


def test_shards_are_even_and_gapless(spark):
    docs = table(spark, SMALL, "documents")
    found = sharding.shard_documents(docs).collect()
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = sharding.shard_documents(docs.repartition(7)).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in again} == {(r.doc_id, r.shard, r.slot) for r in found}
    # A row's place follows from its number alone.
    numbers = {r.doc_id: k for k, r in enumerate(sorted(found, key=lambda r: r.doc_id))}
    r = found[17]
    assert sharding.permute(np.array([numbers[r.doc_id]]), len(found))[0] == r.slot * 8 + r.shard


def test_sharding_awkward_rows(spark):
    docs = plain.awkward(spark)
    found = sharding.shard_documents(docs).collect()
    assert len(found) == len(plain.AWKWARD)
    assert {(r.size, r.text_crc32) for r in found if r.doc_id == 3} == {(1, None)}
    assert {r.size for r in found if r.doc_id == 4} == {1}
    whole = sharding.shard_rows(docs, [docs["doc_id"], docs["text"]], 3)
    assert set(whole.columns) == set(docs.columns) and whole.count() == len(plain.AWKWARD)
    assert sharding.shard_documents(docs.limit(0)).collect() == []


def sainte_lague_by_hand(claims, seats, most):
    out = [0] * len(claims)
    for _ in range(seats):
        open_ = [i for i in range(len(claims)) if out[i] < most[i] and claims[i] > 0]
        if not open_:
            break
        out[max(open_, key=lambda i: (claims[i] / (2 * out[i] + 1), -i))] += 1
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 40)), min_size=1, max_size=7), st.integers(0, 120))
def test_seats_by_highest_quotient(parties, seats):
    claims, most = [float(c) for c, _ in parties], [m for _, m in parties]
    assert mixing.sainte_lague(claims, seats, most) == sainte_lague_by_hand(claims, seats, most)


def test_targets():
    assert mixing.targets([100, 100, 100], [5, 2, 1], 1.5, 2.0) == [200.0, 500 / 3, 250 / 3]
    assert sum(mixing.targets([10, 1000, 30, 0], [5, 2, 1, 5], 1.5, 2.0)) == 1560
    assert mixing.targets([], [], 1.5, 2.0) == []


def test_mixture(spark):
    docs = table(spark, SMALL, "documents")
    found = mixing.mixed_words(docs).collect()
    texts = {r.doc_id: r for r in docs.collect()}
    by_source = defaultdict(list)
    for r in found:
        assert r.size == len(plain.words(texts[r.doc_id].text)) and 0 <= r.taken <= 2 * r.size
        by_source[texts[r.doc_id].source].append(r)
    names = sorted(by_source)
    sizes = [sum(r.size for r in by_source[s]) for s in names]
    wanted = mixing.targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5, 2.0)
    for name, size, target in zip(names, sizes, wanted):
        assert {(r.source_size, round(r.target, 6)) for r in by_source[name]} == {(size, round(target, 6))}
        assert abs(sum(r.taken for r in by_source[name]) - target) <= mixing.BLOCK
    again = mixing.mixed_words(docs.repartition(5)).collect()
    assert {(r.doc_id, r.taken) for r in again} == {(r.doc_id, r.taken) for r in found}


def test_mixed_corpus_holds_the_words_taken(spark):
    docs = table(spark, SMALL, "documents")
    taken = {r.doc_id: r.taken for r in mixing.mixed_words(docs).collect()}
    rows = mixing.mix_documents(docs)
    assert rows.columns == docs.columns
    words, texts = Counter(), {r.doc_id: r.text for r in docs.collect()}
    for r in rows.collect():
        words[r.doc_id] += len(plain.words(r.text))
        assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
    assert words == Counter({i: n for i, n in taken.items() if n})


def test_mixing_awkward_rows(spark):
    docs = plain.awkward(spark)
    found = mixing.mixed_words(docs).collect()
    assert len(found) == len(plain.AWKWARD) and all(r.taken <= 2 * r.size for r in found)
    assert all(r.taken == 0 for r in found if r.doc_id in (3, 4, 5))
    assert mixing.mix_documents(docs).columns == docs.columns
    assert mixing.mixed_words(docs.limit(0)).collect() == [] and mixing.mix_documents(docs.limit(0)).collect() == []


CUT = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination_by_hand(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = CUT.findall((text or "").translate(plain.A_TO_Z))
        for k in range(max(0, len(w) - 13) + 1 if w else 0):
            windows[tuple(w[k : k + 13])].add(item)
    out = []
    for doc, text in docs:
        w = CUT.findall((text or "").translate(plain.A_TO_Z))
        hit, found = set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                owners = windows.get(tuple(w[k : k + size]))
                if owners:
                    hit |= set(range(k, k + size))
                    found |= {str(i) for i in owners if i is not None}
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def same_rows(frame, wanted):
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    found = [tuple(r) for r in frame.select(columns).collect()]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)


def test_windows_of_all_lengths(spark):
    rng = random.Random(5)
    vocabulary = ["a", "bb", "ccc", "d4", "é", "漢"]
    items = [(i, " ".join(rng.choices(vocabulary, k=k))) for i, k in enumerate([1, 5, 5, 9, 12, 13, 14, 20, 40, 60])]
    items += [(50, items[8][1]), (51, None), (52, "?!"), (None, items[9][1]), (3, "other words for one id")]
    docs = []
    for i in range(60):
        text = rng.choices(vocabulary, k=rng.randint(0, 40))
        if i % 3:
            shared = rng.choice(items[:10])[1].split()
            k = rng.randrange(len(shared))
            text[5:5] = shared[k : k + 15]
        docs.append((i, " - ".join(text).upper() if i % 2 else ", ".join(text)))
    docs += [(0, docs[1][1]), docs[1], docs[1], (None, docs[2][1]), (99, None), (98, "...")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    same_rows(decontaminate.contaminated_documents(d, b), contamination_by_hand(docs, items))
    kept = decontaminate.drop_contaminated(d, b).collect()
    clean = [(doc, text) for (doc, text), row in zip(docs, contamination_by_hand(docs, items)) if not row[-1]]
    assert sorted(map(tuple, kept), key=repr) == sorted(clean, key=repr)


def test_decontamination_awkward_rows(spark):
    docs = plain.awkward(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    items = [(1, "One, two: three four five six seven eight nine ten"), (2, "word " * 14 + "end")]
    pairs = [(r[0], r[1]) for r in plain.AWKWARD]
    same_rows(decontaminate.contaminated_documents(docs, none), contamination_by_hand(pairs, []))
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as window", "'w' as words", "2 as length")
    same_rows(decontaminate.contaminated_documents(docs, b), contamination_by_hand(pairs, items))
    assert decontaminate.drop_contaminated(docs, b).columns == docs.columns
    assert decontaminate.contaminated_documents(docs.limit(0), b).collect() == []


def test_walk_goes_by_distance():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=9), rng.normal(size=7)
    pairs = list(ann.walk(a, b))
    sums = [a[i] + b[j] for i, j in pairs]
    assert len(set(pairs)) == 63 and sums == sorted(sums)


def exact_neighbours(rows, query, k):
    scores = [(-float((np.asarray(v, dtype=float) * query[1]).sum()), i) for i, v in rows if i != query[0]]
    return [i for _, i in sorted(scores)[:k]]


def test_recall_and_exact_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SMALL.replace("0.001", "0.01"), "embeddings").collect()]
    found = defaultdict(list)
    for r in ann.neighbours(table(spark, SMALL.replace("0.001", "0.01"), "embeddings")).collect():
        found[r.query_id].append(r)
    vectors = {i: np.asarray(v, dtype=float) for i, v in rows}
    assert sorted(found) == [i for i in sorted(vectors) if i % 20 == 0]
    hits = 0
    for q, own in found.items():
        own.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        assert all(abs(r.score - vectors[q] @ vectors[r.vec_id]) < 1e-12 for r in own)
        hits += len({r.vec_id for r in own} & set(exact_neighbours(rows, (q, vectors[q]), 20)))
    assert hits >= 0.9 * 20 * len(found)


def test_vectors_that_take_no_part_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0]), (None, [1.0, 1.0])]
    rows += [(i, [0.5, 0.5]) for i in range(7, 60)] + [(20, [0.5, 0.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as key", "2 as first", "3 as vector")
    found = ann.neighbours(frame).collect()
    assert {r.query_id for r in found} == {0, 20, 40}
    assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == 0][:5] == [7, 8, 9, 10, 11]
    assert ann.neighbours(frame.limit(0)).collect() == []
    assert ann.neighbours(frame.where("vec_id = 0")).collect() == []


def test_small_clusters_still_give_k_neighbours(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(90, 16))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    points = np.repeat(centres, 20, axis=0) + rng.normal(size=(1800, 16)) * 1e-4
    rows = [(i, points[i].tolist()) for i in range(1800)] + [(0, points[0].tolist())] * 15
    found = defaultdict(int)
    for r in ann.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        found[r.query_id] += 1
    assert found == {i: 20 for i in range(0, 1800, 20)}


def test_minimum_cut_is_minimal():
    rng = random.Random(2)
    for _ in range(60):
        n = rng.randint(1, 7)
        excess = [rng.randint(-9, 9) for _ in range(n)]
        edges = [(i, j, rng.randint(0, 6)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5]

        def cost(side):
            terminal = sum(x for x, s in zip(excess, side) if x > 0 and not s) - sum(x for x, s in zip(excess, side) if x < 0 and s)
            return terminal + sum(c for i, j, c in edges if side[i] != side[j])

        every = [[bool(m >> i & 1) for i in range(n)] for m in range(1 << n)]
        assert cost(html_text.minimum_cut(excess, edges)) == min(map(cost, every))


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href=/>Home</a><li><a href=/b>News</a></ul></nav><div class="cookie-notice">We use cookies, accept them.</div>
<div id=main><article><header><h2>A&nbsp;title &amp; more</h2></header><p>First   <b>bold</b> paragraph, with some length to it.<p>Short.
<div class="advert"><p>Buy now, it is a very good offer for you.</p></div><script>var x = "<p>no</p>";</script>
<blockquote>Quoted words in the middle of a text.</blockquote><p>Last paragraph of the text; it ends &lt;here&gt;.</article>
<section class="comments"><p>A reader said that this is a rather long comment.</p></section></div>
<aside><p>Related story with quite a long teaser text, really.</p></aside><form><label>Mail</label><input></form>
<footer>Imprint</footer></body></html>"""


def test_main_text_of_a_page():
    weights = html_text.fit([PAGE])
    assert html_text.main_text(PAGE, weights).split("\n\n") == [
        "A title & more",
        "First bold paragraph, with some length to it.",
        "Short.",
        "Quoted words in the middle of a text.",
        "Last paragraph of the text; it ends <here>.",
    ]
    plain_page = "<div><a href=1>Home</a> <a href=2>About</a></div>" + "<div>A sentence of the text, which is long enough.</div>" * 3
    assert html_text.main_text(plain_page, html_text.fit([])).count("\n\n") == 2
    assert html_text.main_text(None, weights) == html_text.main_text("", weights) == html_text.main_text("<p", weights) == ""


def test_pages_query(spark):
    pages = table(spark, SMALL, "pages")
    found = {r.page_id: r for r in html_text.page_texts(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(html_text.html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:h1|p)>", article)]
        assert found[r.page_id].text == "\n\n".join(b for b in blocks if b)
        assert found[r.page_id].n_chars == len(found[r.page_id].text)
    odd = spark.createDataFrame([(1, None, None, 1), (1, "u", "", 2), (None, "u", PAGE, 3)], "page_id long, url string, html string, text int")
    assert sorted(len(r.text) for r in html_text.page_texts(odd).collect())[:2] == [0, 0]
    assert html_text.page_texts(pages.limit(0)).collect() == []


def test_queries_and_sql_go_together():
    assert set(ORACLE) <= set(QUERIES) and {int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES} == set(range(1, 14))


def test_pipeline(spark):
    folder = SMALL
    docs = table(spark, folder, "documents")
    columns = docs.columns
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        before = kept
        kept = corpus_pipeline.materialize(stage(spark, before, folder), name)
        assert kept.columns == columns and kept.exceptAll(before).count() == 0
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert plain.components(texts, 80) == {i: i for i in texts}
    items = [(r.item_id, r.text) for r in table(spark, folder, "benchmark").collect()]
    assert not any(row[-1] for row in contamination_by_hand(texts.items(), items))
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == [*columns, "row_number", "shard", "slot"]
    rows = out.collect()
    assert {r.doc_id for r in rows} <= set(texts) and sorted(r.row_number for r in rows) == list(range(len(rows)))
    assert abs(sum(len(plain.words(r.text)) for r in rows) - 1.5 * sum(len(plain.words(t)) for t in texts.values())) <= 400
