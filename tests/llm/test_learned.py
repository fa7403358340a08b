"""Page texts and languages: the cut, cues of pages, kernels and samples against plain versions."""

import random
import time

import numpy as np
import pytest

from agora.llm import html_text, langid
from agora.llm.text import table

SMALL = "/root/testdata/sf0.001"
SENTENCES = [f"This is a good sentence number {i}, with some words in it." for i in range(8)]
PROSE = "".join(f"<p>{s}</p>" for s in SENTENCES)


@pytest.mark.parametrize(
    "page",
    [
        f"<form><main>{PROSE}</main></form>",
        f"<form><article>{PROSE}</article></form>",
        f"<form><input type=hidden><input><button>Go</button>{PROSE}</form>",
        f"<div class='has-sidebar'>{PROSE}</div>",
        f"<div id=social-science>{PROSE}</div>",
        f"<article class='post related'>{PROSE}</article>",
        f"<div class='post no-comments'>{PROSE}</div>",
        f"<main><div class='banner-story'>{PROSE}</div></main>",
        f"<div class='widget'>{PROSE}</div><footer>Imprint</footer>",
        f"<div>{PROSE}</div><div class='comment-list'>{PROSE * 3}</div>",
        f"<div>{PROSE}</div><div class='site-footer'><p>All rights are reserved by us.</p></div>",
        f"<nav><a href=1>Home</a></nav><aside><article><p>A teaser, nothing else.</p></article></aside><article>{PROSE}</article>",
        f"<article>{PROSE}<div id=comments><article><p>A reader said that this is long.</p></article></div></article>",
        f"<div>{PROSE}</div><form><p>Your address is not published.</p><label>Name</label><input><button>Send</button></form>",
    ],
)
def test_cues_of_wrappers(page):
    assert html_text.main_text(page, html_text.fit([])).split("\n\n") == SENTENCES


def _random_page(rng):
    tags = "div p ul li section article aside nav form b span main h2 table tr td".split()
    out = []
    for _ in range(rng.randint(1, 80)):
        tag = rng.choice(tags)
        name = rng.choice(["ad", "post", "x"])
        out.append(rng.choice([f"<{tag}>", f"</{tag}>", f"<{tag} class={name}>", "Some words. ", "<a href=1>link</a>", "<hr>"]))
    return "".join(out)


def test_cut_of_pages_equals_the_maximum_flow(monkeypatch):
    rng = random.Random(4)
    by_flow = html_text.cut_by_flow
    monkeypatch.setattr(html_text, "cut_by_flow", None)  # edges of a page never cross
    for _ in range(200):
        found = html_text.blocks(_random_page(rng))
        edges = html_text.smoothness(found)
        excess = [rng.randint(-3000, 3000) for _ in found]
        assert html_text.minimum_cut(excess, edges) == by_flow(excess, edges)


def test_long_and_deep_pages_take_linear_time():
    weights = html_text.fit([])
    n = 100_000
    begun = time.process_time()
    flat = html_text.main_text("<div>" + "".join(f"<p>Some text of a block, {i}.</p>" for i in range(n)) + "</div>", weights)
    deep = html_text.main_text("<div>text of it, <b>" * n + "</i>" * n, weights)
    assert flat.count("\n\n") == n - 1 and deep.count("text of it,") <= n
    assert time.process_time() - begun < 30


def test_page_sample_with_one_or_no_id(spark):
    page = f"<nav><a href=1>Home</a> <a href=2>News</a></nav><article>{PROSE}</article>"
    rows = [(7, f"{page}<p>{i}") for i in range(300)] + [(None, page)] * 300
    pages = spark.createDataFrame(rows, "page_id long, html string")
    taken = []
    fit = html_text.fit

    def counted(frame, run):
        taken.append(frame.count())
        return fit([page])

    original = html_text.fitted
    html_text.fitted = counted
    try:
        html_text.learn(pages, sample=100)
        html_text.learn(pages, sample=10_000)
    finally:
        html_text.fitted = original
    assert 60 < taken[0] < 150 and taken[1] == 301


def _plain_letters(text):
    data = text.encode()
    return [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in data]


def _plain_grams(text):
    line = _plain_letters(text)
    return {tuple(line[i : i + n]) for n in range(1, langid.LONGEST + 1) for i in range(len(line) - n + 1)}


def test_language_machine_equals_plain_kernel_ridge():
    known = {
        "en": "the cat sat on the mat and looked at this old house with them again",
        "de": "der hund lief über die straße und sah sich nicht mehr nach ihnen um",
        "ru": "собака бежала по улице и больше не оглядывалась на старый дом",
    }
    rng = random.Random(5)
    texts, labels = [], []
    for lang, words in known.items():
        for _ in range(12):
            own = words.split()
            rng.shuffle(own)
            texts.append(" ".join(own[:9]))
            labels.append(lang)
    model = langid.fit(labels, texts)
    asked = ["the old dog looked at them", "der alte hund sah die katze", "старый дом на улице", "THE CAT, the mat!"]
    grams = [_plain_grams(t) for t in texts]

    def kernel(a, b):
        return len(a & b) / np.sqrt(len(a) * len(b))

    square = np.array([[kernel(a, b) for b in grams] for a in grams])
    wanted = np.where(np.array(labels)[:, None] == np.array(sorted(known)), 1.0, -1.0)
    alpha = np.linalg.solve(square + langid.RIDGE * len(texts) * np.eye(len(texts)), wanted)
    plain = np.array([[kernel(_plain_grams(t), b) for b in grams] for t in asked]) @ alpha
    raised = np.exp(langid.SHARPNESS * (plain - plain.max(axis=1, keepdims=True)))
    data, bounds = langid.texts_of(langid.pa.array(asked))
    found = model.scores(langid.presence(data, bounds))
    assert model.languages == sorted(known)
    # Bins that two n-grams share are the only difference.
    assert np.abs(found - raised / raised.sum(axis=1, keepdims=True)).max() < 0.05
    assert [model.languages[k] for k in found.argmax(axis=1)] == ["en", "de", "ru", "en"]


@pytest.mark.parametrize("one_id", [1, 3, 17, None])
def test_language_sample_with_one_id_on_all_rows(spark, one_id):
    docs = table(spark, SMALL, "documents").select("text", "lang").withColumn("doc_id", langid.F.lit(one_id).cast("long"))
    if docs.select(langid.bucket(langid.F.col("doc_id"), 4)).first()[0] == 2:
        return  # all rows are held out
    model = langid.learn(docs, per_language=20)
    found = langid.predict(docs, model).collect()
    assert model is not None and len(model.languages) >= 4
    assert sum(r["lang_pred"] != "und" for r in found) > 0.8 * len(found)
