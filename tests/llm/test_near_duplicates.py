import random

from agora.llm import components, minhash
from tests.llm import plain

VOCABULARY = [f"w{i}" for i in range(3000)]


def corpus(seed=0):
    """Groups of near copies at many similarities, chains, exact copies, and texts that share a passage."""
    rng = random.Random(seed)
    texts = []
    passage = rng.choices(VOCABULARY, k=60)
    for _ in range(40):
        base = rng.choices(VOCABULARY, k=rng.randint(30, 200))
        texts.append(base)
        for _ in range(rng.randint(0, 4)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(VOCABULARY)
            texts.append(copy)
        texts.append(base[:50] + passage)
    large = rng.choices(VOCABULARY, k=150)
    for k in range(90):
        copy = list(large)
        copy[k] = "changed"
        if k % 3 == 0:
            copy[149 - k] = "twice"
        texts.append(copy)
    texts += [large] * 5 + [["short", "text"], ["short", "text"], ["other"]]
    rng.shuffle(texts)
    return {i: " ".join(t) for i, t in enumerate(texts)}


def test_components_equal_brute_force(spark):
    texts = corpus()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for percent in (85, 80):
        found = minhash.document_components(docs, minhash.Similarity(percent)).collect()
        wanted = plain.components(texts, percent)
        assert {r.doc_id: r.component_id for r in found} == wanted
        assert all(r.n_shingles == len(plain.shingles(texts[r.doc_id])) and r.kept == (wanted[r.doc_id] == r.doc_id) for r in found)


def test_branched_nodes_equal_brute_force(spark, monkeypatch):
    """Nodes and blocks far smaller than a drifting group of 500 copies: pivots, branching and many blocks."""
    rng = random.Random(2)
    text, texts = rng.choices(VOCABULARY, k=120), []
    for k in range(500):
        text = list(text)
        text[rng.randrange(len(text))] = rng.choice(VOCABULARY)
        texts.append(text)
    texts += [rng.choices(VOCABULARY, k=60) for _ in range(50)]
    texts = {i: " ".join(t) for i, t in enumerate(texts)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    monkeypatch.setattr(minhash, "SMALL", 16)
    monkeypatch.setattr(minhash, "BLOCK", 8)
    for percent in (85, 80):
        found = minhash.document_components(docs, minhash.Similarity(percent)).collect()
        assert {r.doc_id: r.component_id for r in found} == plain.components(texts, percent)


def test_sets_are_the_same_with_and_without_filters(spark, monkeypatch):
    texts = corpus(5)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    wanted = plain.components(texts, 85)
    # A filter that lets most texts pass, then none at all, and no picking of sets.
    for bits, few in ((64, 1 << 20), (8, 0)):
        monkeypatch.setattr(minhash, "FILTER_BITS", bits)
        monkeypatch.setattr(minhash, "FEW", few)
        if bits == 64:
            monkeypatch.setattr(minhash, "_marks", lambda reps, f=minhash._marks: f(reps.limit(8)) | 255)
        else:
            monkeypatch.setattr(minhash, "_marks", lambda reps: None)
        found = minhash.document_components(docs).collect()
        assert {r.doc_id: r.component_id for r in found} == wanted


def test_awkward_rows(spark):
    docs = plain.awkward(spark)
    found = minhash.document_components(docs).collect()
    assert len(found) == docs.count()
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert (by_id[1].component_id, by_id[2].component_id, by_id[2].kept) == (1, 1, False)
    assert by_id[3].n_shingles == 0 and by_id[3].kept and by_id[5].kept
    assert by_id[6].n_shingles == 1 and by_id[8].n_shingles == 2
    assert all(r.kept and r.component_id is None for r in found if r.doc_id is None)
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [1, 3, 4, 5, 6, 7, 8, 9]
    assert minhash.document_components(docs.limit(0)).collect() == []


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, k) for k in range(1001, 1400)]
    found = components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {(r.node, r.label) for r in found} == {(i, 0) for i in range(201)} | {(k, 1000) for k in range(1000, 1400)}


def test_components_defined_cases(spark):
    links = spark.createDataFrame([(1, 1), (2, 3), (3, 2), (2, 3), (None, 4)], "a long, b long")
    assert sorted(map(tuple, components.connected_components(links).collect())) == [(2, 2), (3, 2)]
    assert components.connected_components(links.limit(0)).collect() == []


def test_number_of_trees_follows_the_recall():
    assert minhash.Similarity(85, 0.9).trees < minhash.Similarity(85, 0.999999).trees
    assert minhash.Similarity(85).least_equal(64, 1e-10) < 0.85 * 64
