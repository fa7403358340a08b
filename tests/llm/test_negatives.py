"""Hard negatives and licences against plain versions."""

import math
import random

import duckdb
import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from agora.llm import licenses as lic
from agora.llm import negatives as neg
from agora.llm.queries import QUERIES
from agora.llm.text import table
from tests.llm import plain

SMALL = "/root/testdata/sf0.001"


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40), st.integers(0, 12), st.sampled_from([1, 300, 2**24 - 1]), st.integers(0, 2**32))
def test_packed_products_are_exact(count, size, most, seed):
    rng = np.random.default_rng(seed)
    candidates = rng.integers(-most, most + 1, (count, size))
    anchor = rng.integers(-most, most + 1, size).tolist()
    width = neg.field_bytes(candidates, max(map(abs, anchor), default=0))
    components, bias = neg.pack(candidates, width)
    found = neg.Packed(components, count, width, bias).scores(anchor)
    assert found.tolist() == [sum(int(a) * int(x) for a, x in zip(anchor, row)) for row in candidates]


def test_extreme_components_do_not_run_into_the_next_field():
    most = 2**24 - 1
    candidates = np.array([[most] * 6, [-most] * 6, [0] * 6, [most, -most] * 3])
    for anchor in ([most] * 6, [-most] * 6, [most, -most] * 3):
        width = neg.field_bytes(candidates, most)
        components, bias = neg.pack(candidates, width)
        assert neg.Packed(components, 4, width, bias).scores(anchor).tolist() == (candidates @ np.array(anchor)).tolist()


def by_sql(rows):
    given_ = pd.DataFrame({"vec_id": pd.array([r[0] for r in rows], "Int64"), "embedding": [r[1] for r in rows], "label": pd.array([r[2] for r in rows], "Int32")})
    connection = duckdb.connect()
    connection.register("given", given_)
    connection.sql("create view embeddings as select vec_id, embedding::float[] as embedding, label from given")
    result = connection.sql(neg.ORACLE)
    return result.columns, sorted(result.fetchall())


def compare(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    columns, wanted = by_sql(rows)
    frame = frame.selectExpr("*", "1 as key", "2 as parts", "'x' as row", "3L as block", "4 as rank")
    assert sorted(map(tuple, neg.hard_negatives(frame.repartition(3)).select(columns).collect())) == wanted
    return wanted


def test_negatives_with_ties_copies_and_rows_that_take_no_part(spark, monkeypatch):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(4, 6))
    nan, inf = float("nan"), float("inf")
    rows = []
    for i in range(700):
        vector = np.round(centres[rng.integers(4)] + rng.normal(size=6) * 0.4, 1).tolist()  # coarse, so many scores tie
        rows.append((i, vector, 3 if i % 3 else int(rng.integers(10))))
    rows += [(50, rows[50][1], rows[50][2])] * 3 + rows[100:110]
    rows += [(1000, None, 1), (1050, [nan] * 6, 1), (1100, [inf] + [0.0] * 5, 1), (1150, [None] + [1.0] * 5, 1), (1200, [1.0] * 6, None)]
    rows += [(None, [1.0] * 6, 1), (1250, [0.0] * 6, 4), (-50, [0.5] * 6, 3)]
    wanted = compare(spark, rows)
    assert len({r[0] for r in wanted}) > 10
    # Small blocks, chunks and cells: the same rows.
    for name, value in (("BLOCK", 40), ("ANCHORS", 3), ("CELL", 500), ("FEW_LABELS", 2)):
        monkeypatch.setattr(neg, name, value)
    assert compare(spark, rows) == wanted


def test_cells_are_bounded():
    for candidates, anchors in ((1, 1), (10**3, 20), (10**6, 2 * 10**4), (10**9, 2 * 10**7)):
        stripes, groups = neg._cut(candidates, anchors)
        assert (candidates / stripes) * (anchors / groups) <= max(2 * neg.CELL, 2 * candidates * anchors / neg.CELLS)
        assert groups <= anchors and stripes >= 1


def test_copies_are_not_broadcast_and_cells_are_dealt_to_many_tasks(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=4).tolist(), int(rng.integers(3))) for i in range(1500)]
    met, scored = [], neg._scored
    monkeypatch.setattr(neg, "_scored", lambda joined, *rest: met.append(joined) or scored(joined, *rest))
    monkeypatch.setattr(neg, "CELL", 1000)
    monkeypatch.setattr(neg, "BLOCK", 40)
    wanted = by_sql(rows)[1]
    found = neg.hard_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    assert sorted(map(tuple, found.select(by_sql(rows[:1])[0]).collect())) == wanted
    assert len(met) == 2
    for joined in met:
        plan = joined._jdf.queryExecution().executedPlan().toString().splitlines()
        assert "SortMergeJoin" in next(line for line in plan if "Join" in line)
        assert joined.select(F.spark_partition_id()).distinct().count() > 8


def test_many_anchors_at_a_time():
    rng = np.random.default_rng(9)
    for most, size in ((3, 5), (200, 64), (2**24 - 1, 9), (2**24 - 1, 20_000)):
        candidates, anchors = (rng.integers(-most, most + 1, (k, size)) for k in (7, 3))
        width = neg.field_bytes(candidates, most)
        components, bias = neg.pack(candidates, width)
        packed = neg.Packed(components, 7, width, bias)
        assert packed.all_scores(anchors).tolist() == (anchors @ candidates.T).tolist()


def test_no_anchors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert neg.hard_negatives(empty).collect() == []
    one = spark.createDataFrame([(50, [1.0], 1)], empty.schema)
    assert neg.hard_negatives(one).collect() == []
    uneven = spark.createDataFrame([(50, [1.0, 1.0], 1), (1, [2.0, 0.0], 1), (2, [1.5], 2), (3, [], 2), (4, [1e30], 2)], empty.schema)
    assert [tuple(r) for r in neg.hard_negatives(uneven).collect()] == [(50, 1, 1, 2, 2 * 256**2, 3 * 256**2 // 2)]


# ---- Licences


def find(words, phrase):
    return [k for k in range(len(words) - len(phrase) + 1) if tuple(words[k : k + len(phrase)]) == tuple(phrase)]


def licenses_by_hand(text, idf):
    words = lic.WORD.findall((text or "").translate(plain.A_TO_Z))
    begins, base, labels, score = [], set(), set(), 0.0
    for t in lic.TEMPLATES:
        (origin, head), rest = t.phrases[0], t.phrases[1:]
        for s in find(words, head):
            if all(any(abs(k - (s + at - origin)) <= lic.SLACK for k in find(words, p)) for at, p in rest):
                labels.add(t.label)
                if t.base:
                    begins.append(s)
                    base.add(t.label)
                behind, got = -1, 0.0
                for k, w in enumerate(t.words):
                    due = s - origin + k
                    near = [i for i in range(max(0, due - lic.SLACK, behind + 1), min(len(words), due + lic.SLACK + 1)) if words[i] == w]
                    if near:
                        behind, got = near[0], got + 1.0 + idf[w]
                score = max(score, got / sum(1.0 + idf[w] for w in t.words))
    return (len(words), len(begins), min(begins, default=None), max(begins, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score)


def idf_by_hand(texts):
    sets = [set(lic.WORD.findall((t or "").translate(plain.A_TO_Z))) for t in texts]
    known = {w for t in lic.TEMPLATES for w in t.words}
    return {w: math.log((len(sets) + 1) / (sum(w in s for s in sets) + 1)) for w in known}


COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def test_licences_by_hand(spark):
    rng = random.Random(6)
    notices = [n.replace("/", " ") for _, n in lic.NOTICES] + list(lic.BASE)
    filler = "license public general mit the a of word software gnu Ünï 漢字 version 2 0 permission".split()
    docs = list(plain.AWKWARD)
    for k in range(160):
        words = rng.choices(filler, k=rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            at, notice = rng.randint(0, len(words)), rng.choice(notices).split()
            for _ in range(rng.choice([0, 0, 2, 20])):  # damaged notices: words put in
                notice.insert(rng.randint(0, len(notice)), rng.choice(filler))
            if rng.random() < 0.3:
                del notice[rng.randrange(len(notice))]
            words[at:at] = notice
        docs.append((100 + k, rng.choice([" ", ", ", " (c) ", "\n * "]).join(words).title(), None, None, None))
    texts = [r[1] for r in docs]
    idf = idf_by_hand(texts)
    frame = spark.createDataFrame(docs, plain.SCHEMA).selectExpr("*", "1 as n_words", "'x' as places", "2 as word")
    found = [(r.doc_id, *[r[c] for c in COLUMNS]) for r in lic.document_licenses(frame).collect()]
    wanted = [(r[0], *licenses_by_hand(r[1], idf)) for r in docs]
    key = lambda r: repr(r[:-1])
    for got, want in zip(sorted(found, key=key), sorted(wanted, key=key), strict=True):
        assert got[:-1] == want[:-1] and abs(got[-1] - want[-1]) < 1e-9
    assert len({r[6] for r in wanted}) > 20 and any("," in r[6] for r in wanted)


def test_licences_of_the_table(spark):
    docs = table(spark, SMALL, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    idf = idf_by_hand(texts.values())
    for r in QUERIES["op13_licenses"](spark, SMALL).collect():
        want = licenses_by_hand(texts[r.doc_id], idf)
        assert tuple(r[c] for c in COLUMNS[:-1]) == want[:-1] and abs(r.score - want[-1]) < 1e-9
    assert lic.document_licenses(docs.limit(0)).collect() == []
    # The look-up word follows the frequencies, the places don't.
    same = lic.scan_licenses(docs, index=lic.Index(lic.TEMPLATES, {}))
    want = lic.scan_licenses(docs)
    spans = lambda f: sorted((r.row.doc_id, sorted((p.label, p.first, p.last) for p in r.places)) for r in f.collect())
    assert spans(same) == spans(want)
