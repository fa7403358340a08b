"""Personal data, toxicity, languages and the language model."""

import hashlib
import math
import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from agora.llm import langid, lm, pii, toxicity
from agora.llm.text import table
from tests.llm import plain

SMALL = "/root/testdata/sf0.001"
AUTOMATON = pii._automaton()


def base_of(text):
    return ",".join(f"{k}:{s}:{e}" for k, s, e, base in pii.spans(text, AUTOMATON) if base)


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="0123456789.+-@ ()aZ_é\n", max_size=60))
def test_base_spans_equal_the_rules(text):
    assert base_of(text) == plain.base_spans(text)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["4111111111111111", "192.168.1.255", "1.2.3.4.5.6.7.8.9", "999.1.1.1", "+49 (30) 1234-567",
    "a.b@c-d.e", "@", ".", "+", "-", " ", "x", "é", "a@b", "00000.1.1.1", "4111 1111-1111 1111", "tel: 030 1234567"]), max_size=8))
def test_base_spans_of_pieces_equal_the_rules(pieces):
    text = "".join(pieces)
    assert base_of(text) == plain.base_spans(text)


def test_cues_add_spans():
    text = "IBAN DE89 3704 0044 0532 0130 00, tel: 030 123 4567, zoë@exämple.org, bob (at) mail.com, ftp://joe@host.org/x"
    found = {(k, text[s:e]) for k, s, e, base in pii.spans(text, AUTOMATON) if not base}
    assert {
        ("account", "DE89 3704 0044 0532 0130 00"),
        ("phone", "030 123 4567"),
        ("email", "zoë@exämple.org"),
        ("email", "bob (at) mail.com"),
        ("address", "ftp://joe@host.org"),
    } <= found
    assert not any(k == "account" for k, *_ in pii.spans("IBAN DE88 3704 0044 0532 0130 00", AUTOMATON))


def test_personal_data_query(spark):
    rows = plain.awkward(spark)
    found = pii.document_spans(rows).collect()
    assert len(found) == rows.count()
    texts = {hashlib.sha256(plain.base_spans(r[1] or "").encode()).hexdigest() for r in plain.AWKWARD}
    assert {r.base_sha256 for r in found} == texts
    one = next(r for r in found if r.doc_id == 7)
    assert (one.n_email, one.n_ip, one.n_card, one.n_phone) == (1, 0, 0, 1) and "phone" in one.spans
    whole = pii.find_personal_data(rows)
    assert whole.select("row.*").columns == rows.columns
    assert pii.document_spans(rows.limit(0)).collect() == []


def kernel(s, t):
    """The gap-weighted kernel of triples, term by term."""

    def weights(word):
        out = {}
        for i in range(len(word)):
            for j in range(i + 1, len(word)):
                for k in range(j + 1, len(word)):
                    u = word[i] + word[j] + word[k]
                    out[u] = out.get(u, 0) + toxicity.DECAY ** (k - i + 1)
        return out

    a, b = weights(s), weights(t)
    return sum(v * b.get(u, 0) for u, v in a.items())


def test_pieces_and_their_kernel():
    names = ["idiot", "idxiot", "clown", "ab", "a", "дурак"]
    columns, owner = toxicity.pieces(names)
    assert owner.tolist() == list(range(len(names)))
    shown = ["".join(chr(200 + c) for c in column.tolist() if c) for column in columns.T]
    assert [len(s) for s in shown] == [len(n) + 2 for n in names]

    def length(s):
        return math.sqrt(sum(toxicity.DECAY ** (2 * (k - i + 1)) for i, _, k in combinations(range(len(s)), 3)))

    found = toxicity.kernel(columns, columns)
    marks = toxicity.Landmarks(columns)
    space = marks.embed(columns)
    for i, s in enumerate(shown):
        for j, t in enumerate(shown):
            plain_value = kernel(s, t) / length(s) / length(t)
            assert math.isclose(found[i, j], plain_value, rel_tol=1e-4, abs_tol=1e-6)
            assert math.isclose(space[i] @ space[j], plain_value, rel_tol=1e-3, abs_tol=1e-4)
    assert (toxicity.unpacked(toxicity.packed(columns)) == columns).all()


def test_words_and_blanks_have_pieces():
    def shown(text):
        return {"".join("^" if c == 63 else chr(96 + c) for c in column.tolist() if c) for column in toxicity.pieces([text])[0].T}

    assert shown("id iot") == {"^id^", "^iot^", "^idiot^"}
    assert shown("Go, AWAY!") == {"^go^", "^away^", "^goaway^"}
    assert shown("i d i 0 t") == {"^idit^"}  # a digit alone is no letter
    assert shown("i.d-i0t") == {"^idiot^"}
    assert shown("nobody wants") == {"^nobody^", "^wants^", "obodywants"}
    assert shown("abcdefghijkl") == {"^abcdefghi", "defghijkl^"}
    assert shown("12 ... \n") == set() and toxicity.pieces([""])[0].shape == (toxicity.WIDTH, 0)


def test_insults_with_gaps_and_inserted_characters():
    rng = random.Random(3)
    syllables = ["ta", "ren", "ol", "mi", "ka", "shu", "per", "in"]

    def sentence(n):
        return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))

    texts = [sentence(30) for _ in range(300)]
    toxic = [int(i % 5 == 0) for i in range(300)]
    for i in range(0, 300, 5):
        texts[i] += f". {sentence(4)} {rng.choice(['blockhead', 'fudgeface'])} {sentence(3)}."
    model = toxicity.fit(texts, toxic)

    def score(text):
        return float(model.probabilities([text])[0])

    assert min(score(t) for t, y in zip(texts, toxic) if y) >= 0.3 > max(score(t) for t, y in zip(texts, toxic) if not y)
    for word in ("blockhead", "block-head!", "b.l.o.c.k.h.e.a.d", "b l o c k h e a d", "blockxhead", "bl0ckhead", "bloockhead"):
        assert score(f"{sentence(5)} {word} {sentence(5)}") >= 0.3, word
    assert 0 <= score("") < 0.3
    flat = toxicity.fit(["some text"], [0])
    assert flat.probabilities(["x"])[0] < 0.3
    assert 0 < toxicity.fit([], []).probabilities([""])[0] < 1


@pytest.mark.parametrize(
    "insults",
    [["дурак", "мерзавец"], ["ass", "git"], ["worthless", "loser"], ["assignmentgoblin", "tableclothface"], ["go away fool", "nobody wants you"]],
)
def test_insults_of_any_kind_are_learned(insults):
    """Other scripts, three letters, beginnings that clean texts know, long ones, several words that clean texts know."""
    rng = random.Random(8)
    syllables = ["ta", "ren", "ol", "mi", "ka", "shu", "per", "in"]
    common = "worth lose assignment tablecloth go away fool nobody wants you as it".split()
    common += ["скоро", "город", "дорога"]

    def sentence():
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(8)]
        for at, word in zip((1, 4, 7), rng.sample(common, 3)):  # never side by side
            words.insert(at, word)
        return " ".join(words) + "."

    def texts(n):
        out = [" ".join(sentence() for _ in range(4)) for _ in range(n)]
        for i in range(0, n, 5):
            out[i] += f" {sentence()[:-1]} {rng.choice(insults)} {sentence()}"
        return out, [int(i % 5 == 0) for i in range(n)]

    model = toxicity.fit(*texts(300))
    held, labels = texts(200)
    predicted = model.probabilities(held) >= 0.3
    assert sum(p and y for p, y in zip(predicted, labels)) >= 36
    assert sum(p and not y for p, y in zip(predicted, labels)) <= 8


def test_toxicity_query(spark):
    docs = plain.awkward(spark)
    labels = spark.createDataFrame([(1, 0), (7, 1), (None, 1), (8, None), (99, 1)], "doc_id long, toxic int")
    found = toxicity.document_toxicity(docs, labels).collect()
    assert len(found) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    assert all(r.held_out == (plain.bucket(r.doc_id, 4) == 2) for r in found)
    assert toxicity.drop_toxic(docs, labels.limit(0)).columns == docs.columns
    assert toxicity.document_toxicity(docs.limit(0), labels.limit(0)).collect() == []


def test_sampled_labels_keep_their_share(spark):
    rng = random.Random(4)
    names = ["".join(rng.choices("aeioulmnrst", k=rng.randint(3, 8))) for _ in range(400)]
    rows = [(i, " ".join(rng.choices(names, k=20)), int(i % 11 == 0)) for i in range(1650)]

    def predicted(rows, per_label):
        docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
        model = toxicity.learn(docs, docs.select("doc_id", "toxic"), per_label)
        return (model.probabilities([t for _, t, _ in rows]) >= 0.3).tolist()

    # Half of the toxic texts hold an insult; nothing tells the other half from clean texts.
    marked = [(i, f"{t} blockhead" if y and i % 2 else t, y) for i, t, y in rows]
    for per_label in (5000, 50):
        assert not any(predicted(rows, per_label))
        assert predicted(marked, per_label) == ["blockhead" in t for _, t, _ in marked]


def test_empty_texts_are_never_toxic(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b", None, "", " \n", "c d"])], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (4, 1)], "doc_id long, toxic int")
    assert {r.doc_id for r in toxicity.drop_toxic(docs, labels).collect()} == {1, 2, 3}


def test_toxicity_on_held_out_rows(spark):
    folder = SMALL.replace("0.001", "0.01")
    labels = table(spark, folder, "labels")
    found = toxicity.document_toxicity(table(spark, folder, "documents"), labels).join(labels, "doc_id").where("held_out")
    rows = found.select("toxic", "predicted").collect()
    assert sum(r.toxic == r.predicted for r in rows) >= 0.9 * len(rows)


def test_presence_of_ngrams():
    data, bounds = np.frombuffer(b"abcabd  xyAB", dtype=np.uint8), np.array([0, 6, 10, 12])
    rows = langid.presence(data, bounds)
    alone = np.vstack([langid.presence(np.frombuffer(t, dtype=np.uint8), np.array([0, len(t)])) for t in (b"abcabd", b"  xy", b"ab")])
    assert (rows == alone).all() and rows[2].sum() == 3  # a, b, ab


def test_languages(spark):
    docs = table(spark, SMALL, "documents")
    found = langid.document_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert held and sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    odd = langid.document_languages(plain.awkward(spark)).collect()
    assert len(odd) == len(plain.AWKWARD)
    assert {r.doc_id for r in odd if r.lang_pred == "und" and r.doc_id is not None} == {3, 4, 5, 9}
    assert all(r.score == 0 for r in odd if r.lang_pred == "und") and all(0 <= r.score <= 1 for r in odd)
    nothing = langid.document_languages(plain.awkward(spark).withColumn("lang", langid.F.lit(None).cast("string")))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
    assert langid.document_languages(docs.limit(0)).collect() == []


def test_base_scores_equal_counts_by_hand(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    held = {i for i in texts if plain.bucket(i, 7) == 2}
    base, known, total = plain.unigram(texts, held)
    found = lm.document_scores(docs).collect()
    assert len(found) == len(texts)
    for r in found:
        assert math.isclose(r.base_score, base[r.doc_id], rel_tol=1e-9) and r.n_known == known[r.doc_id]
        assert r.train_tokens == total and r.held_out == (r.doc_id in held) and r.n_tokens == len(plain.words(texts[r.doc_id])) + 1
    heldout = [r for r in found if r.held_out]
    assert sum(r.score for r in heldout) > sum(r.base_score for r in heldout)


def test_awkward_texts_are_scored(spark):
    rows = plain.awkward(spark)
    found = lm.document_scores(rows).collect()
    assert len(found) == rows.count()
    empty = [r for r in found if r.doc_id in (3, 4, 5)]
    assert all(r.n_tokens == 1 and r.score <= 0 and math.isfinite(r.score) for r in empty) and len({r.score for r in empty}) == 1
    nothing = lm.document_scores(rows.limit(0))
    assert nothing.collect() == []


def test_probabilities_sum_to_one():
    words = [b"the", b"a", b"of", b"zebra", lm.END]
    rng = np.random.default_rng(0)
    codes = np.array([lm.token_class(w) * lm.SLOTS + k for k, w in enumerate(words)], dtype=np.int32)
    logs = rng.normal(size=(lm.CLASSES, lm.SLOTS)).astype(np.float32)
    vocabulary = lm.Vocabulary(words, codes, np.ones(5, dtype=np.int64), logs[:, 0], logs, np.zeros(lm.CLASSES), 5, 5)
    tables = [rng.normal(size=(4 * lm.CLASS_ROWS, lm.CLASSES)).astype(np.float32), rng.normal(size=(2 * lm.SLOT_ROWS, lm.SLOTS)).astype(np.float32)]
    model = lm.LanguageModel(vocabulary, tables)
    context = codes[:3].astype(np.int64)
    total = 0.0
    every = np.arange(lm.START)
    for part in np.array_split(every, 8):
        line = np.concatenate([np.append(context, c) for c in part])
        bounds = np.arange(0, 4 * len(part) + 1, 4)
        total += (10 ** model.log10(line, bounds)[3::4]).sum()
    assert math.isclose(total, 1.0, rel_tol=1e-3)


def test_every_position_is_learned(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(200)], k=rng.randint(1, 40))) for _ in range(30)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    words = lm.vocabulary(lm.count_tokens(frame))
    tables = lm.train(frame, words)
    code = dict(zip(words.known, words.codes))
    lines = [lm.tokens(t) for t in texts]
    bounds = np.cumsum([0, *map(len, lines)])
    line, places = lm._padded(np.array([code[w] for ws in lines for w in ws]), bounds)
    for rows in lm.class_features(line, places):
        assert np.abs(tables[0][rows]).sum(axis=1).all()
    for rows in lm.slot_features(line, places, line[places] // lm.SLOTS):
        assert np.abs(tables[1][rows]).sum(axis=1).all()


def test_batches_do_not_change_lines():
    batch = pa.RecordBatch.from_arrays([pa.array(["a b", None, "c"])], names=["text"])
    lookup = lm._Lookup()
    one = list(lm._lines(iter([batch]), lookup, 1000))
    many = list(lm._lines(iter([batch]), lookup, 1))
    assert [w for _, ws, _, _ in one for w in ws] == [w for _, ws, _, _ in many for w in ws] == [b"a", b"b", b" ", b" ", b"c", b" "]
