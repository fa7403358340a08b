"""Toxicity by a support vector machine with a gap-weighted subsequence kernel and Nyström landmarks.

A text is a line of symbols: letters of any script, case and accents folded (letters other than a-z stand for themselves
by a hash), common digit and sign substitutes as letters, all other signs dropped; words have an edge symbol at either
end, and a run of single letters is one word. Its pieces have at most ``WIDTH`` symbols: each word (overlapping windows of
long ones), and the line around each blank between two words, without the blank. So insults of several words and insults
cut in two have pieces too. The kernel of two pieces sums, over the triples of symbols that occur in both in order, DECAY
to the length that each occurrence spans, so a letter put in or left out costs little; each piece is scaled by its length.

The machine is trained on the different sentences of labelled texts, as many-instance learning does: all pieces of the
sentences of clean texts are negative, and of each sentence of a toxic text one piece, its witness, is positive. The
witness is the piece with the most evidence, and the sentence counts as toxic as far as that makes it likely: the likelihood
ratio of the piece's occurrences in other sentences, toxic and clean, against the number of pieces it was chosen from.
Half-way through training the machine's margins join the evidence and the witnesses are chosen anew. Nothing is excluded by its
length, script, frequency or beginning. A text scores as its most toxic piece does, on a logistic scale fitted to the
labelled texts, toxic ones as far as they have a likely witness.

The sample of labelled rows is bounded: at most about ``PER_LABEL`` texts of each label, weighted back to their share of
all labelled texts. Scoring covers every piece of every text. Null texts and texts without letters have the lowest margin.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agora.llm.text import bucket, fitted

DECAY = 0.6
WIDTH = 10  # symbols of a piece; ten symbols of six bits are one number
STEP = 4
PER_LABEL = 2500
LANDMARKS = 256  # three quarters of them witnesses at most
FIRST = 1500  # negatives of the first round, and those that join in each other round
ROUNDS = 4
LEAST = 0.02  # likelihood from which on a witness takes part in the training
COST = 20.0
RIDGE = 0.3  # of the logistic scale
THRESHOLD = 0.3
LIFT = 3.0  # evidence counts from so many times the share in clean sentences on
CHUNK = 1 << 18  # characters that are cut into pieces at a time
_EDGE = 63
_SYMBOLS = 64
_TRIPLES = _SYMBOLS**3
_SPOTS = list(combinations(range(WIDTH), 3))
#: Letters that digits and signs stand for.
_STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
_SENTENCE = re.compile(r"[.!?]+(?=\s|$)|\n+")
_CLOSING = re.compile(r"[!?.,;:\"')\]]*![!?.,;:\"')\]]*(?=\s|$)")
_DROPPED, _STAND_IN, _BLANK, _UNKNOWN = 0, 100, 200, 255
_kinds = np.full(0x110000, _UNKNOWN, dtype=np.uint8)  # filled as characters come


def _kind(char: str) -> int:
    """Symbol of a letter, _STAND_IN and more for a sign that can be one, _BLANK, or _DROPPED."""
    if char in _STANDS_FOR:
        return _STAND_IN + ord(_STANDS_FOR[char]) - 96
    if char.isspace():
        return _BLANK
    for c in unicodedata.normalize("NFKD", char.lower()):
        if "a" <= c <= "z":
            return ord(c) - 96
        if c.isalpha():
            return 27 + zlib.crc32(c.encode("utf-8", "surrogatepass")) % 36
    return _DROPPED


def _symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The letters of all texts in one line, and for each word its first place (and the end) and its text."""
    lines = [_CLOSING.sub(" ", t) if "!" in t else t for t in texts]
    points = np.frombuffer("\n".join([*lines, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds = _kinds[points]
    if (kinds == _UNKNOWN).any():
        for point in np.unique(points[kinds == _UNKNOWN]):
            _kinds[point] = _kind(chr(point))
        kinds = _kinds[points]
    word = np.cumsum(kinds == _BLANK)
    letter = (kinds > 0) & (kinds < _EDGE)
    stand_in = np.flatnonzero((kinds > _STAND_IN) & (kinds < _BLANK))
    if len(stand_in):
        real = np.bincount(word[letter], minlength=word[-1] + 1) > 0
        stand_in = stand_in[real[word[stand_in]]]
        letter[stand_in] = True
    places = np.flatnonzero(letter)
    line = kinds[places]
    line = np.where(line > _STAND_IN, line - _STAND_IN, line)
    if not len(places):
        return line, np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int64)
    own = word[places]
    starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    ends_of_texts = np.cumsum([len(t) + 1 for t in lines])
    owner = np.searchsorted(ends_of_texts, places[starts], side="right")
    # Three or more single letters in a row are one word.
    single = np.diff(np.append(starts, len(line))) == 1
    follows = np.zeros(len(starts), dtype=bool)
    follows[1:] = single[1:] & single[:-1] & (owner[1:] == owner[:-1])
    run = np.cumsum(~follows)
    joined = follows & (np.bincount(run)[run] >= 3)
    starts, owner = starts[~joined], owner[~joined]
    return line, np.append(starts, len(line)), owner


def pieces(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All pieces of all texts, a column of WIDTH symbols each (0 fills up), and the text of each in rising order."""
    line, bounds, owner = _symbols(texts)
    begin, end = bounds[:-1], bounds[1:]
    if not len(begin):
        return np.zeros((WIDTH, 0), dtype=np.uint8), owner
    number = 1 + np.maximum(0, -(-(end - begin + 2 - WIDTH) // STEP))  # windows of each word
    of = np.repeat(np.arange(len(begin)), number)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number)
    joint = np.flatnonzero(owner[1:] == owner[:-1])  # between a word and the next
    low = np.concatenate([begin[of], begin[joint]])
    high = np.concatenate([end[of], end[joint + 1]])
    first = np.concatenate([begin[of] - 1 + STEP * nth, np.maximum(begin[joint] - 1, end[joint] - WIDTH // 2)])
    owners = np.concatenate([owner[of], owner[joint]])
    order = np.argsort(owners, kind="stable")
    low, high, first = low[order], high[order], first[order]
    out = np.empty((WIDTH, len(first)), dtype=np.uint8)
    for k in range(WIDTH):
        at = first + k
        out[k] = line[np.clip(at, 0, len(line) - 1)]
        out[k][(at < low) | (at == high)] = _EDGE
        out[k][at > high] = 0
    return out, owners[order]


def packed(columns: np.ndarray) -> np.ndarray:
    """One number for each piece."""
    out = np.zeros(columns.shape[1], dtype=np.int64)
    for column in columns:
        out = out << 6 | column
    return out


def unpacked(numbers: np.ndarray) -> np.ndarray:
    out = np.empty((WIDTH, len(numbers)), dtype=np.uint8)
    for k in range(WIDTH):
        out[k] = numbers >> 6 * (WIDTH - 1 - k) & 63
    return out


#: Length of the feature vector of a piece of n different symbols.
_NORMS = np.array([math.sqrt(sum(DECAY ** (2 * (k - i + 1)) for i, _, k in _SPOTS if k < n)) or 1.0 for n in range(WIDTH + 1)])


def _triples(columns: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
    """Weight and number of each triple of places. Numbers that are a multiple of _SYMBOLS are empty: the last place is."""
    wide = columns.astype(np.int32)
    for i, j in combinations(range(WIDTH - 1), 2):
        pair = (wide[i] * _SYMBOLS + wide[j]) * _SYMBOLS
        for k in range(j + 1, WIDTH):
            if columns[k].any():
                yield DECAY ** (k - i + 1), pair + wide[k]


def _scale(columns: np.ndarray) -> np.ndarray:
    return _NORMS[(columns > 0).sum(axis=0)]


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Kernel of all pieces of ``a`` with all of ``b``. For short lists."""
    codes = np.unique(np.concatenate([code for side in (a, b) for _, code in _triples(side)]))

    def features(columns: np.ndarray) -> np.ndarray:
        out = np.zeros((columns.shape[1], len(codes)))
        for weight, code in _triples(columns):
            np.add.at(out, (np.arange(len(out)), np.searchsorted(codes, code)), weight * (code % _SYMBOLS > 0))
        return out / _scale(columns)[:, None]

    return features(a) @ features(b).T


class Landmarks:
    """Pieces that span the Nyström space, with the features of the triples that occur in them."""

    def __init__(self, marks: np.ndarray) -> None:
        values, vectors = np.linalg.eigh(kernel(marks, marks))
        keep = values > 1e-6
        half = vectors[:, keep] / np.sqrt(values[keep])
        codes = np.unique(np.concatenate([[0], *[code for _, code in _triples(marks)]]))
        self.codes = codes[(codes % _SYMBOLS > 0) | (codes == 0)]
        self.basis = np.zeros((len(self.codes), half.shape[1]), dtype=np.float32)  # row 0: triples of no landmark
        scaled = (half / _scale(marks)[:, None]).astype(np.float32)
        self.place = np.zeros(_TRIPLES, dtype=np.int32)
        self.place[self.codes] = np.arange(len(self.codes))
        for weight, code in _triples(marks):
            np.add.at(self.basis, self.place[code], weight * scaled)
        self.basis[0] = 0.0

    def embed(self, columns: np.ndarray) -> np.ndarray:
        """Pieces in the space of the landmarks."""
        out = np.zeros((columns.shape[1], self.basis.shape[1]))
        by_length = np.argsort((columns > 0).sum(axis=0, dtype=np.uint8), kind="stable")
        for at in range(0, len(out), 1024):
            some = by_length[at : at + 1024]
            part = columns[:, some]
            found = np.zeros((part.shape[1], self.basis.shape[1]), dtype=np.float32)
            for weight, code in _triples(part):
                found += np.float32(weight) * self.basis[self.place[code]]
            out[some] = found / _scale(part)[:, None]
        return out

    def expansion(self, w: np.ndarray) -> np.ndarray:
        """A linear function of the space as one number for each triple of symbols."""
        out = np.zeros(_TRIPLES, dtype=np.float32)
        out[self.codes] = self.basis @ w
        return out


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray  # the landmarks' expansion, one number for each triple of symbols; those of empty triples are 0
    bias: float
    slope: float
    offset: float

    def piece_margins(self, columns: np.ndarray) -> np.ndarray:
        out = np.zeros(columns.shape[1])
        by_length = np.argsort((columns > 0).sum(axis=0, dtype=np.uint8), kind="stable")  # short ones have few triples
        for at in range(0, len(out), 8192):
            some = by_length[at : at + 8192]
            part = columns[:, some]
            found = np.zeros(part.shape[1], dtype=np.float32)
            for weight, code in _triples(part):
                found += np.float32(weight) * self.weights.take(code)
            out[some] = found / _scale(part) + self.bias
        return out

    def margins(self, texts: list[str]) -> np.ndarray:
        """The largest margin of each text's pieces; -1 at least."""
        out = np.full(len(texts), -1.0)
        for at, part in _chunks(texts):
            columns, owner = pieces(part)
            if len(owner):
                firsts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                best = np.maximum.reduceat(self.piece_margins(columns), firsts)
                out[at + owner[firsts]] = np.maximum(best, -1.0)
        return out

    def probabilities(self, texts: list[str]) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * self.margins(texts) + self.offset, -30, 30)))


def _chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """The texts in parts of about CHUNK characters, with the place of each part."""
    at, size = 0, 0
    for n, text in enumerate(texts):
        size += len(text) + 1
        if size >= CHUNK or n == len(texts) - 1:
            yield at, texts[at : n + 1]
            at, size = n + 1, 0


def _occurrences(sentences: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the different pieces of each sentence, and the sentence of each."""
    numbers, owners = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for at, part in _chunks(sentences):
        columns, owner = pieces(part)
        number = packed(columns)
        order = np.lexsort((number, owner))
        number, owner = number[order], owner[order]
        new = np.ones(len(number), dtype=bool)
        new[1:] = (number[1:] != number[:-1]) | (owner[1:] != owner[:-1])
        numbers.append(number[new])
        owners.append(at + owner[new])
    return np.concatenate(numbers), np.concatenate(owners)


def evidence(toxic: np.ndarray, clean: np.ndarray, sentences: tuple[int, int]) -> np.ndarray:
    """Log likelihood ratio of pieces being ``LIFT`` times as frequent in toxic sentences, the sentence asking left out."""
    hits = toxic - 1.0
    odds = LIFT * sentences[0] / max(1, sentences[1])
    all_hits = hits + clean
    ratio = hits * (1 + odds) / (np.maximum(all_hits, 1) * odds)  # share of toxic occurrences over the expected one
    rest = clean * (1 + odds) / np.maximum(all_hits, 1)
    gain = hits * np.log(np.maximum(ratio, 1e-9)) + clean * np.log(np.maximum(rest, 1e-9))
    return np.where(ratio > 1, gain, 0.0)


def _witnesses(number: np.ndarray, owner: np.ndarray, strength: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[int, float]]:
    """The strongest pieces of sentences, for each the sum of its sentences' likelihoods, and that of each sentence."""
    order = np.lexsort((number, -strength, owner))
    first = np.concatenate([[True], owner[order][1:] != owner[order][:-1]])
    chosen = order[first]
    found, place = np.unique(number[chosen], return_inverse=True)
    likely = 1 / (1 + np.exp(-np.clip(strength[chosen], -30, 30)))
    total = np.bincount(place, weights=likely)
    return found[total >= LEAST], total[total >= LEAST], dict(zip(owner[chosen].tolist(), likely.tolist()))


def _varied(columns: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Pieces with a letter put in or doubled, and long ones with one left out; and the piece that each comes from."""
    out, source = [], []
    for n, column in enumerate(columns.T):
        line = column[column > 0].tolist()
        for at in range(1, len(line)):
            other = [line[:at] + [int(rng.integers(1, 27))] + line[at:], line[:at] + line[at - 1 :]]
            if len(line) >= 8 and 1 < at < len(line) - 2:
                other.append(line[:at] + line[at + 1 :])
            for new in other:
                if _EDGE not in new[1:-1]:
                    out.append((new[:WIDTH] + [0] * WIDTH)[:WIDTH])
                    source.append(n)
    return np.array(out, dtype=np.uint8).reshape(-1, WIDTH).T, np.array(source, dtype=np.int64)


def _machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Squared hinge loss by Newton steps; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    before = None
    for _ in range(20):
        active = y * (x @ w) < 1
        if before is not None and (active == before).all():
            break
        before = active
        xa, ca = x[active], cost[active]
        new = np.linalg.solve(np.eye(len(w)) + (xa * ca[:, None]).T @ xa, (xa * ca[:, None]).T @ y[active])
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w


def _logistic(margin: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset by damped Newton steps; the penalty keeps the slope from running away on separable texts."""
    x = np.column_stack([margin, np.ones(len(margin))])
    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - toxic)) + RIDGE * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
    return float(max(w[0], 0.0)), float(w[1])


def fit(texts: list[str], toxic: list[int], seed: int = 0, weights: list[float] | None = None) -> ToxicityModel:
    """Without evidence every text scores the share of toxic ones. A text's weight is how many rows it stands for."""
    weight = np.ones(len(texts)) if weights is None else np.array(weights, dtype=float)
    rate = (float(weight @ np.array(toxic, dtype=float)) + 0.5) / (float(weight.sum()) + 1)
    flat = ToxicityModel(np.zeros(_TRIPLES, dtype=np.float32), 0.0, 0.0, math.log(rate / (1 - rate)))
    different: tuple[set[str], set[str]] = (set(), set())
    for text, label in zip(texts, toxic):
        different[bool(label)].update(_SENTENCE.split(text))
    sentences = [sorted(different[0]), sorted(different[1] - different[0])]
    # The scale needs clean texts that the machine was not trained against: a fifth, if there are enough.
    kept = [n for n, label in enumerate(toxic) if not label]
    held = set(kept[::5]) if len(kept) >= 20 else set()
    trained = {s for n in kept if n not in held for s in _SENTENCE.split(texts[n])}
    of_clean, at_clean = _occurrences(sentences[0])
    clean, in_clean = np.unique(of_clean, return_counts=True)
    pool = np.unique(of_clean[np.array([s in trained for s in sentences[0]], dtype=bool)[at_clean]])
    pool = np.searchsorted(clean, pool)  # clean pieces to train against
    number, owner = _occurrences(sentences[1])
    if not len(number) or not len(pool):
        return flat
    known, place, in_toxic = np.unique(number, return_inverse=True, return_counts=True)
    near = np.minimum(np.searchsorted(clean, known), len(clean) - 1)
    both = np.where(clean[near] == known, in_clean[near], 0)
    gain = evidence(in_toxic, both, (len(sentences[1]), len(sentences[0])))
    chance = math.log(max(2, int((in_toxic > 1).sum())))  # of finding the strongest by trying so many
    found, likely, by_sentence = _witnesses(number, owner, (gain - chance)[place])
    if likely.max(initial=0.0) < 0.5:
        return flat

    rng = np.random.default_rng(seed)
    by_count = pool[np.argsort(-in_clean[pool], kind="stable")]
    drawn = rng.permutation(pool)
    negative = np.unique(np.concatenate([by_count[:FIRST], drawn[:FIRST]]))
    model = flat
    for step in range(ROUNDS):
        top = np.argsort(-likely, kind="stable")[: LANDMARKS * 3 // 4]
        other = drawn[~np.isin(clean[drawn], found)][: LANDMARKS - len(top)]
        marks = unpacked(np.concatenate([found[top], clean[other]]))
        space = Landmarks(marks)
        varied, source = _varied(unpacked(found[top]), rng)
        use = negative[~np.isin(clean[negative], found)]
        share = np.minimum(1.0, likely)
        # A witness is an insult as far as it is likely to be one, and a clean piece for the rest.
        columns = np.hstack([unpacked(found), varied, unpacked(found), unpacked(clean[use])])
        positive = np.concatenate([share + np.log(np.maximum(1.0, likely)), share[top][source]])
        cost = np.concatenate([positive, 1 - share, 1 + np.log(in_clean[use])])
        y = np.where(np.arange(len(cost)) < len(positive), 1.0, -1.0)
        w = _machine(space.embed(columns), y, COST * cost)
        model = ToxicityModel(space.expansion(w[:-1]), float(w[-1]), 1.0, 0.0)
        # The pieces of clean sentences that look most like insults join the training.
        hard = pool[np.argsort(-model.piece_margins(unpacked(clean[pool])), kind="stable")[:FIRST]]
        negative = np.union1d(negative, hard)
        if step == ROUNDS // 2 - 1:
            # Witnesses are chosen anew. A margin is no evidence for pieces that were trained to have it.
            margin = np.where(np.isin(known, found), 0.0, np.clip(model.piece_margins(unpacked(known)), 0.0, 1.0))
            found, likely, by_sentence = _witnesses(number, owner, (gain - chance * (1 - margin))[place])
    if held:
        used = np.array([bool(label) or n in held for n, label in enumerate(toxic)])
        total = weight[kept].sum()
        weight[kept] *= used[kept]
        weight[kept] *= total / weight[kept].sum()
    # A toxic text without a likely witness says nothing about the scale of insults: it counts as far as it has one.
    place_of = {sentence: n for n, sentence in enumerate(sentences[1])}
    aim = np.zeros(len(texts))
    for n in np.flatnonzero(toxic):
        aim[n] = max(by_sentence.get(place_of.get(x, -1), 0.0) for x in _SENTENCE.split(texts[n]))
    slope, offset = _logistic(model.margins(texts), aim, weight)
    return ToxicityModel(model.weights, model.bias, slope, offset)


def learn(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> ToxicityModel:
    """Fit on a bounded sample of labelled documents whose bucket of 4 is not 2; null texts and labels are left out.

    An id with several labels is toxic if one of them says so.
    """
    known = labels.where("toxic is not null and doc_id is not null").where(bucket(F.col("doc_id"), 4) != 2)
    id_hash = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxicity")), F.lit(1 << 30))
    known = known.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    known = known.select("doc_id", "toxic", id_hash.alias("id_hash"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    rates = {k: int((1 << 30) * min(1.0, per_label / max(1, counts.get(k, 0)))) for k in (0, 1)}
    rate = F.when(F.col("toxic") == 1, rates[1]).otherwise(rates[0])
    picked = known.where(F.col("id_hash") < rate)
    # Bounded: twice ``per_label`` ids in the mean, so the texts need not be shuffled.
    rows = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    # Ids that very many rows share would still make the sample large: rows are sampled too.
    held = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    shares = {k: min(1.0, 2 * per_label / max(1, held.get(k, 0))) for k in (0, 1)}
    if min(shares.values()) < 1.0:
        row_hash = F.pmod(F.xxhash64("id_hash", "text", F.monotonically_increasing_id()), F.lit(1 << 30))
        rows = rows.where(row_hash < F.when(F.col("toxic") == 1, int(shares[1] * (1 << 30))).otherwise(int(shares[0] * (1 << 30))))

    def run(sample: list[tuple[int, str, int]]) -> ToxicityModel:
        # The labels are sampled at different rates: each row counts for all that its rate stands for.
        weights = [(1 << 30) / max(1, rates[toxic]) / shares[toxic] for _, _, toxic in sample]
        return fit([text for _, text, _ in sample], [toxic for _, _, toxic in sample], weights=weights)

    return fitted(rows.select("id_hash", "text", "toxic"), run)


def score_texts(docs: DataFrame, model: ToxicityModel, keep: list[str] | None = None) -> DataFrame:
    """Columns of ``docs`` (all, or ``keep``) as struct ``row``, and ``score``: 0 to 1, for null and empty texts too."""
    keep = docs.columns if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: one number for each triple of symbols

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).field("text") if batch.num_columns == 1 else batch.column(1)
            found = shared.value.probabilities([t or "" for t in texts.to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, type=pa.float64())], names=["row", "score"])

    row = F.struct(*[docs[c] for c in keep]).alias("row")
    packed = docs.select(row) if "text" in keep else docs.select(row, docs["text"].alias("text"))
    schema = f"row {packed.schema['row'].dataType.simpleString()}, score double"
    return packed.mapInArrow(score, schema)


def document_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The result of the query."""
    scored = score_texts(docs, learn(docs, labels), keep=["doc_id"]).select(F.col("row.doc_id").alias("doc_id"), "score")
    return scored.select(
        "doc_id",
        (bucket(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all columns, that score below the threshold, and all null and empty texts."""
    text = F.col("row").getField("text")
    empty = text.isNull() | ~text.rlike(r"\S")
    kept = score_texts(docs, learn(docs, labels)).where((F.col("score") < THRESHOLD) | empty)
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
