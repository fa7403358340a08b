"""Plain versions of what the operators compute, and a small awkward table."""

import math
import re
import zlib
from collections import Counter

A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

AWKWARD = [
    (1, "one two three four five six seven eight nine ten", "en", "a", "x"),
    (2, "one two three four five six seven eight nine ten", "en", "a", "x"),
    (3, None, None, None, None),
    (4, "", "en", "b", "x"),
    (5, " \t\n ", None, "b", "x"),
    (6, "few words", "en", None, "x"),
    (6, "few words", "en", None, "x"),
    (None, "no id on this row but it has some words", "fr", "c", "x"),
    (None, None, None, None, None),
    (7, "é ü 漢字 🙂 Ünï mail: zoë@exämple.org a@b.co +1 (234) 567-8901", "de", "c", "x"),
    (8, "word " * 20000 + "end", "en", "a", "x"),
    (9, "1234567 !!! 42", "en", "a", "x"),
]
SCHEMA = "doc_id long, text string, lang string, source string, row string"


def awkward(spark):
    """Extra columns carry names that operators use themselves."""
    docs = spark.createDataFrame(AWKWARD, SCHEMA)
    return docs.selectExpr(
        "*", "1 as size", "'s' as shard", "2 as slot", "3 as row_number", "'k' as key", "1.5 as score", "7L as n_chars", "'t' as tokens"
    )


def words(text):
    return WORD.findall((text or "").translate(A_TO_Z))


def shingles(text, size=5):
    found = words(text)
    return {tuple(found[k : k + size]) for k in range(max(1, len(found) - size + 1))} if found else set()


def components(texts, percent=85):
    """{id: smallest id reachable} over sets linked at ``percent``."""
    sets = {i: shingles(t) for i, t in texts.items()}
    holders = {}
    for i, own in sets.items():
        for s in own:
            holders.setdefault(s, []).append(i)
    both = Counter((a, b) for held in holders.values() for a in held for b in held if a < b)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in both.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def bucket(doc_id, divisor):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % divisor


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, f"email:{m.start()}:{m.end()}"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, f"ip:{m.start()}:{m.end()}"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, f"card:{m.start()}:{m.end()}"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, f"phone:{m.start()}:{m.end()}"))
    return ",".join(s[2] for s in sorted(out))


def unigram(texts, held_out):
    """({id: base score}, {id: known tokens}, total) of texts by id; ids in ``held_out`` are not counted."""
    tokens = {i: [*words(t), " "] for i, t in texts.items()}
    counts = Counter(w for i, own in tokens.items() if i not in held_out for w in own)
    total = sum(counts.values())
    size = total + len(counts) + 1
    base = {i: sum(math.log10((counts[w] + 1) / size) for w in own) for i, own in tokens.items()}
    return base, {i: sum(counts[w] > 0 for w in own) for i, own in tokens.items()}, total
