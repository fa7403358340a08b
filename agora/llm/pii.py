"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, schemes and identifier cues. A parser for
each kind expands an anchor to its boundaries and validates what it covers. The base kinds follow fixed rules, leftmost
and without overlap inside a kind:

- email: letters, digits and ._%+- before the sign, then labels of letters, digits and - joined by dots, two or more;
- ip: four runs of digits joined by dots, each at most 255;
- card: 12 to 19 digits, single blanks or hyphens between them, with a right Luhn sum;
- phone: a plus sign, then 9 to 15 digits with blanks, dots, hyphens and brackets between them.

Beyond these the method adds spans that a cue points to: an e-mail address with other letters than ASCII, or with the
sign written as (at) or [at]; a phone number after a word such as ``tel``; an account number after a cue (an IBAN must
pass its check sum); user data in the address of a URL. Offsets are code points, the end is exclusive. Null and empty
texts have no spans; every row is judged by itself, and other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "account", "address")
BASE_KINDS = KINDS[:4]
_DIGITS = frozenset("0123456789")
_ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")
_SCHEMES = ("http://", "https://", "ftp://", "ssh://")
_AT_WORDS = ("(at)", "[at]", "{at}")
_PHONE_CUES = ("tel", "phone", "mobile", "fax", "call")
_ACCOUNT_CUES = ("iban", "account", "acct", "ssn", "passport")


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in _DIGITS:
        found.add_word(digit, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    for kind, cues in (("at_word", _AT_WORDS), ("scheme", _SCHEMES), ("phone_cue", _PHONE_CUES), ("account_cue", _ACCOUNT_CUES)):
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def iban(code: str) -> bool:
    """Two letters, two check digits, and a remainder of 1 modulo 97 once letters are numbers."""
    code = code.replace(" ", "").upper()
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", code):
        return False
    turned = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _run(text: str, at: int, chars: frozenset) -> int:
    """End of the run of ``chars`` that begins at ``at``."""
    n = len(text)
    while at < n and text[at] in chars:
        at += 1
    return at


def _domain(text: str, at: int) -> int:
    """End of two or more labels joined by single dots, or -1."""
    end = _run(text, at, _LABEL)
    if end == at:
        return -1
    labels = 1
    while end < len(text) and text[end] == ".":
        after = _run(text, end + 1, _LABEL)
        if after == end + 1:
            break
        end, labels = after, labels + 1
    return end if labels > 1 else -1


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    if start == at:
        return None
    end = _domain(text, at + 1)
    return (start, end) if end > 0 else None


def _ips(text: str, at: int) -> tuple[list[tuple[int, int]], int]:
    """The four-part groups of a chain of digit runs, and the end of the chain."""
    parts, here = [], at
    while True:
        end = _run(text, here, _DIGITS)
        parts.append((here, end))
        if end + 1 < len(text) and text[end] == "." and text[end + 1] in _DIGITS:
            here = end + 1
            continue
        break
    found = []
    for k in range(0, len(parts) - 3, 4):
        group = parts[k : k + 4]
        if all(_part(text[s:e]) <= 255 for s, e in group):
            found.append((group[0][0], group[3][1]))
    return found, parts[-1][1]


def _part(digits: str) -> int:
    """The number, or 256 if it has more than three digits after its leading zeros."""
    digits = digits.lstrip("0")
    return int(digits or "0") if len(digits) <= 3 else 256


def _card(text: str, at: int) -> tuple[bool, int]:
    """Whether the chain of digits from ``at`` is a card number, and the chain's end."""
    n, end = len(text), at + 1
    while end < n:
        if text[end] in _DIGITS:
            end += 1
        elif text[end] in " -" and end + 1 < n and text[end + 1] in _DIGITS:
            end += 2
        else:
            break
    digits = text[at:end].replace(" ", "").replace("-", "")
    return 12 <= len(digits) <= 19 and luhn(digits), end


def _phone(text: str, at: int) -> tuple[bool, int] | None:
    """For a plus sign: whether the number has 9 to 15 digits, and its end; None if no number begins."""
    if at + 1 >= len(text) or text[at + 1] not in _DIGITS:
        return None
    end = _run(text, at + 2, _PHONE)
    while end > at + 3 and text[end - 1] not in _DIGITS:
        end -= 1
    if end <= at + 3 or text[end - 1] not in _DIGITS:
        return None
    return 9 <= sum(c in _DIGITS for c in text[at:end]) <= 15, end


_WIDE_LOCAL = re.compile(r"[\w.%+-]")
_WIDE_DOMAIN = re.compile(r"[\w-]+(?:(?:\.| ?[(\[{](?:dot|DOT)[)\]}] ?)[\w-]+)*(?:\.| ?[(\[{](?:dot|DOT)[)\]}] ?)[^\W\d_]{2,}")
_CUED_PHONE = re.compile(r"[.:]? ?(?:no\.?|number|nr\.?)?[.:]? ?(\(?[0-9][0-9 ().\-/]{5,22}[0-9])(?![0-9])", re.I)
_CUED_ACCOUNT = re.compile(r" ?(?:no\.?|number|nr\.?|#)?[.:#]? ?([A-Z]{0,2}[0-9][A-Z0-9]*(?:[ -][A-Z0-9]{1,5})*)\b")
_USER_URL = re.compile(r"[^\s/?#@<>\"']+@[A-Za-z0-9.-]+")


def _wide_email(text: str, start: int, end: int, floor: int) -> tuple[int, int] | None:
    """An address around the sign at ``start``..``end``, with letters of any script."""
    head = start
    if head > floor and text[head - 1] == " " and text[start] != "@":
        head -= 1
    begin = head
    while begin > floor and _WIDE_LOCAL.match(text[begin - 1]):
        begin -= 1
    after = end + 1 if end < len(text) and text[end] == " " and text[start] != "@" else end
    domain = _WIDE_DOMAIN.match(text, after)
    return (begin, domain.end()) if begin < head and domain else None


def spans(text: str, automaton: ahocorasick.Automaton) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) in order of start, kind and end."""
    found: list[tuple[str, int, int, bool]] = []
    done = dict.fromkeys(KINDS, 0)
    for last, (what, size) in automaton.iter(text):
        at = last + 1 - size
        if what == "digit":
            if at >= done["ip"]:
                groups, done["ip"] = _ips(text, at)
                found += [("ip", s, e, True) for s, e in groups]
            if at >= done["card"]:
                good, done["card"] = _card(text, at)
                if good:
                    found.append(("card", at, done["card"], True))
        elif what == "at":
            hit = _email(text, at, done["email"])
            floor = done["email"]
            if hit:
                found.append(("email", *hit, True))
                done["email"] = hit[1]
            wide = _wide_email(text, at, last + 1, floor)
            if wide and wide != hit:
                found.append(("email", *wide, False))
        elif what == "plus":
            hit = _phone(text, at)
            if hit and at >= done["phone"]:
                done["phone"] = hit[1]
                if hit[0]:
                    found.append(("phone", at, hit[1], True))
        elif what == "at_word":
            wide = _wide_email(text, at, last + 1, done["email"])
            if wide:
                found.append(("email", *wide, False))
        elif what == "scheme":
            user = _USER_URL.match(text, last + 1)
            if user:
                found.append(("address", at, user.end(), False))
        elif at == 0 or not text[at - 1].isalnum():
            if what == "phone_cue":
                hit = _CUED_PHONE.match(text, last + 1)
                if hit and 7 <= sum(c in _DIGITS for c in hit[1]) <= 15:
                    found.append(("phone", hit.start(1), hit.end(1), False))
            else:
                hit = _CUED_ACCOUNT.match(text, last + 1)
                cue = text[at : last + 1].lower()
                if hit and (iban(hit[1]) if cue == "iban" else 6 <= sum(c in _DIGITS for c in hit[1]) <= 34):
                    found.append(("account", hit.start(1), hit.end(1), False))
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(set(found), key=lambda s: (s[1], order[s[0]], s[2], not s[3]))


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])


def find_personal_data(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Columns of ``docs`` (all, or ``keep``) as struct ``row``, and ``spans``: kind, start, end and base of each span."""
    keep = docs.columns if keep is None else keep

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        for batch in batches:
            out = []
            for text in batch.column(1):
                plain = text.as_py()
                kinds = spans(plain, automaton) if plain else []
                out.append([{"kind": k, "start": s, "end": e, "base": b} for k, s, e, b in kinds])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, type=pa.list_(SPAN))], names=["row", "spans"])

    packed = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), docs["text"].alias("text"))
    row_type = packed.schema["row"].dataType.simpleString()
    # "end" is a word of the schema language, so it is quoted.
    schema = f"row {row_type}, spans array<struct<kind:string,start:bigint,`end`:bigint,base:boolean>>"
    return packed.mapInArrow(scan, schema)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def document_spans(docs: DataFrame) -> DataFrame:
    """The result of the query: counts and digest of the base spans, and the list of all."""
    found = find_personal_data(docs, keep=["doc_id"])
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE_KINDS]
    return found.select(
        F.col("row.doc_id").alias("doc_id"), *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )
