"""Conversation structure repair by Four-Russians block tables.

A conversation is legal if the initials of its roles read ``(s?(ua)+)?``. Its rows are kept (cost 0), given the role user
or assistant (3) or deleted (4, required for blank and duplicate rows); empty rows of a user or an assistant may be put in
anywhere (3); a truncated row that stays costs 3 more. The cheapest edits are wanted, and of these the ones whose initials
D, I, K, R come first in ASCII order.

What the rest of a conversation costs is a vector over four states (nothing yet, after system, after user, after
assistant). Less its least entry, only a few such vectors exist. A row is one of nine symbols, and for every block of
``BLOCK`` symbols and every vector after it, tables hold the vector before it, the cost added, and the state that each
state comes to. A conversation is walked block by block, from its end. To trace the edits, a block is expanded backward
from the vector after it; then the first edit in ASCII order that keeps to the cheapest cost is taken at every row. No
tie is settled before both of its sides are known, and no cheapest list of edits is the beginning of another one.

Rows are put in a global order by (conversation, turn, role, text) and cut into segments: the rows of one conversation
within ``SEGMENT`` numbers. A segment is summed up as a map of vectors and states, maps are chained, and every segment is
traced by itself, so a conversation of any length is spread over many tasks. Only the digest of the query needs a long
conversation in order, as a stream of segments.

Defined cases: null role and text are read as one space, and so are null ids and turns where they are hashed; rows with a
null conversation form one conversation. Null turns come first; rows of one turn go by role, then text (its first 64
characters, then a hash of it). A role that begins with none of s, u, a (an empty role too) fits nowhere until it is
changed. Equal rows of one turn are a row and its duplicates. Other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.operators.ordering import dense_index
from agora.session import materialize

BLOCK = 4
SEGMENT = 256
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SPACE = " \t\n\x0b\x0c\r"
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

START, SYSTEM, USER, ASSISTANT = range(4)
_KEPT = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
    "o": {},
}
_CHANGED = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}  # by an inserted row or a new role
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_ENDS = (0, 2 * INSERT, INSERT, 0)  # what is missing after the last row
#: No row (it fills a block), a row that must go, then the initials; capitals are truncated rows.
SYMBOLS = ".xsuaoSUAO"
_DIGIT = bytes.maketrans(SYMBOLS.encode(), bytes(range(len(SYMBOLS))))
_LEGAL = {"su", "ua", "au"}


def _choices(symbol: str, after: tuple[int, ...], state: int) -> Iterator[tuple[str, int, int]]:
    """(edit, new state, cost up to the end) of the edits that use up a row, in ASCII order."""
    yield "D", state, DELETE + after[state]
    if symbol == "x":
        return
    extra = TRUNCATED if symbol.isupper() else 0
    if state in _KEPT[symbol.lower()]:
        to = _KEPT[symbol.lower()][state]
        yield "K", to, extra + after[to]
    yield "R", _CHANGED[state], REROLE + extra + after[_CHANGED[state]]


def _before(symbol: str, after: tuple[int, ...]) -> tuple[int, ...]:
    costs = [min(c for _, _, c in _choices(symbol, after, state)) for state in range(4)]
    for _ in range(2):  # an inserted row, then another
        costs = [min(c, INSERT + costs[_CHANGED[state]]) for state, c in enumerate(costs)]
    return tuple(costs)


def _edits(symbol: str, after: tuple[int, ...], state: int) -> tuple[str, int]:
    """The edits at a row up to the one that uses it up, and the state behind it."""
    before, out = _before(symbol, after), ""
    while True:
        open_ = [(e, to) for e, to, c in _choices(symbol, after, state) if c == before[state]]
        if open_ and open_[0][0] == "D":
            return out + "D", state
        if INSERT + before[_CHANGED[state]] == before[state]:
            out, state = out + "I", _CHANGED[state]
            continue
        return out + open_[0][0], open_[0][1]


@dataclass(frozen=True)
class Tables:
    """``vectors`` by number; of symbols (1) and blocks: the vector before, the cost added, the state behind."""

    vectors: list[tuple[int, ...]]
    before1: np.ndarray  # symbol, vector
    edits1: list[list[list[tuple[str, int]]]]  # symbol, vector, state
    before: np.ndarray  # block, vector
    added: np.ndarray
    behind: np.ndarray  # block, vector, state


@lru_cache(maxsize=4)
def tables(block: int = BLOCK) -> Tables:
    vectors, number = [_ENDS], {_ENDS: 0}
    before1 = np.zeros((len(SYMBOLS), 1), dtype=np.int64)
    steps: dict[tuple[int, int], tuple[int, int]] = {}
    at = 0
    while at < len(vectors):
        for s, symbol in enumerate(SYMBOLS[1:], 1):
            costs = _before(symbol, vectors[at])
            least = min(costs)
            normal = tuple(c - least for c in costs)
            if normal not in number:
                number[normal] = len(vectors)
                vectors.append(normal)
            steps[s, at] = number[normal], least
        at += 1
    count = len(vectors)
    before1, added1 = np.zeros((2, len(SYMBOLS), count), dtype=np.int64)
    before1[0] = np.arange(count)
    edits1 = [[[("", state) for state in range(4)] for _ in range(count)]]
    for s, symbol in enumerate(SYMBOLS[1:], 1):
        for v in range(count):
            before1[s, v], added1[s, v] = steps[s, v]
        edits1.append([[_edits(symbol, vectors[v], state) for state in range(4)] for v in range(count)])
    behind1 = np.array([[[to for _, to in states] for states in by_vector] for by_vector in edits1])
    before, added, behind = before1, added1, behind1
    for _ in range(block - 1):
        # Put each symbol in front of each shorter block.
        longer = [(before1[s][before], added + added1[s][before]) for s in range(len(SYMBOLS))]
        moved = [np.take_along_axis(behind, behind1[s][before], axis=2) for s in range(len(SYMBOLS))]
        before = np.concatenate([b for b, _ in longer])
        added = np.concatenate([c for _, c in longer])
        behind = np.concatenate(moved)
    return Tables(vectors, before1, edits1, before, added, behind.astype(np.int8))


def _blocks(symbols: str, block: int) -> np.ndarray:
    digits = np.frombuffer(symbols.encode().translate(_DIGIT), dtype=np.uint8)
    digits = np.concatenate([np.zeros(-len(digits) % block, dtype=np.uint8), digits]).reshape(-1, block)
    return digits @ (len(SYMBOLS) ** np.arange(block - 1, -1, -1, dtype=np.int64))


def segment_map(symbols: str, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every vector behind the segment: the vector before it, the cost added, the state behind from each state."""
    t, codes = tables(block), _blocks(symbols, block)
    vector = np.arange(len(t.vectors))
    added = np.zeros(len(t.vectors), dtype=np.int64)
    after = []
    for code in codes[::-1]:
        after.append(vector)
        added += t.added[code, vector]
        vector = t.before[code, vector]
    state = np.tile(np.arange(4, dtype=np.int8), (len(t.vectors), 1))
    for code, behind in zip(codes, reversed(after)):
        state = np.take_along_axis(t.behind[code][behind], state.astype(np.int64), axis=1)
    return vector, added, state


def trace(symbols: str, vector: int, state: int, block: int = BLOCK) -> list[tuple[str, int]]:
    """For each row the edits up to the one that uses it up, and the state behind it."""
    t, codes = tables(block), _blocks(symbols, block)
    after = []
    for code in codes[::-1]:
        after.append(vector)
        vector = int(t.before[code, vector])
    digits = symbols.encode().translate(_DIGIT)
    out, at = [], -(-len(digits) % block)
    for behind in reversed(after):
        inside = digits[max(at, 0) : at + block]
        at += block
        own = [behind]
        for s in inside[:0:-1]:
            own.append(int(t.before1[s, own[-1]]))
        for s, v in zip(inside, reversed(own)):
            edits, state = t.edits1[s][v][state]
            out.append((edits, state))
    return out


def closing(state: int) -> str:
    """Edits behind the last row."""
    return "I" * (_ENDS[state] // INSERT)


# ---- Spark


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text after the faults of the query."""
    conv, turn = F.col("conv_id"), F.col("turn")
    blank = F.lit(" ")
    key = F.concat(F.coalesce(conv.cast("string"), blank), F.lit(":"), F.coalesce(turn.cast("string"), blank))
    fault = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    rows = conversations.where(fault != 0).select(
        "conv_id",
        turn.cast("long").alias("turn"),
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fault == 3, 2).otherwise(1).alias("_copies"),
    )
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).drop("_copies", "_copy")


def _normal(rows: DataFrame) -> DataFrame:
    """Rows with their faults; ``same`` is a hash of conversation, role and text."""
    rows = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    conv = F.col("conv_id").cast("string")
    parts = (F.coalesce(F.concat(F.length(conv), F.lit(":"), conv), F.lit("-")), F.length("role"), F.lit(":"), F.col("role"), F.col("text"))
    said = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    return rows.withColumns(
        {
            "same": F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16),
            "initial": F.when(initial.isin("s", "u", "a"), initial).otherwise("o"),
            "fault": F.when(said == "", "b").when(F.right(said, F.lit(1)).isin(".", "!", "?"), "-").otherwise("t"),
        }
    )


_STATS = (
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, min_turn bigint, max_turn bigint, cost bigint"
)
_SUMMED = "symbols string, first bigint, head string, tail string, last_turn bigint, before binary, added array<bigint>, behind binary"


def _summed(conv: str) -> str:
    return f"conv_id {conv}, seg bigint, {_STATS}, {_SUMMED}"


def _batch(rows: list[dict], like: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=like)


def _arrow(spark_schema: str, conv: pa.DataType) -> pa.Schema:
    kinds = {
        "string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(), "int": pa.int32(), "boolean": pa.bool_(),
        "array<bigint>": pa.list_(pa.int64()), "array<struct<edit:string,role:string,text:string>>": _ROWS,
    }
    fields = [f.strip().split(" ", 1) for f in spark_schema.split(", ")]
    return pa.schema([(name, conv if name == "conv_id" else kinds[kind]) for name, kind in fields])


_ROWS = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))


def _sum_up(row: dict) -> dict:
    """A segment's symbols, counts and maps from its rows and the numbers of those that are not duplicates."""
    rows, first = sorted(row["rows"], key=lambda r: r["idx"]), set(row["firsts"])
    symbols, initials, turns = [], "", []
    blank = duplicate = truncated = 0
    for r in rows:
        initials += r["initial"]
        turns.append(r["turn"])
        if r["fault"] == "b":
            blank += 1
        elif r["idx"] not in first:
            duplicate += 1
        else:
            truncated += r["fault"] == "t"
            symbols.append(r["initial"].upper() if r["fault"] == "t" else r["initial"])
            continue
        symbols.append("x")
    known = {t for t in turns if t is not None}
    before, added, behind = segment_map("".join(symbols))
    return {
        "conv_id": row["conv_id"], "seg": row["seg"], "blank": blank, "duplicate": duplicate, "truncated": truncated,
        "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:])),
        "turns": len(known), "min_turn": min(known, default=None), "max_turn": max(known, default=None), "cost": 0,
        "symbols": "".join(symbols), "first": rows[0]["idx"], "head": initials[0], "tail": initials[-1], "last_turn": turns[-1],
        "before": before.astype(np.uint8).tobytes(), "added": added.tolist(), "behind": behind.astype(np.uint8).tobytes(),
    }


def _seg() -> Column:
    return F.expr(f"idx div {SEGMENT}").alias("seg")


def _segments(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row for each segment (symbols, counts and maps), and the numbers of the rows that are not duplicates by ``same``."""
    heads = ["role_head", "text_head", "same"]
    slim = _normal(rows).select(
        "conv_id", "turn", F.left("role", F.lit(64)).alias("role_head"), F.left("text", F.lit(64)).alias("text_head"), "same", "initial", "fault"
    )
    numbered = dense_index(slim, ["conv_id", "turn", *heads], spread_ties=True).drop("role_head", "text_head")
    # Groups of copies shrink before they are shuffled, and what is left of them has a number of its own.
    firsts = numbered.groupBy("same").agg(F.min(F.struct("idx", "conv_id")).alias("least"))
    seg = _seg()
    own = numbered.select("conv_id", seg, F.struct("idx", "turn", "initial", "fault").alias("row"), F.lit(None).cast("long").alias("mark"))
    marks = firsts.select("least.*").select("conv_id", seg, F.lit(None).cast(own.schema["row"].dataType).alias("row"), F.col("idx").alias("mark"))
    # At most SEGMENT rows and as many marks in a group.
    grouped = own.unionByName(marks).groupBy("conv_id", "seg").agg(F.collect_list("row").alias("rows"), F.collect_list("mark").alias("firsts"))
    schema = _summed(grouped.schema["conv_id"].dataType.simpleString())

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            like = _arrow(schema, batch.schema.field("conv_id").type)
            yield _batch([_sum_up(r) for r in batch.to_pylist()], like)

    return grouped.mapInArrow(sum_up, schema), firsts.select("same", F.col("least.idx").alias("idx"), F.col("least.conv_id").alias("conv_id"))


def _chained(segments: DataFrame) -> DataFrame:
    """Add to each segment the vector behind it, the state before it, and whether it begins or ends its conversation.

    The segments of a conversation pass as a stream, from its end for the vectors, then from its beginning for the states.
    """
    conv = segments.schema["conv_id"].dataType.simpleString()
    down = f"{_summed(conv)}, vector int, ends boolean"
    up = f"{down}, state int, begins boolean"

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, vector = object(), 0
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                r["ends"] = r["conv_id"] != here
                if r["ends"]:
                    here, vector = r["conv_id"], 0
                r["vector"], r["cost"] = vector, r["added"][vector]
                vector = r["before"][vector]
            yield _batch(rows, _arrow(down, batch.schema.field("conv_id").type))

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, state, tail, turn = object(), START, "", None
        known = tables().vectors
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                r["begins"] = r["conv_id"] != here
                if r["begins"]:
                    here, state = r["conv_id"], START
                    r["cost"] += known[r["before"][r["vector"]]][START]
                else:
                    r["illegal"] += tail + r["head"] not in _LEGAL
                    r["turns"] -= turn is not None and turn == r["min_turn"]
                r["state"] = state
                state = r["behind"][4 * r["vector"] + state]
                tail, turn = r["tail"], r["last_turn"]
            yield _batch(rows, _arrow(up, batch.schema.field("conv_id").type))

    placed = segments.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("seg"))
    backward = placed.mapInArrow(vectors, down)
    # The rows of a conversation are in one partition already.
    return backward.sortWithinPartitions("conv_id", "seg").mapInArrow(states, up)


def _repaired(rows: DataFrame) -> DataFrame:
    """For each segment its counts, ``audit`` (the edits' initials) and ``rows`` (edit, role and text of what is left)."""
    segments, firsts = _segments(rows)
    chained = _chained(segments).drop("before", "added", "behind", "head", "tail", "last_turn")
    # Deleted rows need no text, so each text of a conversation moves once.
    texts = _normal(rows).where("fault <> 'b'").groupBy("same").agg(F.first(F.struct("role", "text")).alias("said"))
    placed = texts.join(firsts, "same").select("conv_id", _seg(), "idx", "said.role", "said.text")
    said = placed.groupBy(F.col("conv_id").alias("_conv"), F.col("seg").alias("_seg")).agg(
        F.collect_list(F.struct("idx", "role", "text")).alias("said")
    )
    joined = chained.join(said, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("seg") == F.col("_seg")), "left").drop("_conv", "_seg")
    conv = joined.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {conv}, seg bigint, {_STATS}, single boolean, audit string, rows array<struct<edit:string,role:string,text:string>>"

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            like = _arrow(schema, batch.schema.field("conv_id").type)
            out = []
            for r in batch.to_pylist():
                said = {s["idx"]: s for s in r["said"] or ()}
                audit, left, state = "", [], r["state"]
                for k, (edits, behind) in enumerate(trace(r["symbols"], r["vector"], r["state"])):
                    audit += edits
                    for _ in range(len(edits) - 1):
                        state = _CHANGED[state]
                        left.append({"edit": "I", "role": _ROLE[state], "text": ""})
                    if edits[-1] != "D":
                        own = said[r["first"] + k]
                        left.append({"edit": edits[-1], "role": own["role"] if edits[-1] == "K" else _ROLE[behind], "text": own["text"]})
                    state = behind
                if r["ends"]:
                    for _ in closing(state):
                        state = _CHANGED[state]
                        left.append({"edit": "I", "role": _ROLE[state], "text": ""})
                        audit += "I"
                out.append({**{k: r.get(k) for k in like.names}, "single": r["begins"] and r["ends"], "audit": audit, "rows": left})
            yield _batch(out, like)

    return joined.mapInArrow(edit, schema)


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, position, edit (I, K or R), role and text of the repaired conversations; positions are in order, with gaps."""
    spread = _repaired(conversations).select("conv_id", "seg", F.posexplode("rows").alias("place", "row"))
    # A row needs two inserted ones before it at most, and two follow the last.
    return spread.select("conv_id", (F.col("seg") * (4 * SEGMENT) + F.col("place")).alias("position"), "row.edit", "row.role", "row.text")


def _digests(chunks: DataFrame) -> DataFrame:
    """conv_id and the digest of its chunks in order, read as a stream."""
    conv = chunks.schema["conv_id"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, running, between, like = object(), None, b"", None
        for batch in batches:
            done = []
            like = _arrow("conv_id -, sha string", batch.schema.field("conv_id").type)
            for c, chunk in zip(batch.column(0).to_pylist(), batch.column(2)):
                if running is None or c != here:
                    if running is not None:
                        done.append({"conv_id": here, "sha": running.hexdigest()})
                    here, running, between = c, hashlib.sha256(), b""
                running.update(between + chunk.as_buffer().to_pybytes())
                between = b"\n"
            yield _batch(done, like)
        if running is not None:
            yield _batch([{"conv_id": here, "sha": running.hexdigest()}], like)

    ordered = chunks.repartition("conv_id").sortWithinPartitions("conv_id", "seg")
    return ordered.select("conv_id", "seg", "chunk").mapInArrow(digest, f"conv_id {conv}, sha string")


def _lines(rows: str = "rows") -> Column:
    return F.array_join(F.transform(rows, lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")


def conversation_repairs(conversations: DataFrame) -> DataFrame:
    """The result of the query: damage, repair, and the counts and digests of every conversation."""
    single = F.col("single")
    segments = materialize(
        _repaired(damage(conversations)).select(
            "conv_id", "seg", "blank", "duplicate", "truncated", "illegal", "turns", "min_turn", "max_turn", "cost", "audit",
            F.when(single, F.sha2(_lines(), 256)).alias("sha"),
            F.when(~single & (F.size("rows") > 0), _lines()).alias("chunk"),
        ),
        "repaired",
    )
    counts = segments.drop("chunk")
    long = _digests(segments.where("chunk is not null"))
    none = conversations.select("conv_id").distinct()
    every = counts.unionByName(long, allowMissingColumns=True).unionByName(none, allowMissingColumns=True)

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).alias(name)

    in_order = F.array_sort(F.collect_list(F.when(F.col("audit").isNotNull(), F.struct("seg", "audit"))))
    found = every.groupBy("conv_id").agg(
        (F.max("max_turn") - F.min("min_turn") + 1 - F.sum("turns")).alias("gaps"),
        *map(total, ("blank", "duplicate", "truncated", "illegal", "cost")),
        in_order.alias("audits"),
        F.max("sha").alias("sha"),
    )
    return found.select(
        "conv_id",
        F.coalesce("gaps", F.lit(0)).alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost",
        F.array_join("audits.audit", "").alias("audit"),
        F.coalesce("sha", F.lit(EMPTY_SHA256)).alias("repaired_sha256"),
    )


# ---- SQL


def _sql_edit(x: str, cost: str, letter: str, line: str | None = None) -> str:
    text = f"{x}.r" if line is None else f"{x}.r || case when {x}.r = '' then '' else chr(10) end || {line}"
    return f"{{'c': {x}.c + {cost}, 'a': {x}.a || '{letter}', 'r': {text}}}"


def _sql_insert(names: list[str]) -> list[str]:
    """Best of each state once a row may have been inserted."""
    s0, s1, s2, s3 = names
    put = [_sql_edit(x, "3", "I", "'user:'") for x in (s0, s1, s3)]
    return [s0, s1, f"list_min([{s2}, {', '.join(put)}])", f"list_min([{s3}, {_sql_edit(s2, '3', 'I', repr('assistant:'))}])"]


def _sql_row() -> list[str]:
    """Best of each state behind a row, over i0 to i3 before it."""

    def stay(x: str, letter: str, cost: str, line: str, if_: str) -> str:
        return f"case when {if_} then {_sql_edit(x, cost, letter, line)} end"

    def into(x: str, initial: str, role: str) -> list[str]:
        keep = stay(x, "K", "e", "role || ':' || text", f"not gone and initial = '{initial}'")
        return [keep, stay(x, "R", "e + 3", f"'{role}:' || text", "not gone")] if role else [keep]

    ways = [[], into("i0", "s", ""), [w for x in ("i0", "i1", "i3") for w in into(x, "u", "user")], into("i2", "a", "assistant")]
    return [f"list_min([{', '.join([_sql_edit(f'i{k}', '4', 'D'), *w])}])" for k, w in enumerate(ways)]


def _sql_named(values: list[str], prefix: str) -> str:
    return ", ".join(f"{v} as {prefix}{k}" for k, v in enumerate(values))


_WAITING = "{'c': 1000000000::bigint, 'a': '', 'r': ''}"
_FIRST = _sql_named(["{'c': 0::bigint, 'a': '', 'r': ''}", _WAITING, _WAITING, _WAITING], "s")

ORACLE = f"""
with recursive crc_table as (
  select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t
), keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key from conversations
), hashed as (
  select k.*, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(key)), lambda i: ascii(key[i + 1])::bigint)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 as fault from keyed k, crc_table
), damaged as (
  select conv_id, turn, case when fault = 4 then 'user' else role end as role,
         case fault when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
         unnest(range(case when fault = 3 then 2 else 1 end)) as copy
  from hashed where fault <> 0
), numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as n from damaged
), judged as (
  select *, not regexp_matches(text, '[^\x20\x09-\x0D]') as blank,
         row_number() over (partition by conv_id, role, text order by n) > 1 as repeated,
         regexp_matches(text, '[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*$') as open_end,
         left(role, 1) as initial from numbered
), faults as (
  select *, blank or repeated as gone, not blank and repeated as duplicate, not blank and not repeated and open_end as truncated,
         case when not blank and not repeated and open_end then 3 else 0 end as e,
         lag(left(role, 1)) over (partition by conv_id order by n) || initial not in ('su', 'ua', 'au') and n > 1 as illegal
  from judged
), steps as (
  select distinct conv_id, 0::bigint as n, {_FIRST} from faults
  union all
  select conv_id, n, {_sql_named(_sql_row(), "s")} from (
    select f.*, {_sql_named(_sql_insert(["j0", "j1", "j2", "j3"]), "i")} from (
      select conv_id, n, {_sql_named(_sql_insert(["s0", "s1", "s2", "s3"]), "j")} from steps
    ) p join faults f on f.conv_id is not distinct from p.conv_id and f.n = p.n + 1
  )
), counted as (
  select conv_id, count(*) as n, sum(blank::int) as blank, sum(duplicate::int) as duplicate, sum(truncated::int) as truncated,
         sum(coalesce(illegal, false)::int) as illegal, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps
  from faults group by conv_id
), ended as (
  select conv_id, list_min([i0, i3]) as best from (
    select conv_id, {_sql_named(_sql_insert(["j0", "j1", "j2", "j3"]), "i")} from (
      select s.conv_id, {_sql_named(_sql_insert(["s0", "s1", "s2", "s3"]), "j")}
      from steps s join counted c on s.conv_id is not distinct from c.conv_id and s.n = c.n
    )
  )
)
select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
       coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(best.c, 0)::bigint as cost,
       coalesce(best.a, '') as audit, sha256(coalesce(best.r, '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counted c on o.conv_id is not distinct from c.conv_id left join ended e on o.conv_id is not distinct from e.conv_id
"""
