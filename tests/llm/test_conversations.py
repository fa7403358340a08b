"""Conversation repair against a best-first search and against its SQL."""

import heapq
import random

import duckdb
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from agora.llm import conversations as c

STEP = {0: 2, 1: 2, 2: 3, 3: 2}
KEEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "o": {}}


def cheapest(symbols):
    """(cost, edits): the least cost, then the least text, by search over rows and states."""
    heap, seen = [(0, "", 0, 0)], {}
    while heap:
        cost, edits, i, q = heapq.heappop(heap)
        if (i, q) in seen:
            continue
        seen[i, q] = (cost, edits)
        heapq.heappush(heap, (cost + 3, edits + "I", i, STEP[q]))
        if i < len(symbols):
            s = symbols[i]
            heapq.heappush(heap, (cost + 4, edits + "D", i + 1, q))
            if s != "x":
                more = 3 if s.isupper() else 0
                heapq.heappush(heap, (cost + more + 3, edits + "R", i + 1, STEP[q]))
                if q in KEEP[s.lower()]:
                    heapq.heappush(heap, (cost + more, edits + "K", i + 1, KEEP[s.lower()][q]))
    return min(seen[len(symbols), 0], seen[len(symbols), 3])


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=c.SYMBOLS[1:], max_size=18), st.sampled_from([1, 2, 3, 4]), st.integers(0, 18))
def test_blocks_give_the_cheapest_edits(symbols, block, cut):
    known = c.tables(block).vectors
    head, tail = symbols[:cut], symbols[cut:]
    # The tail's map ends at the last vector; the head's map ends where the tail's begins.
    before, added, behind = c.segment_map(tail, block)
    middle = int(before[0])
    first, more, moved = c.segment_map(head, block)
    state = int(moved[middle][0])
    edits = c.trace(head, middle, 0, block) + c.trace(tail, 0, state, block)
    last = edits[-1][1] if edits else 0
    assert last == int(behind[0][state])
    cost = int(added[0]) + int(more[middle]) + known[int(first[middle])][0]
    assert (cost, "".join(e for e, _ in edits) + c.closing(last)) == cheapest(symbols)


def by_sql(rows):
    conversations = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    connection = duckdb.connect()
    connection.register("given", conversations)
    connection.sql("create view conversations as select conv_id::bigint conv_id, turn::bigint turn, role::varchar role, text::varchar text from given")
    result = connection.sql(c.ORACLE)
    return result.columns, sorted(result.fetchall(), key=repr)


def compare(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.selectExpr("*", "1 as seg", "'x' as rows", "2L as idx", "'t' as audit", "3 as state")
    columns, wanted = by_sql(rows)
    assert sorted(map(tuple, c.conversation_repairs(frame.repartition(3)).select(columns).collect()), key=repr) == wanted
    return wanted


def test_awkward_conversations(spark):
    rng = random.Random(3)
    texts = ["Yes.", "no", "", " \t", None, "Ünï 漢字!", "a? ", "x" * 30000, "line\nline."]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "user"]
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 9)):
            row = (conv, rng.choice([turn, turn, turn, None, turn // 2]), rng.choice(roles), rng.choice(texts))
            rows += [row] * rng.choice([1, 1, 1, 3])
    rows += [(None, k, roles[k % 8], texts[k % 9]) for k in range(12)] + [(-5, -3, "user", "Hi."), (-5, 40, "assistant", "Ho.")]
    compare(spark, rows)


def test_long_conversations_and_copies(spark):
    rng = random.Random(4)
    # One conversation holds most rows; many rows are equal, in one turn and over all turns.
    rows = [(7, k, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["Same.", f"Text {k}.", f"open {k}"])) for k in range(1500)]
    rows += [(7, 800, "user", "Copy.")] * 700 + [(7, None, "user", "Copy.")] * 300
    rows += [(100 + k // 5, k % 5, "user" if k % 2 else "assistant", f"{k}.") for k in range(600)]
    wanted = compare(spark, rows)
    assert len(wanted) == 121


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "user", "So?"), (1, 3, "user", ""), (2, 0, "assistant", "A.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = [tuple(r) for r in c.repair(frame).orderBy("conv_id", "position").drop("position").collect()]
    # Two ways cost 3 each for conversation 1; R for the second of two user rows comes after I.
    assert found == [
        (1, "K", "system", "Be kind."), (1, "K", "user", "Hi."), (1, "R", "assistant", "So?"), (2, "I", "user", ""), (2, "K", "assistant", "A."),
    ]


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert c.conversation_repairs(empty).collect() == [] and c.repair(empty).collect() == []
    # A conversation whose rows all go: this id and turn have the fault 0.
    gone = next(k for k in range(1000) if __import__("zlib").crc32(f"{k}:0".encode()) % 20 == 0)
    row = c.conversation_repairs(spark.createDataFrame([(gone, 0, "user", "Hi.")], empty.schema)).collect()
    assert [tuple(r) for r in row] == [(gone, 0, 0, 0, 0, 0, 0, "", c.EMPTY_SHA256)]
