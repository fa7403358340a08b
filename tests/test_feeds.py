"""Feeds: ends, repeated and late pages, upserts."""

import json
import random

import pytest

from agora.streaming.ingest import compact_feeds, feed_state, ingest_feeds_stream, read_feeds
from tests.conftest import rows


def page(feed, number, scores, more=True, **other):
    items = None if scores is None else [{"question_id": i, "tags": ["t"], "score": float(s), "owner": {"user_id": i}} for i, s in scores.items()]
    return {"feed": feed, "page": number, "items": items, "has_more": more, **other}


@pytest.fixture
def feeds(spark, tmp_path):
    """land(file, pages...) takes pages in and gives question_id -> score."""

    def land(name, *pages):
        (tmp_path / "landing").mkdir(exist_ok=True)
        (tmp_path / "landing" / name).write_text("\n".join(json.dumps(p) for p in pages))
        out, offsets = str(tmp_path / "table"), str(tmp_path / "offsets")
        ingest_feeds_stream(spark, str(tmp_path / "landing"), out, offsets, "questions", files_per_batch=1).awaitTermination()
        return dict(rows(read_feeds(spark, out, "questions"), "question_id", "score"))

    return land


def test_pages_behind_the_end_are_ignored(spark, feeds, tmp_path):
    assert feeds("1", page("a", 1, {1: 1}), page("a", 2, {2: 2}, False), page("a", 3, {3: 3})) == {1: 1, 2: 2}
    # Another run knows the end; other feeds go on.
    assert feeds("2", page("a", 4, {4: 4}, False), page("b", 9, {9: 9})) == {1: 1, 2: 2, 9: 9}
    # An empty page ends a feed too, and an end that lands late counts for what is stored.
    assert feeds("3", page("b", 5, {}), page("c", 1, None)) == {1: 1, 2: 2}
    state = {r.feed: (r.last_page, r.ended_at) for r in feed_state(spark, str(tmp_path / "table")).collect()}
    assert state == {"a": (4, 2), "b": (9, 5), "c": (1, 1)}
    assert feeds("4", page("b", 2, {5: 5}), page("a", 1, {1: 7})) == {1: 7, 2: 2, 5: 5}


def test_a_repeated_page_changes_nothing_and_a_newer_item_replaces(spark, feeds, tmp_path):
    first = [page("a", 1, {1: 1, 2: 2}), page("a", 2, {3: 3}, False)]
    once = feeds("1", *first)
    assert feeds("2", *first) == once == {1: 1, 2: 2, 3: 3}
    assert feeds("3", page("a", 1, {1: 8, 2: 2})) == {1: 8, 2: 2, 3: 3}
    # Of one landing the higher page counts.
    assert feeds("4", page("a", 2, {1: 5}, False), page("a", 1, {1: 6})) == {1: 5, 2: 2, 3: 3}
    target = str(tmp_path / "compact")
    compact_feeds(spark, str(tmp_path / "table"), "questions", target)
    assert dict(rows(spark.read.parquet(target), "question_id", "score")) == {1: 5, 2: 2, 3: 3}


def test_a_batch_that_runs_again_overwrites_itself(spark, feeds, tmp_path):
    feeds("1", page("a", 1, {1: 1}))
    feeds("2", page("a", 2, {2: 2}))
    # The offsets of the last batch are lost before its commit: the batch is run again.
    (tmp_path / "offsets" / "commits" / "1").unlink()
    for crc in (tmp_path / "offsets" / "commits").glob(".1.crc"):
        crc.unlink()
    assert feeds("3", page("a", 3, {3: 3}, False)) == {1: 1, 2: 2, 3: 3}
    assert rows(spark.read.parquet(str(tmp_path / "table" / "items")), "question_id") == [(1,), (2,), (3,)]


def test_any_order_of_landing_gives_the_same_table(spark, feeds):
    rng = random.Random(1)
    pages = [page(f, n, {100 * k + n: n, 100 * k + n + 50: -n}, n < 6) for k, f in enumerate("xyz") for n in range(1, 9)]
    rng.shuffle(pages)
    for k in range(0, len(pages), 9):
        found = feeds(str(k), *pages[k : k + 9], pages[0])
    assert found == {100 * k + n + m: s * n for k in range(3) for n in range(1, 7) for m, s in ((0, 1), (50, -1))}


def test_pages_without_feed_or_number(spark, feeds, tmp_path):
    assert read_feeds(spark, str(tmp_path / "nothing"), "questions").collect() == []
    assert feeds("1", page(None, None, {1: 1}), page(None, 1, {2: 2}, None), page(None, 2, {3: 3})) == {1: 1, 2: 2}
