"""Benchmark decontamination by winnowing, in DataFrame operations only.

The hash of every 7 words is a k-gram hash; of the 7 k-grams in 13 consecutive words the least hash is kept. Two equal
windows of 13 words keep equal hashes, so joining the kept hashes of documents and items finds every shared window, and
a run of windows with one kept hash costs one row. A hit is extended to the 13 words of its windows, which must equal
an item's words. Items of fewer than 13 words are one window of their own length, kept by the hash of all their words.

Null and empty texts have no words: such documents hit nothing and such items have no window. Repeated documents and
items are judged alike; a null item_id hits words but is not counted among the items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.llm.text import lower_ascii
from agora.session import materialize

WINDOW = 13
GRAM = 7  # words of a k-gram; a window holds WINDOW - GRAM + 1 of them
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LENGTH_BITS = 4  # a kept hash carries the length of its window in the low bits


def words(text: Column) -> Column:
    found = F.array_remove(F.split(lower_ascii(text), GAP), "")
    return F.coalesce(found, F.array().cast("array<string>"))


# Two habits keep costly expressions from being worked out again and again. An array that a lambda reads is also read
# outside it (by size): a single use would let the optimizer move the expression that makes it into the lambda. Arrays
# are exploded by the outer form: from the other, the optimizer infers a filter on the array and pushes it to the scan.


def _hashes(words: Column, size: int) -> Column:
    """Hash of every ``size`` consecutive words, in order."""
    n = F.size(words)
    grams = F.transform(F.sequence(F.lit(1), n - size + 1), lambda i: F.xxhash64(F.slice(words, i, size)))
    return F.when(n >= size, grams).otherwise(F.array().cast("array<bigint>"))


def _tagged(hashes: Column, length: int) -> Column:
    return F.shiftleft(hashes, _LENGTH_BITS).bitwiseOR(F.lit(length).cast("long"))


def with_kept(df: DataFrame, lengths: list[int]) -> DataFrame:
    """Add ``kept<length>``: the kept hash of the window that begins at each word. Needs ``words``."""
    if WINDOW in lengths:
        df = df.withColumn("grams", _hashes(F.col("words"), GRAM))
    per_window = WINDOW - GRAM + 1
    for length in lengths:
        if length == WINDOW:
            last = F.size("grams") - (per_window - 1)
            starts = F.sequence(F.lit(1), last)
            least = F.transform(starts, lambda i: _tagged(F.array_min(F.slice("grams", i, per_window)), WINDOW))
            kept = F.when(last >= 1, least).otherwise(F.array().cast("array<bigint>"))
        else:
            kept = F.transform(_hashes(F.col("words"), length), lambda h: _tagged(h, length))
        df = df.withColumn(f"kept{length}", kept)
    return df


def _all_kept(lengths: list[int]) -> Column:
    return F.array_distinct(F.concat(*[F.col(f"kept{length}") for length in lengths]))


def _window_text(start: Column, length: int) -> Column:
    return F.array_join(F.slice("words", start + 1, length), " ")


def item_windows(items: DataFrame) -> DataFrame:
    """item_id, length, kept, window (its words joined by blanks): every window of every item."""
    cut = items.select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0)
    cut = cut.withColumn("n_words", F.size("words"))
    lengths = sorted(r["l"] for r in cut.select(F.least("n_words", F.lit(WINDOW)).alias("l")).distinct().collect())
    parts = []
    for length in lengths:
        of_length = cut.where(F.col("n_words") >= WINDOW if length == WINDOW else F.col("n_words") == length)
        kept = with_kept(of_length, [length]).select("item_id", "words", F.posexplode_outer(f"kept{length}").alias("start", "kept"))
        parts.append(
            kept.select("item_id", F.lit(length).alias("length"), "kept", _window_text(F.col("start"), length).alias("window"))
        )
    if not parts:
        return items.sparkSession.createDataFrame(
            [], f"item_id {items.schema['item_id'].dataType.simpleString()}, length int, kept bigint, window string"
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _keyed(docs: DataFrame) -> DataFrame:
    """A row's key is 96 bits of id and text: equal rows share it, and so they share their result."""
    id_text = F.col("doc_id").cast("string")
    return docs.select(
        "doc_id", "text", F.xxhash64(id_text, "text").alias("k1"), F.hash("text", id_text).alias("k2")
    )


KEY = ["k1", "k2"]


def hit_windows(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(k1, k2, start, length, window) of every document window that is an item's, and the item windows."""
    windows = materialize(item_windows(items).distinct(), "item-windows")
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())
    if not lengths:
        nothing = docs.sparkSession.createDataFrame([], "k1 bigint, k2 int, start int, length int, window string")
        return nothing, windows
    keyed = _keyed(docs)
    cut = keyed.select("k1", "k2", words(F.col("text")).alias("words"))
    # Every item fingerprint once: as large as the benchmark, so Spark broadcasts it by its size or not at all.
    prints = windows.select("kept").distinct()
    found = with_kept(cut, lengths).select("k1", "k2", F.explode_outer(_all_kept(lengths)).alias("kept")).join(prints, "kept")
    suspects = materialize(
        found.groupBy(*KEY).agg(F.collect_set("kept").alias("found")), "suspects"
    )
    # Extension of the hits, on the texts of suspects alone.
    again = keyed.join(suspects, KEY).select("k1", "k2", "found", words(F.col("text")).alias("words"))
    marked = with_kept(again, lengths)
    parts = []
    for length in lengths:
        starts = marked.select("k1", "k2", "words", "found", F.posexplode_outer(f"kept{length}").alias("start", "kept"))
        parts.append(
            starts.where(F.array_contains("found", F.col("kept"))).select(
                "k1", "k2", "start", F.lit(length).alias("length"), _window_text(F.col("start"), length).alias("window")
            )
        )
    candidates = parts[0]
    for part in parts[1:]:
        candidates = candidates.unionByName(part)
    # Equal rows repeat their windows; each counts once.
    hits = candidates.join(windows.select("length", "window").distinct(), ["length", "window"], "left_semi").distinct()
    return hits.select("k1", "k2", "start", "length", "window"), windows


def contamination(docs: DataFrame, items: DataFrame, share: int = 20) -> DataFrame:
    """The result of the query, with the key of each row: words, words hit, items and whether it is contaminated.

    A document is contaminated if 1 of ``share`` words or more are inside an occurrence of an item's window.
    """
    hits, windows = hit_windows(docs, items)
    span = F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)
    by_doc = materialize(
        hits.select("k1", "k2", span.alias("span"), F.col("length"), "window")
        .groupBy(*KEY)
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("span")))).cast("long").alias("n_hit"),
            F.array_sort(F.collect_set("window")).alias("found"),
        )
        .withColumn("set_id", F.md5(F.array_join("found", "\n"))),
        "hit-documents",
    )
    # Documents that share the same windows share their items: the items are looked up once for each such set.
    sets = by_doc.groupBy("set_id").agg(F.first("found").alias("found")).select("set_id", F.explode("found").alias("window"))
    owners = windows.where(F.col("item_id").isNotNull()).select("window", F.col("item_id").cast("string").alias("item_id"))
    listed = (
        sets.join(owners.distinct(), "window")
        .select("set_id", "item_id")
        .distinct()
        .groupBy("set_id")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    listed = listed.select(
        "set_id", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    )
    judged = by_doc.select("k1", "k2", "n_hit", "set_id").join(listed, "set_id", "left").drop("set_id")
    rows = _keyed(docs).select("doc_id", "k1", "k2", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    out = rows.join(judged, KEY, "left").withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long")))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))).alias("contaminated"),
        "k1",
        "k2",
    )


def contaminated_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    return contamination(docs, items).drop(*KEY)


def drop_contaminated(docs: DataFrame, items: DataFrame, share: int = 20) -> DataFrame:
    """The rows of ``docs``, with all columns, that are not contaminated."""
    bad = contamination(docs, items, share).where("contaminated").select(*KEY).distinct()
    id_text = F.col("doc_id").cast("string")
    packed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.xxhash64(id_text, "text").alias("k1"),
        F.hash("text", id_text).alias("k2"),
    )
    kept = packed.join(bad, KEY, "left_anti")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


ORACLE = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM benchmark WHERE text IS NOT NULL),
item_grams AS (
  SELECT DISTINCT item_id, least(len(w), 13) l, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) s FROM item_words WHERE len(w) > 0)),
doc_grams AS (
  SELECT doc_id, s, l, array_to_string(w[s:s + l - 1], ' ') g
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) s
        FROM doc_words, (SELECT DISTINCT l FROM item_grams) WHERE len(w) >= l)),
hit AS (SELECT d.doc_id, d.s, d.l, i.item_id FROM doc_grams d JOIN item_grams i ON d.g = i.g AND d.l = i.l),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) n_hit
  FROM (SELECT doc_id, unnest(range(s, s + l)) p FROM (SELECT DISTINCT doc_id, s, l FROM hit)) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) h
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(w), 0) AS BIGINT) n_words, CAST(coalesce(n_hit, 0) AS BIGINT) n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) n_items, coalesce(h, sha256('')) items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) contaminated
FROM doc_words d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
