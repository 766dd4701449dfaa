"""Benchmark decontamination by a broadcast hash set, in DataFrame functions alone.

The test items' windows of words are distinct rows (hash, words). Windows of the training texts meet them by hash, and each
hit is verified word by word in the same stage, while the text's words are at hand. What is found belongs to a text, not to
a row, so that copies share it. Where the windows of the items are beyond the bound of a broadcast, they are dealt by hash
into as many parts as fit, and the texts are scanned once for each part: no window of a text is ever shuffled, and a window
that stands in a third of all texts burdens no task.

Null and empty texts have no words and hit nothing. An item with fewer words than a window is one window; one without words
is none. Items of equal id count once; an item without an id marks words and is not named. Rows that repeat have equal
values, empty tables give no hits or no rows, and columns of any other name are kept apart. The ids of the items that a text
meets are one string in the result, so they must fit in a row; they are gathered once for each different set of windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import fresh, stored, table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word and what is between words, before A-Z is lower-cased.
CASED, BETWEEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words of a window.
WINDOW = 10
#: Bytes of items' windows that are broadcast at once, and rows of found texts.
BROADCAST_BYTES, BROADCAST_ROWS = 64 << 20, 200_000


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lower-cased (null: none)."""
    return F.regexp_extract_all(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, UPPER.lower()), F.lit(WORD), F.lit(0))


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(hash, n, gram, group, items): the distinct windows, with the sorted ids of the items that hold them; group is the same for windows of the same items."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(window))
    grams = rows.select("item", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda k: F.slice("w", k, n))).alias("gram"))
    held = grams.groupBy("gram").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return held.select(_window_hash(F.col("gram"), 0, F.size("gram"), window).alias("hash"), F.size("gram").alias("n"), "gram", F.md5(F.array_join("items", ",").cast("binary")).alias("group"), "items")


def _window_hash(w: Column, at: Column | int, n: Column, window: int) -> Column:
    """Hash of the n (at most window) words from a place on, without a slice of them; nulls beyond add nothing."""
    return F.xxhash64(*(F.when(F.lit(k) < n, F.get(w, F.lit(at) + k if isinstance(at, int) else at + k)) for k in range(window)))


def _hits(texts: DataFrame, windows: DataFrame, lengths: list[int], window: int) -> DataFrame:
    """(key, at, n, group) of the places of texts (key, w) where a window stands. Places are numbered once for each length; hashes are taken after they are rows, in generated code."""
    size = F.size("w")
    # The outer form of explode keeps the optimiser from a filter that would look for the words once more.
    rows = texts.select("key", "w", F.explode_outer(F.when(size > 0, F.sequence(F.lit(0), size * len(lengths) - 1))).alias("p")).where("p is not null")
    n = F.element_at(F.array(*map(F.lit, lengths)), F.expr("cast(p div size(w) as int)") + 1)
    rows = rows.withColumns({"at": F.expr("p % size(w)"), "m": n})
    rows = rows.where(F.col("at") + F.col("m") <= size).withColumn("hash", _window_hash(F.col("w"), F.col("at"), F.col("m"), window))
    met = rows.join(F.broadcast(windows.select("hash", "n", "gram", "group")), "hash")
    return met.where((F.col("m") == F.col("n")) & (F.slice("w", F.col("at") + 1, F.col("n")) == F.col("gram"))).select("key", "at", "n", "group")


def _runs(spans: Column) -> Column:
    """Maximal runs (at, end) of words under spans (at, n); neighbours join."""
    start = F.array().cast("array<struct<at:int,end:int>>")

    def add(runs: Column, s: Column) -> Column:
        last, end = F.element_at(runs, -1), s["at"] + s["n"]
        longer = F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(F.struct(last["at"].alias("at"), F.greatest(last["end"], end).alias("end"))))
        return F.when((F.size(runs) > 0) & (s["at"] <= F.try_element_at(runs, F.lit(-1))["end"]), longer).otherwise(F.concat(runs, F.array(F.struct(s["at"].alias("at"), end.alias("end")))))

    return F.aggregate(F.array_sort(spans), start, add)


def _key(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW, item_id: str = "item_id", item_text: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(key, n_hit, n_items, items_sha256, runs) of every different text that meets an item; key is its SHA-256, runs are its hit words (at, end). Stored."""
    windows = stored(item_windows(benchmark, item_id, item_text, window), "test-windows")
    # The lengths are at most as many as words in a window.
    sizes = windows.groupBy("n").agg(F.sum(F.length(F.array_join("gram", " ")) * 2 + F.size("gram") * 16 + 100).alias("bytes")).collect()
    lengths, parts = sorted(r["n"] for r in sizes), max(1, -(-sum(r["bytes"] for r in sizes) // broadcast_bytes))
    texts = docs.select(_key(F.col(text_col)).alias("key"), words_of(F.col(text_col)).alias("w"))
    if not lengths:
        texts, lengths = texts.limit(0), [window]
    hits = None
    for k in range(parts):
        own = windows if parts == 1 else windows.where(F.pmod("hash", F.lit(parts)) == k)
        found = _hits(texts, own, lengths, window)
        # Copies and windows of one text are one row of each task before the shuffle.
        found = found.groupBy("key").agg(F.collect_set(F.struct("at", "n")).alias("spans"), F.collect_set("group").alias("groups"))
        found = found if parts == 1 else stored(found, "window-hits")
        hits = found if hits is None else hits.unionByName(found)
    if parts > 1:
        hits = hits.groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("groups"))).alias("groups"))
    hits = stored(hits.select("key", _runs(F.col("spans")).alias("runs"), F.array_sort("groups").alias("groups")).withColumn("set", F.md5(F.array_join("groups", ",").cast("binary"))), "hit-texts")
    sets = hits.groupBy("set").agg(F.first("groups").alias("groups")).select("set", F.explode("groups").alias("group"))
    names = sets.join(windows.groupBy("group").agg(F.first("items").alias("items")), "group").groupBy("set").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    names = names.select("set", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda s, r: s + (r["end"] - r["at"]))
    return stored(hits.join(names, "set").select("key", n_hit.alias("n_hit"), "n_items", "items_sha256", "runs"), "contaminated")


def _with_found(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """rows with what was found of their text. What was found is broadcast if it is few; else a shuffle, whose hot keys Spark splits."""
    few = found.count() <= BROADCAST_ROWS
    other = found.withColumnRenamed("key", key)
    return rows.join(F.broadcast(other) if few else other, key, "left")


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for each row of docs."""
    found = contaminated_texts(docs, benchmark, text_col, window).drop("runs")
    text = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER, UPPER.lower())
    rows = docs.select(F.col(id_col).alias("doc_id"), _key(F.col(text_col)).alias("key"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"))
    out = _with_found(rows, found, "key")
    zero = F.lit(0).cast("long")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"), F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"))


def cleaned_documents(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """docs without contamination, with their columns. remove: `spans` takes the hit words and what follows each up to the next word out of the text; `documents` drops every row with a hit word."""
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove is {remove!r}")
    key, runs = fresh(docs, "key", "runs")
    found = contaminated_texts(docs, benchmark, text_col, window).select("key", F.col("runs").alias(runs))
    out = _with_found(docs.withColumn(key, _key(F.col(text_col))), found, key)
    if remove == "documents":
        return out.where(F.col(runs).isNull()).select(*docs.columns)
    text = F.col(text_col).cast("string")
    pieces = F.regexp_extract_all(text, F.lit(CASED + BETWEEN), F.lit(0))
    left = F.filter(pieces, lambda p, k: ~F.exists(F.col(runs), lambda r: (r["at"] <= k) & (k < r["end"])))
    cut = F.concat(F.regexp_extract(text, f"^{BETWEEN}", 0), F.array_join(left, ""))
    return out.withColumn(text_col, F.when(F.col(runs).isNull(), text).otherwise(cut)).select(*docs.columns)


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD}')"
_LATER = ", ".join(f"lead(word, {k}) OVER o" for k in range(1, WINDOW))
OP12_SQL = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    g AS (SELECT DISTINCT item_id, n, array_to_string(w[i + 1:i + n], ' ') AS gram FROM (SELECT item_id, w, least(len(w), {WINDOW}) AS n, unnest(range(0, len(w) - least(len(w), {WINDOW}) + 1)) AS i FROM b WHERE len(w) > 0) s),
    e AS (SELECT r, len(w) AS size, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM d),
    f AS (SELECT r, i, size, [word, {_LATER}] AS later FROM e WINDOW o AS (PARTITION BY r ORDER BY i)),
    p AS (SELECT f.r, f.i, l.n, array_to_string(f.later[1:l.n], ' ') AS gram FROM f CROSS JOIN (SELECT DISTINCT n FROM g) l WHERE f.i + l.n <= f.size),
    h AS (SELECT p.r, p.i, p.n, g.item_id FROM p JOIN g ON g.n = p.n AND g.gram = p.gram),
    c AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT r, i, n FROM h) s) t GROUP BY r),
    t AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM h GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN c ON c.r = d.r LEFT JOIN t ON t.r = d.r"""
