"""Benchmark decontamination with DataFrame functions only.

Each document position hashes its own window (one chained 64-bit hash of the words from there
on) inside generated code and probes a broadcast hash set of the benchmark's windows; a hit is
verified word by word before it counts. Only hits, and one marker row a document, leave the
scan; so the one shuffle, by document, carries no text.

What is broadcast is held to ``BROADCAST_BYTES``, measured on the written windows: their words
and hashes if these fit, so that hits are verified in place; or the hashes alone, and hits are
joined with the windows to verify them; or nothing, and positions are joined by hash, without
their words. All three give the same rows.

Items come last: windows with the same items share a set, and the items of each combination of
sets that documents have are united once, however many windows, items or documents share them.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import documents, text_of, written

WINDOW = 13
BROADCAST_BYTES = 64 << 20
HASH_BYTES, WORD_BYTES = 32, 16  # of a hash in the set, and around each word
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after lower-casing, so A-Z no longer occur


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), SEPARATORS), "")


def window_hash(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*(F.get(words, at + k) for k in range(size)))


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """A row per distinct window: ``window_words, window_size, window_hash, items, item_set``. Items without words have none."""
    words = benchmark.select(F.col(id_col).cast("string").alias("item"), words_of(text_of(text_col)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    each = words.select("item", "w", F.explode(starts).alias("s")).select("item", F.slice("w", F.col("s"), F.lit(window)).alias("window_words"))
    distinct = each.groupBy("window_words").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return distinct.select("window_words", F.size("window_words").alias("window_size"), window_hash(F.col("window_words"), F.lit(0), window).alias("window_hash"), "items", F.sha2(F.to_json("items"), 256).alias("item_set"))


def tokens_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_of(text_col)).alias("version"), words_of(text_of(text_col)).alias("words"))


def hits(tokens: DataFrame, windows: DataFrame, window: int, broadcast_bytes: int) -> DataFrame:
    """``doc_id, version, n, at, size, item_set``: a row per verified hit, and one per document row that has ``n``, its number of words."""
    stored = F.octet_length(F.concat_ws(" ", "window_words")) + WORD_BYTES * F.col("window_size") + HASH_BYTES
    sizes = windows.groupBy("window_size").agg(F.count("*").alias("n"), F.sum(stored).alias("bytes")).collect()  # as many rows as window lengths
    lengths = sorted(r["window_size"] for r in sizes) or [window]
    each = tokens.select("doc_id", "version", "words", F.posexplode_outer("words").alias("at", "word"))
    at, size = F.col("at"), F.col("size")
    if len(lengths) == 1:
        probes = each.select("doc_id", "version", "words", "at", F.lit(lengths[0]).alias("size"), window_hash(F.col("words"), at, lengths[0]).alias("hash"))
    else:
        probe = F.array(*(F.struct(F.lit(n).alias("size"), window_hash(F.col("words"), at, n).alias("hash")) for n in lengths))
        probes = each.select("doc_id", "version", "words", "at", F.inline(probe))
    marker = F.coalesce(at, F.lit(0)).eqNullSafe(0) & (size == lengths[0])
    mark = F.when(marker, F.size("words")).alias("n")
    gram = F.slice("words", at + 1, size)
    same = (F.col("hash") == F.col("window_hash")) & (size == F.col("window_size"))
    slim = windows.select("window_words", "window_size", "window_hash", "item_set")
    hit = F.col("window_hash").isNotNull()
    if sum(r["bytes"] for r in sizes) <= broadcast_bytes:
        found = probes.join(F.broadcast(slim), same & (gram == F.col("window_words")), "left").where(hit | marker)
        return found.select("doc_id", "version", mark, "at", F.when(hit, size).alias("size"), "item_set")
    hashes = windows.select("window_hash", "window_size").distinct()
    marks = tokens.select("doc_id", "version", F.size("words").alias("n"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("size"), F.lit(None).cast("string").alias("item_set"))
    if sum(r["n"] for r in sizes) * HASH_BYTES <= broadcast_bytes:
        near = probes.join(F.broadcast(hashes), same, "left_semi").select("doc_id", "version", "at", "size", "hash", gram.alias("gram"))
    else:  # positions meet the hashes in a shuffle, and only those that agree fetch their words
        places = probes.where(at + size <= F.size("words")).select("doc_id", "version", "at", "size", "hash").join(hashes, same, "left_semi").distinct()
        own = tokens.select(F.col("doc_id").alias("own_doc"), F.col("version").alias("own_version"), "words")
        near = places.join(own, F.col("doc_id").eqNullSafe(F.col("own_doc")) & (F.col("version") == F.col("own_version"))).select("doc_id", "version", "at", "size", "hash", gram.alias("gram"))
    verified = near.join(slim, same & (F.col("gram") == F.col("window_words")))
    return verified.select("doc_id", "version", F.lit(None).cast("int").alias("n"), "at", "size", "item_set").unionByName(marks)


def rated(found: DataFrame) -> DataFrame:
    """A row per (doc_id, version) of ``hits``: ``n_words, n_hit, contaminated, spans``, its item sets, and how many rows it has."""
    span = F.when(F.col("size").isNotNull(), F.struct("at", "size"))
    grouped = found.groupBy("doc_id", "version").agg(
        F.max("n").cast("long").alias("n_words"),
        F.count("n").alias("__rows"),
        F.array_sort(F.collect_set(span)).alias("spans"),
        F.array_sort(F.collect_set("item_set")).alias("__sets"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda a, x: F.struct((a["n"] + F.greatest(x["at"] + x["size"] - F.greatest(a["end"], x["at"]), F.lit(0))).cast("long").alias("n"), F.greatest(a["end"], x["at"] + x["size"]).alias("end")),
        lambda a: a["n"],
    )
    counted = grouped.withColumn("n_hit", covered)
    return counted.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A row per document row: ``doc_id, version, n_words, n_hit, n_items, items_sha256, contaminated, spans``.

    ``version`` is the text's hash; ``spans`` are the hit windows as (first word, words).
    Null and empty texts have no words and no hits; texts are read whole, however long. Rows that
    repeat id and text give a row each, an empty table gives none, and other columns are left out.
    A null item id marks words as hit but is no item. An empty benchmark hits nothing.
    """
    windows = written(benchmark_windows(benchmark, item_col, "text", window), "windows")
    per = written(rated(hits(tokens_of(docs, id_col, text_col), windows, window, broadcast_bytes)), "rated").withColumn("__combination", F.when(F.size("__sets") > 0, F.sha2(F.array_join("__sets", ","), 256)))
    sets = windows.select("item_set", "items").dropDuplicates(["item_set"])
    combinations = per.where("__combination is not null").select("__combination", "__sets").dropDuplicates(["__combination"]).select("__combination", F.explode("__sets").alias("item_set"))
    united = combinations.join(sets, "item_set").groupBy("__combination").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    # Written, so that Spark knows its size: a row a combination is broadcast only if that allows, and a common one then moves no document.
    named = written(united.select("__combination", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256")), "combinations")
    full = per.join(named, "__combination", "left").withColumns({"n_items": F.coalesce("n_items", F.lit(0).cast("long")), "items_sha256": F.coalesce("items_sha256", F.sha2(F.lit(""), 256))})
    again = full.select("*", F.explode(F.array_repeat(F.lit(0), F.col("__rows").cast("int"))).alias("__row"))
    return again.select("doc_id", "version", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans")


def reported(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A row per document of which a word is hit, without its items."""
    windows = written(benchmark_windows(benchmark.select(F.lit(0).alias("item_id"), "text"), "item_id", "text", window), "windows")
    return rated(hits(tokens_of(docs, id_col, text_col), windows, window, broadcast_bytes)).where("n_hit > 0")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated documents; other rows and all columns stay as they are."""
    bad = reported(docs, benchmark, id_col, text_col, **options).where("contaminated").select(F.col("doc_id").alias("__bad_doc"), F.col("version").alias("__bad_version"))
    hit = F.col(id_col).cast("long").eqNullSafe(F.col("__bad_doc")) & (F.xxhash64(text_of(text_col)) == F.col("__bad_version"))
    return docs.join(bad, hit, "left_anti")


def without_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with each hit word cut out of its text, together with what separates it from the next word."""
    report = reported(docs, benchmark, id_col, text_col, **options).select(F.col("doc_id").alias("__hit_doc"), F.col("version").alias("__hit_version"), F.col("spans").alias("__spans"))
    match = F.col(id_col).cast("long").eqNullSafe(F.col("__hit_doc")) & (F.xxhash64(text_of(text_col)) == F.col("__hit_version"))
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    parts = F.regexp_extract_all(text_of(text_col), F.lit(f"({word}[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]*)"), 1)
    lead = F.regexp_extract(text_of(text_col), r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", 0)
    kept = F.filter(parts, lambda _, k: ~F.exists("__spans", lambda s: (k >= s["at"]) & (k < s["at"] + s["size"])))
    cut = F.when(F.col("__spans").isNotNull(), F.concat(lead, F.array_join(kept, ""))).otherwise(F.col(text_col))
    return docs.join(report, match, "left").withColumn(text_col, cut).drop("__hit_doc", "__hit_version", "__spans")


def op6_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("version", "spans")


OP6_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, w[s : s + 12] AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM bw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT len(g) AS n FROM win),
pos AS (
  SELECT doc_id, n, s, w[s : s + n - 1] AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM dw, lens WHERE len(w) >= n)),
hits AS (SELECT doc_id, s, n, item_id FROM pos JOIN win USING (g)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""
