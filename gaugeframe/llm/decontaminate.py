"""Benchmark decontamination: a prefix-filtered set join of word shingles, with DataFrame
functions only.

An item window is ``size`` consecutive words of an item (all of them, if it has fewer). As a set
it consists of its shingles of three words, and a document contains the window only if it
contains each of them; so one is a long enough prefix, and the rarest one in the documents is
taken. Where that shingle occurs, its place in the window gives the only possible start, the
document's length bounds it, and the other shingles must follow at their places, word by word.

A null text has no words. Rows with equal id and text get equal results, each its own row. An
item without words has no window; a null item id reads as empty text. Either table may be empty.
Extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import written

SHINGLE = 3
WINDOW = 10
#: A table of item shingles or windows is broadcast up to this many rows, else shuffled.
BROADCAST_ROWS = 500_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else. ``lower`` is much faster than ``translate`` and serves
    wherever the text beyond ASCII has no upper case."""
    beyond = F.regexp_replace(text, "[\\x00-\\x7F]+", "")
    plain = (F.octet_length(text) == F.char_length(text)) | (F.lower(beyond) == beyond)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    parts = F.split(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))),
                    "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
    return F.array_remove(parts, "")


def shingles(held: Column, size: int) -> Column:
    """Array of (pos, gram) of the ``size`` words from each position that has as many."""
    held_grams = F.transform(F.sequence(F.lit(0), F.size(held) - size), lambda i: F.struct(
        i.cast("int").alias("pos"),
        F.concat_ws(" ", *[F.get(held, i + k) for k in range(size)]).alias("gram")))
    return F.when(F.size(held) >= size, held_grams).otherwise(
        F.array().cast("array<struct<pos: int, gram: string>>"))


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 size: int = WINDOW) -> DataFrame:
    """(window, span, item): the words of each window, their number, and an item that has it."""
    held = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                        words(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    spans = held.select("item", F.explode(F.transform(
        starts, lambda i: F.slice(F.col("w"), i, size))).alias("words"))
    return spans.select(F.array_join("words", " ").alias("window"), F.size("words").alias("span"),
                        "item").distinct()


def _sized(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text",
                  size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """What is hit in the documents: (id, fp, span, start, item) for each occurrence of a window,
    and (id, fp, n_words) of each row. ``fp`` is a hash of the text."""
    windows = written(item_windows(items, item_col, item_text_col, size), "windows")
    texts = windows.select("window", "span").distinct()
    # The shingles of a window; one of fewer than three words is its own shingle.
    wide = texts.select("window", "span", F.split("window", " ").alias("w"))
    parts = wide.select("window", "span", F.inline(F.when(F.col("span") >= SHINGLE, shingles(F.col("w"), SHINGLE))
                        .otherwise(F.array(F.struct(F.lit(0).alias("pos"), F.col("window").alias("gram"))))))
    parts = written(parts.withColumnRenamed("pos", "at"), "window-shingles")
    size_of = parts.agg(F.count_distinct("gram").alias("grams"), F.count(F.lit(1)).alias("rows"),
                        F.min("span").alias("least")).first()

    doc = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("fp"),
                      words(F.col(text_col)).alias("w"))
    lengths = doc.select("id", "fp", F.size("w").cast("bigint").alias("n_words"))
    grams = shingles(F.col("w"), SHINGLE)
    for short in range(1, SHINGLE):  # only if some item is so short
        if size_of["least"] is not None and size_of["least"] <= short:
            grams = F.concat(grams, shingles(F.col("w"), short))
    known = _sized(parts.select("gram").distinct(), size_of["grams"])
    # All places of item shingles, with the words that follow bounded by the document's length.
    places = doc.select("id", "fp", F.size("w").alias("n"), F.inline(grams)).join(known, "gram", "left_semi")
    places = written(places, "places")

    rarity = places.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    ranked = parts.join(rarity, "gram")  # a window with a shingle that no document has drops out
    prefix = ranked.groupBy("window", "span").agg(
        F.count(F.lit(1)).alias("found"), F.min(F.struct("df", "gram", "at")).alias("rare"))
    prefix = prefix.filter(F.col("found") == F.greatest(F.col("span") - SHINGLE + 1, F.lit(1)))
    prefix = prefix.select("window", "span", "rare.gram", "rare.at")
    starts = places.join(_sized(prefix, size_of["rows"]), "gram").select(
        "id", "fp", "n", "window", "span", (F.col("pos") - F.col("at")).alias("start"))
    starts = starts.filter((F.col("start") >= 0) & (F.col("start") + F.col("span") <= F.col("n")))
    # Each place is asked for the window's shingle there; all must agree.
    asked = starts.join(_sized(parts.select("window", "gram", "at"), size_of["rows"]), "window").select(
        "id", "fp", "window", "span", "start", "gram", (F.col("start") + F.col("at")).alias("pos"))
    here = places.select(*[F.col(c).alias(f"_{c}") for c in ("id", "fp", "pos", "gram")]).distinct()
    agreed = asked.distinct().join(here, F.col("id").eqNullSafe(F.col("_id")) & (F.col("fp") == F.col("_fp"))
                        & (F.col("pos") == F.col("_pos")) & (F.col("gram") == F.col("_gram")))
    whole = agreed.groupBy("id", "fp", "window", "span", "start").agg(F.count(F.lit(1)).alias("n"))
    whole = whole.filter(F.col("n") == F.greatest(F.col("span") - SHINGLE + 1, F.lit(1)))
    return whole.select("id", "fp", "window", "span", "start"), windows, lengths


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: id, fp (a hash of the text), n_words, n_hit (words inside a window),
    n_items and items (sorted ids of the items with windows in it)."""
    hits, windows, lengths = decontaminate(docs, items, id_col, text_col, item_col, item_text_col, size)
    hits = written(hits, "hits")
    covered = hits.select("id", "fp", F.explode(F.sequence(
        F.col("start"), F.col("start") + F.col("span") - 1)).alias("pos")).distinct()
    covered = covered.groupBy("id", "fp").agg(F.count(F.lit(1)).alias("n_hit"))
    of_item = hits.select("id", "fp", "window").distinct().join(
        windows.select("window", "item"), "window").select("id", "fp", "item").distinct()
    of_item = of_item.groupBy("id", "fp").agg(F.array_sort(F.collect_list("item")).alias("items"))

    def by_doc(left: DataFrame, right: DataFrame, new: str) -> DataFrame:
        right = right.select(F.col("id").alias("_id"), F.col("fp").alias("_fp"), new)
        return left.join(right, F.col("id").eqNullSafe(F.col("_id")) & (F.col("fp") == F.col("_fp")),
                         "left").drop("_id", "_fp")

    out = by_doc(by_doc(lengths, covered, "n_hit"), of_item, "items")
    return out.select("id", "fp", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                      F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return contamination(docs, items).select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


OP1_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, list_filter(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
      FROM benchmark),
win AS (SELECT DISTINCT item, len(s) AS span, array_to_string(s, ' ') AS s FROM (
        SELECT item, list_slice(w, i, i + 9) AS s FROM (SELECT item, w,
               unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0))),
spans AS (SELECT DISTINCT span FROM win),
grams AS (SELECT doc_id, span, i, array_to_string(list_slice(w, i, i + span - 1), ' ') AS s FROM (
          SELECT doc_id, w, span, unnest(range(1, len(w) - span + 2)) AS i
          FROM d CROSS JOIN spans WHERE len(w) >= span)),
hit AS (SELECT g.doc_id, g.i, g.span, win.item FROM grams g JOIN win ON g.span = win.span AND g.s = win.s),
pos AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + span)) AS p FROM hit)
        GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(pos.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(pos.n, 0) > 0 AS contaminated
FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id LEFT JOIN its ON d.doc_id = its.doc_id
"""
