"""Benchmark decontamination by a broadcast set of normalised test n-grams (native).

Texts are lower-cased (A-Z) and cut into words of letters, digits and all characters beyond
ASCII. A window is `n` consecutive words of a test item; an item of fewer words is one window.

A window of L words covers a whole aligned block of b = (L + 1) // 2 document words (blocks
start at multiples of b), wherever the window begins. So the scan hashes one block in b words
and looks it up in the set of all b-grams of the windows; this loses no document. Documents
with a block in the set are scanned again, window by window, and the windows are compared as
text, so that no hash decides.

The set is broadcast only if it was counted to hold at most `broadcast_grams` entries;
otherwise Spark joins by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, stored

WINDOW = 13
WORD_CHARS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
OTHER_CHARS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
RAW_OTHER = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"  # before lower-casing
BROADCAST_GRAMS = 500_000
MIN_SHARE = 20  # contaminated: a hit in at least one of so many words


def words(text: Column) -> Column:
    """Normalised words; null and wordless texts give an empty array."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), f"{OTHER_CHARS}+")
    return F.filter(parts, lambda w: w != "")


def _grams(tokens: Column, size: Column, length: Column, step: Column) -> Column:
    """Runs of `length` words starting at 0, step, 2 * step, ...; empty if there is none."""
    last = size - length
    starts = F.when(last >= 0, F.sequence(F.lit(0), last, step))
    return F.coalesce(starts, F.array().cast("array<int>"))


def item_windows(items: DataFrame, n: int, item_id: str, text: str) -> DataFrame:
    """Windows of the test items: `item`, `length`, `words`. Items without words have none."""
    parts = items.select(F.col(item_id).alias("item"), words(F.col(text)).alias("w"))
    size = F.size("w")
    sized = parts.where(size > 0).withColumn("length", F.least(size, F.lit(n)))
    starts = _grams(F.col("w"), size, F.col("length"), F.lit(1))
    return sized.withColumn("start", F.explode(starts)).select(
        "item", "length", F.slice("w", F.col("start") + 1, F.col("length")).alias("words")
    )


def _fitting(df: DataFrame, limit: int) -> DataFrame:
    """`df`, hinted for broadcast if it was counted to have at most `limit` rows."""
    return F.broadcast(df) if df.count() <= limit else df


def contamination(
    docs: DataFrame,
    items: DataFrame,
    n: int = WINDOW,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    min_share: int = MIN_SHARE,
    broadcast_grams: int = BROADCAST_GRAMS,
) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hits.

    `hits` holds the positions (from 0) of the hit words. Null texts and texts without words
    have no hits; without test items nothing is hit; repeated rows get equal results; items
    with equal windows all count. Other columns of either table are ignored.
    """
    windows = stored(item_windows(items, n, item_id, item_text), "windows")
    lengths = [r[0] for r in windows.select("length").distinct().collect()]  # n values at most
    blocks = sorted({(length + 1) // 2 for length in lengths})
    grams = windows.withColumn("b", F.floor((F.col("length") + 1) / 2).cast("int"))
    inside = _grams(F.col("words"), F.col("length"), F.col("b"), F.lit(1))
    grams = (
        grams.withColumn("start", F.explode(inside))
        .select(F.xxhash64(F.slice("words", F.col("start") + 1, F.col("b"))).alias("gram"))
        .distinct()
    )

    text = F.col(f"`{doc_text}`")
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text.alias("text"))
    keyed = rows.withColumn("key", F.md5(F.coalesce("text", F.lit(""))))
    scanned = keyed.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "key", words(F.col("text")).alias("w")
    ).withColumn("n_words", F.size("w").cast("long"))

    def hashes(b: int) -> Column:
        starts = _grams(F.col("w"), F.size("w"), F.lit(b), F.lit(b))
        return F.transform(starts, lambda s: F.xxhash64(F.slice("w", s + 1, b)))

    none = F.array().cast("array<bigint>")
    found = F.concat(none, *[hashes(b) for b in blocks])
    known = _fitting(grams, broadcast_grams).withColumn("known", F.lit(True))
    counted = stored(
        scanned.select("row", "doc_id", "key", "n_words", F.explode_outer(found).alias("gram"))
        .join(known, "gram", "left")
        .groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("key").alias("key"),
            F.first("n_words").alias("n_words"),
            F.coalesce(F.max("known"), F.lit(False)).alias("candidate"),
        )
        .drop("row"),
        "counted",
    )

    suspects = counted.where("candidate").select("doc_id", "key").distinct()
    again = _join_null_safe(keyed, suspects).select("doc_id", "key", words(F.col("text")).alias("w"))
    again = again.dropDuplicates(["doc_id", "key"])

    def runs(length: int) -> Column:
        starts = _grams(F.col("w"), F.size("w"), F.lit(length), F.lit(1))
        return F.transform(
            starts,
            lambda s: F.struct(
                s.alias("start"),
                (s + length).alias("stop"),
                F.array_join(F.slice("w", s + 1, length), " ").alias("run"),
            ),
        )

    empty = F.array().cast("array<struct<start:int,stop:int,run:string>>")
    exploded = again.select(
        "doc_id", "key", F.inline(F.concat(empty, *[runs(length) for length in lengths]))
    )
    texts = windows.select("item", F.array_join("words", " ").alias("run")).distinct()
    hit = (
        exploded.join(_fitting(texts, broadcast_grams), "run")
        .groupBy("doc_id", "key")
        .agg(
            F.collect_set("item").alias("items"),
            F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"),
        )
    )
    positions = F.array_distinct(
        F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["stop"] - 1)))
    )
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    hit = hit.select("doc_id", "key", positions.alias("hits"), names.alias("names"))
    n_hit = F.size(F.coalesce("hits", F.array().cast("array<int>"))).cast("long")
    names = F.coalesce("names", F.array().cast("array<string>"))
    return (
        _join_null_safe(counted, hit, "left")
        .select(
            "doc_id",
            "n_words",
            n_hit.alias("n_hit"),
            F.size(names).cast("long").alias("n_items"),
            F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
            F.coalesce("hits", F.array().cast("array<int>")).alias("hits"),
            "key",
        )
        .withColumn(
            "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * min_share >= F.col("n_words"))
        )
    )


def _join_null_safe(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on (doc_id, key); a null doc_id equals a null doc_id."""
    right = right.withColumnsRenamed({"doc_id": "r_id", "key": "r_key"})
    same = F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("key") == F.col("r_key"))
    return left.join(right, same, how).drop("r_id", "r_key")


def clean(
    docs: DataFrame, items: DataFrame, remove: str = "documents", doc_id: str = "doc_id",
    doc_text: str = "text", **options,
) -> DataFrame:
    """`docs` without contamination, in its own columns.

    remove="documents" drops contaminated documents. remove="spans" keeps every document and
    cuts the hit words, each with the characters up to the next word, out of the text.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is 'documents' or 'spans', not {remove!r}")
    judged = contamination(docs, items, doc_id=doc_id, doc_text=doc_text, **options)
    flagged = (
        judged.where("contaminated" if remove == "documents" else "n_hit > 0")
        .select(F.col("doc_id").alias("r_id"), F.col("key").alias("r_key"), "hits")
        .dropDuplicates(["r_id", "r_key"])
    )
    text = F.col(f"_doc.`{doc_text}`")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    same = F.col(f"_doc.`{doc_id}`").eqNullSafe(F.col("r_id")) & (
        F.md5(F.coalesce(text, F.lit(""))) == F.col("r_key")
    )
    if remove == "documents":
        return rows.join(flagged, same, "left_anti").select("_doc.*")
    pieces = F.split(text, f"(?<={RAW_OTHER})(?={RAW_WORD})")
    lead = F.when(text.rlike(f"^{RAW_WORD}"), 0).otherwise(1)
    kept = F.filter(pieces, lambda p, i: ~F.array_contains("hits", i - lead))
    cut = F.when(F.col("hits").isNull(), text).otherwise(F.array_join(kept, ""))
    columns = [cut.alias(c) if c == doc_text else F.col(f"_doc.`{c}`") for c in docs.columns]
    return rows.join(flagged, same, "left").select(*columns)
