"""Names of a dictionary in texts: leftmost, longest, with places.

A name is a run of words and what stands between them, such as `Anna de la Cruz`, `O'Brien` or
`Jean-Luc`; white space between words may differ, everything else has to be equal. Words are first joined
with the distinct first words of all names, each with the numbers of words that its names have;
only runs of such numbers that start there are put together and looked up, in a join on the whole
run. So a first word that very many names share makes no more rows than any other. Long texts are
first cut into pieces of some words, so that no row grows with its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.personal_data import THRESHOLDS
from ..functions.text import or_empty
from .once import with_columns_once

WORD = r"[\p{L}\p{N}]"
TOKEN = rf"{WORD}+[^\p{{L}}\p{{N}}]*"  # a word and what follows it
HEAD = f"{WORD}+"  # the first word
CORE = rf"(?s){WORD}(?:.*{WORD})?"  # from the first word to the end of the last
PIECES = (4096, 64)  # words of a piece, cut in two steps


def _one_blank(c: Column) -> Column:
    return F.regexp_replace(c, r"[ \t\n\x0B\f\r]+", " ")


def _cut(rows: DataFrame, size: int, more: int) -> DataFrame:
    """`rows` (base, own, words) cut into pieces of `size` own words, with `more` that follow."""

    def piece(k: Column) -> Column:
        first, own = k * size + 1, F.least(F.lit(size), F.col("own") - k * size)
        return F.struct(
            F.length(F.array_join(F.slice("words", first, own), "")).alias("chars"),
            own.alias("own"),
            F.slice("words", first, own + more).alias("words"),
        )

    last = F.expr(f"CAST((own - 1) DIV {size} AS INT)")
    cut = with_columns_once(rows, {"pieces": F.transform(F.sequence(F.lit(0), last), piece)})
    kept = [c for c in rows.columns if c not in ("base", "own", "words")]
    before = F.aggregate(F.slice(F.col("pieces.chars"), 1, F.col("at")), F.lit(0), lambda n, x: n + x)
    cut = cut.drop("own", "words").select("*", F.posexplode("pieces").alias("at", "piece"))
    return cut.select(*kept, (F.col("base") + before).alias("base"), "piece.own", "piece.words")


def _runs(pieces: DataFrame, heads: DataFrame, longest: int) -> DataFrame:
    """Runs of words that may be names: their first word is one of `heads` (head, sizes) and
    their number of words one of its sizes. key, row, start, chars, value."""
    own = F.transform(F.slice("words", F.lit(1), F.col("own")), lambda w: F.regexp_extract(w, HEAD, 0))
    placed = with_columns_once(pieces, {"heads": own})
    placed = placed.select("key", "row", "base", "words", F.posexplode("heads").alias("i", "head"))
    start = F.col("base") + F.length(F.array_join(F.slice("words", F.lit(1), F.col("i")), ""))
    ahead = F.slice("words", F.col("i") + 1, F.lit(longest))
    placed = placed.select("key", "row", "head", start.alias("start"), ahead.alias("words"))
    placed = placed.join(heads, "head").select("key", "row", "start", "words", F.explode("sizes").alias("n"))
    placed = placed.where(F.col("n") <= F.size("words"))
    run = F.regexp_extract(F.array_join(F.slice("words", F.lit(1), F.col("n")), ""), CORE, 0)
    runs = with_columns_once(placed, {"run": run})
    return runs.select("key", "row", "start", F.length("run").alias("chars"), _one_blank(F.col("run")).alias("value"))


def find_names(
    rows: DataFrame,
    names: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    threshold: float = THRESHOLDS["PERSON"],
) -> DataFrame:
    """Places of listed names (name, score): key, value, start, end, score, copies.

    Of names that overlap in a text the one that starts first counts, of those that start
    together the longest. `start` and `end` are code points of the text, end exclusive; `value`
    is the name with single blanks. Of a name listed more than once the best score counts;
    names below the threshold or without a word are left out. Rows with equal key and text
    are reported once, `copies` is their number; a null text has no names.
    """
    value = _one_blank(F.regexp_extract("name", CORE, 0)).alias("value")
    known = names.where(F.col("score") >= threshold).groupBy(value).agg(F.max("score").alias("score"))
    known = known.where("value <> ''")
    known = known.withColumn("n", F.regexp_count("value", F.lit(HEAD)))
    sizes = [r[0] for r in known.select("n").distinct().collect()]  # few numbers
    heads = known.groupBy(F.regexp_extract("value", HEAD, 0).alias("head"))
    heads = heads.agg(F.collect_set("n").alias("sizes"))

    whole = or_empty(F.col(text))
    words = rows.select(
        F.col(key).alias("key"), F.xxhash64(key, F.md5(whole)).alias("row"), F.length(whole).alias("chars"),
        F.regexp_extract_all(whole, F.lit(TOKEN), F.lit(0)).alias("words"),
    )
    words = with_columns_once(words, {"words": F.col("words")}).where(F.size("words") > 0)
    lead = F.col("chars") - F.length(F.array_join("words", ""))
    pieces = words.select("key", "row", lead.alias("base"), F.size("words").alias("own"), "words")
    for size in PIECES:
        pieces = _cut(pieces, size, max(sizes, default=1) - 1)

    runs = _runs(pieces, heads, max(sizes, default=1))

    # each copy of a row brings every length that was found at a place once
    best = F.max(F.struct("chars", "value", "score"))
    found = runs.join(known.drop("n"), "value").groupBy("key", "row", "start").agg(
        best.alias("best"), (F.count(F.lit(1)) / F.size(F.collect_set("chars"))).cast("long").alias("copies")
    )
    found = found.select(
        "key", "row", "start", (F.col("start") + F.col("best.chars")).alias("end"),
        "best.value", "best.score", "copies",
    )
    return _leftmost(found).select(F.col("key").alias(key), "value", "start", "end", "score", "copies")


def _leftmost(found: DataFrame) -> DataFrame:
    """Of hits that overlap, those that a scan from the left takes; only hits that hang
    together by overlaps are looked at together."""
    order = Window.partitionBy("key", "row").orderBy("start")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = found.withColumn("fresh", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int"))
    chained = apart.withColumn("chain", F.sum("fresh").over(order))
    hit = F.struct("start", "end", "value", "score", "copies")
    chains = chained.groupBy("key", "row", "chain").agg(F.sort_array(F.collect_list(hit)).alias("hits"))

    def take(kept: Column, new: Column) -> Column:
        free = new["start"] >= F.element_at(kept, -1)["end"]
        return F.when(free, F.concat(kept, F.array(new))).otherwise(kept)

    rest = F.slice("hits", F.lit(2), F.greatest(F.size("hits") - 1, F.lit(0)))
    kept = F.aggregate(rest, F.slice("hits", 1, 1), take)
    return chains.select("key", "row", F.inline(kept))
