"""Phrase collocations by top-order marginalisation.

Only the longest windows are counted: every word with the three words that lead on from it in
its piece, padded at the end. A phrase's count is the sum over the windows that begin with it,
so a ROLLUP over (w1, w2, w3, w4) gives all shorter phrases, and no n-gram list is made apart.

Windows are numbers where they are shuffled. Words that occur often enough to be part of a
candidate get codes by falling count, and a window ends before any other word, which cannot
change a candidate's count. The code table is sent to all tasks, so it is bounded: it takes
CODES words of at most CODE_BYTES bytes; windows with a frequent word beyond it are counted as
text (`_rest`). Before the ROLLUP, prefixes that stay below the wanted count are folded into
their shorter prefix; for that, windows are dealt by their first two words, and by the third as
well where both are among the HOT most frequent words, so no key holds more than 1 in HOT rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

ORDER = 4  # words of the longest phrase
LEAST = 30  # occurrences of a candidate
CODES, CODE_BYTES = 2**20 - 1, 64
HOT, SALTS = 256, 64
TOP = 2_000  # phrases reported of each language
NO_LANG = "und"
TOKENS_AT_ONCE, ENTRIES_AT_ONCE = 1_000_000, 200_000
TOKEN = re.compile(rb"[^ \t.,;:!?\n\x0b\x0c\r]+|[.,;:!?\n\x0b\x0c\r]")
BREAKS = frozenset(bytes([b]) for b in b".,;:!?\n\x0b\x0c\r")


def _tokens(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """Language, and words and breaks, of each row (lang, text)."""
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        yield lang, TOKEN.findall((text.as_py() or "").encode("utf-8", "surrogatepass").lower())


def _rows(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(f"`{text}`").alias("text"))


def word_counts(rows: DataFrame) -> DataFrame:
    """(lang, word, f) of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, tokens in _tokens(batch):
                counts.setdefault(lang, Counter()).update(tokens)
                if sum(map(len, counts.values())) > ENTRIES_AT_ONCE:
                    yield flush(counts)
                    counts = {}
        yield flush(counts)

    def flush(counts: dict[str, Counter]) -> pa.RecordBatch:
        found = [(lang, w, n) for lang, own in counts.items() for w, n in own.items() if w not in BREAKS]
        langs, words, numbers = zip(*found) if found else ((), (), ())
        return pa.record_batch(
            [pa.array(langs, pa.string()), pa.array([w.decode("utf-8", "surrogatepass") for w in words], pa.string()), pa.array(numbers, pa.int64())],
            ["lang", "word", "f"],
        )

    found = rows.mapInArrow(run, "lang string, word string, f long")
    return found.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def _coded(rows: DataFrame, codes: dict[str, dict[bytes, int]]) -> DataFrame:
    """(head, tail, c): windows of coded words, two in a number, counted within a task's part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for lang, tokens in _tokens(batch):
                own = codes.get(lang)
                if own and tokens:
                    parts.append(np.array([*[own.get(t, 0) for t in tokens], 0], np.int64))
                    held += len(tokens)
                if held > TOKENS_AT_ONCE:
                    yield flush(parts)
                    parts, held = [], 0
        yield flush(parts)

    def flush(parts: list[np.ndarray]) -> pa.RecordBatch:
        codes = np.concatenate([*parts, np.zeros(ORDER, np.int64)])
        size = len(codes) - ORDER
        lead = [codes[k : k + size].copy() for k in range(ORDER)]
        for k in range(1, ORDER):
            lead[k][lead[k - 1] == 0] = 0
        start = lead[0] > 0
        head = (lead[0] << 32 | lead[1])[start]
        tail = (lead[2] << 32 | lead[3])[start]
        order = np.lexsort((tail, head))
        head, tail = head[order], tail[order]
        first = np.flatnonzero(np.concatenate(([True], (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])))[: len(head)])
        counts = np.diff(np.concatenate((first, [len(head)])))
        return pa.record_batch([pa.array(head[first]), pa.array(tail[first]), pa.array(counts.astype(np.int64))], ["head", "tail", "c"])

    return rows.mapInArrow(run, "head long, tail long, c long")


def _first(packed: str) -> Column:
    return F.shiftright(packed, 32)


def _second(packed: str) -> Column:
    return F.col(packed).bitwiseAND(F.lit(2**32 - 1))


def _coded_phrases(rows: DataFrame, table: DataFrame, codes: dict[str, dict[bytes, int]], least: int) -> DataFrame:
    """(lang, words, f) of all phrases of coded words with f of `least` or more."""
    hot = (_first("head") <= HOT) & (_second("head") <= HOT)
    salt = F.when(hot, F.pmod(F.xxhash64(_first("tail")), F.lit(SALTS))).otherwise(0).cast("int")
    windows = _coded(rows, codes).withColumn("salt", salt).repartition("head", "salt")
    counted = windows.groupBy("head", "salt", "tail").agg(F.sum("c").alias("c"))
    counted = counted.withColumns({"w1": _first("head"), "w2": _second("head"), "w3": _first("tail"), "w4": _second("tail")})
    three = F.sum("c").over(Window.partitionBy("head", "salt", "w3"))
    two = F.sum("c").over(Window.partitionBy("head", "salt"))
    counted = counted.withColumn("f3", three).withColumn("f2", two)
    # a phrase below `least` is folded into its prefix; a salted pair's sum is not known yet
    long = (F.col("f2") >= least) | ((F.col("w1") <= HOT) & (F.col("w2") <= HOT))
    folded = counted.select(
        "w1",
        F.when(long, F.col("w2")).otherwise(0).alias("w2"),
        F.when(long & (F.col("f3") >= least), F.col("w3")).otherwise(0).alias("w3"),
        F.when(long & (F.col("c") >= least), F.col("w4")).otherwise(0).alias("w4"),
        "c",
    )
    folded = folded.groupBy("w1", "w2", "w3", "w4").agg(F.sum("c").alias("c"))
    names = [f"w{k}" for k in range(1, ORDER + 1)]
    sums = folded.rollup(*names).agg(F.sum("c").alias("f"), F.grouping_id().alias("left"))
    # `left` is 2^k - 1 for the sums that leave out the last k words; padding ends a phrase
    last = [(F.col("left") == 2 ** (ORDER - k) - 1) & (F.col(names[k - 1]) > 0) for k in range(1, ORDER + 1)]
    whole = last[0] | last[1] | last[2] | last[3]
    found = stored(sums.where(whole & (F.col("f") >= least)).drop("left"), "coded-phrases")
    for k, name in enumerate(names, 1):
        named = table.select(F.col("code").alias(name), F.col("word").alias(f"t{k}"), *(["lang"] if k == 1 else []))
        found = found.join(named, name, "inner" if k == 1 else "left")
    words = F.array_compact(F.array(*[f"t{k}" for k in range(1, ORDER + 1)]))
    return found.select("lang", words.alias("words"), "f")


def _rest(rows: DataFrame, codes: dict[str, dict[bytes, int]], least: int) -> DataFrame:
    """(lang, words, f) of all phrases with a word that has no code, f of `least` or more."""
    names = [f"w{k}" for k in range(1, ORDER + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for lang, tokens in _tokens(batch):
                own = codes.get(lang, {})
                for i in (i for i, t in enumerate(tokens) if t not in own and t not in BREAKS):
                    # the windows in which this is the first word without a code
                    for start in range(i, max(-1, i - ORDER), -1):
                        if start < i and tokens[start] not in own:
                            break
                        window = tokens[start : start + ORDER]
                        stop = next((k for k, t in enumerate(window) if t in BREAKS), len(window))
                        counts[lang, i - start + 1, *window[:stop], *[None] * (ORDER - stop)] += 1
                if len(counts) > ENTRIES_AT_ONCE:
                    yield flush(counts)
                    counts = Counter()
        yield flush(counts)

    def flush(counts: Counter) -> pa.RecordBatch:
        langs, firsts, *words = zip(*counts) if counts else [()] * (2 + ORDER)
        columns = [pa.array([w if w is None else w.decode("utf-8", "surrogatepass") for w in ws], pa.string()) for ws in words]
        numbers = [pa.array(firsts, pa.int32()), pa.array(list(counts.values()), pa.int64())]
        return pa.record_batch([pa.array(langs, pa.string()), *columns, *numbers], ["lang", *names, "at", "c"])

    columns = ", ".join(f"{n} string" for n in names)
    windows = rows.mapInArrow(run, f"lang string, {columns}, at int, c long")
    counted = windows.groupBy("lang", *names).agg(F.sum("c").alias("c"), F.max("at").alias("at"))
    sums = counted.rollup("lang", *names).agg(F.sum("c").alias("f"), F.max("at").alias("at"), F.grouping_id().alias("left"))
    last = [
        (F.col("left") == 2 ** (ORDER - k) - 1) & F.col(names[k - 1]).isNotNull() & (F.col("at") <= k)
        for k in range(1, ORDER + 1)
    ]
    whole = last[0] | last[1] | last[2] | last[3]
    return sums.where(whole & (F.col("f") >= least)).select("lang", F.array_compact(F.array(*names)).alias("words"), "f")


def phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, codes: int = CODES
) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases (lang, words, f), and (lang, n) with the number of all words."""
    rows = _rows(docs, text, lang)
    counts = stored(word_counts(rows), "word-counts")
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = counts.where(F.col("f") >= least)
    listed = (
        frequent.where(F.octet_length("word") <= CODE_BYTES)
        .orderBy(F.desc("f"), "lang", "word")
        .limit(codes)
        .collect()  # at most `codes` words of CODE_BYTES bytes
    )
    table: dict[str, dict[bytes, int]] = {}
    for code, row in enumerate(listed, 1):
        table.setdefault(row["lang"], {})[row["word"].encode("utf-8", "surrogatepass")] = code
    spark = docs.sparkSession
    named = spark.createDataFrame(
        [(code, r["lang"], r["word"]) for code, r in enumerate(listed, 1)], "code long, lang string, word string"
    )
    found = _coded_phrases(rows, stored(named, "word-codes"), table, least)
    if frequent.count() > len(listed):
        found = found.unionByName(_rest(rows, table, least))
    return stored(found, "phrases"), totals


def _exact(count: str) -> Column:
    return F.col(count).cast("decimal(20,0)")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    top: int = TOP,
    codes: int = CODES,
) -> DataFrame:
    """The `top` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Candidates are phrases of 2 to 4 words that occur `least` times or more. A cut after k words
    gives l and r, the counts of the parts, and the score floor(2000000 * a / (l + r)); the cut
    of the lowest score counts. A candidate is dropped if a longer candidate that contains it
    has at least 80 % of its count. Null texts are empty, a null language is `und`; repeated
    rows count each time, other columns are ignored, an empty table gives no rows.
    """
    known, totals = phrases(docs, text, lang, least, codes)
    known = known.withColumns({"m": F.size("words"), "phrase": F.array_join("words", " ")})
    some = known.where("m > 1")

    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("m") - 1),
            lambda size: F.transform(
                F.sequence(F.lit(1), F.col("m") - size + 1), lambda at: F.array_join(F.slice("words", at, size), " ")
            ),
        )
    )
    within = some.where("m > 2").select("lang", F.explode(inner).alias("phrase"), F.col("f").alias("longer"))
    within = within.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    covered = F.coalesce(_exact("longer") * 100 >= _exact("f") * 80, F.lit(False))
    kept = some.join(within, ["lang", "phrase"], "left").where(~covered)

    cuts = kept.select("lang", "phrase", "words", "m", "f", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "f", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("m") - F.col("k")), " ").alias("rest"),
    )
    for part, name in (("first", "l"), ("rest", "r")):
        counts = known.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
        cuts = cuts.join(counts, ["lang", part])
    cuts = cuts.withColumn("twice", _exact("f") * 2_000_000).withColumn("parts", _exact("l") + _exact("r"))
    cuts = cuts.withColumn("score", F.expr("twice div parts"))
    worst = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", F.col("f").alias("a")).agg(worst)
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
