"""Names of several words against a plain scan."""

import random
import re

from deskweave.operators import masking, names

LISTED = [
    ("Maria Rossi", 0.9), ("Maria Rossi", 0.5), ("Maria", 0.6), ("O'Brien", 0.8), ("Jean-Luc Picard", 0.7),
    (" Anna de  la Cruz. ", 0.9), ("Rossi Bianchi", 0.8), ("Weak Name", 0.3), ("...", 0.9), (None, 0.9), ("Zoë", 0.4),
]


def plain(text, listed, threshold=0.4):
    """(value, start, end, score) of the leftmost, longest names."""
    known = {}
    for name, score in listed:
        words = re.search(r"(?s)\w(?:.*\w)?", name or "")
        if words and score >= threshold:
            value = re.sub(r"\s+", " ", words[0])
            known[value] = max(score, known.get(value, 0))
    out, reach = [], 0
    tokens = [m.span() for m in re.finditer(r"\w+", text)]
    for i, (start, _) in enumerate(tokens):
        for _, end in reversed(tokens[i:]):
            value = re.sub(r"\s+", " ", text[start:end])
            if start >= reach and value in known:
                out.append((value, start, end, known[value]))
                reach = end
    return out


def found(spark, rows, listed=LISTED):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = names.find_names(docs, spark.createDataFrame(listed, "name string, score double"))
    return {(r["doc_id"], r["value"], r["start"], r["end"], r["score"], r["copies"]) for r in got.collect()}


def test_names_of_several_words(spark):
    texts = [
        "Ciao Maria Rossi, and  Maria\n Rossi Bianchi; O'Brien met O Brien.", "Jean-Luc Picard, Jean Luc Picard",
        "«Anna de la\tCruz» Zoë Zoë😀Maria", "Weak Name maria MariaRossi", "", "...", None, "Maria",
    ]
    got = found(spark, list(enumerate(texts)))
    assert got == {(i, *hit, 1) for i, t in enumerate(texts) for hit in plain(t or "", LISTED)}
    assert (0, "O'Brien", 45, 52, 0.8, 1) in got and len([g for g in got if g[0] == 1]) == 1


def test_long_and_random_texts(spark):
    rng = random.Random(5)
    listed = [("a", 0.5), ("a b", 0.6), ("b a b a", 0.7), ("c-a", 0.5), ("b c c", 0.9)]
    sizes = [3, 63, 64, 65, 130, 4095, 4100]
    texts = ["".join(rng.choice("abcd") + rng.choice([" ", "  ", "-", ", "]) for _ in range(n)) for n in sizes]
    got = found(spark, list(enumerate(texts)), listed)
    want = set()
    for i, text in enumerate(texts):
        # only runs of up to four words can be listed
        reach = 0
        tokens = [m.span() for m in re.finditer(r"\w+", text)]
        for k, (start, _) in enumerate(tokens):
            for _, end in reversed(tokens[k : k + 4]):
                value = re.sub(r"\s+", " ", text[start:end])
                if start >= reach and value in dict(listed):
                    want.add((i, value, start, end, dict(listed)[value], 1))
                    reach = end
    assert got == want


def test_repeated_rows_null_keys_and_empty_tables(spark):
    rows = [(1, "Maria Rossi"), (1, "Maria Rossi"), (1, "Maria"), (None, "Maria"), (None, "Maria")]
    assert found(spark, rows) == {
        (1, "Maria Rossi", 0, 11, 0.9, 2), (1, "Maria", 0, 5, 0.6, 1), (None, "Maria", 0, 5, 0.6, 2),
    }
    assert found(spark, []) == set() and found(spark, rows, []) == set()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counted = masking.detect_names(docs, spark.createDataFrame(LISTED, "name string, score double")).collect()
    assert {(r["doc_id"], r["value"], r["hits"]) for r in counted} == {
        (1, "Maria Rossi", 2), (1, "Maria", 1), (None, "Maria", 2),
    }


def test_only_runs_behind_a_first_word_are_made(spark):
    """Work follows the words that begin some name, not all words times all sizes."""
    words = ["Anna", "de", "la", "Cruz", *["word"] * 59, "Anna"]
    pieces = spark.createDataFrame(
        [(1, 7, 10, len(words), [f"{w}, " for w in words] + ["de "])], "key int, row int, base int, own int, words array<string>"
    )
    heads = spark.createDataFrame([("Anna", [1, 2, 4]), ("Cruz", [3]), ("Zoe", [1])], "head string, sizes array<int>")
    runs = names._runs(pieces, heads, 4).drop("key", "row").collect()
    assert sorted(map(tuple, runs)) == [
        (10, 4, "Anna"), (10, 8, "Anna, de"), (10, 18, "Anna, de, la, Cruz"), (24, 16, "Cruz, word, word"),
        (10 + 6 + 4 + 4 + 6 + 59 * 6, 4, "Anna"), (10 + 6 + 4 + 4 + 6 + 59 * 6, 8, "Anna, de"),
    ]
