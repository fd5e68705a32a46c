import hashlib
import re

import pytest
from pyspark.sql import functions as F

from llm_data import make_docs, some_docs  # noqa: F401

from deskweave.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def plain(docs, items, n=13):
    runs = []
    for i, t in items:
        w = words(t)
        k = min(n, len(w))
        runs += [(i, w[s : s + k]) for s in range(len(w) - k + 1) if w]
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for i, run in runs:
            for s in range(len(w) - len(run) + 1):
                if w[s : s + len(run)] == run:
                    hit |= set(range(s, s + len(run)))
                    found.add(str(i))
        names = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), names, bool(hit) and 20 * len(hit) >= len(w)))
    return out


LONG = " ".join(f"w{i}" for i in range(40))
ITEMS = [(1, LONG), (2, "Short ITEM, of five words"), (10, "one"), (11, ""), (12, None), (3, LONG), (4, "éÀ x")]
DOCS = [
    (1, " ".join(f"w{i}" for i in range(5, 30))),
    (2, "filler " * 300 + " ".join(f"W{i}" for i in range(13)) + " tail"),
    (3, " ".join(f"w{i}" for i in range(12))),
    (4, "a short item of five words and ONE, one more"),
    (5, None), (6, ""), (7, "..."), (8, "nothing here at all"), (8, "nothing here at all"),
    (9, "prefix éÀ x suffix ÉÀ x"), (None, "one"), (None, "two"), (12, LONG + " " + LONG),
]


def rows_of(df):
    keep = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return sorted((tuple(r[c] for c in keep) for r in df.collect()), key=repr)


@pytest.fixture
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_against_brute_force(spark, make_docs, items):
    got = rows_of(decontaminate.contamination(make_docs(DOCS), items))
    assert got == sorted(plain(DOCS, ITEMS), key=repr)
    got = rows_of(decontaminate.contamination(make_docs(DOCS), items, broadcast_grams=0))
    assert got == sorted(plain(DOCS, ITEMS), key=repr)


def test_given_tables(spark, make_docs, some_docs, items):
    docs = [(i, t) for i, t, _ in some_docs[:60]] + [(900, LONG)]
    assert rows_of(decontaminate.contamination(make_docs(docs), items)) == sorted(plain(docs, ITEMS), key=repr)


def test_no_items_and_no_documents(spark, make_docs, items):
    none = items.where("false")
    assert rows_of(decontaminate.contamination(make_docs(DOCS), none)) == sorted(plain(DOCS, []), key=repr)
    assert decontaminate.contamination(make_docs([]), items).count() == 0


def test_removal(spark, make_docs, items):
    docs = make_docs(DOCS).withColumns({c: F.lit(1) for c in ("hits", "key", "_doc", "w")})
    bad = {r[0] for r in plain(DOCS, ITEMS) if r[5]}
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == sorted(
        i for i, _ in DOCS if i is not None and i not in bad
    )
    cut = {r["doc_id"]: r["text"] for r in decontaminate.clean(docs, items, "spans").collect()}
    assert cut[8] == "nothing here at all" and cut[5] is None and cut[7] == "..."
    assert cut[4] == "a and more"
    assert cut[2] == "filler " * 300 + "tail"
    with pytest.raises(ValueError):
        decontaminate.clean(docs, items, "lines")
