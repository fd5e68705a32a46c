import re
from collections import Counter

import numpy as np
import pytest

from llm_data import make_docs, some_docs  # noqa: F401

from deskweave.llm import collocations


def plain(docs, least, top):
    """(lang, rank, phrase, a, l, r, n, score) by plain counting."""
    counts, totals = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for m in range(1, 5):
                counts.update((lang, tuple(words[i : i + m])) for i in range(len(words) - m + 1))
    known = {k: f for k, f in counts.items() if f >= least}
    longer = Counter()
    for (lang, p), f in known.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                longer[lang, p[i : i + m]] = max(longer[lang, p[i : i + m]], f)
    scored = []
    for (lang, p), a in known.items():
        if len(p) > 1 and 100 * longer[lang, p] < 80 * a:
            cuts = [(known[lang, p[:k]], known[lang, p[k:]]) for k in range(1, len(p))]
            score, k = min((2_000_000 * a // (x + y), k) for k, (x, y) in enumerate(cuts))
            scored.append((lang, -score, -a, " ".join(p).encode(), *cuts[k]))
    out, rank = [], Counter()
    for lang, score, a, phrase, x, y in sorted(scored):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, x, y, totals[lang], -score))
    return out


def rows(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.fixture
def langs(spark):
    def make(docs):
        return spark.createDataFrame([(lang, text, 1) for lang, text in docs], "lang string, text string, f int")

    return make


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(3)
    words = ["of", "the", "New", "york", "é", "a", "b", "rare1", "rare2", "state-of", "x" * 90, "Ünder"]
    marks = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", " ! "]
    share = np.array([9, 9, 5, 5, 3, 3, 2, 0.3, 0.3, 1, 2, 1])
    docs = []
    for i in range(400):
        picked = rng.choice(len(words), int(rng.integers(0, 60)), p=share / share.sum())
        docs.append((["en", "de", None][i % 3], "".join(words[k] + marks[rng.integers(len(marks))] for k in picked)))
    return [*docs, *docs[:20], ("en", None), ("en", ""), (None, " . ,"), ("en", "of the new york " * 4000)]


@pytest.mark.parametrize("codes", [collocations.CODES, 6, 1])
def test_against_plain_counts(langs, sample, codes):
    """With all frequent words coded but the long one, with half of them, with one."""
    got = rows(collocations.collocations(langs(sample), least=5, top=40, codes=codes))
    assert got == sorted(plain(sample, 5, 40)) and len(got) > 60


def test_on_given_documents(make_docs, some_docs):
    docs = make_docs(some_docs)
    want = sorted(plain([("en", t) for _, t, _ in some_docs], 30, 2000))
    assert rows(collocations.collocations(docs)) == want and want


def test_small_parts_and_hot_pairs(langs, sample, monkeypatch):
    monkeypatch.setattr(collocations, "TOKENS_AT_ONCE", 50)
    monkeypatch.setattr(collocations, "ENTRIES_AT_ONCE", 20)
    monkeypatch.setattr(collocations, "HOT", 2)
    assert rows(collocations.collocations(langs(sample), least=5, top=40)) == sorted(plain(sample, 5, 40))


def test_empty(langs, spark):
    assert rows(collocations.collocations(langs([("en", None)]))) == []
    assert rows(collocations.collocations(spark.createDataFrame([], "lang string, text string"))) == []
