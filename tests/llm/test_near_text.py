import numpy as np

from pyspark.sql import functions as F

from llm_data import make_docs, some_docs  # noqa: F401

from deskweave.llm import near_text, simhash


def plain_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_groups(texts):
    """Smallest place of a text reachable over pairs of Jaccard 0.8 or more."""
    sets = [plain_set(t) for t in texts]
    near = [
        [j for j, b in enumerate(sets) if 10 * len(a & b) >= 8 * len(a | b)] for a in sets
    ]
    root = list(range(len(texts)))
    while True:
        new = [min(root[j] for j in js) for js in near]
        if new == root:
            return root
        root = new


def edited(rng, words, changes):
    words = list(words)
    for at in rng.choice(len(words), changes, replace=False):
        words[at] = f"new{rng.integers(10**6)}"
    return " ".join(words)


def varied(rng):
    """Texts whose similarities to their original lie on both sides of 0.8."""
    texts = []
    for k in range(12):
        words = [f"w{rng.integers(10**6)}" for _ in range(60 + 25 * k)]
        texts += [" ".join(words)] + [edited(rng, words, c) for c in range(1, 2 + len(words) // 25)]
        texts.append(" ".join(words[: len(words) - len(words) // 6]))
    return texts


def test_sets_are_those_of_the_words():
    texts = ["", None, "One", "one  two\tTHREE four", "a b c d e", "a b c d e a b c d e a", "É a b c d x e"]
    assert [len(near_text.shingle_set(t, 5)) for t in texts] == [len(plain_set(t)) for t in texts]


def test_a_band_finds_what_reaches_the_similarity():
    rng = np.random.default_rng(1)
    equal = []
    for _ in range(400):
        hashes = rng.integers(0, 2**64, 110, np.uint64)
        a, b = hashes[:100], np.concatenate([hashes[10:100], hashes[100:]])
        first, second = near_text.minima(a), near_text.minima(b)
        equal.append((near_text.band_values(first) == near_text.band_values(second)).mean())
    # similarity 90 / 110
    assert min(equal) > 0 and abs(np.mean(equal) - (9 / 11) ** near_text.ROWS) < 0.02


def test_deduplicate_against_brute_force_jaccard(spark, make_docs, some_docs):
    texts = [t for _, t, _ in some_docs] + varied(np.random.default_rng(3)) + ["", None, "one", "One "]
    root = plain_groups(texts)
    assert len(set(root)) < len(texts) - 40
    kept = simhash.deduplicate(make_docs(list(enumerate(texts))))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(root))


def test_links_that_the_smallest_member_does_not_have(spark, make_docs):
    """A bucket's members are near each other, though not all near its smallest one."""
    rng = np.random.default_rng(8)
    texts = []
    for _ in range(10):
        words = [f"w{rng.integers(10**6)}" for _ in range(200)]
        far = edited(rng, words, 9).split()
        texts += [" ".join(words), " ".join(far), *[edited(rng, far, 1) for _ in range(3)]]
    root = plain_groups(texts)
    kept = simhash.deduplicate(make_docs(list(enumerate(texts))))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(root))


def test_one_id_on_two_unrelated_texts(spark, make_docs):
    """Both hold id 1 as their group's smallest, yet each group keeps a text."""
    rng = np.random.default_rng(4)
    first, second = (" ".join(f"w{rng.integers(10**6)}" for _ in range(80)) for _ in range(2))
    rows = [(1, first), (1, second), (2, first + " more"), (3, second + " more")]
    kept = simhash.deduplicate(make_docs(rows)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted(rows[:2])


def test_a_signature_shows_the_similarity():
    rng = np.random.default_rng(2)
    found = []
    for _ in range(300):
        hashes = rng.integers(0, 2**64, 110, np.uint64)
        marks = [np.frombuffer(near_text.signature(near_text.minima(x)), np.uint64) for x in (hashes[:100], hashes[10:])]
        found.append(near_text.likeness(marks[0][None], marks[1][None])[0])
    assert abs(np.mean(found) - 9 / 11) < 0.01 and np.std(found) < 0.045


def test_a_large_group_on_both_sides_of_the_similarity(spark, make_docs):
    """Copies of one text with 1 to 5 changed words: few pairs reach 0.8, many come close."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(150)]
    texts = [" ".join(base)] + [edited(rng, base, int(rng.integers(1, 6))) for _ in range(600)]
    root = plain_groups(texts)
    kept = {r["doc_id"] for r in simhash.deduplicate(make_docs(list(enumerate(texts)))).collect()}
    redundant = len(texts) - len(set(root))
    assert redundant > 200 and kept >= set(root)
    assert len(texts) - len(kept) >= 0.98 * redundant


def test_two_tight_groups_with_a_loose_link(spark, make_docs):
    """The best offers stay inside each group; the link between them is found afterwards."""
    rng = np.random.default_rng(6)
    first = [f"w{rng.integers(10**6)}" for _ in range(400)]
    second = edited(rng, first, 7).split()
    texts = [" ".join([*words, f"end{i}"]) for words in (first, second) for i in range(40)]
    assert len(set(plain_groups(texts))) == 1
    assert simhash.deduplicate(make_docs(list(enumerate(texts)))).count() == 1


def test_empty_null_and_wordless(spark, make_docs):
    assert simhash.deduplicate(make_docs([])).count() == 0
    rows = [(None, None), (None, ""), (3, " \t"), (None, "a b"), (5, "A  b"), (5, "A  b")]
    kept = simhash.deduplicate(make_docs(rows)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(3, " \t"), (5, "A  b")]


def test_operator_1_links_are_verified_and_kept(spark, make_docs, monkeypatch):
    rng = np.random.default_rng(7)
    words = [f"w{n}" for n in rng.integers(0, 5000, 3000)]
    near = [*words[:1500], "other", *words[1501:]]
    short = [*words[:9], *words[:9]]
    texts = [" ".join(t) for t in (words, near, short, [*short, *short], words[:1000])]
    bits = [simhash.fingerprint(t) for t in texts]
    assert (bits[0] ^ bits[1]).bit_count() <= simhash.RADIUS
    docs = make_docs([(n, t) for n, t in enumerate(texts)])
    pairs = simhash.linked_texts(docs.select(F.col("doc_id").alias("key"), "text"))
    assert (0, 1) in {tuple(sorted(r)) for r in pairs.collect()}

    nothing = spark.createDataFrame([], "a long, b long, alike double")
    monkeypatch.setattr(near_text, "_offers", lambda *_: near_text.stored(nothing, "offers"))
    kept = {r["doc_id"] for r in simhash.deduplicate(docs).collect()}
    assert 0 in kept and 1 not in kept and {2, 4} <= kept


def test_a_link_of_operator_1_below_the_similarity_does_not_count(spark, make_docs, monkeypatch):
    texts = ["a b c d e f g h i j", "k l m n o p q r s t"]
    monkeypatch.setattr(simhash, "fingerprint", lambda text, shingle=4: 1)
    rows = make_docs(list(enumerate(texts)))
    assert simhash.deduplicate(rows).count() == 2
