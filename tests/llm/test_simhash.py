import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_data import make_docs, some_docs  # noqa: F401

from deskweave.llm import simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles)) if shingles else 0


def groups(keys, linked):
    """Smallest key reachable from each key."""
    root = {k: k for k in keys}
    changed = True
    while changed:
        changed = False
        for a in keys:
            for b in keys:
                if linked(a, b) and root[a] > root[b]:
                    root[a], changed = root[b], True
    return root


@given(st.text("ab \t\n\u00a0É\x1f", max_size=60))
@settings(deadline=None)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_of_hash_is_that_of_spark(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(F.xxhash64(F.lit("one two three four")).alias("h")).first()
    assert simhash.fingerprint("One two\tthree four") == row["h"] % 2**64


def test_links_connect_what_brute_force_connects():
    rng = np.random.default_rng(5)
    seen = set()
    for centre in rng.integers(0, 2**64, 12, dtype=np.uint64):
        for _ in range(12):
            flips = rng.choice(64, rng.integers(0, 6), replace=False)
            seen.add(int(centre) ^ sum(1 << int(b) for b in flips))
    keys = sorted(seen)
    want = groups(keys, lambda a, b: (a ^ b).bit_count() <= 4)
    bits = 8
    masks = [int(m) for m in simhash._flips(bits, 2)]
    for part in (simhash.PART, 3000):
        kept, simhash.PART = simhash.PART, part
        dealt = {}
        for k in keys:
            for m in masks:
                dealt.setdefault((k >> (64 - bits)) ^ m, []).append(k)
        pairs = [
            tuple(map(int, p))
            for prefix, own in dealt.items()
            for p in simhash.link_prefix(prefix, np.array(own, np.uint64), bits)
        ]
        simhash.PART = kept
        linked = set(pairs) | {(b, a) for a, b in pairs}
        assert groups(keys, lambda a, b: (a, b) in linked) == want


def test_query_against_brute_force(spark, make_docs, some_docs):
    docs = [(i, t) for i, t, _ in some_docs]
    docs += [(None, "alone without id"), (7, docs[3][1]), (5000, ""), (5001, None), (5001, None)]
    got = {}
    for r in simhash.near_duplicates(make_docs(docs)).collect():
        got.setdefault((r["doc_id"], r["fp"] % 2**64), set()).add(r["component_id"])
    fps = sorted({plain_fingerprint(t) for _, t in docs})
    near = {a: [b for b in fps if (a ^ b).bit_count() <= 4] for a in fps}
    root = {a: a for a in fps}
    for _ in fps:
        for a in fps:
            root[a] = min(root[b] for b in near[a])
    first = {}
    for i, t in docs:
        if i is not None:
            r = root[plain_fingerprint(t)]
            first[r] = min(i, first.get(r, i))
    want = {(i, plain_fingerprint(t)): {first.get(root[plain_fingerprint(t)])} for i, t in docs}
    assert got == want


def test_deduplicate_keeps_one_of_each_group(spark, make_docs):
    long = " ".join(f"word{i}" for i in range(300))
    rows = [(3, long), (1, long + " more"), (2, "other text entirely here"), (2, "other text entirely here")]
    rows += [(None, "no id at all in here"), (9, None), (8, "")]
    kept = simhash.deduplicate(make_docs(rows)).collect()
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept)
    assert ids == [(False, 1), (False, 2), (False, 8), (True, 0)]


def test_clashing_columns_and_empty_table(spark, make_docs):
    from pyspark.sql import functions as F

    docs = make_docs([(1, "a b c d e"), (2, "a b c d e")])
    more = docs.withColumns({c: F.lit("x") for c in ("fp", "key", "root", "component_id", "_doc", "_id")})
    kept = simhash.deduplicate(more)
    assert kept.columns == more.columns and kept.count() == 1
    assert simhash.near_duplicates(docs.where("false")).count() == 0
    assert simhash.deduplicate(docs.where("false")).count() == 0


def test_pairs_apart_are_all_pairs_within_the_radius(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = set()
    for centre in rng.integers(0, 2**64, 6, dtype=np.uint64):
        for _ in range(9):
            flips = rng.choice(64, rng.integers(0, 6), replace=False)
            fp = int(centre) ^ sum(1 << int(b) for b in flips)
            rows |= {(fp, int(g)) for g in rng.integers(0, 4, 2)}
    signed = [(fp - 2**64 if fp >= 2**63 else fp, g) for fp, g in rows]
    want = {
        (*a, *b)
        for a in signed
        for b in signed
        if a[1] < b[1] and ((a[0] ^ b[0]) % 2**64).bit_count() <= 4
    }
    got = simhash.pairs_apart(spark.createDataFrame(signed, "fp long, group long"), 8).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    own = np.array([fp for fp, _ in rows], np.uint64)
    groups = np.array([g for _, g in rows])
    whole = simhash.pairs_prefix(int(own[0] >> np.uint64(56)), own[:1].repeat(4), np.arange(4), 8)
    assert sorted((min(p), max(p)) for a, b in whole for p in zip(a, b)) == [(i, j) for i in range(4) for j in range(i + 1, 4)]


def test_texts_linked_by_operator_1_are_verified_in_all_pairs(spark, make_docs, monkeypatch):
    """Whatever connects groups, texts that operator 1 links and that lie apart are verified."""
    from deskweave.llm import near_text

    base = " ".join(f"word{i}" for i in range(900))
    docs = make_docs([(1, base), (2, "entirely other words"), (3, base + " more")])
    none = spark.createDataFrame([], "a long, b long, alike double")
    monkeypatch.setattr(near_text, "_offers", lambda nodes, similarity: near_text.stored(none, "offers"))
    monkeypatch.setattr(simhash, "links", lambda fps: spark.createDataFrame([], "a long, b long"))
    kept = sorted(r["doc_id"] for r in simhash.deduplicate(docs).collect())
    distance = (simhash.fingerprint(base) ^ simhash.fingerprint(base + " more")).bit_count()
    assert distance <= 4 and kept == [1, 2]
