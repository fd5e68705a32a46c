import hashlib
from collections import Counter

from pyspark.sql import functions as F

from deskweave.llm import token_counts
from deskweave.sources.space import fresh_dir

SCHEMA = "doc_id long, source string, lang string, text string, deleted boolean"


def rollup(spark, counters=None):
    return token_counts.Rollup(spark, fresh_dir(spark, "rollup"), counters or {"words": token_counts.count_words})


def md5(text):
    return "" if text is None else hashlib.md5(text.encode()).hexdigest()


def totals(r):
    return {(x["source"], x["lang"]): (x["docs"], x["tokens"]) for x in r.totals().collect()}


def recount(state):
    out = {}
    for source, lang, text in state.values():
        docs, tokens = out.get((source, lang), (0, 0))
        out[source, lang] = (docs + 1, tokens + len((text or "").split()))
    return out


def test_deltas_equal_a_recount(spark):
    r = rollup(spark)
    batches = [
        [(1, "a", "en", "one two", False), (2, "a", "en", "three", None), (3, None, "de", None, False)],
        [(1, "b", "en", "now four words here", False), (2, "a", "en", "x", True), (9, "a", "en", "y", True)],
        [(2, "a", "fr", "back again", False), (4, "a", "en", "", False), (None, "a", "en", "null id", False)],
        [],
        [(None, "a", "en", "p q", False)] * 3 + [(None, None, "en", "p q", False), (None, "a", "en", None, False)],
        [(None, "a", "en", "p q", True), (None, "a", "en", None, True), (None, "a", "en", None, True)],
        [(None, "a", "en", None, False), (None, "a", "en", "never seen", True), (None, None, "en", "p q", None)],
        [(None, "a", "en", "", True), (4, "a", "en", "a", False), (4, "a", "en", "b c", False), (4, "a", "en", "b c", False)],
    ]
    state = {}
    for number, rows in enumerate(batches, 1):
        changes = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("z") for c in ("tokens", "batch", "_n", "docs")})
        assert r.commit(number, changes)
        for i, s, lang, t, gone in sorted((x for x in rows if x[0] is not None), key=lambda x: (bool(x[4]), md5(x[3]))):
            state[i] = (s, lang, t)
            if gone:
                state.pop(i)
        apart = Counter()  # rows without id are documents of their own
        for i, s, lang, t, gone in rows:
            apart[s, lang, t] += (i is None) * (-1 if gone else 1)
        for (s, lang, t), more in apart.items():
            known = [k for k in state if isinstance(k, tuple) and k[0] == (s, lang, t)]
            for k in range(max(0, len(known) + more), len(known)):
                state.pop(((s, lang, t), k))
            for k in range(len(known), len(known) + more):
                state[(s, lang, t), k] = (s, lang, t)
        assert totals(r) == recount(state)
        assert not r.commit(number, changes)
        assert totals(r) == recount(state)


def test_interrupted_batch_is_overwritten(spark):
    r = rollup(spark)
    rows = spark.createDataFrame([(1, "a", "en", "one two", False)], SCHEMA)
    left = spark.createDataFrame([(1, None, "words", "a", "en", 99, 1, None, None, None, None, 1)], token_counts.LEDGER)
    left.write.parquet(r._folder("ledger", 1))
    assert not r.committed(1) and r.ledger().count() == 0
    r.commit(1, rows)
    assert totals(r) == {("a", "en"): (1, 2)}


def test_bpe_counts_and_new_versions(spark):
    import tiktoken
    from public_tokenizers import PATTERN
    import base64

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(token_counts.BPE_PATH, "rb"))}
    encode = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    texts = ["Hello, world! é", "", None, "a" * 2000, "<|endoftext|>"]
    rows = spark.createDataFrame([(i, "s", "en", t, False) for i, t in enumerate(texts)], SCHEMA)
    r = rollup(spark)
    r.commit(1, rows)
    both = token_counts.Rollup(spark, r.path, {token_counts.BPE_NAME: token_counts.count_bpe()})
    both.commit(2, rows)
    got = {x["tokenizer"]: (x["docs"], x["tokens"]) for x in both.totals().collect()}
    assert got == {"words": (5, 5), token_counts.BPE_NAME: (5, sum(len(encode(t or "")) for t in texts))}


def test_no_batch(spark):
    assert rollup(spark).totals().count() == 0
