"""The registered queries and the pipeline."""

import math

import duckdb
import pytest
from llm_data import SMALL, TABLES
from test_near_text import plain_groups

import corpus_pipeline
from deskweave.llm import checks, decontaminate, pii_crf, queries, token_counts


def plain(value):
    return round(value, 6) if isinstance(value, float) and not math.isnan(value) else value


@pytest.mark.parametrize("name", sorted(checks.all_checks()))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    df = queries.all_queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    found = con.execute(checks.all_checks()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr) == want


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.all_queries())
    assert numbers == list(range(1, 14))


def test_entry_registers_all():
    import __spark_entry__

    assert set(queries.all_queries()) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(checks.all_checks()) <= set(__spark_entry__.oracle_sql())


def test_op3_is_a_recount_of_the_final_documents(spark):
    import base64
    import re

    import tiktoken
    from public_tokenizers import PATTERN

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(token_counts.BPE_PATH, "rb"))}
    encode = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    want, seen = {}, set()
    for d in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        source, text, label = d["source"], d["text"] or "", labels.get(d["doc_id"])
        if label and label["quality"] == 0:
            seen.add("deleted")
            continue
        if label and label["toxic"] == 1:
            seen.add("moved")
            source = None if source is None else source + " toxic"
            text = re.sub("[^ \t-\r]*[0-9][^ \t-\r]*", "", text)
        for name, size in (("words", len(text.encode().split())), (token_counts.BPE_NAME, len(encode(text)))):
            n, t = want.get((source, d["lang"], name), (0, 0))
            want[source, d["lang"], name] = (n + 1, t + size)
    rows = queries.op3_token_counts(spark, SMALL).collect()
    assert {(r["source"], r["lang"], r["tokenizer"]): (r["docs"], r["tokens"]) for r in rows} == want
    assert seen == {"deleted", "moved"}


def test_pipeline_stages(spark):
    """Every stage against what its operator says of the stage's own input."""
    from deskweave.llm.common import stored, table

    docs = table(spark, SMALL, "documents")
    schema, steps = docs.schema, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SMALL), "stage")
        steps[name] = (before, docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.schema.names == schema.names
    ids = {n: [{r["doc_id"]: r["text"] for r in d.collect()} for d in pair] for n, pair in steps.items()}

    before, after = ids["near-duplicates"]
    places = sorted(before)
    root = plain_groups([before[i] for i in places])
    assert set(after) == {places[r] for r in root}
    judged = decontaminate.contamination(steps["benchmark decontamination"][0], table(spark, SMALL, "benchmark"))
    assert set(ids["benchmark decontamination"][1]) == {r["doc_id"] for r in judged.collect() if not r["contaminated"]}
    before, after = ids["personal data"]
    assert set(before) == set(after) and not any(pii_crf.base_spans(t) for t in after.values())
    assert set(ids["mixing sources to target weights"][1]) <= set(after)
    bad = {r["doc_id"] for r in table(spark, SMALL, "labels").where("quality = 0").collect()}
    assert not bad & set(ids["quality classifier"][1])


def test_run_returns_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SMALL)
    assert rows.count() > 0 and "text" in rows.columns
