"""Registered queries against their SQL, and the pipeline against its stages done plainly."""

import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from cloakwork import llm
from cloakwork.llm import rules

from .test_brute import brute_classes, brute_hits

llm.load_all()


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_query_matches_sql(spark, sf, duck, name):
    df = llm.QUERIES[name](spark, sf)
    cur = duck.execute(llm.ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    want = Counter(tuple(r[columns.index(c)] for c in order) for r in cur.fetchall())
    assert Counter(tuple(r[c] for c in order) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(llm.QUERIES) - set(llm.ORACLES)))
def test_query_returns_every_row(spark, sf, name):
    assert llm.QUERIES[name](spark, sf).count() == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    state = docs
    for name, stage in corpus_pipeline.STAGES:
        before, state = state.collect(), corpus_pipeline.materialize(stage(spark, state, sf))
        after = state.collect()
        if name != "shard":
            assert state.columns == docs.columns
        if name == "quality":
            kept = {r["doc_id"] for r in rules.judged(docs).filter("kept").collect()}
            assert Counter(map(tuple, after)) == Counter(tuple(r) for r in before if r["doc_id"] in kept)
        elif name == "near":
            classes = brute_classes([r["text"] for r in before]).values()
            assert sorted(r["doc_id"] for r in after) == sorted(min(before[i]["doc_id"] for i in c) for c in classes)
        elif name == "decontaminate":
            clean = []
            for r in before:
                n, hit, _ = brute_hits(r["text"], items)
                if not (hit and 20 * len(hit) >= n):
                    clean.append(tuple(r))
            assert Counter(map(tuple, after)) == Counter(clean)
        elif name == "mix":
            size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
            words, had = defaultdict(int), defaultdict(int)
            for r in after:
                words[r["source"]] += size(r)
            for r in before:
                had[r["source"]] += size(r)
            sources = sorted(had)
            weight = {s: 1 + i % 3 for i, s in enumerate(sources)}
            level = sum(had.values()) / sum(weight.values())
            if all(3 * had[s] >= level * weight[s] for s in sources):
                most = max(map(size, before))
                assert all(abs(words[s] - level * weight[s]) <= most for s in sources)
            assert max(Counter(r["doc_id"] for r in after).values()) <= 3
        else:
            assert Counter(r["doc_id"] for r in after) == Counter(r["doc_id"] for r in before)
            slots = defaultdict(list)
            for r in after:
                slots[r["shard"]].append(r["slot"])
            assert all(sorted(s) == list(range(len(s))) for s in slots.values())
