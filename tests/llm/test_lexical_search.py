"""Ranked lexical search against plain Python."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhouse.llm import lexical_search as ls
from tallyhouse.llm import queries
from tests.llm.edge import ROWS, documents

#: Fixed value: the pattern of a term as it is stated.
STATED = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def plain_terms(text):
    return re.findall(STATED, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(items, docs, k):
    """(item, rank, doc, score) in the order of the contract; documents without an id last among equals."""
    counted = [(i, Counter(plain_terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(c.total() for _, c in counted)
    out = []
    for item, text in items:
        found = []
        for i, c in counted:
            m = 100 - 50 + (50 * c.total() * n_docs) // n_terms
            score = 0
            for t in set(plain_terms(text)) & c.keys():
                df = sum(t in other for _, other in counted)
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return out


def ordered(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=lambda r: (r[0], r[1]))


def frame(spark, rows, item=False):
    df = spark.createDataFrame(rows, f"{'item_id' if item else 'doc_id'} long, text string")
    return df.withColumn("text_hash", F.lit("x")).withColumn("score", F.lit("y")).withColumn("rank", F.lit(1)).withColumn("item", F.lit("z"))


def corpus(n=300, seed=3):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(400)] + ["Über", "naïve", "日本"]
    rows = []
    for i in range(n):
        size = int(rng.integers(1, 60)) if i % 50 else 3000
        chosen = [words[int(x)] for x in np.minimum(rng.zipf(1.3, size) - 1, len(words) - 1)]
        rows.append((i, "  ".join(chosen).replace("w1 ", "W1, ")))
    return rows


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_terms_are_those_of_the_stated_pattern(text):
    text = text.encode("utf-8", "ignore").decode()
    assert [t.decode() for t in ls.terms_of(text)] == plain_terms(text)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(0, 500), st.one_of(st.integers(1, 5), st.integers(150, 10**9)), min_size=1, max_size=80))
def test_a_sketch_never_underestimates(frequencies):
    terms = Counter({f"t{k}".encode(): v for k, v in frequencies.items()})
    sketch = ls.sketch_of(terms)
    known = list(terms)
    codes = sketch[ls.coordinates(ls.hashes_of(known), len(sketch))].min(0)
    assert all(ls.STANDS_FOR[c] >= terms[t] for c, t in zip(codes, known))
    assert int(ls.STANDS_FOR[-1]) * 10**9 < 2**63 and ls.STANDS_FOR[-1] > 2**31


@pytest.mark.parametrize(("k", "per_term"), [(5, 24), (50, 24), (5, 1)])
def test_agrees_with_scoring_everything(spark, k, per_term):
    """Also with sketches so full that bounds are loose."""
    docs = corpus()
    items = [(1, "w1 w7 w30 Über"), (2, "w399"), (3, "w2 w2 w2 nothing"), (4, "never seen"), (5, ""), (6, None), (7, docs[50][1]), (8, "日本")]
    df = frame(spark, docs).repartition(6)
    found = ordered(ls.search(frame(spark, items, item=True), df, k=k, index=ls.build_index(df, per_term=per_term)))
    assert found == plain_search(items, docs, k)


def test_loose_bounds_are_bounds(spark):
    docs = frame(spark, corpus())
    asked = ls.Queries.of([(1, "w1 w7 w30"), (2, "w50 w51 w52 w53")])
    asked = asked.weighted(*ls.corpus_statistics(docs, asked, "text"))
    index = ls.build_index(docs, per_term=2)
    every = ls.bounds(index, asked, 1, np.zeros(2, np.int64), [0, 0])
    exact = ls.rescore(docs, every.select("item", "text_hash"), asked, False, "doc_id", "text")
    above = {(r["item"], r["doc_id"]): r["bound"] for r in every.collect()}
    scores = {(r["item"], r["doc_id"]): r["score"] for r in exact.collect()}
    assert scores and all(above[at] >= s for at, s in scores.items())
    assert {(i, d) for i, _, d, _ in plain_search([(0, "w1 w7 w30"), (1, "w50 w51 w52 w53")], corpus(), 1000)} == set(scores)


def test_copies_and_ties_go_by_id(spark):
    docs = [(i, "the same words here") for i in range(900)] + [(5000 + i, f"other words {i}") for i in range(300)] + [(None, "the same words here"), (3, "the same words here"), (7, "")]
    items = [(1, "same words"), (2, "other"), (2, "other")]
    found = ordered(ls.search(frame(spark, items, item=True), frame(spark, docs).repartition(7), k=20))
    assert [r for r in found if r[0] == 1] == plain_search(items[:1], docs, 20)
    assert [r for r in found if r[0] == 2] == sorted(plain_search(items[1:2], docs, 20) * 2, key=lambda r: r[1])


def test_blocks_of_items_change_nothing(spark):
    docs, items = corpus(80), [(i, f"w{i} w{i + 3}") for i in range(6)]
    df, asked = frame(spark, docs), frame(spark, items, item=True)
    index = ls.build_index(df)
    assert ordered(ls.search(asked, df, k=4, block_bytes=150, index=index)) == ordered(ls.search(asked, df, k=4)) == plain_search(items, docs, 4)


def test_edge_rows_and_empty_tables(spark):
    rows = [(r[0], r[1]) for r in ROWS]
    items = [(1, "line stands alpha1"), (2, "12345 é")]
    found = ordered(ls.search(frame(spark, items, item=True), documents(spark), k=50))
    assert found == plain_search(items, rows, 50)
    asked, docs = frame(spark, items, item=True), frame(spark, rows)
    for result in (ls.search(asked.limit(0), docs), ls.search(asked, docs.limit(0)), ls.search(asked, docs.where("doc_id = 4"))):
        assert result.columns == ["item_id", "rank", "doc_id", "score"] and result.count() == 0


def test_registered_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in queries.read_table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in queries.read_table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    assert ordered(queries.op11_lexical_search(spark, sf_dir)) == plain_search(items, docs, 50)
