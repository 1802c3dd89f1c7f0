"""Nearest neighbours, embedding dedup, WARC, the URL filter and the pipeline against plain Python."""

import base64
import gzip
import hashlib
import math
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyhouse.llm import ann, cover_tree, mixing, queries, url_filter, vectors, warc
from tallyhouse.session import written
from tests.conftest import plan_of
from tests.llm.edge import ROWS, documents
from tests.llm.test_text_operators import components, lower, plain_lines

SF = "/root/testdata/sf0.01"


def vector_frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("v", F.lit(1)).withColumn("rep", F.lit("x")).withColumn("score", F.lit(0))


def odd_vectors():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    rows = []
    for i in range(400):
        v = centres[i % 12] + rng.normal(size=16) * (0.01 if i % 3 else 0.4)
        rows.append((i, v.astype(np.float32).tolist(), 0))
    rows += [(1000 + i, rows[5][1], 0) for i in range(40)]  # copies
    rows += [(2000 + i, [2 * x for x in rows[7][1]], 0) for i in range(3)]
    rows += [rows[9], rows[9]]  # repeated rows
    nan, inf = float("nan"), float("inf")
    rows += [(3000, None, 0), (3001, [], 0), (3002, [0.0] * 16, 0), (3003, [nan] + [1.0] * 15, 0), (3004, [inf] + [1.0] * 15, 0), (3005, [None] + [1.0] * 15, 0), (None, rows[5][1], 0)]
    return rows


def good(rows):
    out = {}
    for i, v, _ in rows:
        if i is not None and v and len(v) == 16 and None not in v and all(map(math.isfinite, v)) and any(v):
            out[i] = np.array(v, np.float64)
    return out


# -- nearest neighbours


def test_hilbert_keys_walk_from_neighbour_to_neighbour():
    for k, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * k, indexing="ij"), -1).reshape(-1, k)
        keys = ann.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def check_nearest(found, vectors, asked, k=5):
    ids = np.array(sorted(vectors))
    matrix = np.stack([vectors[i] for i in ids])
    norms = np.linalg.norm(matrix, axis=1)
    hit = total = 0
    for q in asked:
        exact = matrix @ vectors[q] / (norms * np.linalg.norm(vectors[q]))
        order = [j for j in np.lexsort((ids, -exact.round(12))) if ids[j] != q][:k]
        got = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert [r for r, _, _ in got] == list(range(1, len(order) + 1))
        assert all(v != q and s == pytest.approx(exact[np.searchsorted(ids, v)], abs=1e-12) for _, v, s in got)
        assert [(-s, v) for _, v, s in got] == sorted((-s, v) for _, v, s in got)
        hit += len({ids[j] for j in order} & {v for _, v, _ in got})
        total += len(order)
    return hit / total


def test_nearest_recall(spark):
    vectors = {r["vec_id"]: np.array(r["embedding"], np.float64) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()}
    found = queries.op1_ann_hilbert(spark, "/root/testdata/sf0.1").collect()
    assert check_nearest(found, vectors, [i for i in vectors if i % 50 == 0]) >= 0.9


def test_nearest_edges(spark):
    rows = odd_vectors()
    found = ann.nearest(vector_frame(spark, rows), "vec_id % 5 = 0").collect()
    asked = [i for i in good(rows) if i % 5 == 0]
    assert {r["query_id"] for r in found} == set(asked)
    assert check_nearest(found, good(rows), asked) >= 0.9
    assert [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == 1000] == [5, 1001, 1002, 1003, 1004]
    assert ann.nearest(vector_frame(spark, []), "vec_id % 5 = 0").count() == 0
    few = ann.nearest(vector_frame(spark, rows[:3]), "vec_id = 0").collect()
    assert sorted(r["vec_id"] for r in few) == [1, 2]


# -- embedding near-dedup


@pytest.mark.parametrize("chunk", [2_048, 50])
def test_cover_tree_finds_exactly_the_links(spark, monkeypatch, chunk):
    monkeypatch.setattr(cover_tree, "CHUNK", chunk)
    monkeypatch.setattr(cover_tree, "PER_CENTRE", 150 if chunk == 50 else 4_096)
    monkeypatch.setattr(cover_tree, "LEAF", 3)
    rows = odd_vectors()
    vectors = good(rows)
    ids = sorted(vectors)
    matrix = np.stack([vectors[i] / np.linalg.norm(vectors[i]) for i in ids])
    near = matrix @ matrix.T >= 0.9
    links = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(near, 1)))]
    of = components(ids, links)
    got = {r["vec_id"]: tuple(r)[1:] for r in cover_tree.near_duplicates(vector_frame(spark, rows)).collect()}
    expected = {i: (int(near[k].sum()) - 1, of[i], of[i] == i) for k, i in enumerate(ids)} | {i: (0, i, True) for i in range(3000, 3006)}
    assert got == expected
    assert cover_tree.near_duplicates(vector_frame(spark, [])).count() == 0


def test_cover_tree_covers_and_nests():
    points = np.random.default_rng(4).normal(size=(300, 3))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    tree = cover_tree.Tree(points)
    placed = points[tree.order]
    assert sorted(tree.order) == list(range(300))
    for node, children in enumerate(tree.children):
        far = np.linalg.norm(placed[tree.begin[node] : tree.end[node]] - points[tree.centre[node]], axis=1)
        assert far.max() <= tree.radius[node] + 1e-3
        assert not children or tree.centre[children[0]] == tree.centre[node]
        assert all(tree.radius[c] <= tree.radius[node] / 2 + 1e-3 for c in children)


def test_chunks_are_not_sent_to_each_other(spark, monkeypatch):
    """Vectors without structure, of which no two chunks can be told apart: what is compared in pairs is not shuffled, and what is written follows the vectors."""
    monkeypatch.setattr(cover_tree, "CHUNK", 20)
    monkeypatch.setattr(cover_tree, "PAGE", 20_000, raising=False)
    plans, files, n = {}, [], 800

    def watched(df, purpose):
        plans[purpose] = plan_of(df)
        out = written(df, purpose)
        files.extend(Path(x.removeprefix("file:")) for x in out.inputFiles())
        return out

    monkeypatch.setattr(cover_tree, "written", watched)
    rng = np.random.default_rng(6)
    whole = rng.normal(size=(n, 64)).astype(np.float32).astype(np.float64)
    whole[n // 2 :: 8] = whole[: n // 2 : 8] + rng.normal(size=whole[: n // 2 : 8].shape) / 10  # near copies, which single precision does not hold
    whole[1], whole[3, 5] = whole[0], 0
    rows = [(i, v.tolist()) for i, v in enumerate(whole)] + [(n, [-0.0 if x == 0 else x for x in whole[3].tolist()])] * 2
    whole = np.vstack([whole, whole[3]])
    whole /= np.linalg.norm(whole, axis=1, keepdims=True)
    near = whole @ whole.T >= 0.9
    of = components(range(n + 1), [(int(i), int(j)) for i, j in zip(*np.nonzero(np.triu(near, 1)))])
    found = cover_tree.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found) == [(i, int(near[i].sum()) - 1, of[i]) for i in range(n + 1)]
    assert "Exchange" not in plans["links"]
    assert sum(x.stat().st_size for x in files) < 3 * whole.nbytes


def test_packed_vectors_are_whole():
    rows = [[0.5, -0.0, 3.0], [0.1, 2.0, 1e300], [0.0, 0.0, 0.0], [None, 1.0, 1.0], [float("inf"), 1.0, 1.0], [0.5, 0.0, 3.0], [1e-320, 0.0, 0.0]]
    for kind, whole in ((pa.float64(), [0, 1, 5, 6]), (pa.float32(), [0, 5])):
        usable, data = vectors.packed(pa.array(rows, pa.list_(kind)))
        assert usable.tolist() == whole
        assert data[0] == data[whole.index(5)] and len(data[0]) == 12
        assert vectors.unpacked(data, 3).tolist() == [rows[i] for i in whole]


def test_two_lengths_in_one_table(spark):
    rows = [(i, [1.0, float(i % 2)], 0) for i in range(4)] + [(10 + i, [1.0, 0.5, float(i % 3)], 0) for i in range(6)]
    df = vector_frame(spark, rows)
    links = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in cover_tree.near_duplicates(df, threshold=0.99).collect()}
    assert {i: links[i] for i in range(4)} == {0: (1, 0), 1: (1, 1), 2: (1, 0), 3: (1, 1)}
    assert {i: links[i] for i in range(10, 16)} == {10 + i: (1, 10 + i % 3) for i in range(6)}
    found = {}
    for r in ann.nearest(df, "vec_id % 10 = 0", k=3).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert sorted(found[0]) == [(1, 2), (2, 1), (3, 3)] and sorted(found[10])[0] == (1, 13)
    assert all(v >= 10 for _, v in found[10])


# -- WARC

PAGES = [
    (1, "http://a/1", "<p>one</p>"),
    (2, "http://a/2\r\nX: y", "<p>one</p>"),
    (3, None, None),
    (4, "http://a/4", ""),
    (5, "http://a/5", "before\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0\r\nafter"),
    (6, "http://a/6", "WARC/1.0\r\nContent-Length: 999999\r\n\r\n" * 3),
    (7, "http://a/7", "é\r\n\r\n" * 50_000),
    (8, "http://a/8", "<p>one</p>"),
    (8, "http://a/8", "<p>one</p>"),
]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_warc_round_trip(spark, tmp_path, setting):
    setting("spark.sql.files.maxPartitionBytes", "20000")
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("kind", F.lit("x")).coalesce(1)
    first = {h or "": max(i for i, _, x in PAGES if (x or "") == (h or "")) for _, _, h in PAGES}
    for compression in ("none", "gzip"):
        path = f"{tmp_path}/{compression}"
        warc.write_warc(warc.record_types(pages), path, compression)
        got = warc.read_warc(spark, path).collect()
        assert len(got) == len(PAGES)
        for r in got:
            html = next(h for i, _, h in PAGES if i == r["page_id"]) or ""
            assert (r["payload_digest"], r["payload_bytes"]) == (digest(html), len(html.encode()))
            if r["page_id"] == first[html]:
                assert (r["kind"], r["refers_to"], r["body"], r["body_digest"], r["body_bytes"]) == ("response", None, html, digest(html), len(html.encode()))
            else:
                assert (r["kind"], r["refers_to"], r["body"]) == ("revisit", first[html], "")
    raw = gzip.open(next(Path(f"{tmp_path}/gzip").glob("*.gz"))).read()
    assert raw.startswith(b"WARC/1.0\r\n") and raw.endswith(b"\r\n\r\n")


def test_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    kinds = {(r["page_id"], r["record_type"]) for r in warc.record_types(pages, min_bytes=11).collect()}
    assert (1, "response") in kinds and not any(k == "revisit" for i, k in kinds)


def test_warc_of_nothing(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_warc(warc.record_types(pages), f"{tmp_path}/none")
    assert warc.read_warc(spark, f"{tmp_path}/none").count() == 0


# -- URL filter


def plain_verdict(url, rules, otherwise):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = lower(rest[:end]), rest[end:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, otherwise))
    return host, path, best[1], best[2]


def test_url_rules(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "https://example.com/en/", "https://example.com/en", "http://a.example.com/en/1", "http://badexample.com/en/1",
        "http://x.net/es/1", "http://net/fr/", "http://x.net/de/", "http://example.com", "http://example.com?q=/en/", "x://y://example.com/en/", "http://example.com/en/\nx", "http://a..com/", "http://x.net/es/" + "a" * 100_000,
    ]
    rows = [(i, u) for i, u in enumerate(urls + urls)] + [(0, None), (4, urls[4])]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("key", F.lit(1)).withColumn("verdict", F.lit(1))
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    got = sorted(map(tuple, url_filter.judge_urls(pages, rules).collect()), key=repr)
    assert got == sorted(((i, *plain_verdict(u, queries.URL_RULES, "allow")) for i, u in rows), key=repr)
    many = [(f"h{i}.org", f"/{'p' * (i % 5)}", "block") for i in range(3000)]
    asked = [(i, f"http://www.h{i}.org/{'p' * (i % 7)}/x") for i in range(0, 6000, 7)]
    got = url_filter.judge_urls(spark.createDataFrame(asked, "page_id long, url string"), spark.createDataFrame(many, "host string, path string, verdict string"))
    by_host = {h: (h, p, v) for h, p, v in many}
    assert sorted(map(tuple, got.collect())) == sorted((i, *plain_verdict(u, [by_host[h] for h in [u.split("/")[2][4:]] if h in by_host], "allow")) for i, u in asked)
    assert url_filter.judge_urls(pages, rules.where("host = 'x'")).where("verdict <> 'allow' or rule is not null").count() == 0
    assert url_filter.judge_urls(pages.where("page_id < 0"), rules).count() == 0


# -- pipeline


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = corpus_pipeline.identify_language(spark, docs, SF).cache()
    assert clean.columns == docs.columns
    gone = docs.join(clean.select("doc_id"), "doc_id", "left_anti").collect()
    assert len(gone) < 0.01 * docs.count()
    lines = corpus_pipeline.drop_repeated_lines(spark, clean, SF).cache()
    expected = plain_lines([(r["doc_id"], r["text"]) for r in clean.collect()])
    assert sorted((r["doc_id"], r["text"] or "") for r in lines.collect()) == sorted(expected)
    single = corpus_pipeline.drop_near_duplicates(spark, lines, SF).cache()
    from tests.llm.test_text_operators import plain_fingerprint

    marks = {r["doc_id"]: plain_fingerprint(r["text"]) for r in lines.collect()}
    ids = sorted(marks)
    of = components(ids, [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if (marks[a] ^ marks[b]).bit_count() <= 3])
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(i for i in ids if of[i] == i)
    mixed = corpus_pipeline.mix_sources(spark, single, SF).cache()
    assert mixed.columns == docs.columns and set(mixed.collect()) <= set(single.collect())
    packed = corpus_pipeline.pack(spark, mixed, SF)
    counts = lambda df: sorted(map(tuple, df.groupBy("doc_id").count().collect()))
    assert counts(packed.where("start = 0")) == counts(mixed)
    whole = sorted(map(tuple, packed.collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == whole


def test_pipeline_stages_on_edges(spark):
    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
        out.count()
    single = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    kept = sorted(r["doc_id"] or -1 for r in single.collect())
    assert kept == [-1, 1, 3, 4, 7, 8, 9, 12] and len(ROWS) == 12


def test_language_stage_keeps_mixed_texts_and_drops_unlearned_ones(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    by = {}
    for r in docs.where("text is not null").orderBy("doc_id").collect():
        by.setdefault(r["lang"], []).append(r["text"].split())
    pure = [[w for t in texts[:20] for w in t][:400] for _, texts in sorted(by.items())]
    assert len(pure) == 4 and min(map(len, pure)) == 400
    mixes = [list(range(3)), list(range(1, 4)), list(range(4))]
    clean = [" ".join(w for k in mix for w in pure[k][: 1200 // len(mix) // 4]) for mix in mixes]
    clean += ["\n".join(" ".join(pure[k][i : i + 10]) for i in range(0, 100, 10) for k in mix) for mix in mixes]
    rng = np.random.default_rng(5)
    noise = " ".join("".join(rng.choice(list("bcdfghjklmnpqrstvwxz"), 8)) for _ in range(300))
    junk = [None, "12 34 -- 56", noise, "Быстрая коричневая лиса прыгает через ленивую собаку " * 9, "".join(map(chr, rng.integers(0x4E00, 0x9000, 300)))]
    added = spark.createDataFrame([(10**6 + i, t, None) for i, t in enumerate(clean + junk)], "doc_id long, text string, lang string")
    # A second label for every other document of a language divides the mass of its words.
    split = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.concat("lang", F.lit("2"))).otherwise(F.col("lang")))
    for learned in (docs, split):
        kept = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, learned.unionByName(added), SF).collect()}
        assert {i for i in kept if i >= 10**6} == {10**6 + i for i in range(len(clean))}
        assert kept >= {r["doc_id"] for r in docs.where("text rlike '[a-z]'").collect()}


def test_rows_with_one_id_or_none_are_told_apart(spark):
    a, b = (f"{x} text about many things that the other text does not name, in words of its own {x} {x}" for x in ("first", "second"))
    c = "Something else entirely stands here: numbers, colours, seven rivers and the names of the hills beyond them"
    rows = [(1, a, "x"), (2, b, "x"), (2, c, "x"), (2, c, "x"), (3, c, "y"), *[(None, b, "x")] * 3, (None, c, "x"), (None, c, "y"), (5, a, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    single = lambda df: sorted(map(tuple, corpus_pipeline.drop_near_duplicates(spark, df, SF).collect()), key=repr)
    got = single(docs.repartition(5))
    assert [r[:2] for r in got] == sorted([(1, a), (2, b), (2, c), (None, b), (None, c)], key=repr)
    assert single(docs.orderBy(F.desc("text"), F.desc("source")).coalesce(1)) == got


def test_rows_without_an_id_draw_by_their_text(spark):
    docs = spark.createDataFrame([(None, f"text number {i}", s) for i in range(1000) for s in ("a", "b")], "doc_id long, text string, source string")
    mixed, new = mixing.mix_sources(docs, [2, 1], 1.1)
    for r in mixed.groupBy("source", new["target"]).agg(F.sum(F.col(new["size"]) * F.col(new["copies"])).alias("taken")).collect():
        assert r["taken"] == pytest.approx(r[new["target"]], rel=0.1)
