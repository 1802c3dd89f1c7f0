"""Packing, mixing, SimHash, line dedup, LM scoring and language ID against plain Python, on the edge cases and a real table."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyhouse.llm import language_id, line_dedup, lm_scoring, mixing, packing, queries, simhash
from tests.llm.edge import LINE, ROWS, documents, text

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def table(spark, name="documents", sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def shape(rows):
    return [tuple(r) for r in rows]


# -- packing


def check_packing(pieces, texts):
    ids = Tokenizer.from_file(packing.TOKENIZER)
    of = defaultdict(list)
    for p in pieces:
        of[p["doc_id"]].append(p)
    for one, t in texts.items():
        whole = [*ids.encode(t or "", add_special_tokens=False).ids, 1]
        at = 0
        for p in sorted(of[one], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(whole)
            part = whole[at : at + p["length"]]
            assert p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += p["length"]
        assert at == len(whole)
    filled = defaultdict(list)
    for p in pieces:
        filled[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(filled)


def test_packing_holds_every_id_once(spark):
    docs = table(spark)
    pieces = packing.pack_documents(docs, with_ids=False).collect()
    n = check_packing(pieces, {r["doc_id"]: r["text"] for r in docs.collect()})
    assert sum(p["length"] for p in pieces) > 0.97 * 2048 * (n - 1)


def test_packing_edges(spark):
    rows = [r for r in ROWS if r[0] not in (9, None)] + [(20, "a <|endoftext|> b", "en", "a", 1), (21, "a  b \n c\x85d \u2003 it's 's", "en", "a", 1)]
    check_packing(packing.pack_documents(documents(spark, rows)).collect(), {r[0]: r[1] for r in rows})
    twice = packing.pack_documents(documents(spark)).where("doc_id = 9").collect()
    assert len(twice) == 2 and len({(p["sequence_id"], p["offset"]) for p in twice}) == 2
    assert packing.pack_documents(documents(spark, [])).count() == 0
    ids = packing.pack_documents(documents(spark, [(1, "a b", "en", "a", 1)])).first()["ids"]
    assert np.frombuffer(ids, "<u4")[-1] == 1


def test_best_fit_takes_the_tightest_window():
    bins, offsets = packing.best_fit_decreasing(np.array([6, 5, 4, 3, 2]), 10)
    assert list(zip(bins, offsets)) == [(0, 0), (1, 0), (0, 6), (1, 5), (1, 8)]
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 65, 500)
    bins, _ = packing.best_fit_decreasing(lengths, 64)
    free = []
    for i in np.argsort(-lengths, kind="stable"):
        fits = [f for f in free if f >= lengths[i]]
        if fits:
            free.remove(min(fits))
        free.append((min(fits) if fits else 64) - lengths[i])
    assert sorted(free) == sorted(64 - np.bincount(bins, lengths).astype(int))


# -- mixing


def water_level(sizes, weights, total):
    """Hand out by weight, again and again, until none is above twice its size."""
    target, fixed = {}, set()
    while True:
        rest = total - sum(2 * sizes[s] for s in fixed)
        open_ = [s for s in sizes if s not in fixed]
        w = sum(weights[s] for s in open_)
        above = {s for s in open_ if rest * weights[s] / w > 2 * sizes[s]}
        if not above:
            return {s: 2 * sizes[s] if s in fixed else rest * weights[s] / w for s in sizes}
        fixed |= above


@pytest.mark.parametrize("rows", [None, ROWS])
def test_mixing_targets_and_copies(spark, rows):
    docs = documents(spark, rows) if rows else table(spark)
    mixed, new = mixing.mix_sources(docs, [5, 2, 1], 1.5)
    found = mixed.collect()
    assert len(found) == docs.count()
    sizes, names = Counter(), {r["source"] for r in found}
    for r in found:
        assert r[new["size"]] == len(WORD.findall(r["text"] or ""))
        sizes[r["source"]] += r[new["size"]]
    order = sorted(names - {None}) + ([None] if None in names else [])
    target = water_level({s: sizes[s] for s in order}, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(sizes.values()))
    for r in found:
        assert r[new["target"]] == pytest.approx(target[r["source"]])
        rate = target[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 0
        assert math.floor(rate) <= r[new["copies"]] <= min(2, math.ceil(rate))
    emitted = mixing.emit_copies(mixed, new["copies"], docs.columns)
    assert emitted.columns == docs.columns and emitted.count() == sum(r[new["copies"]] for r in found)
    again = mixing.mix_sources(docs.repartition(5), [5, 2, 1], 1.5)[0].collect()
    assert sorted(map(repr, again)) == sorted(map(repr, found))


def test_mixing_of_many_sources(spark):
    """Targets of a few thousand sources in several ranges, against the excess handed out again and again."""
    draw = random.Random(3)
    sizes = {f"s{i:05}": draw.choice([0, 1, 5, 50, 5000, draw.randrange(1, 10**6)]) for i in range(3000)} | {None: 77}
    weights = [5, 2, 1, 0.5]
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 4] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        level = (total - sum(2.0 * sizes[s] for s in capped)) / sum(w[s] for s in names if s not in capped)
        more = {s for s in names if s not in capped and level * w[s] > 2.0 * sizes[s]}
        if not more:
            break
        capped |= more
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long").repartition(5)
    got = {r["source"]: r["target"] for r in mixing.source_rates(frame, weights, 1.5, 2.0).collect()}
    assert got == {s: pytest.approx(2.0 * sizes[s] if s in capped else level * w[s]) for s in names}


def test_mixing_of_nothing(spark):
    assert mixing.mix_sources(documents(spark, []), [5, 2, 1], 1.5)[0].count() == 0


# -- SimHash


def plain_fingerprint(t, n=3):
    words = WORD.findall(lower(t))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {i: root(i) for i in ids}


def test_simhash_against_all_pairs(spark):
    docs = table(spark, sf="/root/testdata/sf0.01")
    found = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    marks = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs.collect()}
    links = [(a, b) for a, b in itertools.combinations(sorted(marks), 2) if (marks[a] ^ marks[b]).bit_count() <= 3]
    expected = components(marks, links)
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in found.items()} == {i: (f"{marks[i]:016x}", expected[i]) for i in marks}


def test_simhash_edges(spark):
    found = sorted((r["doc_id"] or -1, r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(documents(spark)).collect())
    assert len(found) == len(ROWS)
    of = {i: (f, c) for i, f, c in found}
    assert of[4] == of[5] == of[6] == ("0" * 16, 4)
    assert of[1] == of[2] == of[-1] and of[1][1] == 1
    assert [x for x in found if x[0] == 9] == [(9, f"{plain_fingerprint(ROWS[8][1]):016x}", 9)] * 2
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def test_full_buckets_are_cut_again_and_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 20)
    rng = np.random.default_rng(5)
    base = int(rng.integers(1 << 62))
    marks = {base ^ sum(1 << int(b) for b in rng.choice(40, rng.integers(0, 7), replace=False)) for _ in range(300)}
    prints = spark.createDataFrame([(m,) for m in marks], "fp long")
    found = [tuple(r) for r in simhash.close_pairs(prints, 3).collect()]
    expected = {(min(a, b), max(a, b)) for a, b in itertools.combinations(marks, 2) if (a ^ b).bit_count() <= 3}
    assert set(found) == expected and len(found) == len(expected)


def test_components_of_a_long_chain(spark):
    from tallyhouse.llm.common import connected_components

    chain = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(300, 301), (7, 7), (None, 4)], "a long, b long")
    found = {r["node"]: r["root"] for r in connected_components(chain, "a", "b").collect()}
    assert found == {i: 0 for i in range(201)} | {300: 300, 301: 300}
    assert connected_components(chain.where("a < 0"), "a", "b").count() == 0


# -- line dedup


def plain_lines(rows):
    """doc_id -> kept text, by the rule."""
    white = " \t\n\v\f\r"
    key = lambda line: lower(line.strip(white))
    holders = defaultdict(set)
    for one, t in rows:
        for line in (t or "").split("\n"):
            if one is not None and len(key(line)) >= 20:
                holders[key(line)].add(one)
    shared = {k: max(v) for k, v in holders.items() if len(v) >= 3}
    return [(one, "\n".join(x for x in (t or "").split("\n") if one is None or key(x) not in shared or shared[key(x)] == one)) for one, t in rows]


@pytest.mark.parametrize("rows", [None, ROWS])
def test_line_dedup(spark, rows):
    docs = documents(spark, rows) if rows else table(spark)
    expected = plain_lines([(r["doc_id"], r["text"]) for r in docs.collect()])
    found = line_dedup.dedup_lines(docs)
    n_lines, n_dropped = line_dedup.added_names(docs)
    got = found.collect()
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in got) == sorted((i or -1, t) for i, t in expected)
    before = Counter((r["doc_id"], len((r["text"] or "").split("\n"))) for r in docs.collect())
    assert Counter((r["doc_id"], r[n_lines]) for r in got) == before
    assert all(r[n_lines] - r[n_dropped] in (len((r["text"] or "").split("\n")), 0) for r in got)
    assert found.columns == [*docs.columns, n_lines, n_dropped]


def test_line_dedup_of_nothing(spark):
    assert line_dedup.dedup_lines(documents(spark, [])).count() == 0


def test_cuckoo_filter_knows_its_keys_and_forgets_deleted_ones():
    keys = np.frombuffer(b"".join(hashlib.md5(str(i).encode()).digest() for i in range(6000)), np.uint8).reshape(-1, 16).copy()
    own = line_dedup.CuckooFilter(3000)
    own.insert(keys[:3000])
    assert own.contains(keys[:3000]).all() and own.contains(keys[3000:]).mean() < 0.01
    own = line_dedup.CuckooFilter.load(own.dump())
    own.delete(keys[:1000])
    assert own.contains(keys[1000:3000]).all() and own.contains(keys[:1000]).mean() < 0.02
    small = line_dedup.CuckooFilter(4)
    small.insert(keys[:200])  # more than it has room for
    assert small.contains(keys[:200]).all()


def test_line_index_can_be_undone(spark):
    docs = spark.createDataFrame([r for r in ROWS if r[0]], "doc_id long, text string, lang string, source string, n_chars long")
    first, second = docs.where("doc_id <= 5"), docs.where("doc_id > 5")
    index = line_dedup.LineIndex(spark)
    index.insert(first)
    state = sorted(map(repr, index.table.collect()))
    before = sorted(map(repr, index.strip(first).collect()))
    index.insert(second)
    whole = sorted(map(repr, line_dedup.dedup_lines(docs).collect()))
    assert sorted(map(repr, index.strip(docs).collect())) == whole
    index.insert(second)
    assert sorted(map(repr, index.strip(docs).collect())) == whole
    index.delete(second)
    assert sorted(map(repr, index.table.collect())) == state
    assert sorted(map(repr, index.strip(first).collect())) == before
    index.delete(docs)
    assert index.table.count() == 0 and LINE in "".join(r["text"] or "" for r in index.strip(docs).collect())


def test_cuckoo_filter_tells_overflowing_keys_of_one_mark_apart():
    keys = np.zeros((40, 16), np.uint8)
    keys[:, 4], keys[:, 8] = np.arange(40), 7  # one fingerprint and one bucket
    own = line_dedup.CuckooFilter(1)
    own.insert(keys)
    own = line_dedup.CuckooFilter.load(own.dump())
    own.delete(keys[:39])
    assert own.contains(keys[39:]).all()
    own.delete(keys[39:])
    assert not own.contains(keys).any() and not own.rest


def test_line_index_grows_past_a_tiny_first_load(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARDS", 1)
    shared = ["\n".join(f"{half} half, shared line number {i}" for i in range(2000)) for half in ("first", "second")]
    texts = [LINE] * 3 + ["\n".join(shared)] * 2 + shared
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    index = line_dedup.LineIndex(spark)
    index.insert(docs.where("doc_id < 3"))
    index.insert(docs.where("doc_id >= 3"))
    left = docs.where("doc_id <> 6")
    for now in (docs, left):
        if now is left:
            index.delete(docs.where("doc_id = 6"))
        (own,) = [line_dedup.CuckooFilter.load(r["filter"]) for r in index.filters.collect()]
        keys = [r["key"] for r in index.table.where("n_docs >= 3").collect()]
        assert own.contains(line_dedup.digests_of(keys)).all() and len(keys) <= 0.8 * own.slots.size and not own.rest
        assert sorted(map(tuple, index.strip(now).collect())) == sorted(map(tuple, line_dedup.dedup_lines(now).collect()))


def test_line_index_rewrites_the_shards_of_a_document_only(spark):
    docs = spark.createDataFrame([(i, f"{LINE}\na line that only document {i} holds") for i in range(40)], "doc_id long, text string")
    index = line_dedup.LineIndex(spark, shards=32)
    index.insert(docs.unionAll(spark.createDataFrame([(99, LINE)], docs.schema)))
    before = [dict(t.at) for t in (index._log, index._table, index._filters)]
    index.delete(spark.createDataFrame([(99,)], "doc_id long"))
    for was, now in zip(before, (index._log, index._table, index._filters)):
        assert len({s for s in was.keys() | now.at.keys() if was.get(s) != now.at.get(s)}) == 1
    index.delete(spark.createDataFrame([(5,), (1000,), (None,)], "doc_id long"))
    left = docs.where("doc_id <> 5")
    assert sorted(map(tuple, index.strip(left).collect())) == sorted(map(tuple, line_dedup.dedup_lines(left).collect()))
    assert index.table.count() == 40 and index._log.read().count() == 78


def test_a_line_of_all_documents_is_looked_up_in_bounded_slices(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "REFERENCES_PER_SLICE", 50)
    monkeypatch.setattr(line_dedup, "REFERENCES_PER_SHARD", 100)
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit(LINE + "\nown line of the document "), "id").alias("text"))
    refs = line_dedup.in_shards(line_dedup.references(docs, 20), 80)
    filters = line_dedup.build_filters(line_dedup.count_table(refs), 3)
    dealt, sent = line_dedup.in_slices(refs, filters)
    sizes = [r["count"] for r in dealt.groupBy("shard", "slice").count().collect()]
    assert sum(sizes) == 8000 and max(sizes) <= 150 and len(sizes) <= 8000 / 50 + 80
    assert sent.count() <= 4100 / 50 + 1 and filters.count() == 1
    found = line_dedup.dedup_lines(docs)
    assert found.agg(F.sum("n_dropped")).first()[0] == 3999


# -- LM scoring


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_scores(spark, order):
    docs = table(spark)
    rows = [(r["doc_id"], WORD.findall(lower(r["text"]))) for r in docs.collect()]
    counts = [Counter(tuple(w[i : i + n]) for _, w in rows for i in range(len(w) - n + 1)) for n in range(order + 1)]
    total = sum(len(w) for _, w in rows)
    expected = {}
    for one, w in rows:
        logs, steps = 0.0, 0
        for i in range(len(w)):
            n = min(order, i + 1)
            while n > 1 and counts[n][tuple(w[i - n + 1 : i + 1])] < 2:
                n, logs, steps = n - 1, logs + math.log(0.4), steps + 1
            gram = tuple(w[i - n + 1 : i + 1])
            logs += math.log(counts[n][gram] / (counts[n - 1][gram[:-1]] if n > 1 else total))
        expected[one] = (len(w), steps, logs / len(w) if w else None)
    for block_bytes in (lm_scoring.BLOCK_BYTES, 50_000):
        got = lm_scoring.score_documents(docs, order=order, block_bytes=block_bytes).collect()
        assert {r["doc_id"] for r in got} == set(expected)
        for r in got:
            n, steps, score = expected[r["doc_id"]]
            assert (r["n_words"], r["n_backoff"]) == (n, steps)
            assert r["score"] == (pytest.approx(score, abs=1e-9) if n else None)


def test_lm_edges(spark):
    got = lm_scoring.score_documents(documents(spark)).collect()
    assert len(got) == len(ROWS)
    of = defaultdict(list)
    for r in got:
        of[r["doc_id"]].append(r)
    assert [of[i][0]["score"] for i in (4, 5, 6)] == [None] * 3 and of[4][0]["n_words"] == 0
    assert len(of[9]) == 2 and of[9][0]["score"] == of[9][1]["score"] and of[None][0]["score"] == of[1][0]["score"]
    assert lm_scoring.score_documents(documents(spark, [])).count() == 0


# -- language ID


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(1)
    lengths = np.array([3, 1, 4])
    scores, moves, start = rng.normal(size=(8, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    found, expected_moves, log_z = language_id.forward_backward(scores, moves, start, lengths)
    at, logs, total = 0, 0.0, np.zeros((3, 3))
    for n in lengths:
        weight, mass = {}, np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            weight[path] = math.exp(start[path[0]] + sum(scores[at + i, k] for i, k in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
        z = sum(weight.values())
        for path, w in weight.items():
            for i, k in enumerate(path):
                mass[i, k] += w / z
            for a, b in zip(path, path[1:]):
                total[a, b] += w / z
        assert np.allclose(found[at : at + n], mass)
        at, logs = at + n, logs + math.log(z)
    assert np.allclose(expected_moves, total) and log_z == pytest.approx(logs)


def test_language_of_held_out_documents(spark):
    docs = table(spark, sf="/root/testdata/sf0.1")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    got = queries.op4_language_id(spark, "/root/testdata/sf0.1").collect()
    assert len(got) == len(truth)
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    right = [r["lang_pred"] == truth[r["doc_id"]] for r in held if truth[r["doc_id"]]]
    assert len(right) > 2000 and sum(right) / len(right) > 0.99


def test_language_edges_and_switches(spark):
    docs = table(spark).where("lang in ('en', 'de')")
    model = language_id.learn(docs)
    got = language_id.identify(documents(spark), model)
    assert got.columns == ["doc_id", "lang_pred", "score"] and got.count() == len(ROWS)
    of = {r["doc_id"]: r for r in got.collect()}
    assert [tuple(of[i])[1:] for i in (4, 5, 6)] == [("und", 0.0)] * 3
    labeller = language_id.Labeller(model)
    rows = {r["lang"]: r["text"] for r in docs.orderBy("doc_id").collect() if len(r["text"]) > 2000}
    cut = {k: v.replace("\n", " ").split()[:60] for k, v in rows.items()}
    spans = labeller.spans(" ".join(cut["en"] + cut["de"]))
    words = {k: sum(b - a for a, b, lang in spans if lang == k) for k in ("en", "de")}
    assert abs(words["en"] - 60) <= 6 and spans[0][2] == "en" and spans[-1][2] == "de"
    assert sum(len(s) > 0 for s in [labeller.label(["12 34", None, ""])[0]]) and labeller.label(["12 34"])[0] == ["und"]
    none = language_id.learn(docs.where("doc_id < 0"))
    assert {r["lang_pred"] for r in language_id.identify(docs, none).collect()} == {"und"}
    assert language_id.identify(documents(spark, []), model).count() == 0


def test_every_language_is_learned_whatever_the_ids(spark):
    many = [(i, f"w{i % 70}a w{i % 70}b text {i}", f"l{i % 70:02}", "a", 1) for i in range(210)]
    texts, langs = language_id.training_sample(documents(spark, many, clash=False))
    assert len(texts) == 210 and len(set(langs)) == 70
    for one_id in (None, 7):
        hot = [(one_id, f"the english text number {i}", "en", "a", 1) for i in range(20_000)]
        copies = [(one_id, "the same english text", "en", "a", 1)] * 3_000
        french = [(i, f"le texte français {i}", "fr", "a", 1) for i in range(300)]
        texts, langs = language_id.training_sample(documents(spark, hot + copies + french, clash=False))
        assert Counter(langs) == {"en": language_id.SAMPLE_DOCS, "fr": language_id.SAMPLE_DOCS}
        assert len(set(texts)) == 2 * language_id.SAMPLE_DOCS


def test_blocks_of_lines_do_not_change_labels(spark, monkeypatch):
    docs = table(spark)
    labeller = language_id.Labeller(language_id.learn(docs))
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()] + [None, "", "12\n\n34"]
    langs, scores = labeller.label(texts)
    monkeypatch.setattr(language_id, "BLOCK", 100)
    again, close = labeller.label(texts)
    assert again == langs and np.allclose(close, scores, atol=1e-12)
    assert len(list(labeller.blocks(texts))) > len(texts) / 2 and langs[-3:] == ["und"] * 3
    assert [len(part) for part in labeller.label([])] == [0, 0]


def test_a_very_long_text_is_whole(spark):
    assert len(text(7, 20_000).split()) == 20_000
    got = lm_scoring.score_documents(documents(spark)).where("doc_id = 7").first()
    assert got["n_words"] == 20_000


def test_lm_cells_are_those_of_the_hashes_at_hand():
    draw = np.random.default_rng(1)
    for n in (0, 1, 5, 1000):
        hashes = np.unique(draw.integers(0, 2**64, n, dtype=np.uint64))
        for shards in (1, 2, 72, 10**7):
            expected = defaultdict(list)
            for i, h in enumerate(hashes.tolist()):
                expected[h // ((1 << 64) // shards + 1)].append(i)
            assert list(lm_scoring.by_shard(hashes, shards)) == [(s, at[0], at[-1] + 1) for s, at in sorted(expected.items())]
