"""Exact dedup, SimHash and embedding near-dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import xxhash

from orbitfit.llm import components, embedding, exact_dedup, simhash
from tests_llm_common import SF, groups


def test_exact_dedup_edges(edges, nothing):
    rows = exact_dedup.exact_dedup(edges).collect()
    assert len(rows) == 11
    by = {}
    for r in rows:
        by.setdefault(bytes(r["digest"]), []).append(r)
    cat = by[hashlib.sha256(b"The cat sat on the mat and looked at the dog.").digest()]
    assert [(r["keep_id"], r["group_size"]) for r in cat] == [(1, 3)] * 3
    assert sorted(r["doc_id"] for r in cat if r["kept"]) == [1]
    empty = by[hashlib.sha256(b"").digest()]
    assert sorted(r["doc_id"] for r in empty) == [3, 4]
    assert sum(r["kept"] for r in rows) == len(by)
    assert exact_dedup.exact_dedup(nothing).count() == 0
    assert exact_dedup.keep_first(edges).columns == edges.columns
    assert exact_dedup.keep_first(edges).count() == len(by)


def test_exact_dedup_many_rounds(spark):
    rows = [(i, f"text {i % 37 if i % 3 else 0}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    got = {r["doc_id"]: r for r in exact_dedup.exact_dedup(docs, fan_in=2).collect()}
    want = {}
    for i, t in rows:
        want.setdefault(t, []).append(i)
    for ids in want.values():
        assert {(got[i]["keep_id"], got[i]["group_size"]) for i in ids} == {(min(ids), len(ids))}


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    fps = {r["doc_id"]: slow_fingerprint(r["text"]) for r in rows}
    ids = sorted(fps)
    want = groups(ids, [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if (fps[a] ^ fps[b]).bit_count() <= 4])
    for limit in (simhash.CELL_LIMIT, 1):   # 1: every cell with company is cut into chunks
        got = {r["doc_id"]: r for r in simhash.near_dedup(docs, cell_limit=limit).collect()}
        assert {i: int(r["fingerprint"], 16) for i, r in got.items()} == fps
        assert {i: r["component_id"] for i, r in got.items()} == want


def test_simhash_edges(edges, nothing):
    rows = simhash.near_dedup(edges).collect()
    assert len(rows) == 11
    assert {r["component_id"] for r in rows if r["doc_id"] in (3, 4, 5)} == {3}
    assert all(r["fingerprint"] == "0" * 16 for r in rows if r["doc_id"] in (3, 4, 5))
    assert simhash.near_dedup(nothing).count() == 0
    kept = simhash.keep_one(edges)
    assert kept.columns == edges.columns
    assert kept.filter("doc_id in (3, 4, 5)").count() == 1
    assert kept.filter("doc_id in (1, 2)").count() == 1


def test_simhash_keeps_texts_without_or_with_shared_ids(spark):
    rng = random.Random(5)
    a, b, c, d = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(4))
    rows = [(None, a), (None, b), (7, c), (7, d), (7, d), (None, c), (9, c), (None, None), (None, " ")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, first string")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted((i, t) for i, t in got if i) == sorted([(7, c), (7, d)])
    assert {t for i, t in got if i is None and t and t.strip()} == {a, b}
    assert sum(not (t or "").strip() for _, t in got) == 1 and len(got) == 5


def test_grid_finds_every_pair_of_a_dense_cluster(spark):
    rng = random.Random(1)
    centre = rng.getrandbits(64)
    fps = {centre}
    for _ in range(300):   # chains of near fingerprints and strangers
        x = rng.choice(sorted(fps))
        for _ in range(rng.randint(1, 5)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    fps |= {rng.getrandbits(64) for _ in range(200)}
    signed = [f - (1 << 64) if f >> 63 else f for f in sorted(fps)]
    order = sorted(fps)
    want = groups(order, [(a, b) for k, a in enumerate(order) for b in order[k + 1:] if (a ^ b).bit_count() <= 4])
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    for limit in (10_000, 7):
        links = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.near_links(df, cell_limit=limit).collect()]
        assert all((a ^ b).bit_count() <= 4 for a, b in links)
        assert groups(order, links) == want


def test_popcount_distance_is_a_lower_bound():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**64, 5000, dtype=np.uint64)
    b = a ^ (rng.integers(0, 2**64, 5000, dtype=np.uint64) & rng.integers(0, 2**64, 5000, dtype=np.uint64))
    bits = np.bitwise_count(a ^ b)
    got = simhash.manhattan(simhash.popcounts(a), simhash.popcounts(b))
    count = lambda x: [[(int(v) >> 2 * s & 3).bit_count() for s in range(32)] for v in x[:200]]
    slow = np.abs(np.array(count(a)) - np.array(count(b))).sum(axis=1)
    assert (got[:200] == slow).all() and (got <= bits).all()


def test_components_of_a_long_path(spark):
    n = 40
    links = spark.createDataFrame([(i, i + 1) for i in range(n)], "a long, b long")
    nodes = spark.createDataFrame([(i, n - i) for i in range(n + 1)], "node long, label long")
    assert {r["component"] for r in components.components(links, nodes).collect()} == {0}


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string, id string, key string")


def test_embedding_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(150, 16))
    x = np.concatenate([base, base[:60] + rng.normal(size=(60, 16)) * 0.12, base[:5].repeat(8, axis=0),
                        base[7] + rng.normal(size=(80, 16)) * 0.1]).astype(np.float32)
    rows = [(i, [float(v) for v in r], "l", "i", "k") for i, r in enumerate(x)]
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hit = unit @ unit.T >= 0.95
    np.fill_diagonal(hit, False)
    measured = []
    got = {r["vec_id"]: r for r in embedding.near_dedup(vectors(spark, rows), residents=8, visitors=16,
                                                       measured=measured).collect()}
    links = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (links <= hit.sum(axis=1)).all()
    assert links.sum() >= 0.95 * hit.sum() and measured[0]["recall"] >= 0.95
    everything = {r["vec_id"]: r for r in embedding.near_dedup(vectors(spark, rows), recall=1.0).collect()}
    assert [everything[i]["n_links"] for i in range(len(x))] == hit.sum(axis=1).tolist()
    want = groups(range(len(x)), zip(*np.nonzero(hit)))
    assert {i: r["component_id"] for i, r in everything.items()} == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in everything.values())


def test_embedding_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [1.0, None]), (8, []), (9, [1.0, 0.0, 0.0]), (None, [0.0, 3.0]), (10, [0.0, 1.0]),
            (11, [1e-30, 0.0])]
    got = embedding.near_dedup(vectors(spark, [(*r, "l", "i", "k") for r in rows])).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], []).append((r["n_links"], r["component_id"], r["kept"]))
    assert by[1] == [(3, 1, True)] and by[2] == [(3, 1, False)] * 2 and by[11] == [(3, 1, False)]
    assert all(by[i] == [(0, i, True)] for i in (3, 4, 5, 6, 7, 8, 9))
    assert by[10] == [(1, 10, True)] and by[None] == [(1, 10, False)]
    assert embedding.near_dedup(vectors(spark, [])).count() == 0


def test_embedding_finds_isolated_pairs(spark, monkeypatch):
    """A few pairs at the cosine among many strangers, of which the probes hold next to none."""
    monkeypatch.setattr(embedding, "PROBES", 40)
    rng = np.random.default_rng(9)
    x = embedding.unit(rng.normal(size=(4000, 32)))
    pairs = embedding.threshold_partners(x[:80], 0.952, 1)
    rows = [(i, r.tolist(), "l", "i", "k") for i, r in enumerate(np.concatenate([x, pairs]))]
    measured = []
    got = {r["vec_id"]: r["component_id"] for r in embedding.near_dedup(vectors(spark, rows), measured=measured).collect()}
    assert measured[0]["visits"] > 1 and measured[0]["drawn_recall"] >= 0.98
    assert sum(got[4000 + i] == i for i in range(80)) >= 76


def test_embedding_visits_count_every_probe_alike(spark):
    """A hot group does not crowd out the probes of sparse pairs that lie cells apart."""
    rng = np.random.default_rng(9)
    x = embedding.unit(rng.normal(size=(2000, 32)))
    far = embedding.threshold_partners(x, 0.951, 1)
    grid = embedding.Grid(x, 10)
    ranks = np.minimum(grid.rank(x, grid.home(far)), grid.rank(far, grid.home(x)))
    apart = np.argsort(-ranks, kind="stable")[:100]
    hot = embedding.threshold_partners(x[:1], 0.999, 120)
    rows = [(k, r.tobytes()) for k, r in enumerate(np.concatenate([hot, x[apart], far[apart]]))]
    classes = spark.createDataFrame(rows, "cid long, v binary").coalesce(1)
    visits, recall, *_ = embedding.visits_needed(classes, grid, 32, 0.95, 0.98)
    assert recall >= 0.98 and visits > np.quantile(ranks[apart], 0.9)
