"""Exact deduplication, SimHash, vector near-duplicates and components against brute force."""

from __future__ import annotations

import hashlib
import random
import tracemalloc

import numpy as np
import pytest
import xxhash
from conftest import TEXTS
from pyspark.sql import functions as F

from sondage.llm import digest_index, graph, simhash, vectors_pq
from sondage.operators.distribute import shared_folder


def reach(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_exact_dedup(docs, none):
    got = sorted((r["doc_id"] is None, r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"])
                 for r in digest_index.deduplicate(docs).collect())
    groups = {}
    for i, t, _ in TEXTS:
        groups.setdefault(t or "", []).append(i)
    want = []
    for i, t, _ in TEXTS:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        want.append((i is None, i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert digest_index.deduplicate(none).count() == 0


def test_index_is_kept_and_grows(spark, docs):
    path = f"{shared_folder(spark)}/index"
    first = digest_index.DigestIndex(spark, path, 4)
    digest_index.deduplicate(docs.filter("doc_id < 5"), first, batch="one")
    again = digest_index.DigestIndex(spark, path, 4)  # another session: only the files are known
    size = again.table().count()
    seen = digest_index.deduplicate(docs.filter("doc_id < 8"), again, batch="two").collect()
    assert not any(r["kept"] for r in seen if r["doc_id"] < 5)
    assert {r["doc_id"] for r in seen if r["kept"]} == {5, 6, 7}
    assert again.table().count() == size + 3
    before = {r["doc_id"]: r["kept"] for r in seen}
    repeat = digest_index.deduplicate(docs.filter("doc_id < 8"), again, batch="two").collect()  # a batch that ran half
    assert {r["doc_id"]: r["kept"] for r in repeat} == before and again.table().count() == size + 3
    new = spark.range(10).select(F.sha2(F.col("id").cast("string"), 256).alias("text_sha256"), F.col("id").alias("keep_id"), F.lit(1).alias("group_size"))
    plan = again.meet(new, "three")._jdf.queryExecution().toString()
    assert "SelectedBucketsCount: 4 out of 4" in plan and "SortMergeJoin" in plan
    assert plan[plan.index("== Physical Plan"):].count("Exchange hashpartitioning") == 1  # the new rows alone are shuffled


def test_exact_keep_one(docs, none):
    kept = digest_index.keep_one(docs)
    assert kept.columns == docs.columns and none.columns == digest_index.keep_one(none).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
        str(x) for x in {max((i for i, u, _ in TEXTS if (u or "") == (t or "") and i is not None), default=None) for _, t, _ in TEXTS})


def slow_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\n", " ").replace("\t", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, none):
    got = [(r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(docs).collect()]
    prints = [slow_fingerprint(t) for _, t, _ in TEXTS]
    comp = reach(len(TEXTS), [(a, b) for a in range(len(TEXTS)) for b in range(a) if bin(prints[a] ^ prints[b]).count("1") <= 3])
    want = [(i, prints[n], min((TEXTS[m][0] for m in range(len(TEXTS)) if comp[m] == comp[n] and TEXTS[m][0] is not None), default=None))
            for n, (i, _, _) in enumerate(TEXTS)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and 13 not in {r["doc_id"] for r in kept.collect()}


def test_simhash_keeps_one_of_each_group(spark):
    """Repeated and null ids: an id in two groups, two texts with one id in a group, groups without ids, repeated rows."""
    a, b, c = ("alpha beta gamma delta epsilon zeta eta theta", "one two three four five six seven eight nine", "rot gelb blau braun schwarz rosa lila")
    rows = [(1, a), (1, a.upper()), (1, b), (2, b), (2, a + " "), (None, c), (None, c.upper()), (None, a), (3, b), (3, b), (None, None), (None, ""), (4, " ")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, mark int").repartition(3)
    kept = simhash.keep_one(df).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], (r["text"] or "").lower().strip()) for r in kept) == sorted(
        [(False, 1, a), (False, 1, b), (True, None, c), (False, 4, "")], key=str)
    assert simhash.keep_one(df.limit(0)).count() == 0


@pytest.mark.parametrize("paired", [1, 4, 256])
def test_simhash_links_whatever_the_path(spark, paired):
    rng = random.Random(paired)
    values = [0]
    for _ in range(12):  # chains and dense balls
        base = rng.getrandbits(64)
        values += [base] + [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))) for _ in range(12)]
        for _ in range(6):
            values.append(values[-1] ^ sum(1 << b for b in rng.sample(range(64), 3)))
    values = sorted(set(values))
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    found = simhash.links(df, paired=paired).distinct().collect()
    place = {v: i for i, v in enumerate(values)}
    pairs = [(place[r["a"] % (1 << 64)], place[r["b"] % (1 << 64)]) for r in found]
    assert all(bin(values[a] ^ values[b]).count("1") <= 3 for a, b in pairs)
    every = [(a, b) for a in range(len(values)) for b in range(a) if bin(values[a] ^ values[b]).count("1") <= 3]
    assert reach(len(values), pairs) == reach(len(values), every)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (300, 301), (301, 300)]
    got = {r["v"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 300: 300, 301: 300}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_vectors(spark):
    rng = np.random.default_rng(0)
    rows = []
    for g in range(30):
        base = rng.standard_normal(16)
        for k in range(rng.integers(1, 7)):
            rows.append((base + rng.standard_normal(16) * rng.choice([0, 0.05, 0.15, 0.3])).tolist())
    labels = [int(x) for x in rng.integers(0, 3, len(rows))]
    table = [(i, v, lab) for i, (v, lab) in enumerate(zip(rows, labels))]
    n = len(table)
    table += [(n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [float("nan")] * 16, 1), (n + 3, rows[0], None), (n + 4, rows[0], labels[0]),
              (n + 5, [None] + rows[0][1:], labels[0]), (n + 6, [], 1), (n + 7, [1.0, 2.0], 1), (n + 8, [2.0, 4.0], 1),
              (n + 9, [float("inf")] + rows[0][1:], labels[0])]
    df = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in table],
                               "vec_id long, embedding array<double>, label int, rep string, x string, kept string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors_pq.near_duplicates(df).collect()}

    def good(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    pairs = []
    for a, va, la in table:
        for b, vb, lb in table:
            if b < a and la is not None and la == lb and good(va) and good(vb) and len(va) == len(vb):
                if np.dot(va, vb) / np.linalg.norm(va) / np.linalg.norm(vb) >= 0.93:
                    pairs.append((a, b))
    comp = reach(len(table), pairs)
    want = {i: (sum(i in p for p in pairs), comp[i], comp[i] == i) for i in range(len(table))}
    assert got == want and len(pairs) > 30
    assert vectors_pq.near_duplicates(df.limit(0)).count() == 0


def test_probes_and_lookups_lose_no_link():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((600, 24))
    x[300:] = x[:300] + rng.standard_normal((300, 24)) * 0.08
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q = vectors_pq.Quantiser(x, 12)
    own, radius = q.nearest(x), np.sqrt(2 - 2 * 0.93)
    near = q.reachable(x, own, radius)
    linked = np.argwhere(x @ x.T >= 0.93)
    assert len(linked) > 700 and all(near[a, own[b]] for a, b in linked)
    for which in range(12):
        mine = np.flatnonzero(own == which)
        codes, error = q.code(x[mine], own[mine])
        d = q.lookup(x, which, codes)
        for a, b in linked:
            if own[b] == which:
                j = int(np.searchsorted(mine, b))
                assert d[a, j] <= (radius + error[j] + 1e-4) ** 2 + 1e-4


def test_reachable_needs_no_cube():
    rng = np.random.default_rng(4)
    x = vectors_pq._unit(rng.standard_normal((2048, 64)))
    q = vectors_pq.Quantiser.__new__(vectors_pq.Quantiser)
    q.coarse = x[:256]
    tracemalloc.start()
    got = [q.reachable(x, own, 0.37) for own in (np.full(len(x), 7), q.nearest(x))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6  # rows x lists x dimensions doubles are 268 MB
    for own, near in zip((np.full(len(x), 7), q.nearest(x)), got):
        d = ((x[:, None] - q.coarse[None, :]) ** 2).sum(axis=2)
        apart = np.sqrt(((q.coarse[own][:, None] - q.coarse[None]) ** 2).sum(axis=2))
        assert (near == (d - d[np.arange(len(x)), own][:, None] <= 2 * (0.37 + vectors_pq._SLACK) * apart + vectors_pq._SLACK)).all()


def test_simhash_keep_one_leaves_texts_in_place(spark):
    """The few rows that go are broadcast, so that no text moves; beyond a limit the texts are joined, with the same result."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rows = [(i, " ".join(random.Random(i % 40).sample(words, 8))) for i in range(60)] + [(None, "x y z w"), (7, "x y z w")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    near, far = simhash.keep_one(df), simhash.keep_one(df, gone_bytes=0)
    assert sorted(near.collect(), key=str) == sorted(far.collect(), key=str) and near.count() < len(rows)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "SortMergeJoin" not in plan
