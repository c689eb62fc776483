"""Exact similarity join and leader clustering against brute force."""

import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catalogops.operators import clusters, grams, vectors
from catalogops.sources import stages


def unit(m):
    m = np.asarray(m, dtype="float64")
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n == 0, 1, n)


def brute(ids, matrix, k, tau):
    sims = np.round(unit(matrix) @ unit(matrix).T, 9)
    out = {}
    for i, a in enumerate(ids):
        order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-sims[i, j], ids[j]))
        out[a] = [(ids[j], round(float(sims[i, j]), 7)) for j in order[: k - 1] if sims[i, j] >= tau]
    return {a: v for a, v in out.items() if v}


def spark_knn(spark, ids, matrix, **kw):
    df = spark.createDataFrame(
        [(int(i), [float(x) for x in v]) for i, v in zip(ids, matrix)], "id long, v array<float>"
    ).repartition(3)
    out = {}
    for r in vectors.knn(df, "id", "v", **kw).orderBy("id", "rank").collect():
        out.setdefault(r.id, []).append((r.neighbour, round(r.sim, 7)))
        assert r["rank"] == len(out[r.id])
    return out


def clustered(seed, groups, per, dim=8, spread=0.15):
    rng = np.random.default_rng(seed)
    centres = unit(rng.normal(size=(groups, dim)))
    points = np.vstack([c + spread * rng.normal(size=(per, dim)) for c in centres])
    return unit(points).astype("float32")


@pytest.mark.parametrize("tau", [0.92, 0.3, -1.0])
@pytest.mark.parametrize("block", [16, 4096])
def test_knn_is_exact_for_any_blocking(spark, tau, block):
    m = clustered(1, 12, 10)
    ids = random.Random(2).sample(range(1000), len(m))
    got = spark_knn(spark, ids, m, k=5, min_sim=tau, block_rows=block)
    assert got == brute(ids, m, 5, tau)


def test_knn_with_a_hot_group_of_copies(spark):
    m = np.vstack([clustered(4, 6, 5), np.tile(clustered(5, 1, 1), (40, 1))])
    ids = random.Random(3).sample(range(500), len(m))
    got = spark_knn(spark, ids, m, k=10, min_sim=0.5, block_rows=8)
    assert got == brute(ids, m, 10, 0.5)


def test_knn_with_one_crowded_cell(spark):
    m = np.vstack([clustered(6, 1, 60, spread=0.02), clustered(7, 10, 4)])
    ids = list(range(len(m)))
    got = spark_knn(spark, ids, m, k=4, min_sim=0.92, block_rows=8)
    assert got == brute(ids, m, 4, 0.92)


@pytest.mark.parametrize("tau", [0.92, -1.0])
def test_blocks_meet_without_copies_of_vectors(spark, monkeypatch, tau):
    """Each vector is stored in one block, blocks meet without a shuffle, and each vector gets its best back once a task."""
    made, meeting = [], vectors._meeting_blocks

    def meet(blocks, *args):
        made.append((blocks, meeting(blocks, *args)))
        return made[-1][1]

    monkeypatch.setattr(vectors, "_meeting_blocks", meet)
    m = np.vstack([clustered(8, 1, 300, spread=0.05), clustered(9, 20, 5)])
    ids = random.Random(4).sample(range(5000), len(m))
    assert spark_knn(spark, ids, m, k=4, min_sim=tau, block_rows=32) == brute(ids, m, 4, tau)
    blocks, partial = made[0]
    assert sum(len(r.reps) // 8 for r in blocks.collect()) == len(m) and blocks.count() > 10
    assert "Exchange hash" not in partial._jdf.queryExecution().executedPlan().toString()
    assert partial.count() <= 4 * len(m) * partial.rdd.getNumPartitions()


def test_knn_ties_and_zero_vectors(spark):
    m = np.array([[1, 0], [0, 1], [1, 0], [0, -1], [0, 0], [1, 1]], dtype="float32")
    for tau in (0.0, 0.7, -1.0):
        got = spark_knn(spark, [5, 3, 9, 1, 4, 2], m, k=3, min_sim=tau, block_rows=2)
        assert got == brute([5, 3, 9, 1, 4, 2], m, 3, tau)


def test_knn_of_nothing(spark):
    df = spark.createDataFrame([], "id long, v array<float>")
    assert vectors.knn(df, "id", "v").count() == 0


def visits_of(tree, m, reach):
    """Widen the tree to what lies in its cells; (row, cell) of all visits."""
    for cell, angle, branch in zip(*tree.assign(m)):
        tree.widen(cell, angle + reach, branch + reach)
    return [(r, c) for rows, cells in tree.visits(m) for r, c in zip(rows.tolist(), cells.tolist())]


def test_pivots_prune_far_cells():
    """Well separated groups: a row visits few cells, not all of them."""
    m = clustered(8, 20, 30, dim=16, spread=0.02).astype("float64")
    tree = vectors.CellTree(unit(m[::30]))
    assert len(visits_of(tree, m, np.arccos(0.92))) < 20 * len(m) / 4


def test_two_levels_of_pivots_save_angles_and_lose_no_pair():
    rng = np.random.default_rng(9)
    centres = np.vstack([c + 0.1 * rng.normal(size=(40, 24)) for c in unit(rng.normal(size=(12, 24)))])
    m = unit(np.vstack([c + 0.02 * rng.normal(size=(10, 24)) for c in centres]))
    pivots = unit(m[rng.permutation(len(m))[:256]])
    tree = vectors.CellTree(pivots)
    cell = tree.assign(m)[0]
    # Branches and the pivots of one branch, in place of all pivots.
    assert tree.angles < len(m) * len(pivots) / 4
    reach = float(np.arccos(0.92 - 1e-8) + 1e-6)
    tree = vectors.CellTree(pivots)
    met = set(visits_of(tree, m, reach))
    assert tree.angles < 2 * len(m) * len(pivots) / 3
    near = np.argwhere(np.round(m @ m.T, 9) >= 0.92)
    assert len(near) > 5 * len(m)
    assert all((i, cell[j]) in met for i, j in near.tolist())


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_small_trees_and_equal_pivots(n):
    rng = np.random.default_rng(n)
    m = unit(rng.normal(size=(30, 4)))
    tree = vectors.CellTree(np.vstack([m[:n], m[:n]]))
    assert {c for _, c in visits_of(tree, m, 4.0)} == set(tree.assign(m)[0].tolist())


def pairs_of(lists):
    return {(i, j) for i, near in lists.items() for j, _ in near}


def test_approximate_join_finds_nearly_all(spark):
    """Groups of very different size, one of them a third of all rows."""
    rng = np.random.default_rng(11)
    groups = [clustered(20 + g, 1, int(n), dim=32, spread=0.03) for g, n in enumerate([900, *rng.integers(2, 40, 80)])]
    m = np.vstack(groups)
    m = np.vstack([m, np.tile(m[:1], (12, 1))])
    ids = random.Random(5).sample(range(10**6), len(m))
    exact = pairs_of(brute(ids, m, 10, 0.92))
    df = spark.createDataFrame(
        [(int(i), [float(x) for x in v]) for i, v in zip(ids, m)], "id long, v array<float>"
    ).repartition(3)
    rows = vectors.approximate_knn(df, "id", "v", block_rows=128).collect()
    sims = unit(m) @ unit(m).T
    at = {i: n for n, i in enumerate(ids)}
    assert all(abs(r.sim - sims[at[r.id], at[r.neighbour]]) < 1e-6 and r.sim >= 0.92 for r in rows)
    found = {(r.id, r.neighbour) for r in rows}
    assert max(r["rank"] for r in rows) <= 9 and len(rows) == len(found)
    assert len(found & exact) >= 0.9 * len(exact)


def test_approximate_join_of_little(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0]), (4, None), (5, [1.0, 0.0])], "id long, v array<float>")
    found = {(r.id, r.neighbour) for r in vectors.approximate_knn(df, "id", "v").collect()}
    assert found == {(1, 5), (5, 1), (1, 2), (2, 1), (5, 2), (2, 5)}
    assert vectors.approximate_knn(df.limit(0), "id", "v").count() == 0


def test_hashed_vectors(spark):
    texts = ["Dinner Set", "dinner set ", "Dinner Sets", "Gear pump", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    v = {r.id: np.array(r.vector) for r in vectors.embed_hashed(df, "t").collect()}
    assert np.array_equal(v[0], v[1])
    assert np.isclose(v[0] @ v[0], 1)
    assert v[0] @ v[2] > 0.8 > v[0] @ v[3]
    assert not v[5].any() and len(v[5]) == 256


def test_ngrams_cover_the_whole_text():
    encode = vectors.hashed_ngrams(64)()
    long = "ab" * 30_000 + "\u03a9\U0001d11e"
    assert encode([long])[0].sum() == len(long)
    assert not np.array_equal(encode([long]), encode([long[:-1] + "x"]))


def test_user_encoder(spark):
    def make():
        def encode(texts):
            return np.array([[len(t), 1.0] for t in texts])

        return encode

    df = spark.createDataFrame([(1, "aaa"), (2, "a")], "id long, t string")
    got = {r.id: r.vector for r in vectors.embed(df, "t", make, batch=1).collect()}
    assert np.allclose(got[1], unit([[3, 1]])[0]) and np.allclose(got[2], unit([[1, 1]])[0])


def sequential_leaders(ids, lists):
    visited, out = set(), {}
    for i in sorted(ids):
        if i in visited:
            continue
        visited.add(i)
        for j in lists.get(i, []):
            if j not in visited:
                visited.add(j)
                out[j] = i
    return out


def edges_frame(spark, lists):
    rows = [(i, j, 1.0 - 0.01 * n, n + 1) for i, js in lists.items() for n, j in enumerate(js)]
    return spark.createDataFrame(rows, "id long, neighbour long, sim double, rank int")


@pytest.mark.parametrize("seed, block", [(0, 50_000), (1, 4), (2, 7), (3, 20)])
def test_leaders_equal_the_sequential_loop(spark, seed, block):
    rng = random.Random(seed)
    n = 60
    lists = {i: rng.sample([j for j in range(n) if j != i], rng.randint(0, 3)) for i in range(n)}
    got = clusters.leader_assignment(edges_frame(spark, lists), block)
    assert {r.member: r.leader for r in got.collect()} == sequential_leaders(range(n), lists)


def test_chain_is_not_closed_transitively(spark):
    lists = {1: [2], 2: [1, 3], 3: [2, 4], 4: [3]}
    got = {r.member: r.leader for r in clusters.leader_assignment(edges_frame(spark, lists)).collect()}
    assert got == {2: 1, 4: 3}


def test_smallest_leader_wins_and_hub_is_aggregated(spark):
    lists = {i: [1000] for i in range(300)}
    got = clusters.leader_assignment(edges_frame(spark, lists)).collect()
    assert [(r.member, r.leader) for r in got] == [(1000, 0)]


def test_chain_of_many_rounds_and_of_one(spark):
    lists = {i: [i + 1] for i in range(12)}
    got = {r.member: r.leader for r in clusters.leader_assignment(edges_frame(spark, lists)).collect()}
    assert got == {i + 1: i for i in range(0, 12, 2)}
    lists = {0: [2], 1: [2]}  # decided in the first round: the smallest leader only
    got = [(r.member, r.leader) for r in clusters.leader_assignment(edges_frame(spark, lists)).collect()]
    assert got == [(2, 0)]


def test_rounds_follow_blocks_and_not_the_chain(spark, monkeypatch):
    rounds = []
    stage_at = clusters.stage_at
    monkeypatch.setattr(clusters, "stage_at", lambda df, name: rounds.append(name) or stage_at(df, name))
    far = 1 << 60  # ids beyond what a double holds
    lists = {far + i: [far + i + 1] for i in range(400)} | {i: [i + 1, 5000] for i in range(1000, 1400)}
    got = {r.member: r.leader for r in clusters.leader_assignment(edges_frame(spark, lists), 200).collect()}
    assert got == sequential_leaders(lists, lists)
    assert len(rounds) - 1 <= 5  # 801 listed ids in blocks of 200; the first write is no round


def test_no_edges_no_clusters(spark):
    empty = edges_frame(spark, {1: [2]}).where("id > 5")
    assert clusters.cluster_table(clusters.leader_assignment(empty)).count() == 0


def test_cluster_order(spark):
    lists = {7: [9, 8], 1: [5, 3], 3: [1]}
    table = clusters.cluster_table(clusters.leader_assignment(edges_frame(spark, lists)))
    named = table.withColumn("name", F.concat(F.lit("n"), "member_id"))
    got = {r.cluster_id: r.members for r in clusters.cluster_lists(named, "name").collect()}
    assert got == {"cluster_0000": ["n1", "n5", "n3"], "cluster_0001": ["n7", "n9", "n8"]}


def test_single_precision_decides_nothing(monkeypatch):
    monkeypatch.setattr(vectors, "_PRECISE", 7)
    rng = np.random.default_rng(6)
    # Similarities that differ by less than single precision can tell, around the threshold and among the best.
    base = unit(rng.normal(size=(1, 40)))
    across = unit(rng.normal(size=(400, 40)) * [0.0, *[1.0] * 39])
    across = unit(across - (across @ base.T) * base)
    cos = np.concatenate([0.92 + rng.integers(-20, 20, 200) * 4e-9, 0.97 + rng.integers(0, 20, 200) * 4e-9])
    right = cos[:, None] * base + np.sqrt(1 - cos**2)[:, None] * across
    for rows, k in ((right, 10), (right[:200], 300)):
        row, other, sim = vectors._merged_top_k(k, 0.92)(vectors._NOTHING, base, np.arange(1), np.arange(len(rows)), rows)
        exact = np.round((base @ rows.T)[0], vectors.DIGITS)
        best = [j for j in np.lexsort((np.arange(len(rows)), -exact)) if exact[j] >= 0.92][:k]
        assert other.tolist() == best and sim.tolist() == exact[best].tolist()


# --- the join over n-grams

def gram_vectors(text, n):
    padded = f" {text.strip().lower()} "
    return collections.Counter(padded[i:i + n] for i in range(len(padded) - n + 1))


def brute_grams(rows, n, k, tau):
    made = {i: gram_vectors(t, n) for i, t in rows if t is not None}
    made = {i: v for i, v in made.items() if v}
    norm = {i: sum(c * c for c in v.values()) for i, v in made.items()}
    out = {}
    for i, v in made.items():
        near = []
        for j, w in made.items():
            sim = round(sum(c * w[g] for g, c in v.items()) / math.sqrt(norm[i] * norm[j]), 9)
            if i != j and sim >= tau:
                near.append((-sim, j))
        out[i] = [(j, -s) for s, j in sorted(near)[: k - 1]]
    return {i: v for i, v in out.items() if v}


def names(seed, size):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(4, 9))) for _ in range(30)]
    out = []
    for _ in range(size):
        words = [rng.choice(stems) for _ in range(rng.randrange(1, 6))]
        if rng.random() < 0.5 and out:
            words = out[rng.randrange(len(out))].split() or words
            words[rng.randrange(len(words))] += rng.choice(["s", "x", ""])
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("tau, limit", [(0.92, None), (0.7, 6), (0.92, 3), (0.3, 0)])
def test_gram_join_equals_all_pairs(spark, tau, limit):
    texts = names(4, 150) + [None, "", "a", "  ", "ab", "AB ", "ab"] + ["crowded name of many"] * 15 + ["crowded name of manys"] * 3
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "id long, t string").repartition(3)
    found = {}
    for r in grams.gram_join(df, "id", "t", k=6, min_sim=tau, long_posting=limit, block_rows=40).orderBy("id", "rank").collect():
        found.setdefault(r.id, []).append((r.neighbour, r.sim))
    expected = brute_grams(rows, 3, 6, tau)
    assert found.keys() == expected.keys()
    for i, near in expected.items():
        assert [j for j, _ in found[i]] == [j for j, _ in near]
        assert all(abs(s - r) < 2e-9 for (_, s), (_, r) in zip(found[i], near))


def test_gram_index_is_stored_once_and_blocks_meet_without_a_shuffle(spark, monkeypatch):
    stored = {}

    def keep(df, name, **options):
        out, path = stages.stage_at(df, name, **options)
        stored[name] = df._jdf.queryExecution().executedPlan().toString(), out.collect() if "blocks" in name else []
        return out, path

    monkeypatch.setattr(grams, "stage_at", keep)
    monkeypatch.setattr(grams, "stage", lambda df, name: keep(df, name)[0])
    # A crowd: all texts share n-grams, and each has near ones.
    rows = [(i, f"the very same beginning of them all {i % 40:03d} {'x' * (i % 3)}") for i in range(240)]
    found = {}
    for r in grams.gram_join(spark.createDataFrame(rows, "id long, t string"), "id", "t", k=4, min_sim=0.9, long_posting=3, block_rows=20).orderBy("id", "rank").collect():
        found.setdefault(r.id, []).append(r.neighbour)
    assert found == {i: [j for j, _ in near] for i, near in brute_grams(rows, 3, 4, 0.9).items()}
    held = [text for block in stored["grams-blocks"][1] for text in block.texts]
    assert len(held) == len(set(held)) == 120 and len(stored["grams-blocks"][1]) > 2
    plan = stored["grams-nearest"][0]
    met = plan[plan.index("MapInArrow"):]
    assert "Exchange hash" not in met and ("CartesianProduct" in met or "BroadcastNestedLoopJoin" in met)


def test_gram_blocks_hold_texts_of_one_size_and_others_do_not_meet(spark, monkeypatch):
    stored, met = {}, []

    def keep(df, name, **options):
        out, path = stages.stage_at(df, name, **options)
        stored[name] = out.collect() if "blocks" in name else []
        return out, path

    meeting = grams._meeting
    monkeypatch.setattr(grams, "stage_at", keep)
    monkeypatch.setattr(grams, "_meeting", lambda *args: met.append(args) or meeting(*args))
    rng = random.Random(11)
    rows = []
    for size in [8, 40, 160] * 10:  # near pairs of three sizes, dealt in turn; some repeat themselves
        words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(size)]
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join([*words, "x"]) * rng.choice([1, 1, 4]))]
    df = spark.createDataFrame(rows, "id long, t string").repartition(3)
    found = {}
    for r in grams.gram_join(df, "id", "t", k=4, min_sim=0.9, block_rows=8).orderBy("id", "rank").collect():
        found.setdefault(r.id, []).append(r.neighbour)
    assert found == {i: [j for j, _ in near] for i, near in brute_grams(rows, 3, 4, 0.9).items()}
    blocks = stored["grams-blocks"]
    pairs = [(a, b) for a in blocks for b in blocks if a.block <= b.block]
    near = [(a, b) for a, b in pairs if a.least <= b.most and b.least <= a.most]
    assert len(met) == 1 and len(near) < 0.6 * len(pairs)


def test_support_is_the_least_that_a_near_text_needs():
    rng = np.random.default_rng(2)
    for _ in range(300):
        counts = rng.integers(1, rng.integers(2, 40), rng.integers(1, 60))
        tau = rng.choice([0.3, 0.7, 0.92, 1.0])
        held = np.sqrt(np.cumsum(np.sort(counts.astype(float))[::-1] ** 2) / (counts.astype(float) ** 2).sum())
        support, least = grams._support(counts, tau)
        assert support == len(counts) and (least == 1 or held[least - 2] < tau) and held[least - 1] >= tau - 1e-8


def test_gram_join_of_nothing(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, t string")
    assert grams.gram_join(df, "id", "t").count() == 0 and grams.gram_join(df.limit(0), "id", "t").count() == 0
    with pytest.raises(ValueError):
        grams.gram_join(df, "id", "t", min_sim=0.0)


def test_packed_vectors_are_the_same_bit_for_bit():
    rng = np.random.default_rng(3)
    for kind in ("float32", "float64"):
        m = np.vstack([rng.integers(0, 9, (5, 400)) / 7, rng.normal(size=(3, 400)), np.zeros((1, 400)), np.full((1, 400), -0.0)]).astype(kind)
        packed = vectors._packed(pa.array(list(m)))
        assert np.array_equal(vectors._unpacked(packed), vectors._unit(m.astype("float64")))
        assert np.array_equal(vectors._unpacked(packed.slice(2)), vectors._unit(m[2:].astype("float64")))
        assert max(map(len, packed.to_pylist()[:5])) < m[0].nbytes / 3
    assert vectors._packed(pa.array(list(m)).slice(3)).to_pylist() == packed.to_pylist()[3:]


def test_approximate_join_returns_short_lists(spark, monkeypatch):
    """One list for each row of a table, of the vector's best in three blocks, not one for each pair of blocks."""
    m = clustered(31, 1, 600, spread=0.02)
    compared = vectors._beside(4, 0.92, 64)
    codes = vectors.Codes(unit(m), 3, 10)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "rep long, vec array<float>").repartition(1)
    coded = vectors._coded(df, codes, 1).coalesce(1).sortWithinPartitions("table", "code", "rep")
    found = coded.mapInArrow(compared, "rep long, others array<long>, sims array<double>").collect()
    assert len(found) == 600 * 3 * 2 and max(len(r.others) for r in found) == 4
    sims = unit(m) @ unit(m).T
    assert all(abs(sims[r.rep, o] - s) < 1e-6 and list(r.sims) == sorted(r.sims, reverse=True) for r in found for o, s in zip(r.others, r.sims))
