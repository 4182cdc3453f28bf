import numpy as np
import pytest

from reviewcraft.llm import itq

SCHEMA = "vec_id long, embedding array<float>, label int"


def rows(seed=0, n=60, dims=16):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        base = rng.standard_normal(dims)
        out.append((len(out), base.tolist(), i % 3))
        for _ in range(i % 4):
            near = base + rng.standard_normal(dims) * rng.choice([0.05, 0.2, 0.4])
            out.append((len(out), near.tolist(), i % 3))
    out += [(1000 + i, out[5][1], out[5][2]) for i in range(5)]
    out += [(2000, out[5][1], None), (2001, None, 1), (2002, [], 1), (2003, [0.0] * dims, 1)]
    out += [(2004, [float("nan")] + [1.0] * (dims - 1), 1), (2005, [None] + [1.0] * (dims - 1), 1)]
    out += [(2006, [float("inf")] + [1.0] * (dims - 1), 1), (2007, [1.0, 2.0], 1), (2008, [2.0, 4.0], 1)]
    out += [(None, out[8][1], out[8][2]), out[12], out[12]]
    return out


def plain(table, threshold=0.93):
    units = []
    for _, vector, label in table:
        ok = vector and label is not None and None not in vector and np.isfinite(vector).all()
        v = np.array(vector, dtype=np.float32).astype(float) if ok else np.zeros(1)
        norm = np.linalg.norm(v)
        units.append(v / norm if norm else None)
    n, root, links = len(table), list(range(len(table))), [0] * len(table)
    for i in range(n):
        for j in range(i):
            a, b = units[i], units[j]
            if a is None or b is None or len(a) != len(b) or table[i][2] != table[j][2]:
                continue
            if a @ b >= threshold:
                links[i] += 1
                links[j] += 1
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    out = []
    for i in range(n):
        ids = [table[j][0] for j in range(n) if root[j] == root[i] and table[j][0] is not None]
        out.append((table[i][0], links[i], min(ids, default=None)))
    return out


@pytest.mark.parametrize("cell", [4096, 3])
def test_against_all_pairs(spark, cell):
    table = rows()
    params = itq.ItqParams(recall=0.9999, cell_vectors=cell)
    found = itq.vector_links(spark.createDataFrame(table, SCHEMA), params).collect()
    got = sorted(str((r["vec_id"], r["n_links"], r["component_id"])) for r in found)
    assert got == sorted(map(str, plain(table)))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found if r["vec_id"] is not None)


def test_production_recall(spark):
    table = rows(3, 400)
    found = itq.vector_links(spark.createDataFrame(table, SCHEMA)).collect()
    links = {r["vec_id"]: r["n_links"] for r in found}
    expected = {i: n for i, n, _ in plain(table)}
    assert all(links[i] <= n for i, n in expected.items())
    assert sum(links.values()) >= 0.9 * sum(expected.values())


def test_rotation_lowers_the_quantisation_error():
    rng = np.random.default_rng(1)
    sample = rng.standard_normal((500, 8)) * np.array([4, 3, 2, 1, 1, 1, 1, 0.5])

    def loss(rounds):
        mean, projection = itq.learn_rotation(sample, 8, rounds, 3)
        values = (sample - mean) @ projection
        return float(((np.sign(values) - values) ** 2).sum())

    assert loss(30) < loss(0)


def test_table_shape_grows_with_the_table():
    few, many = itq.table_shape(1000, itq.ItqParams()), itq.table_shape(10**9, itq.ItqParams())
    assert few[0] == 8 and many[0] > 20 and many[1] > few[1]


def test_empty_and_clashing_columns(spark):
    assert itq.vector_links(spark.createDataFrame([], SCHEMA)).count() == 0
    clash = spark.createDataFrame([(1, [1.0], 1, 5)], f"{SCHEMA}, node int")
    assert [tuple(r) for r in itq.vector_links(clash).collect()] == [(1, 0, 1, True)]


def common_mean(length, n, dims=64, cosine=0.93, seed=5):
    """Unit vectors around a common mean of that length, each with a partner at the cosine."""
    rng = np.random.default_rng(seed)
    mean = np.eye(dims)[0] * length
    units = mean + np.sqrt(1 - length**2) * rng.standard_normal((n, dims)) / np.sqrt(dims)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    away = rng.standard_normal((n, dims))
    away -= (away * units).sum(axis=1, keepdims=True) * units
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    return units, cosine * units + np.sqrt(1 - cosine**2) * away


@pytest.mark.parametrize("length", [0.0, 0.71, 0.84])
@pytest.mark.parametrize("vectors", [200, 100_000])
def test_recall_with_a_common_mean(length, vectors):
    units, near = common_mean(length, 3000)
    index = itq.learn_index(np.concatenate([units, near]), vectors, itq.ItqParams())
    met = (index.substrings(units) == index.substrings(near)).any(axis=1)
    print("recall", length, vectors, index.substring_bits, index.tables, met.mean())
    assert met.mean() >= 0.95


def test_links_with_a_common_mean(spark):
    units, near = common_mean(0.84, 150, cosine=0.9301)
    table = [(i, v.tolist(), 1) for i, v in enumerate(np.concatenate([units, near]))]
    found = itq.vector_links(spark.createDataFrame(table, SCHEMA)).collect()
    got, expected = sum(r["n_links"] for r in found), sum(n for _, n, _ in plain(table))
    print("links", got, expected)
    assert 0.93 * expected <= got <= expected
