"""Embedding groups against all pairs in double precision; recall at the threshold."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kenning.llm.embedding import Forest, block_edges, candidates, embedding_groups, links


def brute(rows, threshold=0.9):
    ids = [r[0] for r in rows]
    vecs = [np.array(v, float) if v and all(x is not None and np.isfinite(x) for x in v) and any(v) else None for _, v in rows]
    n, root = len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    links = [0] * n
    for a in range(n):
        for b in range(a + 1, n):
            x, y = vecs[a], vecs[b]
            if x is not None and y is not None and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links[a] += 1
                links[b] += 1
                root[find(b)] = find(a)
    low = {}
    for i in range(n):
        low.setdefault(find(i), []).append(ids[i])
    out = []
    for i in range(n):
        c = min((x for x in low[find(i)] if x is not None), default=None)
        out.append((ids[i], links[i], c, ids[i] == c))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:2], str(r)))


def test_groups(lspark):
    rng = np.random.default_rng(0)
    rows, i = [], 0
    for _ in range(60):
        c = rng.standard_normal(64)
        for k in range(rng.integers(1, 5)):
            rows.append((i, (c + k * 0.2 * rng.standard_normal(64)).astype(np.float32).tolist()))
            i += 1
    rows += [(i, rows[0][1]), (i + 1, [2 * x for x in rows[0][1]]), (i + 2, rows[0][1]), (i + 2, rows[0][1]), (None, rows[0][1])]
    rows += [(500, None), (501, []), (502, [0.0] * 64), (503, [float("nan")] * 64), (504, [float("inf")] + [0.0] * 63),
             (505, [None] + [1.0] * 63), (506, [1.0, 0.0]), (507, [1.0, 0.01]), (508, [0.0] * 64), (None, None)]
    df = lspark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 as node", "2 as vec", "3 as kept")
    want = [(r[0], [None if x is None else float(np.float32(x)) for x in r[1]] if r[1] else r[1]) for r in rows]
    assert order(map(tuple, embedding_groups(df).collect())) == order(brute(want))


def test_sql_on_linked_vectors():
    """The given tables have hardly a link: the query's SQL on chains and copies, held against all pairs."""
    import duckdb
    import pyarrow as pa

    from kenning.llm.queries import ORACLE
    rng = np.random.default_rng(1)
    vecs = []
    for _ in range(30):
        v = rng.standard_normal(64)
        for _ in range(rng.integers(1, 7)):
            vecs.append(v.astype(np.float32).tolist())
            v = v + 0.4 * rng.standard_normal(64)  # a chain: its ends are not linked
    vecs += [vecs[0], None, [], [0.0] * 64, [float("nan")] * 64, [float("inf")] * 64, [None] + [1.0] * 63, [1.0, 0.0], [1.0, 0.01]]
    ids = rng.permutation(len(vecs)).tolist()
    embeddings = pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(vecs, pa.list_(pa.float32()))})
    con = duckdb.connect()
    con.register("embeddings", embeddings)
    got = con.execute(f"SELECT vec_id, n_links, component_id, kept FROM ({ORACLE['op8_embedding_dedup']})").fetchall()
    want = brute(list(zip(ids, vecs)))
    assert sorted(got) == sorted(want) and sum(r[1] for r in want) > 50 and any(r[1] == 1 and not r[3] for r in want)


def test_given_table(lspark):
    df = lspark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert order(map(tuple, embedding_groups(df).collect())) == order(brute(rows))


@pytest.mark.parametrize("dim", [2, 7, 64, 128, 384, 768])
def test_candidates_hold_every_link(dim):
    """Pairs of exactly the threshold are candidates in every dimension, and blocks leave
    few others: shares add up to the whole."""
    rng = np.random.default_rng(dim)
    x, z = rng.standard_normal((2, 1500, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(1 - 0.81) * z / np.linalg.norm(z, axis=1, keepdims=True)
    found = [set(zip(a.tolist(), b.tolist())) for a, b in candidates(x, y, 0.9, False)]
    assert all((i, i) in set().union(*found) for i in range(len(x)))
    assert sum(e - s for s, e in block_edges(dim)) == dim
    if dim >= 64:
        assert sum(map(len, found)) < 1500 + 0.001 * 1500 ** 2


def test_forest_connects_what_links_connect():
    rng = np.random.default_rng(3)
    for _ in range(50):
        i, j = rng.integers(0, 40, (2, 60))
        i, j = i[i != j], j[i != j]
        pairs = np.array(sorted({(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist())}))
        times = rng.integers(1, 5, 40)
        f = Forest(40)
        for part in np.array_split(pairs, 3):
            f.add(part[:, 0], part[:, 1], times)
        weight = np.zeros(40, int)
        root = list(range(40))
        for a, b in pairs.tolist():
            weight[a] += times[b]
            weight[b] += times[a]
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
        assert f.weight.tolist() == weight.tolist() and f.root.tolist() == root
        assert len(f.edges) == 40 - len(set(root)) and {(min(e), max(e)) for e in f.edges} <= set(map(tuple, pairs.tolist()))


def test_empty(lspark):
    df = lspark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert embedding_groups(df).count() == 0


def test_no_link_is_lost_in_any_dimension(lspark):
    """Pairs just above and just below cosine 0.9, in one tile and across many."""
    rng = np.random.default_rng(5)
    rows, want, node = [], set(), 0
    for dim in (64, 128, 256, 384):
        for k in range(60):
            x, z = rng.standard_normal((2, dim))
            x /= np.linalg.norm(x)
            z -= (z @ x) * x
            cos = 0.9 + (1e-6 if k % 4 else -1e-6)
            rows += [(node, x.tolist()), (node + 1, (cos * x + np.sqrt(1 - cos * cos) * z / np.linalg.norm(z)).tolist())]
            want |= {(node, node + 1)} if k % 4 else set()
            node += 2
    df = lspark.createDataFrame(rows, "node bigint, vec array<double>").withColumn("n", F.lit(1).cast("bigint"))
    for tile_rows in (4096, 100):
        found = links(df, 0.9, tile_rows=tile_rows).collect()
        assert sorted((min(r.a, r.b), max(r.a, r.b)) for r in found if r.b is not None) == sorted(want)
        assert sorted((r.a, r.m) for r in found if r.b is None) == sorted((x, 1) for p in want for x in p)


def test_a_hot_group_gives_a_forest(lspark):
    """1,000 vectors that all link: as many rows as vectors, not as links."""
    rng = np.random.default_rng(9)
    rows = [(i, (np.ones(64) + 0.05 * rng.standard_normal(64)).tolist()) for i in range(1000)]
    df = lspark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = embedding_groups(df).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(999, 0)} and sum(r.kept for r in got) == 1
    classes = df.select(F.col("vec_id").alias("node"), F.col("embedding").alias("vec"), F.lit(1).cast("bigint").alias("n"))
    assert links(classes, 0.9, tile_rows=300).count() <= 2 * 4 * 2 * 1000
