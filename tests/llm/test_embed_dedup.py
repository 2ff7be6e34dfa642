import numpy as np

from shelf.llm import embed_dedup as e


def brute(rows, threshold=0.95):
    good = [i for i, (v, x) in enumerate(rows) if v is not None and x is not None and all(c is not None and np.isfinite(c) for c in x) and any(x)]
    links, parent = {i: 0 for i in range(len(rows))}, list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, i in enumerate(good):
        for j in good[:n]:
            a, b = np.array(rows[i][1]), np.array(rows[j][1])
            if len(a) == len(b) and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= threshold:
                links[i] += 1
                links[j] += 1
                x, y = root(i), root(j)
                if rows[x][0] <= rows[y][0]:
                    parent[y] = x
                else:
                    parent[x] = y
    return sorted((str(v), links[i], str(rows[root(i)][0])) for i, (v, _) in enumerate(rows))


def table(spark, rows):
    return spark.createDataFrame([(i, None if x is None else [None if c is None else float(c) for c in x], 0, 1) for i, x in rows], "vec_id long, embedding array<double>, label int, cls int")


def test_clusters_match_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(6):  # clusters, one of them larger than a window
        centre = rng.standard_normal(16)
        for _ in range((5, 90, 12, 1, 3, 20)[c]):
            rows.append((len(rows), (centre + 0.04 * rng.standard_normal(16)).tolist()))
    rows += [(len(rows) + i, rows[0][1]) for i in range(30)]
    rows += [(500 + i, rng.standard_normal(16).tolist()) for i in range(100)]
    rows += [(900, None), (901, [0.0] * 16), (902, [None] + [1.0] * 15), (903, [float("nan")] * 16), (904, [float("inf")] + [1.0] * 15), (905, []), (None, rows[0][1]), (906, [1.0, 2.0]), (907, [2.0, 4.0])]
    for window, block, tile in ((32, 2048, 1024), (4, 16, 10)):
        got = e.near_vectors(table(spark, rows), window=window, block=block, tile=tile).collect()
        assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == brute(rows)
        assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)


def test_repeated_rows_are_copies(spark):
    got = e.near_vectors(table(spark, [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])])).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 1, 1), (1, 1, 1), (2, 0, 2)]


def test_great_and_small_vectors_link(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal(16)
    rows = [(0, x), (1, x * 1e200), (2, x * 1e-200), (3, -x * 1e300), (4, (x + 0.05 * rng.standard_normal(16)) * 2.0**900)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in e.near_vectors(table(spark, [(i, v.tolist()) for i, v in rows])).collect()}
    assert got == {0: (3, 0), 1: (3, 0), 2: (3, 0), 3: (0, 3), 4: (3, 0)}


def test_links_come_from_the_passes(spark, monkeypatch):
    """Fails if groups that windows can hold are compared beside the passes."""
    rng = np.random.default_rng(6)
    rows = [(6 * c + i, (np.eye(32)[c] + 0.005 * rng.standard_normal(32)).tolist()) for c in range(20) for i in range(6)]
    seen = []
    monkeypatch.setattr(e, "_tile_links", lambda members, *_: seen.append(members.count()) or spark.createDataFrame([], "cls long, links long"))
    got = e.near_vectors(table(spark, rows)).collect()
    assert seen == [0] and all((r.n_links, r.component_id) == (5, r.vec_id // 6 * 6) for r in got)


def test_recall_on_a_whole_table(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    x = np.array([v for _, v in rows], float)
    near = (x @ x.T) / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(x, axis=1)[None, :] >= 0.95
    want = near.sum() - len(x)
    got = e.near_vectors(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")).agg({"n_links": "sum"}).first()[0]
    assert 0.9 * want <= got <= want


def test_empty_table(spark):
    assert e.near_vectors(table(spark, [(1, [1.0])]).where("false")).count() == 0


def planted(rng, n, dense, pairs, low=0.95, high=0.953):
    """n unit vectors of 64 numbers, a third of them at a cosine of about `dense` to each other, with pairs between two cosines."""
    axis = np.eye(64)[0]
    x = rng.standard_normal((n, 64))
    crowd = n // 3
    x[:crowd, 0] = 0
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[:crowd] = np.sqrt(dense) * axis + np.sqrt(1 - dense) * x[:crowd]
    for k in range(pairs):  # within the crowd: the partner differs in a direction across the axis
        a = x[2 * k]
        u = rng.standard_normal(64)
        u[0] = 0
        u -= u @ a * a
        c = rng.uniform(low, high)
        x[2 * k + 1] = c * a + np.sqrt(1 - c * c) * u / np.linalg.norm(u)
    return x


def check_recall(spark, x):
    got = {r.vec_id: r.n_links for r in e.near_vectors(table(spark, [(i, v.tolist()) for i, v in enumerate(x)])).collect()}
    want = np.concatenate([(x[at:at + 2000] @ x.T >= 0.95).sum(1) - 1 for at in range(0, len(x), 2000)])
    assert want.sum() > 500
    assert all(got[i] <= n for i, n in enumerate(want))
    return sum(got.values()) / want.sum()


def test_recall_of_planted_links_in_a_dense_direction(spark):
    for dense in (0.8, 0.9):
        found = check_recall(spark, planted(np.random.default_rng(8), 21_000, dense, 400))
        print("dense", dense, "recall", found)
        assert found >= 0.99


def test_recall_of_planted_links_in_all_directions(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((20_000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    u = rng.standard_normal((500, 64))
    u -= (u * x[:500]).sum(1)[:, None] * x[:500]
    x[500:1000] = 0.951 * x[:500] + np.sqrt(1 - 0.951**2) * u / np.linalg.norm(u, axis=1)[:, None]
    found = check_recall(spark, x)
    print("all directions, recall", found)
    assert found >= 0.99
