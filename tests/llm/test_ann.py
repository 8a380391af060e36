import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from ledgerloom.llm import ann


def brute(rows, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in ok:
        if i % 20 == 0:
            scored = sorted((-float((q * v).sum()), j) for j, v in ok if j != i)[:k]
            out[i] = [(j, -s) for s, j in scored]
    return out


def run(spark, rows, k=20):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, vec string").repartition(4)
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, k).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: [(v, s) for _, v, s in sorted(x)] for q, x in got.items()}


def test_odd_vectors_and_copies(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    copy = rng.normal(size=8).tolist()
    rows += [(i, copy) for i in range(300, 500)]
    rows += [(500, None), (501, [0.0] * 8), (520, [float("nan")] * 8), (540, [float("inf")] + [1.0] * 7), (560, [None] + [1.0] * 7), (580, [1.0] * 3), (None, [1.0] * 8)]
    want = brute(rows, 20)
    got = run(spark, [(i, v, 1, "clash") for i, v in rows])
    assert set(got) == set(want)
    found = 0
    for q, near in want.items():
        assert len(got[q]) == 20 and q not in [v for v, _ in got[q]]
        assert got[q] == sorted(got[q], key=lambda x: (-x[1], x[0]))
        found += len({v for v, _ in near} & {v for v, _ in got[q]})
    assert found / (20 * len(want)) > 0.95
    for q in (300, 320, 480):  # ties among copies go to the smaller ids
        assert [v for v, _ in got[q]] == [v for v, _ in want[q]]


def test_few_and_none(spark):
    got = run(spark, [(0, [1.0, 0.0], 1, ""), (1, [0.5, 0.5], 1, ""), (2, [0.0, 1.0], 1, "")])
    assert got == {0: [(1, 0.5), (2, 0.0)]}
    assert run(spark, [(0, None, 1, "")]) == {}


def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    table = df.orderBy("vec_id").toPandas()
    x, ids = np.stack(table["embedding"]).astype(float), table["vec_id"].to_numpy()
    got = ann.nearest(df, F.col("vec_id") % 20 == 0).toPandas()
    by = got.groupby("query_id")["vec_id"].apply(set)
    hit = n = 0
    for row in np.flatnonzero(ids % 20 == 0):
        s = x @ x[row]
        s[row] = -np.inf
        hit += len(set(ids[np.lexsort((ids, -s))[:20]]) & by[ids[row]])
        n += 20
    assert hit / n >= 0.9
    index = ann.build_index(df.withColumn("place", F.lit(1)).withColumnRenamed("embedding", "vec"))
    # This table has hardly any clusters: the ratio keeps most of its lists, but each query still chooses among them.
    assert index.lists == 31 and met_share(index, x, np.flatnonzero(ids % 20 == 0)) < 1


def test_graph_search_finds_nearest():
    rng = np.random.default_rng(0)
    centroids = rng.normal(size=(500, 8))
    graph = ann.CentroidGraph(centroids)
    q = rng.normal(size=(40, 8))
    ids, d = graph.search(q, 32)
    true = np.sqrt(((q[:, None] - centroids[None]) ** 2).sum(axis=2))
    assert (ids[:, 0] == true.argmin(axis=1)).mean() > 0.97
    assert np.allclose(np.take_along_axis(true, ids, axis=1), d, atol=1e-3)


def test_bisection_is_balanced():
    x = np.random.default_rng(0).normal(size=(1000, 4))
    assert ann.balanced_centroids(x, 37).shape == (37, 4)


def recall_and_scan(spark, path, x, every, bound):
    """Recall@20 against brute force, the share of stored entries that a query meets, and replicas a vector."""
    n = len(x)
    pq.write_table(pa.table({"vec_id": np.arange(n), "embedding": pa.array(list(x.astype(np.float32)))}), path, row_group_size=n // 8)
    df = spark.read.parquet(path).repartition(8)
    x = x.astype(np.float32).astype(float)
    got = ann.nearest(df, F.col("vec_id") % every == 0, bound=bound).toPandas()
    by = got.groupby("query_id")["vec_id"].apply(set)
    hit = 0
    for row in range(0, n, every):
        s = x @ x[row]
        s[row] = -np.inf
        hit += len(set(np.argpartition(s, -20)[-20:]) & by[row])
    index = ann.build_index(df.withColumn("place", F.lit(1)).withColumnRenamed("embedding", "vec"), bound)
    queries = np.arange(0, n, every)
    assert (got.groupby("query_id").size() == 20).all() and set(by.index) == set(queries)
    return hit / (20 * len(queries)), met_share(index, x, queries), len(index.dealt(x, True)[0]) / n, len(index.dealt(x[queries], False)[0]) / len(queries) / index.lists


def met_share(index, x, queries, k=20):
    """The share of all stored entries that a query is scored against: its first lists, then those whose zone can reach its bar."""
    rows, lists, _, _ = index.dealt(x, True)
    order = np.argsort(lists, kind="stable")
    rows, ends = rows[order], np.searchsorted(lists[order], np.arange(index.lists + 1))
    of, probed, near, most = index.dealt(x[queries], False)
    met = 0
    for q in range(len(queries)):
        own = of == q
        first = np.unique(np.concatenate([rows[ends[c] : ends[c + 1]] for c in probed[own & near]]))
        scores = np.sort(x[first] @ x[queries[q]])[::-1]
        bar = scores[k] if len(scores) > k else -np.inf
        met += sum(ends[c + 1] - ends[c] for c in probed[own & (near | (most >= bar))])
    return met / len(queries) / len(rows)


def test_recall_without_clusters(spark, tmp_path):
    """60,000 vectors without clusters: the ratio alone decides; it keeps many lists, but not most."""
    x = np.random.default_rng(11).normal(size=(60_000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    recall, _, replicas, probed = recall_and_scan(spark, str(tmp_path / "v.parquet"), x, 300, ann.IndexBound())
    assert recall >= 0.9 and replicas > 1.2 and probed < 0.5


def test_recall_with_clusters(spark, tmp_path):
    """Where there are clusters, under 15 percent of the entries are met."""
    rng = np.random.default_rng(12)
    centers = rng.normal(size=(600, 32))
    x = centers[rng.integers(0, 600, 60_000)] + 0.3 * rng.normal(size=(60_000, 32))
    recall, scanned, replicas, probed = recall_and_scan(spark, str(tmp_path / "v.parquet"), x, 300, ann.IndexBound())
    assert recall >= 0.9 and scanned < 0.15 and replicas > 1.2 and probed < 0.15


def test_long_lists_are_divided(spark, tmp_path):
    """With few centroids for the table, lists get centroids of their own, and queries go to some of their parts."""
    rng = np.random.default_rng(13)
    centers = rng.normal(size=(300, 16))
    x = centers[rng.integers(0, 300, 30_000)] + 0.3 * rng.normal(size=(30_000, 16))
    bound = ann.IndexBound(max_lists=6, part_rows=400)
    assert recall_and_scan(spark, str(tmp_path / "v.parquet"), x, 300, bound)[0] >= 0.9


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(df, F.col("vec_id") % 20 == 0).count() == 0


def test_repeated_ids(spark):
    """One row 50 times, one id with 50 vectors, every row twice: limits count ids."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] * 2
    rows += [(i, (9 * x[0]).tolist()) for i in (20, 500)] + [(500, (9 * x[0]).tolist())] * 50 + [(0, x[0].tolist())] * 50
    rows += [(501, (5 * x[40] + 0.01 * v).tolist()) for v in rng.normal(size=(50, 8))] + [(40, v.tolist()) for v in rng.normal(size=(3, 8))]
    best = {}
    for q, a in rows:
        if q % 20 == 0:
            for j, b in rows:
                if j != q:
                    best.setdefault(q, {})[j] = max(best.get(q, {}).get(j, -np.inf), float((np.array(a) * np.array(b)).sum()))
    got = run(spark, [(i, v, 1, "") for i, v in rows])
    assert set(got) == set(best)
    for q, scores in best.items():
        want = sorted(scores.items(), key=lambda s: (-s[1], s[0]))[:20]
        assert len({v for v, _ in got[q]}) == 20
        assert np.allclose([s for _, s in got[q]], [s for _, s in want]) and [v for v, _ in got[q]] == [v for v, _ in want]


def test_uneven_norms(spark, tmp_path):
    """Log-normal norms and one vector much longer than all others: zones of norms keep most entries out of sight."""
    rng = np.random.default_rng(14)
    centers = rng.normal(size=(300, 64))
    x = centers[rng.integers(0, 300, 20_000)] + 0.3 * rng.normal(size=(20_000, 64))
    x *= (np.exp(0.5 * rng.normal(size=20_000)) / np.linalg.norm(x, axis=1))[:, None]
    x[17] *= 20 / np.linalg.norm(x[17])
    recall, scanned, _, _ = recall_and_scan(spark, str(tmp_path / "v.parquet"), x, 100, ann.IndexBound())
    assert recall >= 0.9 and scanned < 0.3


def test_one_long_vector(spark, tmp_path):
    """Unit vectors without clusters beside one of norm 20."""
    x = np.random.default_rng(15).normal(size=(20_000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[17] *= 20
    recall, scanned, _, _ = recall_and_scan(spark, str(tmp_path / "v.parquet"), x, 100, ann.IndexBound())
    assert recall >= 0.9 and scanned < 0.3


def test_each_length_is_answered_within_itself(spark):
    """Lengths with zones of their own and, past `lengths`, those with one list, which is divided where it is long."""
    rng = np.random.default_rng(16)
    rows = [(i, rng.normal(size=2 + i % 4).tolist()) for i in range(1200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    for bound in (ann.IndexBound(), ann.IndexBound(lengths=1, norms=2), ann.IndexBound(lengths=1, part_rows=64)):
        got = {}
        for r in ann.nearest(df, F.col("vec_id") % 20 == 0, 20, bound=bound).collect():
            got.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
        hit = 0
        for i, q in rows[::20]:
            scores = {j: float(np.dot(q, v)) for j, v in rows if j != i and len(v) == len(q)}
            assert len(got[i]) == 20 and all(abs(scores[j] - s) < 1e-9 for j, s in got[i].items())
            hit += len(set(sorted(scores, key=lambda j: (-scores[j], j))[:20]) & set(got[i]))
        assert hit / (20 * 60) >= 0.9


def test_queries_probe_on_until_k_are_met(spark):
    """Lists of about two rows and one probe a zone: every query still gets 20."""
    rng = np.random.default_rng(17)
    df = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(600)], "vec_id long, embedding array<double>")
    bound = ann.IndexBound(list_rows=4, least_probes=1, prune=1.0, replicas=1)
    counts = ann.nearest(df, F.col("vec_id") % 20 == 0, bound=bound).groupBy("query_id").count().collect()
    assert len(counts) == 30 and all(r["count"] == 20 for r in counts)


def test_norms_of_any_size():
    x = np.array([[3.0, 4.0], [1e300, 1e300], [5e-324, 0.0], [1.7e308, 1.7e308]])
    assert np.allclose(ann.norms(x)[:2], [5, 2**0.5 * 1e300]) and (ann.norms(x) > 0).all() and np.isfinite(ann.norms(x)).all()
    assert ann.norm_bands(np.array([1 - 1e-7, 1 + 1e-7])).tolist() == [0, 0]


def test_a_small_table_is_no_single_group(spark, tmp_path):
    """2,000 clustered vectors: queries choose among lists at this size too."""
    rng = np.random.default_rng(18)
    x = rng.normal(size=(40, 32))[rng.integers(0, 40, 2_000)] + 0.3 * rng.normal(size=(2_000, 32))
    recall, scanned, _, _ = recall_and_scan(spark, str(tmp_path / "v.parquet"), x, 20, ann.IndexBound())
    assert recall >= 0.9 and scanned < 0.6
