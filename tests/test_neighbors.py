import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from decisionkit.operators import anomaly as A
from decisionkit.operators import imbalance as I
from decisionkit.operators import neighbors as N
from decisionkit.operators.neighbors import knn_join


def brute(queries, refs, k, exclude_self):
    out = {}
    for qid, q in queries:
        pairs = [(round(float(np.sqrt(((q - r) ** 2).sum())), 6), rid) for rid, r in refs if not (exclude_self and rid == qid)]
        out[qid] = sorted(pairs)[:k]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in rows], "id long, vector array<double>")


@pytest.mark.parametrize("dims,exclude_self,pivots", [(2, True, None), (2, False, 3), (16, True, 5)])
def test_knn_matches_brute_force(spark, dims, exclude_self, pivots):
    rng = np.random.default_rng(dims)
    rows = list(enumerate(rng.normal(size=(160, dims))))
    rows += [(200 + i, np.ones(dims)) for i in range(80)]  # a third of the rows are copies
    rows += [(400, np.full(dims, 1e5))]  # a far outlier
    refs = rows if exclude_self else rows[::2]
    got = knn_join(
        frame(spark, rows), frame(spark, refs), 6, exclude_self=exclude_self, pivots=pivots, query_block=16, reference_block=24
    )
    found = {r["id"]: [(n["distance"], n["id"]) for n in r["neighbours"]] for r in got.collect()}
    assert found == brute(rows, refs, 6, exclude_self)


def test_knn_with_fewer_references_than_k(spark):
    rows = [(i, np.array([float(i)])) for i in range(4)]
    got = knn_join(frame(spark, rows), frame(spark, rows), 10, exclude_self=True)
    assert {r["id"]: len(r["neighbours"]) for r in got.collect()} == {0: 3, 1: 3, 2: 3, 3: 3}


def test_references_are_copied_once_per_block_of_queries(spark, monkeypatch):
    rows = list(enumerate(np.random.default_rng(4).normal(size=(600, 32))))  # no structure: every group reaches every reference
    sent, plain = [], N._sent
    monkeypatch.setattr(N, "_sent", lambda df, groups: sent.append(plain(df, groups)) or sent[-1])
    monkeypatch.setattr(N, "SENT_ROWS", 50)
    got = knn_join(frame(spark, rows), frame(spark, rows), 3, exclude_self=True, query_block=200)
    assert {r["id"]: [(n["distance"], n["id"]) for n in r["neighbours"]] for r in got.collect()} == brute(rows, rows, 3, True)
    assert 600 <= sent[0].count() <= 6 * 600  # two packs together hold more than a block


def test_knn_without_queries(spark):
    rows = frame(spark, enumerate(np.ones((5, 2))))
    assert knn_join(rows.filter("id < 0"), rows, 2).count() == 0


def minority_frame(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"id": np.arange(300), "y": (np.arange(300) % 6 == 0).astype(int), "a": rng.integers(0, 20, 300),
                        "c": rng.choice(["u", "v"], 300)})
    df = spark.createDataFrame(pdf)
    return pdf, df.withColumn("vector", F.array(F.col("a").cast("double")))


@pytest.mark.parametrize("hot_rows", [10, 100_000])
def test_resampling_reaches_parity(spark, hot_rows):
    pdf, df = minority_frame(spark)
    small = int(pdf["y"].sum())
    under = I.undersample(df, "id", hot_rows=hot_rows).groupBy("y").count().toPandas().set_index("y")["count"].to_dict()
    assert under == {0: small, 1: small}
    copies = I.oversample_copies(df, "id", hot_rows=hot_rows)
    over = I.repeat_rows(copies).groupBy("y").count().toPandas().set_index("y")["count"].to_dict()
    assert over == {0: 300 - small, 1: 300 - small}
    made = I.smote(df, "id", "vector", ["a"], ["c"], k=3, hot_rows=hot_rows).toPandas()
    assert len(made) == 300 - 2 * small
    minority = pdf[pdf["y"] == 1].set_index("id")
    assert set(made["base"]) <= set(minority.index) and set(made["neighbour"]) <= set(minority.index)
    a0, a1 = minority["a"][made["base"]].to_numpy(), minority["a"][made["neighbour"]].to_numpy()
    assert ((made["a"] >= np.minimum(a0, a1) - 1e-9) & (made["a"] <= np.maximum(a0, a1) + 1e-9)).all()
    assert set(made["c"]) <= {"u", "v"}


def test_class_weights_sum_to_row_count(spark):
    _, df = minority_frame(spark)
    total = I.balanced_weights(df).agg(F.sum("weight")).first()[0]
    assert abs(total - 300) < 1e-9


def test_detectors_rank_the_outliers_first(spark):
    rng = np.random.default_rng(5)
    train = frame(spark, enumerate(rng.normal(size=(400, 2))))
    new = frame(spark, [(1000, [0.0, 0.1]), (1001, [0.3, -0.2]), (1002, [9.0, 9.0])])
    nodes = A.fit_isolation_forest(train, 40)
    assert nodes.groupBy("tree").agg(F.max("sample").alias("s")).filter("s > 256").count() == 0
    for scores in (A.score_isolation_forest(new, nodes), A.local_outlier_factor(train, new, 10)):
        ranked = scores.orderBy(F.col("score").desc()).toPandas()
        assert ranked["id"].iloc[0] == 1002
    again = A.score_isolation_forest(new, A.fit_isolation_forest(train.repartition(3), 40))
    first = A.score_isolation_forest(new, nodes)
    assert {r["id"]: r["score"] for r in first.collect()} == {r["id"]: r["score"] for r in again.collect()}


@pytest.mark.parametrize("n", [400, 9000])
def test_isolation_trees_draw_from_the_whole_table(spark, n):
    """Few rows meet many trees, many rows one tree at most; either way far points stand out."""
    from decisionkit.operators import anomaly as A

    rng = np.random.default_rng(0)
    rows = [(i, [float(v) for v in rng.normal(size=2)]) for i in range(n)]
    train = spark.createDataFrame(rows, "id long, vector array<double>")
    nodes = A.fit_isolation_forest(train, 12, key="id")
    new = spark.createDataFrame([(0, [0.0, 0.0]), (1, [9.0, -9.0])], "id long, vector array<double>")
    score = {r["id"]: r["score"] for r in A.score_isolation_forest(new, nodes, "id").collect()}
    assert score[1] > 0 > score[0] and nodes.select("tree").distinct().count() == 12


def clustered(n, centres=40, width=16, seed=3):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(centres, width)) * 4
    return middle[draw.integers(0, centres, n)] + draw.normal(size=(n, width))


@pytest.mark.parametrize("blocks", [{}, {"query_block": 64, "reference_block": 100}])
def test_hash_tables_find_nearly_all(spark, blocks):
    x = clustered(3000)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, vector array<double>").cache()
    found = N.approximate_knn_join(df, df, 10, exclude_self=True, bucket_rows=64, **blocks).cache()
    facts = N.neighbour_recall(found, N.knn_join(df, df, 10, exclude_self=True)).first()
    assert facts["queries"] == 3000 and facts["recall"] > 0.95 and facts["better_than_exact"] == 0
    rows = {r["id"]: r["neighbours"] for r in found.collect()}
    assert all(len({n["id"] for n in ns}) == len(ns) and i not in {n["id"] for n in ns} for i, ns in rows.items())
    assert all(abs(n["distance"] - np.sqrt(((x[i] - x[n["id"]]) ** 2).sum())) < 1e-5 for i in range(0, 3000, 300) for n in rows[i])


def test_copies_do_not_grow_with_rows(spark):
    """A reference is filed once per table and a query asked once per table and probe at any size."""
    draw = np.random.default_rng(1)
    for n in (300, 1200):
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(clustered(n))], "id bigint, vector array<double>")
        axes = [draw.normal(size=(max(16, n // 20), 16)) for _ in range(4)]
        assert N._hashed(df, axes, 1).count() == 4 * n and N._hashed(df, axes, 6).count() == 24 * n


def test_hash_tables_on_odd_rows(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(50)] + [(50, [1.0, 3.0])], "id bigint, vector array<double>")
    got = {r["id"]: [n["id"] for n in r["neighbours"]] for r in N.approximate_knn_join(same, same, 3, exclude_self=True, probes=16).collect()}
    assert len(got) == 51 and got[7] == [0, 1, 2] and got[0] == [1, 2, 3] and got[50] == [0, 1, 2]
    none = same.limit(0)
    assert N.approximate_knn_join(none, none, 3).count() == 0
    assert all(r["neighbours"] == [] for r in N.approximate_knn_join(same, none, 3).collect())


def copies_sent(spark, monkeypatch, x, **blocks):
    """(rows, copies of queries that go to other cells, neighbours)."""
    sent, plain = [], N._sent
    with monkeypatch.context() as m:
        m.setattr(N, "_sent", lambda df, groups: sent.append(plain(df, groups)) or sent[-1])
        rows = list(enumerate(x))
        got = {r["id"]: [(n["distance"], n["id"]) for n in r["neighbours"]] for r in knn_join(frame(spark, rows), frame(spark, rows), 3, exclude_self=True, **blocks).collect()}
    assert got == brute(rows, rows, 3, True)
    return sum(s.count() for s in sent)


def test_queries_meet_few_cells_in_few_dimensions(spark, monkeypatch):
    x = np.random.default_rng(6).normal(size=(1500, 2))
    assert copies_sent(spark, monkeypatch, x, query_block=100) < 1500  # a sixteenth of the cells lies around a query


def test_nothing_is_copied_where_every_query_meets_every_cell(spark, monkeypatch):
    x = np.random.default_rng(7).normal(size=(400, 40))
    assert copies_sent(spark, monkeypatch, x, query_block=20) == 0


@pytest.mark.parametrize("width", [3, 40])
def test_radius_and_small_cells_change_nothing(width):
    draw = np.random.default_rng(width)
    q, r, ids = draw.normal(size=(300, width)).round(1), draw.normal(size=(1500, width)).round(1), draw.permutation(1500)
    r[5], q[9] = np.nan, np.nan
    within = np.round(np.sqrt(((q[:, None] - r[None]) ** 2).sum(2)), 6)
    for radius in (None, np.full(300, np.nanquantile(within, 0.01)), np.full(300, np.inf)):
        row, found, distance = N._search(q, r, ids, 4, radius)
        for i in range(300):
            near = sorted((d, j) for d, j in zip(within[i], ids.tolist()) if d <= (np.inf if radius is None else radius[i]))[:4]
            assert list(zip(distance[row == i], found[row == i])) == near


def test_vectors_that_share_an_id_share_its_list(spark):
    x = np.random.default_rng(8).normal(size=(300, 2))
    rows = [(i % 290, v) for i, v in enumerate(x)]
    got = knn_join(frame(spark, rows), frame(spark, rows), 3, query_block=40)
    lists = {}
    for i, v in rows:
        lists.setdefault(i, []).extend(sorted((round(float(np.sqrt(((v - r) ** 2).sum())), 6), j) for j, r in rows)[:3])
    for r in got.collect():
        assert [(n["distance"], n["id"]) for n in r["neighbours"]] == sorted(lists[r["id"]])[:3]
