"""Blocked alternating least squares equals the joined one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.operators import blocked_als as BA
from keelson.operators import recommend as RC


def table(spark, seed=3, users=25, items=18):
    rng = np.random.default_rng(seed)
    rows = [(u, f"i{i}", float(rng.integers(1, 6))) for u in range(users) for i in range(items) if rng.random() < 0.3 or u == 0 or i == 1]
    return spark.createDataFrame(rows, "user long, item string, rating double").repartition(3)


def start(rt, k):
    X = rt.select("item").distinct().select("item", *[F.sin(F.length("item") + F.lit(f)).alias(f"x{f}") for f in range(k)])
    T = rt.select("user").distinct().select("user", *[F.cos(F.col("user") * k + F.lit(f)).alias(f"t{f}") for f in range(k)])
    return X, T


@pytest.mark.parametrize("chunk", [20_000, 4])
def test_factors_and_costs_equal_the_joined_sweeps(spark, monkeypatch, chunk):
    monkeypatch.setattr(BA, "CHUNK", chunk)
    k, lam = 2, 0.7
    rt = table(spark)
    X0, T0 = start(rt, k)
    X, T, hist = RC.train_als(rt, X0, T0, k, lam, iters=2)
    odd = rt.unionByName(spark.createDataFrame([(None, "i1", 3.0), (3, None, 1.0), (4, "i2", None), (5, "i3", float("nan"))], rt.schema))
    X2, T2, hist2 = BA.train(odd, T0, k, lam, iters=2)
    assert X2.columns == X.columns and T2.columns == T.columns
    assert [J for _, J in hist2] == pytest.approx([J for _, J in hist], rel=1e-9)
    for a, b in ((X, X2), (T, T2)):
        got, want = ({r[0]: list(r[1:]) for r in d.collect()} for d in (b, a))
        assert got.keys() == want.keys()
        for i in want:
            assert got[i] == pytest.approx(want[i], rel=1e-7, abs=1e-9)


def test_a_half_step_moves_less_than_the_ratings(spark):
    k = 2
    rows = spark.range(40_000).select((F.col("id") % 400).alias("user"), ((F.col("id") * 7919) % 97).alias("item"), (F.col("id") % 5).cast("double").alias("rating"))
    side = BA.deal(rows, "user", "item", "rating", 40_000)
    _, T0 = start(rows.withColumn("item", F.col("item").cast("string")), k)
    routes = side.routes.agg(F.sum(F.size("blocks"))).first()[0]
    numbers = routes * (k + 1) + 400 * (k * (k + 1) // 2 + k + 2)
    assert numbers < 40_000 * 3 / 5
    plan = side.rows.groupBy("block").cogroup(side.rows.groupBy("block")).applyInArrow(lambda a, b: a, side.rows.schema)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_no_ratings(spark):
    rt = table(spark).limit(0)
    T0 = spark.createDataFrame([(1, 0.5)], "user long, t0 double")
    X, T, hist = BA.train(rt, T0, 1, 1.0, iters=1)
    assert X.count() == T.count() == 0 and hist == [(1, 0.0)]


def plain_sweeps(rows, T, k, lam, iters):
    """Joined sweeps: a null id matches nothing, a null rating is 0 in the factors and not in the cost."""
    def side(at, other, fixed):
        out = {}
        for e in {r[at] for r in rows}:
            mine = [(fixed[r[other]], r[2]) for r in rows if r[at] == e and r[other] is not None and r[other] in fixed]
            if mine:
                V, y = np.array([v for v, _ in mine]), np.array([y or 0.0 for _, y in mine])
                out[e] = np.linalg.solve(V.T @ V + lam * np.eye(k), V.T @ y)
        return out
    hist = []
    for _ in range(iters):
        X = side(1, 0, T)
        T = side(0, 1, X)
        err = [X[i] @ T[u] - y for u, i, y in rows if None not in (u, i, y) and u in T and i in X]
        hist.append(0.5 * np.sum(np.square(err)) + 0.5 * lam * sum(v @ v for d in (X, T) for v in d.values()))
    return X, T, hist


@pytest.mark.parametrize("chunk", [20_000, 4])
def test_joined_sweeps_repeat_no_factors_and_keep_null_rows(spark, monkeypatch, chunk):
    monkeypatch.setattr(BA, "CHUNK", chunk)
    monkeypatch.setattr(BA, "COUNTED", 2)
    monkeypatch.setattr(BA, "SLICE", 7)

    def no_join(*_):
        raise AssertionError("factor rows repeated for every salt")
    monkeypatch.setattr(RC, "salted_join", no_join)
    k, lam = 2, 0.7
    odd = [(None, "i1", 3.0), (3, None, 1.0), (4, "i2", None), (0, "i3", None), (6, "i1", 2.0), (6, "i1", 2.0)]
    rt = table(spark).unionByName(spark.createDataFrame(odd, "user long, item string, rating double"))
    rows = [tuple(r) for r in rt.collect()]
    T0 = {u: np.cos(u * k + np.arange(k)) for u in {r[0] for r in rows} if u is not None}
    X, T, hist = RC.train_als(rt, None, start(rt.filter("user is not null"), k)[1], k, lam, iters=2)
    X1, T1, hist1 = plain_sweeps(rows, T0, k, lam, 2)
    assert [J for _, J in hist] == pytest.approx(hist1, rel=1e-9)
    for got, want in ((X, X1), (T, T1)):
        got = {r[0]: list(r[1:]) for r in got.collect()}
        assert got.keys() == want.keys() and None in got
        for i in want:
            assert got[i] == pytest.approx(list(want[i]), rel=1e-7, abs=1e-9)


def test_factors_are_packed_by_block():
    import pyarrow as pa
    rows = pa.RecordBatch.from_pydict({"other": ["a", "b", "c"], "f": [[1.0, 2.0], [3.0, 4.0], [5.0, 6.0]], "blocks": [[2, 0], [2], [0, 2]]},
                                      pa.schema({"other": pa.string(), "f": pa.list_(pa.float64()), "blocks": pa.list_(pa.int32())}))
    got = [r for b in BA.packed([rows.slice(0, 0), rows, rows.slice(1, 1)]) for r in b.to_pylist()]
    assert got == [{"block": 0, "others": ["a", "c"], "f": [1.0, 2.0, 5.0, 6.0]},
                   {"block": 2, "others": ["a", "b", "c"], "f": [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]},
                   {"block": 2, "others": ["b"], "f": [3.0, 4.0]}]


def test_both_sides_come_from_one_table_and_only_cut_sums_move(spark, monkeypatch):
    rt = table(spark)
    users, items = BA.deal_both(rt, "user", "item", "rating", rt.count())
    one = BA.deal(rt, "user", "item", "rating", rt.count())
    routes = lambda s: {r["other"]: sorted(r["blocks"]) for r in s.routes.collect()}
    assert routes(users) == routes(one) and not users.cuts
    T = start(rt, 2)[1].select(F.col("user").alias("id"), F.array("t0", "t1").alias("f"))
    plan = BA.half_step(items, T, 2, 1.0)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    monkeypatch.setattr(BA, "CHUNK", 2)
    monkeypatch.setattr(BA, "COUNTED", 1)
    assert BA.deal_both(rt, "user", "item", "rating", rt.count())[0].cuts


@pytest.mark.parametrize("chunk", [20_000, 4])
def test_normalise_deals_hot_items_without_repeating_means(spark, monkeypatch, chunk):
    monkeypatch.setattr(BA, "CHUNK", chunk)
    monkeypatch.setattr(BA, "COUNTED", 1)
    monkeypatch.setattr(RC, "salted_join", None)
    odd = [(3, None, 1.0), (None, "i1", 4.0), (4, "i2", None), (5, "none", None)]
    rt = table(spark).unionByName(spark.createDataFrame(odd, "user long, item string, rating double"))
    rows = [tuple(r) for r in rt.collect() if r[1] is not None]
    mean = {i: np.mean([y for _, j, y in rows if j == i and y is not None] or [np.nan]) for i in {r[1] for r in rows}}
    got = RC.normalise(rt)
    assert got.columns == ["item", "user", "rating", "norm"]
    want = {(u, i): None if y is None else y - mean[i] for u, i, y in rows}
    have = {(r["user"], r["item"]): r["norm"] for r in got.collect()}
    assert have.keys() == want.keys() and got.count() == len(rows)
    assert all(have[p] is None if want[p] is None else have[p] == pytest.approx(want[p], abs=1e-12) for p in want)


def test_block_numbers_are_dealt_to_partitions_of_their_own(spark):
    for blocks in (1, 7, 54):
        numbers = spark.createDataFrame([(n,) for n in BA.numbers(spark, blocks)], "n int").repartition(blocks, "n")
        assert numbers.select(F.spark_partition_id().alias("p")).distinct().count() == blocks


@pytest.mark.parametrize("chunk", [20_000, 4])
def test_ratings_dealt_by_item_stay_there_for_means_and_the_items_side(spark, monkeypatch, chunk):
    from keelson.session import cut_partitioned
    monkeypatch.setattr(BA, "CHUNK", chunk)
    monkeypatch.setattr(BA, "COUNTED", 1)
    monkeypatch.setattr(BA, "IDS", 3)
    k, lam, blocks = 2, 0.7, 5
    odd = [(None, "i1", 3.0), (3, None, 1.0), (4, "i2", None), (6, "i1", 2.0)]
    rt = table(spark).unionByName(spark.createDataFrame(odd, "user long, item string, rating double"))
    own = BA.placed(rt, "item", "user", blocks, "item")[0]
    own = cut_partitioned(own, blocks, "item_block", order=("item", "item_part"))
    norm = RC.normalise(own)
    shuffles = lambda df: [s for s in df._jdf.queryExecution().executedPlan().toString().splitlines()
                           if "Exchange hashpartitioning" in s]
    assert len(shuffles(norm)) == 1  # the means of cut items alone
    plain = RC.normalise(rt)
    key = lambda r: (r["user"] is None, r["user"], r["item"], r["rating"] or 0.0)
    got, want = (sorted(d.select("user", "item", "rating", "norm").collect(), key=key) for d in (norm, plain))
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert all(a is b if b is None else a == pytest.approx(b, abs=1e-12) for a, b in zip((r[3] for r in got), (r[3] for r in want)))

    written, plans = BA.cut_partitioned, []

    def seen(df, parts, *keys):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plans.append(shuffles(df.repartition(parts, *keys)))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        return written(df, parts, *keys)
    monkeypatch.setattr(BA, "cut_partitioned", seen)
    normed = lambda d: d.drop("rating").withColumnRenamed("norm", "rating")
    T0 = start(rt.filter("user is not null"), k)[1]
    X, T, hist = RC.train_als(normed(norm), None, T0, k, lam, iters=2, blocks=blocks)
    of_means = 1
    assert len(plans[0]) == 1 + of_means and len(plans[1]) == of_means  # users move, items don't
    X1, T1, hist1 = RC.train_als(normed(plain), None, T0, k, lam, iters=2)
    assert [J for _, J in hist] == pytest.approx([J for _, J in hist1], rel=1e-9)
    for a, b in ((X, X1), (T, T1)):
        got, want = ({r[0]: list(r[1:]) for r in d.collect()} for d in (a, b))
        assert got.keys() == want.keys()
        assert all(got[i] == pytest.approx(want[i], rel=1e-7, abs=1e-9) for i in want)


@pytest.mark.parametrize("chunk", [20_000, 4])
def test_recommendations_come_from_ratings_dealt_once(spark, monkeypatch, tmp_path, chunk):
    from keelson.plans import q_recsvm as Q
    monkeypatch.setattr(BA, "CHUNK", chunk)
    monkeypatch.setattr(BA, "COUNTED", 1)
    rng = np.random.default_rng(8)
    li = [(int(o), int(p), float(q)) for o, p, q in zip(rng.integers(0, 60, 400), rng.integers(0, 25, 400) ** 2 // 25, rng.integers(1, 51, 400))]
    li += li[:40] + [(None, 3, 9.0), (5, None, 9.0), (6, None, 12.0), (7, 4, None), (999, 4, 1.0)]
    orders = [(o, o % 17 if o % 20 else None) for o in range(60)] + [(None, 4)]
    sf = str(tmp_path)
    spark.createDataFrame(li, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{sf}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{sf}/orders.parquet")
    plain = Q.ratings(spark, sf)
    own, blocks = Q.ratings_by_item(spark, sf)
    rows = lambda d: sorted(map(repr, d.select("user_id", "item_id", "rating").collect()))
    assert rows(own) == rows(plain) and own.rdd.getNumPartitions() == blocks
    assert (own.filter("item_part is not null").count() > 0) == (chunk == 4)
    norm = RC.normalise(plain, item="item_id", user="user_id").drop("rating").withColumnRenamed("norm", "rating")
    X0, T0 = Q.init_factors(plain)
    X, T, _ = RC.train_als(norm, X0, T0, Q.K, Q.LAM, iters=3, user="user_id", item="item_id")
    top = plain.groupBy("user_id").count().orderBy(F.col("count").desc(), "user_id").first()["user_id"]
    t = T.filter(F.col("user_id") == top).first()
    want = RC.recommend_for_user(X, [t[f"t{f}"] for f in range(Q.K)], RC.item_mean(plain, item="item_id").select("item_id", "mean_rating"),
                                 10, Q.K, item="item_id").collect()
    monkeypatch.setattr(Q, "ratings", None)
    got = Q.recommend_trained(spark, sf).collect()
    assert [(r["rank"], r["item_id"]) for r in got] == [(r["rank"], r["item_id"]) for r in want]
    assert [r["prediction"] for r in got] == pytest.approx([r["prediction"] for r in want], abs=1e-7)
