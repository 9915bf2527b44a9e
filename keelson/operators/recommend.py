"""Collaborative filtering on a long ratings table (user, item, rating)
(R1-R6, P13).

The rating mask is row presence, so nothing is ever materialised for the
(user x item) grid.  Ratings meet a factor table on (id, salt), the factor
rows repeated for each of SALTS salts, so a user or item with a third of all
ratings is dealt to SALTS tasks; the following sums by id are combined per
task before their shuffle.  Training is alternating least squares with the
exact, UNWEIGHTED penalty of the cost, over blocks (see blocked_als)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.operators.blocked_als import ITEM_PLACE, parts_of, sweeps
from keelson.operators.indexing import top_k as _top_k


# Tasks that a hot user's or item's ratings are dealt to.
SALTS = 16


def salted_join(ratings: DataFrame, other: DataFrame, key: str, by: str) -> DataFrame:
    """``ratings`` joined with one row per ``key`` of ``other``; the ratings of
    a key are dealt by a hash of ``by``."""
    left = ratings.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    right = other.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, [key, "_salt"]).drop("_salt")


def fcols(prefix: str, k: int) -> list[str]:
    return [f"{prefix}{f}" for f in range(k)]


def item_mean(ratings: DataFrame, item: str = "item", rating: str = "rating") -> DataFrame:
    """Mean rating per item over the users who rated it."""
    return ratings.groupBy(item).agg(F.avg(rating).alias("mean_rating"),
                                     F.count(F.lit(1)).alias("n"))


def normalise(ratings: DataFrame, item: str = "item", rating: str = "rating",
              user: str = "user") -> DataFrame:
    """R2: rating - item mean (unrated cells do not exist in the long table, so
    they stay untouched).  An item's ratings meet in one shuffle; the few items
    with very many get their mean by broadcast and are dealt by a hash of
    ``user``.  Ratings that are dealt by item (columns ``ITEM_PLACE``) stay where
    they are.  ``ratings`` is read three times: written, or cheap to read."""
    rows = ratings.filter(F.col(item).isNotNull())
    if set(ITEM_PLACE) <= set(ratings.columns):
        part, block = map(F.col, ITEM_PLACE)
        cut = rows.filter(part.isNotNull()).groupBy(item).agg(F.avg(rating).alias("_mean"))
        mean = F.avg(rating).over(Window.partitionBy(block, item, part))
        return (rows.join(F.broadcast(cut), item, "left")
                .withColumn("norm", F.col(rating) - F.when(part.isNull(), mean).otherwise(F.col("_mean"))).drop("_mean"))
    cut = rows.join(F.broadcast(parts_of(rows, item, user)), item).groupBy(item).agg(
        F.avg(rating).alias("_mean"), F.first("parts").alias("_parts"))
    part = F.coalesce(F.pmod(F.xxhash64(user), F.col("_parts")), F.lit(-1)).cast("int")
    mean = F.avg(rating).over(Window.partitionBy(item, "_part"))
    return (rows.join(F.broadcast(cut), item, "left").withColumn("_part", part)
            .withColumn("norm", F.col(rating) - F.when(F.col("_part") < 0, mean).otherwise(F.col("_mean")))
            .drop("_mean", "_parts", "_part"))


def append_ratings(ratings: DataFrame, new: DataFrame) -> DataFrame:
    """Add a user's ratings to the table."""
    return ratings.unionByName(new)


def _dot(a: list[str], b: list[str]):
    out = None
    for x, y in zip(a, b):
        out = F.col(x) * F.col(y) if out is None else out + F.col(x) * F.col(y)
    return out


def cost(ratings: DataFrame, X: DataFrame, T: DataFrame, k: int, lam: float,
         user: str = "user", item: str = "item", rating: str = "rating") -> DataFrame:
    """1/2 sum over rated (x_i . theta_u - y)^2 + lam/2 (||X||^2 + ||Theta||^2)."""
    xs, ts = fcols("x", k), fcols("t", k)
    j = salted_join(salted_join(ratings, X, item, user), T, user, item)
    err = _dot(xs, ts) - F.col(rating)
    fit = j.agg((F.sum(err * err) / 2.0).alias("fit"))
    rx = X.agg(F.sum(_dot(xs, xs)).alias("rx"))
    rt = T.agg(F.sum(_dot(ts, ts)).alias("rt"))
    row_f, row_x, row_t = fit.first(), rx.first(), rt.first()
    J = (row_f["fit"] or 0.0) + lam / 2.0 * ((row_x["rx"] or 0.0) + (row_t["rt"] or 0.0))
    return ratings.sparkSession.createDataFrame([(float(J),)], "J double")


def gradient(ratings: DataFrame, X: DataFrame, T: DataFrame, k: int, lam: float,
             user: str = "user", item: str = "item", rating: str = "rating") -> DataFrame:
    """(kind, id, f, grad) for item factors ('X') and user factors ('Theta')."""
    xs, ts = fcols("x", k), fcols("t", k)
    j = salted_join(salted_join(ratings, X, item, user), T, user, item) \
        .withColumn("_e", _dot(xs, ts) - F.col(rating))
    gx = j.groupBy(item).agg(*[F.sum(F.col("_e") * F.col(t)).alias(f"g{f}") for f, t in enumerate(ts)])
    gt = j.groupBy(user).agg(*[F.sum(F.col("_e") * F.col(x)).alias(f"g{f}") for f, x in enumerate(xs)])
    gx = X.join(gx, item, "left").select(
        F.lit("X").alias("kind"), F.col(item).cast("long").alias("id"),
        F.array(*[F.coalesce(F.col(f"g{f}"), F.lit(0.0)) + F.lit(lam) * F.col(xs[f])
                  for f in range(k)]).alias("_g"))
    gt = T.join(gt, user, "left").select(
        F.lit("Theta").alias("kind"), F.col(user).cast("long").alias("id"),
        F.array(*[F.coalesce(F.col(f"g{f}"), F.lit(0.0)) + F.lit(lam) * F.col(ts[f])
                  for f in range(k)]).alias("_g"))
    return gx.unionByName(gt).select("kind", "id", F.posexplode("_g").alias("f", "grad"))


def train_als(ratings: DataFrame, X0: DataFrame, T0: DataFrame, k: int, lam: float,
              iters: int = 5, user: str = "user", item: str = "item", rating: str = "rating",
              blocks: int | None = None):
    """Alternating least squares on the exact cost R3, over blocks that the
    ratings are dealt to once (:mod:`keelson.operators.blocked_als`); returns
    (X, T, [(sweep, cost)]).  Entities without ratings keep the minimiser of
    their penalty (0) and are left out.  A rating that is null counts as 0 in
    the factors and not in the cost.  ``blocks``: the ratings are dealt to so many
    by item.  ``ratings`` is read several times: written, or cheap to read."""
    if iters < 1:
        return X0, T0, []
    return sweeps(ratings, T0, k, lam, iters, user, item, rating, blocks)


def recommend_for_user(X: DataFrame, theta: list[float], means: DataFrame, k_top: int,
                       k: int, item: str = "item") -> DataFrame:
    """Predictions x_i . theta_u + item mean for every item, best
    ``k_top`` (ties by item id)."""
    xs = fcols("x", k)
    pred = None
    for x, t in zip(xs, theta):
        term = F.col(x) * F.lit(float(t))
        pred = term if pred is None else pred + term
    scored = X.join(means, item).withColumn("prediction", pred + F.col("mean_rating"))
    return _top_k(scored.select(item, "prediction"), [F.col("prediction").desc(), F.col(item)],
                  k_top)
