"""Implicit-feedback ALS recommender: split, fit, predict, top-N, RMSE, and a
sweep over the number of latent factors.

Built on ``pyspark.ml.recommendation.ALS`` (block-partitioned ALS: user and
item factors are shuffled between blocks, never collected). The train/test
split is a hash of the key, so it does not depend on partitioning and is the
same after an executor is lost.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quill.sources.scratch import files_released, written

# The settings of the original runs.
DEFAULT_RANKS = (10, 20, 30, 40, 50, 60)
MAX_ITER = 10
ALPHA = 0.01
REG_PARAM = 0.01
SPLIT_SEED = 1001
TRAIN_TENTHS = 8
TOP_N = 10
CHECKPOINT_INTERVAL = 5


def as_triples(df: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    """``(user INT, item INT, rating FLOAT)``; ALS needs 32-bit ids. Casting is
    ANSI-checked, so an id outside the int range fails instead of wrapping."""
    return df.select(F.col(user).cast("int").alias("user"), F.col(item).cast("int").alias("item"),
                     F.col(rating).cast("float").alias("rating"))


def index_ids(df: DataFrame, col: str, out: str = "idx") -> DataFrame:
    """``(col, out INT)``: dense 0-based ids in ascending order of ``col``.

    ALS needs 32-bit ids; catalogue keys can be wider. The numbering is a
    distributed global index (range-partitioned sort plus per-partition
    offsets), and the cast to INT is ANSI-checked, so more than 2^31
    distinct values fail loudly."""
    from quill.operators.ratings import global_index
    ids = df.select(col).where(F.col(col).isNotNull()).distinct()
    return global_index(ids, [F.col(col).asc()], out).withColumn(out, F.col(out).cast("int"))


def hash_split(triples: DataFrame, seed: int = SPLIT_SEED, train_tenths: int = TRAIN_TENTHS,
               keys: tuple[str, str] = ("user", "item")) -> tuple[DataFrame, DataFrame]:
    """(train, test): a row is in train when its tenth (see :func:`split_tenth`)
    is below ``train_tenths``. Deterministic per key, whatever the partitioning
    and whether the ids arrive as int or long."""
    marked = triples.withColumn("_b", split_tenth(seed, keys))
    return (marked.where(F.col("_b") < train_tenths).drop("_b"),
            marked.where(F.col("_b") >= train_tenths).drop("_b"))


def split_tenth(seed: int = SPLIT_SEED, keys: tuple[str, str] = ("user", "item")) -> Column:
    """0-9 from the first eight hex digits of the md5 of ``user,item,seed``, which
    any SQL engine can compute as well."""
    text = F.concat_ws(",", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 10


def fit_implicit(train: DataFrame, rank: int = 10, max_iter: int = MAX_ITER, alpha: float = ALPHA,
                 reg_param: float = REG_PARAM, seed: int = SPLIT_SEED, blocks: int | None = None,
                 checkpoint_interval: int = CHECKPOINT_INTERVAL) -> ALSModel:
    """Implicit-preference ALS on ``(user, item, rating)``. Unseen users or
    items are dropped at prediction time.

    Every iteration shuffles all factors twice. Spark can delete these files once a
    checkpoint has cut the lineage of later factors: at ``checkpoint_interval`` 1 the disk
    holds those of one or two iterations, whatever ``max_iter`` is."""
    als = ALS(rank=rank, maxIter=max_iter, alpha=alpha, regParam=reg_param, implicitPrefs=True,
              userCol="user", itemCol="item", ratingCol="rating", seed=seed,
              coldStartStrategy="drop", checkpointInterval=checkpoint_interval)
    if blocks:
        als = als.setNumUserBlocks(blocks).setNumItemBlocks(blocks)
    return als.fit(train)


def predict(model: ALSModel, test: DataFrame) -> DataFrame:
    """``(user, item, rating, prediction)`` for test pairs whose user and item
    were both seen in training."""
    return model.transform(test).select("user", "item", "rating", "prediction")


def rmse(predictions: DataFrame, actual: str = "rating", predicted: str = "prediction") -> DataFrame:
    """One row ``n_test, rmse``: number of pairs and square root of the mean squared difference. (Implicit
    ALS scores are preferences near 0-1, so this compares unlike scales, as
    the original did.)"""
    diff = F.col(actual).cast("double") - F.col(predicted).cast("double")
    return predictions.agg(F.count(diff).alias("n_test"), F.sqrt(F.avg(diff * diff)).alias("rmse"))


def top_n(model: ALSModel, users: DataFrame, n: int = TOP_N, rank: int | None = None) -> DataFrame:
    """``(rank, user, pos, item, score)``: the n best items per requested user,
    best first (``pos`` 1..n). Users not in the model are skipped."""
    recs = model.recommendForUserSubset(users.select(F.col(users.columns[0]).alias("user")), n)
    out = recs.select("user", F.posexplode("recommendations").alias("_p", "_r")).select(
        "user", (F.col("_p") + 1).alias("pos"), F.col("_r.item").alias("item"),
        F.col("_r.rating").alias("score"))
    if rank is not None:
        out = out.select(F.lit(rank).alias("rank"), *out.columns)
    return out


@dataclass
class Fit:
    """One model of a sweep: its rank, pairs tested and error. A sweep that only uses
    its models keeps what the use returned in place of the model."""
    rank: int
    model: ALSModel | None
    n_test: int
    rmse: float | None
    used: DataFrame | None = None


def sweep_fits(triples: DataFrame, ranks: Iterable[int] = DEFAULT_RANKS, at_once: int = 1,
               use: Callable[[ALSModel, int], DataFrame | None] | None = None, **fit_kwargs) -> list[Fit]:
    """One model per rank on the same split, fitted and tested ``at_once`` at a time.

    Both sides of the split are written once (to the shared scratch folder), dealt by user, and
    every fit reads these copies. Fits that run together are submitted from threads of the
    driver, each in a scheduler pool of its own: with ``spark.scheduler.mode=FAIR`` they
    share the executors evenly, otherwise later ones fill what earlier ones leave idle,
    which is much with few blocks or at the end of each half-step. The largest ranks start
    first, so that no long fit is left alone at the end; models and errors are the same as one
    after another, in the order of ``ranks``. Only one row per rank reaches the driver.

    Fits checkpoint their factors in every iteration, and the driver collects garbage
    meanwhile (:func:`quill.sources.scratch.files_released`), so the disk holds the shuffle files
    of the last iterations of ``at_once`` models, not those of the whole sweep. A model that is
    returned keeps its rating blocks, last messages and cached factors for as long as it is
    referred to; with ``use`` (called with model and rank after the test, its result must not
    read the model) each is given up when the next fit starts."""
    fit_kwargs.setdefault("checkpoint_interval", 1)
    train, test = (written(side.repartition("user")) for side in hash_split(triples))
    sc = triples.sparkSession.sparkContext

    def run(rank: int) -> Fit:
        before = sc.getLocalProperty("spark.scheduler.pool")
        sc.setLocalProperty("spark.scheduler.pool", f"rank-{rank}")
        try:
            model = fit_implicit(train, rank=rank, **fit_kwargs)
            err = rmse(predict(model, test)).first()
            if use is None:
                return Fit(int(rank), model, err["n_test"], err["rmse"])
            used = use(model, rank)
            del model
            gc.collect()                                # Python's references first, then those of the JVM
            sc._jvm.System.gc()
            return Fit(int(rank), None, err["n_test"], err["rmse"], used)
        finally:
            sc.setLocalProperty("spark.scheduler.pool", before)

    ranks = list(ranks)
    if at_once <= 1:
        with files_released(triples.sparkSession):
            return [run(rank) for rank in ranks]
    largest_first = sorted(range(len(ranks)), key=lambda at: -ranks[at])
    with files_released(triples.sparkSession), ThreadPoolExecutor(at_once) as pool:
        fits = pool.map(inheritable_thread_target(triples.sparkSession)(run), [ranks[at] for at in largest_first])
        return [fit for _, fit in sorted(zip(largest_first, fits), key=lambda pair: pair[0])]


def rank_sweep(triples: DataFrame, ranks: Iterable[int] = DEFAULT_RANKS, users: DataFrame | None = None,
               n: int = TOP_N, at_once: int = 1, **fit_kwargs) -> tuple[DataFrame, DataFrame | None]:
    """Fit one model per rank on the same split (:func:`sweep_fits`).

    Returns ``(errors, recommendations)``: ``errors`` is ``(rank, n_test, rmse)``,
    one row per rank; ``recommendations`` is the union of :func:`top_n` per
    rank for ``users`` (None when no users are given), written as soon as each model
    is tested: models are given up one by one, so the disk holds the files of about
    ``at_once`` models however many ranks there are."""
    def top_lists(model: ALSModel, rank: int) -> DataFrame | None:
        return None if users is None else written(top_n(model, users, n, rank))

    fits = sweep_fits(triples, ranks, at_once, top_lists, **fit_kwargs)
    errors = triples.sparkSession.createDataFrame([(f.rank, f.n_test, f.rmse) for f in fits], "rank int, n_test long, rmse double")
    recs = None
    if users is not None:
        for f in fits:
            recs = f.used if recs is None else recs.unionByName(f.used)
    return errors, recs


def gram_matrix(factors: DataFrame) -> DataFrame:
    """``(i, j, g)``, ``i <= j``: sums of products of factor components over all rows of
    ``(id, features)``. Products are summed in each task first, so rank^2 / 2 numbers a
    task are shuffled."""
    first = factors.select("features", F.posexplode("features").alias("i", "_x"))
    return (first.select("i", "_x", F.posexplode("features").alias("j", "_y")).where("i <= j")
            .groupBy("i", "j").agg(F.sum(F.col("_x").cast("double") * F.col("_y").cast("double")).alias("g")))


def half_step_residuals(model: ALSModel, train: DataFrame, alpha: float = ALPHA, reg_param: float = REG_PARAM) -> DataFrame:
    """``(user, n, residual)``: how well each user's factors ``x`` solve the last half-step.

    Implicit ALS ends by solving, for fixed item factors ``y``, the normal equations
    ``(Y'Y + sum c y y' + reg n I) x = sum (1 + c) y`` of every user, where ``c = alpha
    |rating|``, the sums run over the user's items (the right one over ratings above 0, of
    which there are ``n``). ``residual`` is the norm of their difference over the norm of the
    right side. A fit that went wrong, or factors that belong to another model, show here.

    The Gram matrix ``Y'Y`` is a distributed sum; it is broadcast (rank bounds its size).
    Ratings meet the item factors first and are then dealt by user once: user factors,
    sums per component and the residual all stay in that dealing."""
    x = model.userFactors.select(F.col("id").alias("user"), F.col("features").alias("x"))
    y = model.itemFactors.select(F.col("id").alias("item"), F.col("features").alias("y"))
    g = gram_matrix(model.itemFactors)
    both = g.unionByName(g.where("i < j").select(F.col("j").alias("i"), F.col("i").alias("j"), "g"))
    row = both.groupBy("i").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "g"))), lambda e: e["g"]).alias("g"))
    whole = row.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "g"))), lambda e: e["g"]).alias("g"))

    def dot(u, v):
        return F.aggregate(F.zip_with(u, v, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, p: s + p)

    c = F.lit(alpha) * F.abs(F.col("rating").cast("double"))
    liked = (F.col("rating") > 0).cast("double")
    rated = (train.where("rating != 0").select("user", "item", "rating").join(y, "item")
             .select("user", "rating", "y").repartition("user").join(x, "user")
             .select("user", "x", "y", (c * dot("x", "y") - (1 + c) * liked).alias("_off"), ((1 + c) * liked).alias("_b"), liked.alias("_one"))
             .select("user", "_off", "_b", "_one", F.posexplode(F.arrays_zip("x", "y")).alias("i", "_xy"))
             .groupBy("user", "i").agg(F.max("_xy.x").alias("x"), F.sum(F.col("_off") * F.col("_xy.y")).alias("off"),
                                       F.sum(F.col("_b") * F.col("_xy.y")).alias("b"), F.sum("_one").alias("n")))
    parts = (rated.groupBy("user").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("i", "x", "off", "b"))).alias("_p"))
             .crossJoin(F.broadcast(whole)))
    own = F.transform("g", lambda line: dot(line, F.col("_p.x")))
    off = F.zip_with(own, F.col("_p"), lambda gx, p: gx + p["off"] + reg_param * F.col("n") * p["x"])
    return parts.select("user", F.col("n").cast("long").alias("n"),
                        F.sqrt(dot(off, off) / dot(F.col("_p.b"), F.col("_p.b"))).alias("residual"))


def residuals_by_block(residuals: DataFrame, blocks: int = 10) -> DataFrame:
    """``(block, n_users, mean, worst)`` per block of users, dealt as the fit deals them."""
    return residuals.groupBy(F.pmod("user", F.lit(blocks)).alias("block")).agg(
        F.count(F.lit(1)).alias("n_users"), F.avg("residual").alias("mean"), F.max("residual").alias("worst"))
