"""Cosine similarity between sparse long-form vectors ``(id, term, w)``.

Two vectors meet only through an equi-join on ``term``; the dot product is a
sum of products grouped by the id pair, and pairs that share no non-zero term
are never formed (their cosine is 0). Terms whose weight is 0 are dropped
before the join: they add nothing to a dot product, and they are exactly the
terms present in every document (``log10(N/df) = 0``), the hottest join keys.
The product rows are combined map-side by the partial aggregate before the
shuffle on the id pair.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quill.functions.text import safe_divide
from quill.sources.scratch import drop, files_released, written


def _side(vectors: DataFrame, id_col: str, term: str, w: str, prefix: str) -> DataFrame:
    return (vectors.where(F.col(w).isNotNull() & (F.col(w) != 0))
            .select(F.col(id_col).alias(f"{prefix}_id"), F.col(term).alias("_term"),
                    F.col(w).cast("double").alias(f"{prefix}_w")))


#: products of weights that one task forms and sums, some 100 bytes a pair
PAIR_TASK_ROWS = 1 << 20


def pair_blocks(left: DataFrame, right: DataFrame, term: str = "term", w: str = "w") -> tuple[int, int] | None:
    """Numbers of blocks of left and of right ids for :func:`dot_products`: as many cells as keep one
    at some ``PAIR_TASK_ROWS`` products, and as the session has shuffle partitions. None if a few
    tasks hold all products. One job over the counts per term; both sides should be written."""
    counts = [_side(v, term, term, w, x).groupBy("_term").agg(F.count(F.lit(1)).cast("double").alias(f"_{x}")) for v, x in ((left, "l"), (right, "r"))]
    n, n_left, n_right = counts[0].join(counts[1], "_term").agg(F.sum(F.col("_l") * F.col("_r")), F.sum("_l"), F.sum("_r")).first()
    if not n or n <= 4 * PAIR_TASK_ROWS:
        return None
    cells = max(math.ceil(n / PAIR_TASK_ROWS), int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # a left row goes to every block of right ids and the reverse: least copies where both come to as many
    of_left = min(max(round(math.sqrt(cells * n_left / n_right)), 1), cells)
    return of_left, math.ceil(cells / of_left)


def _cells(side: DataFrame, x: str, of: int, others: int, at) -> DataFrame:
    """Rows of a side in every cell that their block has: ``at(block, k)`` for ``k`` below ``others``."""
    block, k = F.pmod(F.xxhash64(f"{x}_id"), F.lit(of)), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long")))
    return side.where(F.col("_term").isNotNull()).withColumn("_block", block).withColumn("_k", k).withColumn("_cell", at(F.col("_block"), F.col("_k")))


def dot_products_by_cell(l: DataFrame, r: DataFrame, blocks: tuple[int, int], out: tuple[str, str]) -> DataFrame:
    """:func:`dot_products` of two sides, their pairs dealt over a grid of blocks of ids: all
    products of a pair are formed and summed in the task of its cell and are never shuffled. A hot
    term is spread over all cells, so tasks stay bounded whatever the terms are."""
    of_l, of_r = blocks
    l = _cells(l, "l", of_l, of_r, lambda block, k: block * of_r + k)
    r = _cells(r, "r", of_r, of_l, lambda block, k: k * of_r + block)
    none = F.lit(None)
    kinds = {x: dict(side.dtypes)[f"{x}_id"] for x, side in (("l", l), ("r", r))}
    empty = {x: none.cast(f"struct<id:{kinds[x]},w:double>").alias(f"_{x}") for x in "lr"}
    own = {x: F.struct(F.col(f"{x}_id").alias("id"), F.col(f"{x}_w").alias("w")).alias(f"_{x}") for x in "lr"}
    # collect_list leaves nulls out, so each list has the rows of its side
    met = (l.select("_cell", "_term", own["l"], empty["r"]).unionByName(r.select("_cell", "_term", empty["l"], own["r"]))
           .repartition(of_l * of_r, "_cell").groupBy("_cell", "_term")
           .agg(F.collect_list("_l").alias("_ls"), F.collect_list("_r").alias("_rs")))
    return (met.where((F.size("_ls") > 0) & (F.size("_rs") > 0))
            .select("_cell", "_ls", F.explode("_rs").alias("_r")).select("_cell", "_r", F.explode("_ls").alias("_l"))
            .groupBy("_cell", F.col("_l.id").alias(out[0]), F.col("_r.id").alias(out[1]))
            .agg(F.sum(F.col("_l.w") * F.col("_r.w")).alias("dot")).drop("_cell"))


def dot_products(left: DataFrame, right: DataFrame, left_id: str = "id", right_id: str = "id",
                 term: str = "term", w: str = "w", out: tuple[str, str] = ("id_1", "id_2"),
                 blocks: tuple[int, int] | None = None) -> DataFrame:
    """``(out[0], out[1], dot)`` for every pair sharing a non-zero term. The sides meet by term, or with
    ``blocks`` (:func:`pair_blocks`) in a grid of cells."""
    l = _side(left, left_id, term, w, "l")
    r = _side(right, right_id, term, w, "r")
    if blocks:
        return dot_products_by_cell(l, r, blocks, out)
    return (l.join(r, on="_term", how="inner")
            .groupBy(F.col("l_id").alias(out[0]), F.col("r_id").alias(out[1]))
            .agg(F.sum(F.col("l_w") * F.col("r_w")).alias("dot")))


def cosine_pairs(left: DataFrame, right: DataFrame, left_id: str = "id", right_id: str = "id",
                 term: str = "term", w: str = "w", out: tuple[str, str] = ("id_1", "id_2"),
                 normalized: bool = False, blocks: tuple[int, int] | None = None) -> DataFrame:
    """``(out[0], out[1], cos)``: ``dot / (|l| |r|)`` for pairs sharing a
    non-zero term. Zero-norm vectors form no pair, so no NaN is produced.

    With ``normalized=True`` the inputs are unit (or zero) vectors and the
    cosine is the dot product itself. Otherwise the norms are partial/final
    aggregates per id joined to the (already aggregated) pairs; a norm is
    never a window over a group id, which could hold a third of all rows.
    ``blocks``: see :func:`dot_products`.
    """
    dots = dot_products(left, right, left_id, right_id, term, w, out, blocks)
    if normalized:
        return dots.select(out[0], out[1], F.col("dot").alias("cos"))
    nl = (left.groupBy(F.col(left_id).alias(out[0]))
          .agg(F.sqrt(F.sum(F.col(w) * F.col(w))).alias("_nl")))
    nr = (right.groupBy(F.col(right_id).alias(out[1]))
          .agg(F.sqrt(F.sum(F.col(w) * F.col(w))).alias("_nr")))
    return (dots.join(nl, on=out[0]).join(nr, on=out[1])
            .select(out[0], out[1], safe_divide("dot", F.col("_nl") * F.col("_nr")).alias("cos")))


def best_match(scores: DataFrame, keys: DataFrame | None = None, key: str = "id_1",
               candidate: str = "id_2", score: str = "cos", digits: int = 9) -> DataFrame:
    """Per key, the candidate with the highest score: ``(key, best, score)``.

    Ties (equal after rounding to ``digits`` places) go to the smallest
    candidate id. A partial/final aggregate, so a key with very many
    candidates is reduced map-side. When ``keys`` (one column named ``key``)
    is given, keys without any candidate are kept with a null ``best`` and
    null score.
    """
    # smallest (-rounded score, candidate): highest score first, then the
    # smallest candidate id of any orderable type (string ids included)
    ordering = F.struct(-F.round(F.col(score), digits), F.col(candidate))
    best = (scores.where(F.col(score).isNotNull() & ~F.isnan(score))
            .groupBy(key)
            .agg(F.min_by(F.struct(F.col(candidate).alias("best"), F.col(score).alias(score)),
                          ordering).alias("_b"))
            .select(key, "_b.best", f"_b.{score}"))
    if keys is not None:
        best = keys.select(key).join(best, on=key, how="left")
    return best


def identical_vectors(side: DataFrame, id_col: str, w: str, rep: str = "_rep") -> DataFrame:
    """``(id_col, rep)``: the least id among vectors with the same terms and weights
    (equal to 12 places). Vectors meet by count and two 64-bit sums of hashes that
    don't depend on the order of rows, so both aggregates combine map-side and a vector
    that a third of all ids have reaches one task as one row per task."""
    value = F.round(w, 12)
    named = side.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("_n"), F.bit_xor(F.xxhash64("_term", value)).alias("_h1"),
        F.bit_xor(F.xxhash64(value, F.lit("second"), "_term")).alias("_h2"))
    least = named.groupBy("_n", "_h1", "_h2").agg(F.min(id_col).alias(rep))
    return named.join(least, ["_n", "_h1", "_h2"]).select(id_col, rep)


def _one_of_each(side: DataFrame, classes: DataFrame, id_col: str) -> DataFrame:
    return side.join(classes.where(F.col("_rep") == F.col(id_col)).select(id_col), id_col, "left_semi")


def _after(part, id_col: str):
    """``part`` over the terms of a vector that follow in the order rarest first (as what
    precedes in the opposite order, which is one pass)."""
    order = Window.partitionBy(id_col).orderBy(F.desc("_df"), F.desc("_term")).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(part.over(order), F.lit(0.0))


def _score_pairs(pairs: DataFrame, lhs: DataFrame, rhs: DataFrame, a: str, b: str) -> DataFrame:
    return (pairs.join(rhs.select(b, "_term", "r_w"), b).join(lhs.select(a, "_term", "l_w"), [a, "_term"])
            .groupBy(a, b).agg(F.sum(F.col("l_w") * F.col("r_w")).alias("cos")))


#: steps of a title weight and of its remaining norm that share a block of an index list
BLOCK_STEPS = 8

#: right vectors that a left one is scored against before its other pairs are judged
FIRST_LOOKS = 4

#: 64-bit words of a left vector's signature, one bit for each of its terms
SIGNATURE_WORDS = 8

#: terms of a right vector that are looked up in a signature, those after them count whole
SIGNED_TERMS = 24


def _bit(term: str):
    return F.pmod(F.xxhash64(term), F.lit(64 * SIGNATURE_WORDS)).cast("int")


def match_candidates(lhs: DataFrame, rhs: DataFrame, own: DataFrame, a: str, b: str,
                     slack: float) -> DataFrame:
    """``(a, b)``: pairs that can be a left vector's best, from sides ``(a, _term, l_w)``
    and ``(b, _term, r_w)``; ``own`` holds pairs worth a first look. They are written,
    what they were found with is deleted. See :func:`best_match_bounded`."""
    common = lhs.groupBy("_term").agg(F.count(F.lit(1)).alias("_df"), F.avg("l_w").alias("_usual"))
    after = Window.partitionBy(b).orderBy(F.desc("_df"), F.desc("_term"))
    signed, tail = after.rowsBetween(-SIGNED_TERMS, -1), after.rowsBetween(Window.unboundedPreceding, -SIGNED_TERMS - 1)
    scaled = F.col("r_w") * F.col("_usual")
    rhs = (rhs.join(common, "_term")
           .withColumn("r_rest", F.sqrt(_after(F.sum(F.col("r_w") * F.col("r_w")), b)))
           .withColumn("r_sum", _after(F.sum(scaled), b)))
    rhs = written(rhs.select(b, "_term", "r_w", "r_rest", "r_sum", (
        F.floor(F.col("r_w") * BLOCK_STEPS) * (BLOCK_STEPS + 1) + F.floor(F.col("r_rest") * BLOCK_STEPS)).alias("_block"),
        F.collect_list(F.struct(_bit("_term").alias("bit"), scaled.alias("x"))).over(signed).alias("_signed"),
        F.coalesce(F.sum(scaled).over(tail), F.lit(0.0)).alias("_tail")))

    def bound(w, rest, total):
        return F.col("l_w") * F.col(w) + F.least(F.col("l_rest") * F.col(rest), F.col("l_most") * F.col(total))

    # of each term the greatest of each part of the bound; floats are enough for bounds, with a little added
    tops = rhs.groupBy("_term").agg(*[F.max(c).cast("float").alias(x) for c, x in (("r_w", "_w"), ("r_rest", "_rest"), ("r_sum", "_sum"))])
    lhs = (lhs.join(common.join(tops, "_term"), "_term")
           .withColumn("l_rest", F.sqrt(_after(F.sum(F.col("l_w") * F.col("l_w")), a)))
           .withColumn("l_most", _after(F.max(F.col("l_w") / F.col("_usual")), a)))
    hope = F.row_number().over(Window.partitionBy(a).orderBy(F.desc(F.col("l_w") * F.col("_w")), "_term"))
    lhs = written(lhs.select(a, "_term", "l_w", *[(F.col(c) * (1 + 1e-6)).cast("float").alias(c) for c in ("l_rest", "l_most")],
                             bound("_w", "_rest", "_sum").cast("float").alias("_top"), (hope <= FIRST_LOOKS).alias("_first")))
    # first round: the given pairs, and the heaviest titles of the most promising terms
    champion = rhs.groupBy("_term").agg(F.min_by(b, F.struct(-F.col("r_w"), F.col(b))).alias(b))
    first = lhs.where("_first").select(a, "_term").join(champion, "_term").select(a, b)
    least = written(_score_pairs(own.unionByName(first).distinct(), lhs, rhs, a, b)
                    .groupBy(a).agg((F.max("cos") - slack).alias("_least")))
    word = [F.bit_or(F.when(F.floor(_bit("_term") / 64) == k, F.expr("shiftleft(1L, _at)")).otherwise(F.lit(0).cast("long"))) for k in range(SIGNATURE_WORDS)]
    signature = lhs.withColumn("_at", _bit("_term") % 64).groupBy(a).agg(*[w.alias(f"_w{k}") for k, w in enumerate(word)])
    signature = signature.select(a, F.array(*[f"_w{k}" for k in range(SIGNATURE_WORDS)]).alias("_signature"))
    # second round: terms, blocks and pairs whose bound reaches the best of the first, then those that do by the signature
    blocks = rhs.groupBy("_term", "_block").agg(F.max("r_w").alias("_w"), F.max("r_rest").alias("_rest"), F.max("r_sum").alias("_sum"))
    needed = (lhs.select(a, "_term", "l_w", "l_rest", "l_most", "_top").join(least.join(signature, a), a)
              .where(F.col("_top") >= F.col("_least") - 1e-6 * (1 + F.abs("_top"))).drop("_top")
              .join(blocks, "_term").where(bound("_w", "_rest", "_sum") >= F.col("_least")).drop("_w", "_rest", "_sum"))
    has = lambda e: F.getbit(F.get("_signature", F.floor(e["bit"] / 64).cast("int")), e["bit"] % 64) == 1
    shared = F.aggregate(F.filter("_signed", has), F.col("_tail"), lambda s, e: s + e["x"])
    met = (needed.join(rhs, ["_term", "_block"]).where(bound("r_w", "r_rest", "r_sum") >= F.col("_least"))
           .where(F.col("l_w") * F.col("r_w") + F.col("l_most") * shared >= F.col("_least")))
    found = written(met.select(a, b).distinct())
    drop(lhs, rhs, least)
    return found


def best_match_bounded(left: DataFrame, right: DataFrame, left_id: str = "id", right_id: str = "id",
                       term: str = "term", w: str = "w_norm", out: tuple[str, str] = ("id_1", "id_2"),
                       digits: int = 9) -> DataFrame:
    """Per left vector, the right vector with the highest dot product:
    ``(out[0], best, cos)`` -- the result of :func:`best_match` over
    :func:`cosine_pairs` with ``normalized=True``, without the pairs that cannot
    win. Weights must be non-negative (TF-IDF). One path at every size:

    1. Identical vectors are one: of equal right vectors only the least id can win, and
       equal left ones have the same best (:func:`identical_vectors`).
    2. Terms are put in one order, rarest on the left side first. If ``t`` is the first
       term that two vectors share, their score is at most ``l_t r_t`` plus the lesser of
       ``|l after t| |r after t|`` (suffix norms) and ``max(l/u after t) * sum(r u after t)``,
       where ``u`` is the usual (mean) left weight of a term, for any ``u`` above 0.
       This bound is small for common terms, so pairs that meet only there are dropped.
    3. First round: every left vector is scored against the right one of its own id
       and against the heaviest right vectors of its ``FIRST_LOOKS`` most promising terms. The
       best of these is what a winner has to reach.
    4. Second round: a left term whose bound with the maxima of all right vectors that have it
       stays below that goes first, before it meets any. The right vectors of a term lie in blocks
       of similar weight and suffix norm. A left term meets the blocks whose maxima pass the
       bound, then the vectors there that pass it themselves. It carries a signature, one bit
       per term of its vector (several may share one), and the sum above is taken again over
       the terms whose bit is set: few pairs are left whose other terms differ, however many
       vectors there are. These pairs are scored over all terms.

    All joins are equi-joins. A vector without a positive score is not in the result.
    Both inputs are read several times: pass tables or written intermediates. What each step
    finds is written, its shuffle files and what no later step reads are deleted, so the disk
    holds those of one step. The result is written too: it reads neither input."""
    a, b = out
    with files_released(left.sparkSession):
        rhs = _side(right, right_id, term, w, "r").withColumnRenamed("r_id", b)
        # terms that no right vector has add nothing: most of a long left vector goes here
        every = written(_side(left, left_id, term, w, "l").withColumnRenamed("l_id", a).join(rhs.select("_term").distinct(), "_term", "left_semi"))
        l_class, r_class = (written(identical_vectors(side, i, x)) for side, i, x in ((every, a, "l_w"), (rhs, b, "r_w")))
        lhs, rhs = written(_one_of_each(every, l_class, a)), written(_one_of_each(rhs, r_class, b))
        drop(every)
        own = (l_class.join(r_class.withColumnRenamed("_rep", "_other"), F.col(a) == F.col(b))
               .select(F.col("_rep").alias(a), F.col("_other").alias(b)))
        pairs = match_candidates(lhs, rhs, own, a, b, 10.0 ** (1 - digits))
        best = best_match(_score_pairs(pairs, lhs, rhs, a, b), None, a, b, "cos", digits)
        found = written(l_class.join(best.withColumnRenamed(a, "_rep"), "_rep").select(a, "best", "cos"))
        drop(l_class, r_class, lhs, rhs, pairs)
    return found


def match_indicator(best: DataFrame, key: str = "id_1", best_col: str = "best") -> DataFrame:
    """Adds ``match = 1`` when the best candidate is the key itself, else 0."""
    return best.withColumn(
        "match", F.when(F.col(best_col).isNotNull() & (F.col(best_col) == F.col(key)), 1).otherwise(0))


def match_accuracy(matches: DataFrame, n_docs=None, label: str = "accuracy") -> DataFrame:
    """One row ``(label, value)``: ``100 * sum(match) / N``; N defaults to the
    number of rows of ``matches``."""
    denom = F.count(F.lit(1)) if n_docs is None else n_docs
    return matches.agg(
        (F.lit(100.0) * F.sum("match").cast("double") / denom).alias("value")
    ).select(F.lit(label).alias("label"), "value")


def group_term_vectors(tf: DataFrame, groups: DataFrame, id_col: str = "id",
                       group_col: str = "category", term: str = "term",
                       value: str = "tf") -> DataFrame:
    """``(group, term, value)``: element-wise sum of the document vectors of
    each group (raw counts by default). Documents are matched to groups by
    id; an id listed under two groups adds to both."""
    g = groups.select(F.col(id_col).alias("_gid"), F.col(group_col).alias(group_col))
    return (tf.join(g, tf[id_col] == g["_gid"], "inner")
            .groupBy(group_col, term)
            .agg(F.sum(value).alias(value)))


def similarity_matrix(vectors: DataFrame, group_col: str = "category", term: str = "term",
                      value: str = "tf") -> DataFrame:
    """``(category_1, category_2, value)``: cosine of every ordered pair of
    group vectors (self included) that share a term. An absent pair means
    cosine 0; :func:`pivot_matrix` fills it in.

    Each unordered pair is computed once and mirrored. The group vectors (one
    row per group and term, far smaller than the corpus) feed both join sides and
    both norm aggregates, so they are written once (one job) rather than recomputed
    from the corpus four times."""
    vectors = written(vectors.select(group_col, term, value))
    l = _side(vectors, group_col, term, value, "l")
    r = _side(vectors, group_col, term, value, "r")
    dots = (l.join(r, (l["_term"] == r["_term"]) & (l["l_id"] <= r["r_id"]))
            .groupBy(F.col("l_id").alias("category_1"), F.col("r_id").alias("category_2"))
            .agg(F.sum(F.col("l_w") * F.col("r_w")).alias("dot")))
    norms = vectors.groupBy(F.col(group_col).alias("_g")).agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias("_n"))
    once = (dots.join(norms.select(F.col("_g").alias("category_1"), F.col("_n").alias("_n1")), "category_1")
            .join(norms.select(F.col("_g").alias("category_2"), F.col("_n").alias("_n2")), "category_2")
            .select("category_1", "category_2", safe_divide("dot", F.col("_n1") * F.col("_n2")).alias("value")))
    both = F.when(F.col("category_1") == F.col("category_2"), F.array(F.struct("category_1", "category_2"))).otherwise(
        F.array(F.struct("category_1", "category_2"),
                F.struct(F.col("category_2").alias("category_1"), F.col("category_1").alias("category_2"))))
    return once.select(F.explode(both).alias("_p"), "value").select("_p.category_1", "_p.category_2", "value")


#: levels of document frequency per doubling, see :func:`group_neighbours`
LEVELS_PER_DOUBLING = 4


def group_neighbours(vectors: DataFrame, threshold: float, group_col: str = "category", term: str = "term",
                     value: str = "tf") -> DataFrame:
    """``(category_1, category_2, value)``, ``category_1 < category_2``: the pairs of
    groups whose cosine is at least ``threshold`` (above 0), without the full matrix.
    Weights must be non-negative.

    Terms are put in levels by the number of groups that have them, rare ones first. If
    two groups share no term below a level, their cosine is at most the product of
    their unit vectors' norms from that level on. So a vector is indexed only by its
    leading terms, up to the level from which its norm falls below the threshold, and
    two groups that meet there are a candidate only if the product of these norms
    reaches it. Candidates are scored over all terms. Norms per level are sums over
    (group, level), some tens of rows a group, so no task holds a whole vector."""
    vectors = written(vectors.where(F.col(value).isNotNull() & (F.col(value) != 0))
                      .select(F.col(group_col).alias("_g"), F.col(term).alias("_term"), F.col(value).cast("double").alias("_v"))
                      .where(F.col("_g").isNotNull()))
    norms = vectors.groupBy("_g").agg(F.sqrt(F.sum(F.col("_v") * F.col("_v"))).alias("_norm"))
    levels = vectors.groupBy("_term").agg(
        F.floor(F.log2(F.count(F.lit(1))) * LEVELS_PER_DOUBLING).alias("_level"))
    unit = written(vectors.join(levels, "_term").join(norms, "_g")
                   .select("_g", "_term", "_level", (F.col("_v") / F.col("_norm")).alias("_w")))
    from_here = Window.partitionBy("_g").orderBy(F.desc("_level")).rowsBetween(Window.unboundedPreceding, 0)
    slack = 1e-9
    rest = (unit.groupBy("_g", "_level").agg(F.sum(F.col("_w") * F.col("_w")).alias("_mass"))
            .select("_g", "_level", F.sqrt(F.sum("_mass").over(from_here)).alias("_rest"))
            .where(F.col("_rest") >= threshold - slack))
    leading = unit.join(rest, ["_g", "_level"]).select("_g", "_term", "_rest")
    a, b = (leading.select(F.col("_g").alias(f"category_{i}"), "_term", F.col("_rest").alias(f"_rest{i}")) for i in (1, 2))
    pairs = (a.join(b, "_term").where((F.col("category_1") < F.col("category_2"))
                                      & (F.col("_rest1") * F.col("_rest2") >= threshold - slack))
             .select("category_1", "category_2").distinct())
    a, b = (unit.select(F.col("_g").alias(f"category_{i}"), "_term", F.col("_w").alias(f"_w{i}")) for i in (1, 2))
    return (pairs.join(a, "category_1").join(b, ["category_2", "_term"])
            .groupBy("category_1", "category_2").agg(F.sum(F.col("_w1") * F.col("_w2")).alias("value"))
            .where(F.col("value") >= threshold))


def tile_matrix(pairs: DataFrame, tile: int = 256, row: str = "category_1", col: str = "category_2",
                value: str = "value", fill: float = 0.0) -> DataFrame:
    """``(row_block, col_block, row, labels, values)``: the wide matrix in tiles of
    ``tile`` x ``tile`` labels, for any number of labels (a pivot has a column for
    each). One row is a row's part of a tile: ``values[k]`` belongs to column
    ``labels[k]``; absent pairs get ``fill``. Parts without any pair are left out.

    Labels are numbered in their order by a distributed ranking. A part is a
    group of at most ``tile`` pairs, so a label with very many pairs is spread over
    its tiles."""
    from quill.operators.ratings import global_index
    names = pairs.select(F.col(row).alias("_label")).unionByName(pairs.select(F.col(col).alias("_label"))).distinct()
    numbered = written(global_index(names.where(F.col("_label").isNotNull()), [F.col("_label").asc()], "_at"))
    block = numbered.groupBy(F.floor(F.col("_at") / tile).alias("col_block")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_at", "_label"))), lambda x: x["_label"]).alias("labels"))
    part = (pairs.join(numbered.select(F.col("_label").alias(row), F.floor(F.col("_at") / tile).alias("row_block")), row)
            .join(numbered.select(F.col("_label").alias(col), F.floor(F.col("_at") / tile).alias("col_block"),
                                  (F.col("_at") % tile).alias("_k")), col)
            .groupBy("row_block", "col_block", row)
            .agg(F.map_from_entries(F.collect_list(F.struct("_k", F.col(value).alias("_v")))).alias("_cells")))
    cells = F.transform("labels", lambda _, k: F.coalesce(F.col("_cells")[k.cast("long")], F.lit(fill)))
    return part.join(block, "col_block").select("row_block", "col_block", row, "labels", cells.alias("values"))


def pivot_matrix(pairs: DataFrame, values: list[str] | None = None, row: str = "category_1",
                 col: str = "category_2", value: str = "value", fill: float = 0.0) -> DataFrame:
    """Wide matrix: one row per ``row`` value, one column per ``col`` value.

    The labels come from the data: Spark finds the distinct ones with a small
    job (at most ``spark.sql.pivotMaxValues``), unless ``values`` lists them; the pairs
    are written before, or both jobs would compute them. With more labels
    :func:`tile_matrix` is the form to use.
    """
    if values is None:
        pairs = written(pairs.select(row, col, value))
    wide = pairs.groupBy(row).pivot(col, values).agg(F.first(value))
    # labels may hold dots (``cs.DB``): address every column quoted
    return wide.select(F.col(f"`{row}`"), *[
        F.coalesce(F.col(f"`{c}`"), F.lit(fill)).alias(c) for c in wide.columns if c != row])
