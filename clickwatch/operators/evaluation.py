"""Labelled anomalies and detection quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickwatch import constants as C
from clickwatch.functions.scalars import between_uniform, clip, hash_uniforms, standard_normal
from clickwatch.operators.dataset import ORDER
from clickwatch.operators.forest import row_key_text
from clickwatch.operators.ordering import group_cutoffs, kth_key, running_totals, up_to_key
from clickwatch.operators.windows import KEYS
from clickwatch.session import stage

DRAW = "_draw"


def _drawn(rows: DataFrame, seed: int, purpose: str) -> DataFrame:
    """Rows with a random but reproducible order key."""
    return rows.withColumn(DRAW, F.md5(F.concat_ws("|", row_key_text(seed), F.lit(purpose))))


def _is_drawn(drawn: DataFrame, k: int) -> Column:
    """True for the `k` rows with the smallest hashes; the cutoff is found by counting."""
    return up_to_key(kth_key(drawn, k, [F.substring(DRAW, 1, 3), F.substring(DRAW, 1, 6)], [DRAW, *ORDER]))


def anomaly_count(total: int, rate: float = C.INJECTION_RATE) -> int:
    return max(1, round(rate * total))


def pick_uniform(rows: DataFrame, rate: float = C.INJECTION_RATE, seed: int = C.FOREST_SEED) -> DataFrame:
    """Mark random rows in `picked`: a comparison per row, no sort, join or shuffle of the table."""
    drawn = _drawn(rows, seed, "pick")
    return drawn.withColumn("picked", _is_drawn(drawn, anomaly_count(rows.count(), rate))).drop(DRAW)


def pick_stratified(rows: DataFrame, rate: float = C.INJECTION_RATE, seed: int = C.FOREST_SEED) -> DataFrame:
    """Mark the same number of rows of every (geo, platform), then cut or top up to the total.

    Every step finds cutoffs by counting, so marking is a comparison per row against one
    small row per stratum; the table is not shuffled. Rows equal in time and keys are marked together.
    """
    k = anomaly_count(rows.count(), rate)
    strata = rows.select(*KEYS).distinct().count()
    drawn = _drawn(rows, seed, "pick")
    place = [DRAW, *ORDER]
    prefixes = [F.substring(DRAW, 1, 3), F.substring(DRAW, 1, 6)]
    cutoffs = group_cutoffs(drawn, max(1, k // max(1, strata)), KEYS, prefixes, place)
    named = cutoffs.select(*[F.col(c).alias(f"_s_{c}") for c in KEYS], "_cutoff")
    same = [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in KEYS]
    # one row per stratum, a count known here
    marked = drawn.join(F.broadcast(named), same, "left").withColumn("picked", F.struct(*place) <= F.col("_cutoff"))
    marked = marked.select(*rows.columns, "picked")
    have = marked.filter("picked").count()
    if have > k:
        cut = kth_key(marked.filter("picked"), k, [F.to_date("window_end"), F.col("window_end")], ORDER)
        return marked.withColumn("picked", F.col("picked") & up_to_key(cut))
    if have < k and have < rows.count():
        pool = _drawn(marked, seed, "top-up")
        more = _is_drawn(pool.filter("NOT picked"), k - have)
        return pool.withColumn("picked", F.col("picked") | more).drop(DRAW)
    return marked


def _changed(marked: DataFrame, cap: float, seed: int) -> DataFrame:
    """Marked rows get one of four kinds of change and a shared small jitter."""
    u = hash_uniforms(row_key_text(seed), 6)
    kinds = F.array(*map(F.lit, C.INJECTION_KINDS))
    drawn = marked.select("*", *[ui.alias(f"_u{i}") for i, ui in enumerate(u)]).withColumn(
        "kind", F.when(F.col("picked"), F.element_at(kinds, F.floor(F.col("_u0") * 4).cast("int") + 1))
    )
    kind, u1, u2, u3 = F.col("kind"), F.col("_u1"), F.col("_u2"), F.col("_u3")
    ctr_factor = (
        F.when(kind == "ctr_spike", between_uniform(u1, C.CTR_SPIKE_FACTOR))
        .when(kind == "mixed", between_uniform(u1, C.MIXED_CTR_FACTOR))
        .otherwise(1.0)
    )
    bounce_shift = (
        F.when(kind == "bounce_spike", between_uniform(u2, C.BOUNCE_SPIKE_SHIFT))
        .when(kind == "mixed", between_uniform(u2, C.MIXED_BOUNCE_SHIFT))
        .otherwise(0.0)
    )
    volume_factor = (
        F.when(kind == "volume_spike", between_uniform(u3, C.VOLUME_SPIKE_FACTOR))
        .when(kind == "mixed", between_uniform(u3, C.MIXED_VOLUME_FACTOR))
        .otherwise(1.0)
    )
    jitter = F.lit(C.JITTER_STD) * standard_normal(F.col("_u4"), F.col("_u5"))
    changed = {
        "ctr": clip(F.col("ctr") * ctr_factor + jitter, 0.0, 1.0),
        "bounce": clip(F.col("bounce") + bounce_shift + jitter, 0.0, 1.0),
        "count": F.least(F.col("count") * volume_factor, F.lit(float(cap))),
    }
    return drawn.select(
        *ORDER,
        *[F.when(F.col("picked"), new).otherwise(F.col(name)).alias(name) for name, new in changed.items()],
        F.col("picked").cast("int").alias("label"),
        "kind",
    )


def inject(
    rows: DataFrame,
    cap: float,
    rate: float = C.INJECTION_RATE,
    seed: int = C.FOREST_SEED,
    stratified: bool = False,
) -> DataFrame:
    """`rows` (natural units) with a known share altered and labelled 1, in one pass."""
    pick = pick_stratified if stratified else pick_uniform
    return _changed(pick(rows, rate, seed), cap, seed)


def confusion_metrics(labelled: DataFrame, predicted: Column, label: str = "label") -> DataFrame:
    """Precision, recall and F1 in one row; 0 where undefined."""
    truth = F.col(label) == 1
    cells = labelled.agg(
        F.count_if(predicted & truth).alias("tp"),
        F.count_if(predicted & ~truth).alias("fp"),
        F.count_if(~predicted & truth).alias("fn"),
        F.count_if(~predicted & ~truth).alias("tn"),
    )

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return cells.select(
        "tp", "fp", "fn", "tn",
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def threshold_counts(labelled: DataFrame, score: str = "anomaly_score", label: str = "label") -> DataFrame:
    """Positives and negatives per distinct score, staged for the curve operators."""
    positive = F.col(label) == 1
    return stage(
        labelled.groupBy(F.col(score).alias("score")).agg(
            F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
        ),
        "score-counts",
    )


def roc_auc(counts: DataFrame) -> DataFrame:
    """Area under the ROC curve, ties counted half; NULL with a single class."""
    cum = running_totals(counts, "score", ["pos", "neg"], descending=True)
    # each step adds a trapezoid: width neg, heights cum_pos - pos and cum_pos
    area = F.sum(F.col("neg").cast("double") * (F.col("cum_pos") - F.col("pos") / F.lit(2.0)))
    return cum.agg(area.alias("area"), F.sum("pos").alias("p"), F.sum("neg").alias("n")).select(
        F.try_divide(F.col("area"), F.col("p").cast("double") * F.col("n")).alias("roc_auc")
    )


def roc_curve(counts: DataFrame, drop_intermediate: bool = False) -> DataFrame:
    """(fpr, tpr, threshold) per distinct score, from the strictest on.

    The starting point (0, 0) has no threshold. `drop_intermediate` leaves out
    points whose step is repeated by the next one, which changes no line drawn.
    """
    totals = counts.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
    cum = running_totals(counts, "score", ["pos", "neg"], descending=True, with_next=drop_intermediate)
    if drop_intermediate:
        repeated = (F.col("next_pos") == F.col("pos")) & (F.col("next_neg") == F.col("neg"))
        cum = cum.filter(~F.coalesce(repeated, F.lit(False)))
    points = cum.select(
        F.try_divide(F.col("cum_neg").cast("double"), F.lit(float(totals["n"] or 0))).alias("fpr"),
        F.try_divide(F.col("cum_pos").cast("double"), F.lit(float(totals["p"] or 0))).alias("tpr"),
        F.col("score").alias("threshold"),
    )
    start = counts.sparkSession.range(1).select(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(None).cast("double").alias("threshold")
    )
    return points.unionByName(start)


def random_labels(rows: DataFrame, rate: float = C.INJECTION_RATE, seed: int = C.FOREST_SEED) -> DataFrame:
    """Labels that have nothing to do with the rows; their AUC must stay near one half."""
    (u,) = hash_uniforms(F.concat_ws("|", row_key_text(seed), F.lit("random-label")), 1)
    return rows.withColumn("label", (u < rate).cast("int"))
