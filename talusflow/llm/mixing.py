"""Mix sources to target weights by Pareto order sampling (DataFrame functions only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talusflow.llm.common import WORD, written

_ROUNDS = "array<struct<_f:bigint,_c:double,_to_f:bigint,_to_c:double,_most:bigint>>"
_COARSE, _FINE = 128, 4096  # levels at which the rank order is added up before single rows


def _ranked(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> list[Column]:
    """Size, source key and a uniform number that depend on the row alone."""
    size = F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long")
    name = F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit(""))
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), ident, F.lit(":"), size.cast("string")).cast("binary"))
    uniform = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(2.0 ** 52)
    return [size.alias("_size"), name.alias("_source"), uniform.alias("_u")]


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float,
                   max_copies: float) -> DataFrame:
    """Target words of each source: `_source`, `source_size`, `target`.

    Weights repeat along the sources in code point order, null last. A source never gets more than
    `max_copies` times its size; what is above goes to the others by weight until nobody is above.
    Sorted by size over weight, the sources that end at their limit come first, so running sums
    give the final level. One row per source passes through these windows.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("_source") == "", "_source")
    by_limit = everything.orderBy(F.col("_limit") / F.col("_weight"), "_source")
    earlier = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    level = (F.lit(float(share)) * F.sum("source_size").over(everything).cast("double")
             - F.coalesce(F.sum("_limit").over(earlier), F.lit(0.0))) / (
        F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(earlier), F.lit(0.0)))
    return (
        sizes.withColumn("_weight", weight)
        .withColumn("_limit", F.lit(float(max_copies)) * F.col("source_size").cast("double"))
        .withColumn("_level", level)
        .withColumn("_full", F.col("_limit") <= F.col("_level") * F.col("_weight"))
        .withColumn("_final", F.first(F.when(~F.col("_full"), F.col("_level")), ignorenulls=True)
                    .over(by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .select("_source", "source_size",
                F.when(F.col("_full"), F.col("_limit"))
                .otherwise(F.col("_final") * F.col("_weight")).alias("target"))
    )


def _odds(uniform: Column, inclusion: Column) -> Column:
    """Pareto rank: random odds over inclusion odds; nothing is due where inclusion is 0."""
    return F.when(inclusion > 0, (uniform / (F.lit(1.0) - uniform))
                  / (inclusion / (F.lit(1.0) - inclusion)))


def _crossing(ranked: DataFrame, due: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Where each source's words run out: the fine step with the sum before it, and the last rank inside
    it that fits, its sum, and the rank that is over. A source whose words all fit is in neither."""
    found = due.withColumn("_before", F.lit(0).cast("long"))
    for step, within in (("_coarse", []), ("_fine", ["_coarse"]), ("_rank", ["_coarse", "_fine"])):
        inside = ranked.join(found, ["_source", *within])
        running = Window.partitionBy("_source").orderBy(step)
        sums = (
            inside.groupBy("_source", *within, step)
            .agg(F.sum("_size").alias("_words"), F.first("_due").alias("_due"),
                 F.first("_before").alias("_before"))
            .withColumn("_after", F.col("_before") + F.sum("_words").over(running))
        )
        if step == "_rank":
            fits = F.col("_after") <= F.col("_due")
            cut = sums.groupBy("_source").agg(
                F.max(F.when(fits, F.col("_rank"))).alias("_inner_cut"),
                F.max(F.when(fits, F.col("_after"))).alias("_inner_sum"),
                F.min(F.when(~fits, F.col("_rank"))).alias("_over"))
            break
        first_over = (
            sums.where(F.col("_after") > F.col("_due"))
            .groupBy("_source").agg(F.min(F.struct(step, *within, "_due",
                                                   (F.col("_after") - F.col("_words")).alias("_before"),
                                                   )).alias("_s"))
        )
        found = written(first_over.select("_source", "_s.*"), "mixing-step")
    return found, cut


def mixing_plan(rows: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
                max_copies: float = 2.0) -> DataFrame:
    """One row per source: size, target, certain copies and which ranks get one copy more.

    `rows` has `_source`, `_size`, `_u`. Each document gets `_whole` certain copies and stands for
    one more with probability `_part`. In Pareto order each document is taken if it fits into the
    words left, and set aside if not; then the one document whose size is nearest to the rest is
    added if that comes closer to the target. The order is added up in coarse steps, then in fine
    steps of the step where the words run out, then row by row, so no task sorts a source. Where a
    document does not fit, a round ends; the next goes on behind it with the documents that fit into
    the words still left, until none does. `_more` has what each round takes.
    """
    sizes = rows.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    targets = source_targets(sizes, weights, share, max_copies)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = written(
        targets.withColumn("_whole", F.floor(ratio).cast("long"))
        .withColumn("_part", ratio - F.floor(ratio))
        .withColumn("_due", F.floor(F.col("target") - F.col("_whole") * F.col("source_size")
                                    + F.lit(0.5)).cast("long")), "mixing-targets")

    place = F.col("_rank") / (F.lit(1.0) + F.col("_rank"))  # 0 to 1 in rank order
    # Written, as each step asks for it: without its join every plan that follows is smaller.
    ranked = written(
        rows.join(plan.select("_source", "_part"), "_source")
        .withColumn("_rank", _odds(F.col("_u"), F.col("_part")))
        .where(F.col("_rank").isNotNull())
        .withColumn("_coarse", F.floor(place * _COARSE))
        .withColumn("_fine", F.floor(place * (_COARSE * _FINE)))
        .select("_source", "_size", "_rank", "_coarse", "_fine"), "mixing-ranked")
    found, cut = _crossing(ranked, plan.select("_source", "_due"))

    # All ranks before the crossing step, and those inside it that still fit.
    cuts = (
        plan.join(found.select("_source", "_fine", "_before"), "_source", "left")
        .join(cut, "_source", "left")
        .withColumn("_crosses", F.col("_fine").isNotNull())
        .withColumn("_filled", F.coalesce(F.col("_inner_sum"), F.col("_before")))
        .withColumn("_fine_cut", F.when(F.col("_crosses"), F.col("_fine")))
        .select("_source", "source_size", "target", "_whole", "_part", "_due", "_crosses", "_fine_cut",
                F.coalesce("_inner_cut", F.lit(-1.0)).alias("_cut"), "_over", "_filled")
    )
    cuts = written(cuts.withColumn("_more", F.array().cast(_ROUNDS)), "mixing-cuts")
    state = cuts.where("_crosses").select("_source", F.col("_fine_cut").alias("_f"), F.col("_over").alias("_c"),
                                          (F.col("_due") - F.col("_filled")).alias("_due"))
    while True:
        small = written(ranked.join(state, "_source").where(
            _after("_f", "_c") & (F.col("_size") <= F.col("_due")) & (F.col("_size") > 0)).select(*ranked.columns), "mixing-fits")
        if small.isEmpty():
            break
        all_of = small.groupBy("_source").agg(F.sum("_size").alias("_all"))
        found, cut = _crossing(small, state.select("_source", "_due"))
        # A round takes what fits after the last rank that was over, up to its own cut; without a
        # crossing that is all. Repeated rows share a rank and are passed over together.
        done = written(
            state.join(all_of, "_source").join(found.select("_source", "_fine", "_before"), "_source", "left")
            .join(cut, "_source", "left")
            .select("_source", "_f", "_c", F.col("_due").alias("_most"), F.col("_fine").alias("_to_f"),
                    F.coalesce("_inner_cut", F.lit(-1.0)).alias("_to_c"), "_over",
                    (F.col("_due") - F.coalesce("_inner_sum", "_before", "_all")).alias("_due")), "mixing-round")
        step = F.struct("_f", "_c", "_to_f", "_to_c", "_most")
        cuts = written(cuts.join(done.select("_source", step.alias("_step"), F.col("_due").alias("_left")), "_source", "left")
                       .withColumn("_filled", F.coalesce(F.col("_due") - F.col("_left"), "_filled"))
                       .withColumn("_more", F.when(F.col("_step").isNull(), F.col("_more"))
                                   .otherwise(F.concat("_more", F.array("_step"))))
                       .drop("_step", "_left"), "mixing-cuts")
        state = done.where(F.col("_to_f").isNotNull()).select(
            "_source", F.col("_to_f").alias("_f"), F.col("_over").alias("_c"), "_due")
    rest = F.col("_due") - F.col("_filled")
    nearest = (
        ranked.join(cuts.where("_crosses"), "_source")
        .where(_after("_fine_cut", "_cut") & ~_in_rounds(F.col("_fine")))
        .where(F.abs(F.col("_size") - rest) < rest)
        .groupBy("_source").agg(F.min(F.struct(F.abs(F.col("_size") - rest), "_rank")).alias("_n"))
        .select("_source", F.col("_n._rank").alias("_last"))
    )
    return written(cuts.join(nearest, "_source", "left"), "mixing-plan")


def _after(fine: str, cut: str) -> Column:
    return (F.col("_fine") > F.col(fine)) | ((F.col("_fine") == F.col(fine)) & (F.col("_rank") > F.col(cut)))


def _in_rounds(fine: Column) -> Column:
    """Whether one of the rounds in `_more` takes the row."""
    rank, size = F.col("_rank"), F.col("_size")
    return F.exists("_more", lambda m: (
        (size <= m["_most"]) & ((fine > m["_f"]) | ((fine == m["_f"]) & (rank > m["_c"])))
        & (m["_to_f"].isNull() | (fine < m["_to_f"]) | ((fine == m["_to_f"]) & (rank <= m["_to_c"])))))


def mixed_rows(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows with `_copies` (0, 1, 2, ...), `source_size` and `target`."""
    rows = rows.join(plan, "_source").withColumn("_rank", _odds(F.col("_u"), F.col("_part")))
    rank = F.col("_rank")
    step = F.floor(rank / (F.lit(1.0) + rank) * (_COARSE * _FINE))
    taken = (
        F.when(rank.isNull(), False)
        .when(~F.col("_crosses"), True)
        .otherwise((step < F.col("_fine_cut"))
                   | ((step == F.col("_fine_cut")) & (rank <= F.col("_cut")))
                   | F.coalesce(rank == F.col("_last"), F.lit(False))
                   | _in_rounds(step))
    )
    return rows.withColumn("_copies", F.col("_whole") + taken.cast("long"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weights: Sequence[float] = (5, 2, 1),
                share: float = 1.5, max_copies: float = 2.0, seed: str = "mix") -> DataFrame:
    """How many words of each document the mix takes: doc_id, size, source_size, target, taken.

    Size is the number of words; null text has none. Null sources form one source, last in order.
    A document's random number depends on seed, id and size alone, so reruns agree and repeated rows
    are taken or left together. Rows without words, also all rows of an empty source, are taken 0
    times. An empty table gives an empty result; columns not named here are not read.
    """
    rows = written(docs.select(F.col(id_col).alias("doc_id"),
                               *_ranked(docs, id_col, text_col, source_col, seed)), "mixing-rows")
    done = mixed_rows(rows, mixing_plan(rows, weights, share, max_copies))
    return done.select("doc_id", F.col("_size").alias("size"), "source_size", "target",
                       (F.col("_size") * F.col("_copies")).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", weights: Sequence[float] = (5, 2, 1),
                    share: float = 1.5, max_copies: float = 2.0, seed: str = "mix") -> DataFrame:
    """The documents of the mix with all their columns, a row for each copy taken.

    The same copies as `mix_sources` counts; a document without words has no weight in the mix and
    stays once.
    """
    keys = _ranked(docs, id_col, text_col, source_col, seed)
    rows = written(docs.select(*keys), "mixing-rows")
    plan = mixing_plan(rows, weights, share, max_copies)
    full = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), *keys)
    copies = F.when(F.col("_size") == 0, F.lit(1)).otherwise(F.col("_copies")).cast("int")
    return (
        mixed_rows(full, plan)
        .select(F.explode(F.array_repeat("_doc", copies)).alias("_doc"))
        .select("_doc.*")
    )
