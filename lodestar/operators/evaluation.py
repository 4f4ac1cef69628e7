"""Study cards of one base rank set in order, and rankings kept per evaluator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.operators.dossier import fallback_score
from lodestar.operators.running import running_sums
from lodestar.operators.tables import upsert

#: Confidence of an order that only the card's own quality gave.
FALLBACK_CONFIDENCE = 0.5


def resolved_positions(cards: DataFrame, judged: DataFrame) -> DataFrame:
    """study_id, trial_id, base_rank, enhanced, confidence, relative_position of the cards that share their base rank with
    another.

    cards(study_id, trial_id, base_rank, quality); judged(study_id, trial_id, enhanced, confidence) are the answers
    there are.  A card without one, or of a rank for which there is none at all, gets the score its quality gives.  Positions 1,
    2, ... go by enhanced score, then study and trial.  There are ten ranks, so none is brought to one task:
    positions are running counts over ranges.
    """
    own = judged.groupBy("study_id", "trial_id").agg(F.max(F.struct("enhanced", "confidence")).alias("_j"))
    rows = cards.where(F.col("base_rank").isNotNull()).join(own, ["study_id", "trial_id"], "left")
    groups = rows.groupBy("base_rank").agg(F.count("*").alias("_n")).where("_n > 1")
    met = rows.join(groups.select("base_rank"), "base_rank", "left_semi")
    plain = fallback_score(F.col("base_rank"), F.coalesce("quality", F.lit(0.0)))
    scored = met.select("study_id", "trial_id", "base_rank", F.coalesce("_j.enhanced", plain).cast("int").alias("enhanced"), F.when(F.col("_j.enhanced").isNotNull(), F.col("_j.confidence")).otherwise(FALLBACK_CONFIDENCE).alias("confidence"))
    return running_sums(scored, ["base_rank"], [F.desc("enhanced"), F.asc("study_id"), F.asc("trial_id")], {"relative_position": F.lit(1)})


def save_rankings(current: DataFrame, incoming: DataFrame, evaluator: str, now: Column) -> DataFrame:
    """current(trial_id, evaluator_id, score_1_10, confidence_level, reasoning_text, created_at, updated_at) after
    incoming(trial_id, quality_rank, confidence, notes) of one evaluator.

    A trial has one row per evaluator; an update keeps its day of creation.  Confidence 0 to 1 is told in fifths, cut to a
    whole number; notes are lines of text.  Of several rows of a trial the largest (as a whole) counts.
    """
    rows = incoming.select(
        "trial_id", F.lit(evaluator).alias("evaluator_id"), F.col("quality_rank").alias("score_1_10"), (F.col("confidence") * 5).cast("int").alias("confidence_level"),
        F.array_join("notes", "\n").alias("reasoning_text"), now.alias("created_at"), now.alias("updated_at"),
    )
    known = current.select("trial_id", "evaluator_id", F.col("created_at").alias("_made"))
    kept = rows.join(known, ["trial_id", "evaluator_id"], "left").withColumn("created_at", F.coalesce("_made", "created_at")).drop("_made")
    return upsert(current, kept, ["trial_id", "evaluator_id"], order=[F.desc("score_1_10"), F.desc("confidence_level"), F.desc("reasoning_text")])
