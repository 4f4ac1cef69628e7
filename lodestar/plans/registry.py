"""Queries over the driver's tables, with their SQL oracles."""

from __future__ import annotations

from lodestar.plans import analysis_queries, card_queries, dossier_queries, entity_queries, filing_queries, history_queries, note_queries, resolution_queries, review_queries, trial_queries

PLANS = (trial_queries, entity_queries, analysis_queries, dossier_queries, filing_queries, note_queries, card_queries, review_queries, history_queries, resolution_queries)
flagship = trial_queries.flagship


def queries() -> dict:
    return {k: f for p in PLANS for k, f in p.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {k: s for p in PLANS for k, s in p.ORACLES.items()}
