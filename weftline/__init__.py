"""Column lineage explained by the SQL that produces it, as Spark jobs."""

from .constants import CONCAT, PATCHED, PROFILES, ROWS, Profile
from .plans.lineage import (
    Corpus,
    Lineage,
    best_candidates,
    candidates,
    extract_lineage,
    statement_dim,
)
from .plans.pipeline import run_pipeline

__all__ = [
    "CONCAT",
    "PATCHED",
    "PROFILES",
    "ROWS",
    "Corpus",
    "Lineage",
    "Profile",
    "best_candidates",
    "candidates",
    "extract_lineage",
    "run_pipeline",
    "statement_dim",
]
