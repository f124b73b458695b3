"""Analyses and the end-to-end pipeline."""

from reqlens.plans import analyses, pipeline
from reqlens.plans.analyses import ANALYSES, run_analyses
from reqlens.plans.pipeline import run_pipeline

__all__ = ["ANALYSES", "analyses", "pipeline", "run_analyses", "run_pipeline"]
