"""Structured Streaming re-expression of the batch drift statistics."""

from riskfold.streaming.psi_monitor import (  # noqa: F401
    batch_psi,
    read_score_stream,
    reference_histogram,
    start_psi_monitor,
)
