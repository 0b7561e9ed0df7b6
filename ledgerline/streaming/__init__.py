"""Incremental loading: each arriving micro-batch of files is one reconciliation run."""

from ledgerline.streaming.incremental import start_incremental_load

__all__ = ["start_incremental_load"]
