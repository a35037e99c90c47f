"""Loads composed from sources, operators and sinks."""

from ledgerline.plans.loads import LoadMetrics, load_envelopes, load_json_rows

__all__ = ["LoadMetrics", "load_envelopes", "load_json_rows"]
