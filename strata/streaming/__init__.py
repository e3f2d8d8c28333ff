"""Streaming entry points."""

from strata.streaming.arrival import ArrivalResult, arrival_load

__all__ = ["ArrivalResult", "arrival_load"]
