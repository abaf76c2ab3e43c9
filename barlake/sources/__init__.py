"""Inputs: landing-zone reads and the layered table catalog."""

from barlake.sources.catalog import Lake
from barlake.sources.landing import read_landing_bars, read_landing_info

__all__ = ["Lake", "read_landing_bars", "read_landing_info"]
