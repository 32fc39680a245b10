"""Reading the two feeds and writing results."""

from counterfoil.sources.feeds import CLIENT, SERVER, Feed
from counterfoil.sources.records import (
    land_array,
    land_records,
    number_records,
    read_array,
    read_clean,
    read_records,
    readable,
)
from counterfoil.sources.sinks import save_models, write_json

__all__ = [
    "CLIENT",
    "SERVER",
    "Feed",
    "land_array",
    "land_records",
    "number_records",
    "read_array",
    "read_clean",
    "read_records",
    "readable",
    "save_models",
    "write_json",
]
