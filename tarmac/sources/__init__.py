"""Readers and the table-shaped views the registered queries run on."""

from tarmac.sources.events import activations, artifacts, prediction_forms, registry, runs  # noqa: F401
from tarmac.sources.files import (  # noqa: F401
    list_objects,
    object_keys,
    read_active_file,
    read_distances_json,
    read_metric_records,
    read_table,
)
from tarmac.sources.flights import flight_view, read_flights_json, write_flights_json  # noqa: F401
from tarmac.sources.tables import dim, table  # noqa: F401
