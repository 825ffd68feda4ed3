"""Move vector collections with Spark: read, normalise, encode, upsert, resume."""

import sys

from pyspark import cloudpickle

from vectorferry.model import CollectionSpec
from vectorferry.operators.collection import (
    compact,
    ensure_collection,
    last_write_wins,
    read_collection,
    read_config,
    read_ledger,
    read_quarantine,
    sink_records,
    upsert,
)
from vectorferry.operators.encode import batch_encoder, encode_sparse, register_encoder
from vectorferry.operators.send import send_records
from vectorferry.plans.job import MigrationJob, migrate, verify
from vectorferry.sources import (
    read_columnar_pages,
    read_field_records,
    read_points,
    reader_for,
    register_paged,
    register_reader,
)
from vectorferry.streaming.job import migrate_stream, start_stream

__all__ = [
    "CollectionSpec", "MigrationJob", "batch_encoder", "compact", "encode_sparse",
    "ensure_collection", "last_write_wins", "migrate", "migrate_stream", "read_collection",
    "read_columnar_pages", "read_config", "read_field_records", "read_ledger", "read_points",
    "read_quarantine", "reader_for", "register_encoder", "register_paged", "register_reader",
    "send_records", "sink_records", "start_stream", "upsert", "verify",
]

# Python that runs in tasks (readers, encoders, senders) is sent by value, so
# executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
