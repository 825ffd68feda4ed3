"""Writing to stores outside Spark."""

from vectorferry.sinks.store import FolderStore, read_folder_store, register_sink

__all__ = ["FolderStore", "read_folder_store", "register_sink"]
