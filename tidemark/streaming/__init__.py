from tidemark.streaming.ingest import ingest_new_files, newest_load, newest_load_time, read_ledger, read_raw

__all__ = ["ingest_new_files", "newest_load", "newest_load_time", "read_ledger", "read_raw"]
