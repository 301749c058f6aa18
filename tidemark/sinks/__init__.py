from tidemark.sinks.runs import FILE_KEY, file_key, write_run

__all__ = ["FILE_KEY", "file_key", "write_run"]
