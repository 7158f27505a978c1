from changeflow.streaming.flows import MOST_FILES, Refused, append_stream, counts_file, finish, intake, upsert_stream, write_checked

__all__ = ["MOST_FILES", "Refused", "append_stream", "counts_file", "finish", "intake", "upsert_stream", "write_checked"]
