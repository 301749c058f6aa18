from tidemark.streaming.landing import epoch_run_time, land_stream

__all__ = ["epoch_run_time", "land_stream"]
