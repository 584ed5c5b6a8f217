from tidemark.streaming.cdc_stream import ChangeLog, stream_cdc

__all__ = ["ChangeLog", "stream_cdc"]
