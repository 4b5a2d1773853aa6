from tidemark.streaming.orders import SEQUENCE, latest_versions, stream_orders

__all__ = ["SEQUENCE", "latest_versions", "stream_orders"]
