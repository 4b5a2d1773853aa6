from tidemark.sources.feeds import load_seed, read_csv_feeds, read_feed_csv
from tidemark.sources.schemas import FEEDS

__all__ = ["FEEDS", "load_seed", "read_csv_feeds", "read_feed_csv"]
