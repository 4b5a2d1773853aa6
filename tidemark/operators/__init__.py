from tidemark.operators.joins import fits_broadcast, lookup, lookup_all, payload_bytes
from tidemark.operators.quality import Check, check_relations
from tidemark.operators.privacy import drop_pii, pii
from tidemark.operators.snapshots import CommitConflict
from tidemark.operators.tables import Partitioning, Table

__all__ = [
    "Check", "CommitConflict", "Partitioning", "Table", "check_relations", "drop_pii", "fits_broadcast", "lookup", "lookup_all",
    "payload_bytes", "pii",
]
