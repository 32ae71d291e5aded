"""Event-analytics warehouse on Spark: JSONL events in, clean facts and reports out."""

from eventmart.plans.warehouse import Warehouse
from eventmart.session import configure

__all__ = ["Warehouse", "configure"]
