"""Keep the history of changing tables on Spark."""

from chronotable.operators.merge import Merge, upsert
from chronotable.operators.status import Status
from chronotable.plans.history import merge_history
from chronotable.plans.scd1 import scd1_upsert
from chronotable.plans.scd2 import State, scd2_changes, scd2_fold, scd2_run
from chronotable.plans.spec import Dimension
from chronotable.sources.state import HistoryStore

__all__ = [
    "Dimension",
    "HistoryStore",
    "Merge",
    "State",
    "Status",
    "merge_history",
    "scd1_upsert",
    "scd2_changes",
    "scd2_fold",
    "scd2_run",
    "upsert",
]
