from sensorfold.plans.batch import compare_tables, reduce_tables, run_batch
from sensorfold.plans.streams import ledger, open_windows, told_readings

__all__ = ["compare_tables", "ledger", "open_windows", "reduce_tables", "run_batch", "told_readings"]
