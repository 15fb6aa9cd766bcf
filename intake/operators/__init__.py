"""DataFrame -> DataFrame operators."""

from intake.operators.batching import batch_plan, threshold_batch, threshold_trigger  # noqa: F401
from intake.operators.bundle import (  # noqa: F401
    STAGES, bundle_ids, dated_output, file_accounting, file_ledger, mark_paired, pair_manifests,
    unpaired_files)
from intake.operators.combine import (  # noqa: F401
    aggregate_entries, combine_entries, dedupe_entries, sort_entries, table_counters)
from intake.operators.filters import (  # noqa: F401
    current_quarantine, exclude_manifests, ignore_prefix, quarantine_filter, quarantine_state,
    quarantine_update)
from intake.operators.metrics import ingest_metrics, observed, stream_progress  # noqa: F401
from intake.operators.prefix import running_totals  # noqa: F401
from intake.operators.shred import metadata_updates, shred_entries  # noqa: F401
from intake.operators.work import (  # noqa: F401
    attempt_ledger, flagged_collisions, parse_work_items, route_orphans, route_work, select_retries, work_items)
