"""Writers: bulk output with manifests, live upserts, bundles."""

from intake.sinks.bulk import read_manifests, write_bulk  # noqa: F401
from intake.sinks.live import compact_live, live_current, newest_per_key, run_id_for, upsert_live  # noqa: F401
from intake.sinks.bundles import compact_bundles  # noqa: F401
