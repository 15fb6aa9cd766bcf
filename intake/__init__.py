"""intake: a Spark-native file ingest, compaction and accounting toolkit.

Every operator is a ``DataFrame -> DataFrame`` function (or a sink that writes
one).  Planning is left to Catalyst; the only Python inside tasks is the
restart-on-threshold batch cut, over slices of bounded size.
"""

from intake.schemas import ENTRY_COLUMNS, ENTRY_SCHEMA  # noqa: F401
from intake.session import checkpoint_dir, local_session, scratch_dir  # noqa: F401
