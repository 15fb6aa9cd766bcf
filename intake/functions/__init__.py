"""Column expressions used inside the operators (all JVM-side built-ins)."""

from intake.functions.paths import (  # noqa: F401
    file_name, flagged_path, java_regex_quote, loaded_path, parent_dir, source_file_path)
from intake.functions.ids import content_id, epoch_micros, from_epoch_seconds  # noqa: F401
