"""Sources: file inventory, typed feed reads, entry read-back."""

from intake.sources.entries import read_entries  # noqa: F401
from intake.sources.inventory import feed_inventories, landing_inventory  # noqa: F401
from intake.sources.typed import TypeSpec, read_typed_feed  # noqa: F401
