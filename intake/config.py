"""Scanner, feeder and bundler settings.

A limit below zero is switched off, as in the reference.  Times are
milliseconds.  Unknown keys are refused (``from_dict``), so a setting that
lands in the wrong section fails loudly instead of being ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

# Java TimeUnit names accepted for the retry interval, in ms.
TIME_UNIT_MS = {
    "NANOSECONDS": 1e-6,
    "MICROSECONDS": 1e-3,
    "MILLISECONDS": 1,
    "SECONDS": 1000,
    "MINUTES": 60_000,
    "HOURS": 3_600_000,
    "DAYS": 86_400_000,
}


@dataclass(frozen=True)
class ScanConfig:
    """What one scan of a landing folder may take and when it fires."""

    input_dir: str | None = None
    ignore_prefix: str | None = None
    max_age: int = -1
    max_files: int = -1
    max_size: int = -1
    recursive: bool = False
    error_retry_interval: int = 60_000
    error_retry_time_unit: str = "MILLISECONDS"

    @property
    def retry_ms(self) -> int:
        unit = self.error_retry_time_unit.upper()
        if unit not in TIME_UNIT_MS:
            raise ValueError(f"unknown time unit {self.error_retry_time_unit!r}")
        return int(self.error_retry_interval * TIME_UNIT_MS[unit])

    @classmethod
    def from_dict(cls, d: dict) -> "ScanConfig":
        return _strict(cls, d)


@dataclass(frozen=True)
class FeederConfig:
    target_dir: str
    input_format: str
    data_type: str
    preserve_path: bool = False

    @classmethod
    def from_dict(cls, d: dict) -> "FeederConfig":
        return _strict(cls, d)


@dataclass(frozen=True)
class IngestConfig:
    """``live_ingest`` picks live upserts over bulk output + manifests."""
    live_ingest: bool = False
    output_dir: str | None = None

    @classmethod
    def from_dict(cls, d: dict) -> "IngestConfig":
        return _strict(cls, d)


@dataclass(frozen=True)
class BundlerConfig:
    bundle_output_dir: str
    work_dir: str | None = None
    date_bundle_output: bool = True
    date_format: str = "yyyy/MM/dd"
    manifest_path_to_replace: str = "/flagged/"
    manifest_path_replacement: str = "/loaded/"

    @classmethod
    def from_dict(cls, d: dict) -> "BundlerConfig":
        return _strict(cls, d)


def _strict(cls, d: dict):
    known = {f.name for f in fields(cls)}
    extra = set(d) - known
    if extra:
        raise ValueError(f"unknown {cls.__name__} keys: {sorted(extra)}")
    return cls(**d)


# Sample profiles of the reference's configuration
# (maxFiles, maxAge ms, maxSize bytes).
PROFILES = {
    "feeder_csv": ScanConfig(max_files=2, max_age=60_000, max_size=-1, ignore_prefix=".", recursive=True),
    "bundler_base": ScanConfig(max_files=1, max_age=60_000, max_size=1_000_000_000, ignore_prefix="."),
    "bundler_pri1": ScanConfig(max_files=10, max_age=120_000, max_size=1_000_000_000),
    "bundler_pri2": ScanConfig(max_files=1, max_age=10_000, max_size=1_000_000_000),
    "all_off": ScanConfig(),
}

# Sample feeds (name, queue) and ingest pools (name, queue, replicas).
SAMPLE_FEEDS = [("feed1", "fast"), ("feed2", "fastest"), ("feed3", "fastest")]
SAMPLE_POOLS = [("speedy", "fast", 1), ("speediest", "fastest", 1)]


# The reference's property names per section and ours.
# Settings that have no meaning in Spark (file-system resource lists, scan
# frequency) are accepted and ignored; any other unknown key is refused, so
# table-store connection settings (not built here) must be left out.
REFERENCE_KEYS = {
    "file": {"inputDir": "input_dir", "ignorePrefix": "ignore_prefix", "maxAge": "max_age",
             "maxFiles": "max_files", "maxSize": "max_size", "recursive": "recursive",
             "errorRetryInterval": "error_retry_interval", "errorRetryTimeUnit": "error_retry_time_unit"},
    "feeder": {"targetDir": "target_dir", "inputFormatClass": "input_format", "dataType": "data_type",
               "preservePath": "preserve_path"},
    "bundler": {"workDir": "work_dir", "bundleOutputDir": "bundle_output_dir",
                "dateBundleOutput": "date_bundle_output", "dateFormat": "date_format",
                "manifestPathToReplace": "manifest_path_to_replace",
                "manifestPathReplacement": "manifest_path_replacement"},
    "ingest": {"liveIngest": "live_ingest"},
}
IGNORED_KEYS = {
    "file": {"fsConfigResources", "frequency"},
    "ingest": {"fsConfigResources", "resourceDirPatterns"},
}
_SECTION_CLASS = {"file": ScanConfig, "feeder": FeederConfig, "bundler": BundlerConfig, "ingest": IngestConfig}


def from_reference(section: str, props: dict):
    """Settings from one section of a reference configuration (camelCase
    keys), e.g. ``from_reference("file", {"maxFiles": 2, "maxAge": 60000})``."""
    names = REFERENCE_KEYS[section]
    ignored = IGNORED_KEYS.get(section, set())
    unknown = set(props) - set(names) - ignored
    if unknown:
        raise ValueError(f"unknown {section} settings: {sorted(unknown)}")
    return _SECTION_CLASS[section](**{names[k]: v for k, v in props.items() if k in names})


def load_reference_yaml(text: str) -> dict:
    """All known sections of a reference YAML configuration."""
    import yaml
    doc = yaml.safe_load(text) or {}
    return {sec: from_reference(sec, doc[sec]) for sec in _SECTION_CLASS if isinstance(doc.get(sec), dict)}
