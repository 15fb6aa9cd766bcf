"""Path expressions: name, parent, flagged target and loaded target."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_REGEX_SPECIAL = set("\\^$.|?*+()[]{}")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def path_key(c) -> Column:
    """One spelling of a path for joins: a local path with or without scheme."""
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, "^file:/+", "/")


def file_name(path) -> Column:
    """Last part of a path (``Path.getName``)."""
    return F.regexp_extract(_col(path), r"([^/]*)$", 1)


def parent_dir(path) -> Column:
    """Everything before the last ``/`` (``Path.getParent``)."""
    return F.regexp_extract(_col(path), r"^(.*)/[^/]*$", 1)


def java_regex_quote(s: str) -> str:
    """Escape a literal for use inside a Java regular expression."""
    return "".join("\\" + ch if ch in _REGEX_SPECIAL else ch for ch in s)


def _replacement_quote(s: str) -> str:
    return s.replace("\\", "\\\\").replace("$", "\\$")


def flagged_path(path, target_dir: str, input_dir: str | None = None,
                 preserve_path: bool = False) -> Column:
    """Where the feeder moves a landed file.

    Flat mode: ``target_dir/name``.  Preserve mode: if the input folder occurs
    in the path, the part after it is kept below ``target_dir``; otherwise flat.
    Trailing slashes of both folders are dropped first.
    """
    p = _col(path)
    target = target_dir.rstrip("/")
    flat = F.concat(F.lit(target + "/"), file_name(p))
    if not preserve_path or not input_dir:
        return flat
    inp = input_dir.rstrip("/")
    at = F.instr(p, inp)
    kept = F.substr(p, at + F.lit(len(inp) + 1))
    return F.when(at > 0, F.concat(F.lit(target + "/"), kept)).otherwise(flat)


def loaded_path(path, mode: str = "all", to_replace: str = "/flagged/",
                replacement: str = "/loaded/") -> Column:
    """Rewrite ``/flagged/`` to ``/loaded/``.

    ``mode="all"`` replaces every literal occurrence (bundler accounting);
    ``mode="first"`` only the first one (live ingest).
    """
    p = _col(path)
    if mode == "all":
        return F.replace(p, F.lit(to_replace), F.lit(replacement))
    if mode == "first":
        pattern = "^(.*?)" + java_regex_quote(to_replace)
        return F.regexp_replace(p, F.lit(pattern), F.lit("$1" + _replacement_quote(replacement)))
    raise ValueError(f"mode must be 'all' or 'first', got {mode!r}")


def source_file_path(encoded="_metadata.file_path") -> Column:
    """The file a row was read from (or what ``encoded`` is of its path), spelled like the file listing
    (``binaryFile``'s ``path``): Spark's ``_metadata.file_path`` is
    URL-encoded (a space is ``%20``), so it is decoded — with a literal ``+``
    protected, which the decoder would otherwise read as a space."""
    return F.url_decode(F.replace(_col(encoded), F.lit("+"), F.lit("%2B")))
