"""Scalar rules for names, paths, durations and URLs (Column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import py_strip

# Fixed values
MISSING_ID_NAME = "missing-id"
APPROX_MARKER = "(approx)"
DEFAULT_AUDIO_URL_TEMPLATE = "https://media.example.org/download?direct=1&ref={ref}&ext=mp3"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sanitize_for_filename(c: Column | str, sep: str = "/") -> Column:
    """strip; path separator -> ``_``; other unsafe runs -> ``_``; squeeze and trim ``_``."""
    v = F.replace(py_strip(_c(c)), F.lit(sep), F.lit("_"))
    v = F.regexp_replace(v, "[^A-Za-z0-9._-]+", "_")
    v = F.regexp_replace(v, "_+", "_")
    v = F.regexp_replace(v, "^_+|_+\\z", "")
    return F.when(F.coalesce(v, F.lit("")) == "", F.lit(MISSING_ID_NAME)).otherwise(v)


def normalize_duration(c: Column | str) -> Column:
    """Remove every ``(approx)`` marker, then strip; null passes through."""
    return py_strip(F.replace(_c(c), F.lit(APPROX_MARKER), F.lit("")))


def audio_url(ref: Column | str, template: str = DEFAULT_AUDIO_URL_TEMPLATE) -> Column:
    """Drop the trimmed id into a ``{ref}`` URL template."""
    head, _, tail = template.partition("{ref}")
    return F.concat(F.lit(head), py_strip(_c(ref)), F.lit(tail))


def base_name(path: Column | str) -> Column:
    return F.regexp_extract(_c(path), "([^/]*)$", 1)


def relative_path(path: Column | str, root: str) -> Column:
    """Path below ``root`` (``root`` without a trailing slash); null when outside."""
    prefix = root.rstrip("/") + "/"
    p = _c(path)
    return F.when(p.startswith(prefix), F.substring(p, len(prefix) + 1, 1 << 30))


def is_under(path: Column | str, directory: str) -> Column:
    d = directory.rstrip("/")
    p = _c(path)
    return (p == F.lit(d)) | p.startswith(d + "/")


def cleaned_output_path(path: Column | str, input_root: str, output_root: str, ext: str = ".txt") -> Column:
    """Mirror the relative folder; ``x.txt`` -> ``x_cleaned.txt``, else ``name_cleaned`` + ext."""
    rel = relative_path(path, input_root)
    rel_dir = F.regexp_extract(rel, "^(.*/)?[^/]*$", 1)
    name = base_name(rel)
    if ext:
        out_name = F.when(
            name.endswith(ext),
            F.concat(name.substr(F.lit(1), F.length(name) - F.lit(len(ext))), F.lit("_cleaned" + ext)),
        ).otherwise(F.concat(name, F.lit("_cleaned" + ext)))
    else:
        out_name = F.concat(name, F.lit("_cleaned"))
    return F.concat(F.lit(output_root.rstrip("/") + "/"), rel_dir, out_name)

