"""Labels, categories and keys that file paths carry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from poseframes.params import VIDEO_EXTENSIONS


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """The base name without its last suffix; a leading dot is no suffix."""
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]+$", "")


def label_from_path(rel_path: Column) -> Column:
    """The parent folder without a leading number, trimmed and in lower case; ``unknown`` if none."""
    parts = F.split(rel_path, "/")
    parent = F.when(F.size(parts) > 1, F.element_at(parts, -2)).otherwise(F.lit("unknown"))
    label = F.lower(F.regexp_replace(F.regexp_replace(parent, r"^\d+[.\-_ ]+", ""), r"^\s+|\s+$", ""))
    return F.coalesce(F.nullif(label, F.lit("")), F.lit("unknown"))


def archive_category(name: Column) -> Column:
    """The archive's name without its part number and its extension."""
    return F.replace(F.regexp_replace(name, r"_\d+of\d+\.zip$", ""), F.lit(".zip"), F.lit(""))


def clip_key(rel_path: Column) -> Column:
    """Stem and the first 16 hex digits of the path's SHA-1: equal names in two folders differ."""
    return F.concat_ws("_", stem(rel_path), F.substring(F.sha1(rel_path.cast("binary")), 1, 16))


def is_video(rel_path: Column) -> Column:
    """A known extension, and not below a ``_zips`` folder."""
    suffix = F.lower(F.regexp_extract(base_name(rel_path), r".(\.[^.]+)$", 1))
    return suffix.isin(VIDEO_EXTENSIONS) & ~F.array_contains(F.split(rel_path, "/"), "_zips")


def in_category(rel_path: Column, wanted: list[str]) -> Column:
    """Any part of the path, the file name too, equals a wanted name, whatever the case."""
    return F.arrays_overlap(F.transform(F.split(rel_path, "/"), F.lower), F.array(*(F.lit(w.lower()) for w in wanted)))
