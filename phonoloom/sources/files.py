"""Folders of recordings and records, pinned snapshots, sidecars of archives, and where a window lies in its carrier."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# What names an audio file, the longest window read, and the samples a tail may lack.
SUFFIXES = ("wav", "flac", "mp3", "m4a", "ogg", "opus", "aac")
LONGEST_S, TAIL = 6 * 3600, 1024


def safe_path(path: Column) -> Column:
    """A6. Whether a relative path stays below its root: not blank, no NUL, not absolute, no part that goes up. Null does not."""
    return F.coalesce((F.trim(path) != "") & ~F.contains(path, F.lit("\x00")) & ~F.startswith(path, F.lit("/")) & ~F.array_contains(F.split(path, "/"), ".."), F.lit(False))


def recordings(spark: SparkSession, folder: str, done: DataFrame | None = None, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """A7. (path, name, size) of the audio files anywhere below ``folder``, without those in ``*_processed`` folders and those whose ``name`` is in ``done``.

    Only the listing is read. A folder without such files gives no rows.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", F.col("length").alias("size"))
    found = files.where(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*suffixes) & ~F.col("path").rlike(r"_processed/"))
    found = found.select("path", F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("name"), "size")
    return found if done is None else found.join(done.select("name").distinct(), "name", "left_anti").select("path", "name", "size")


def record_files(spark: SparkSession, root: str, schema: StructType | str) -> DataFrame:
    """A8. The entries of ``<dir>/<dir>.json``, ``.long.json`` and ``.dialogue.json`` arrays below ``root`` with ``rec`` and ``track`` (short, long, dialogue).

    Folders whose name begins with an underscore, and files not named after their folder, are left out; a file that is no array gives no rows.
    """
    raw = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json").select("value", F.col("_metadata.file_path").alias("p"))
    name = r"/([^/_][^/]*)/([^/]+?)(\.long|\.dialogue)?\.json$"
    raw = raw.select("value", *[F.regexp_extract("p", name, i).alias(c) for i, c in ((1, "dir"), (2, "rec"), (3, "kind"))]).where("dir <> '' and dir = rec")
    track = F.when(F.col("kind") == ".long", "long").when(F.col("kind") == ".dialogue", "dialogue").otherwise("short")
    kind = f"array<{schema if isinstance(schema, str) else schema.simpleString()}>"
    return raw.select("rec", track.alias("track"), F.from_json("value", kind).alias("a")).select("rec", "track", F.inline("a"))


def pinned(path: str) -> str:
    """A10. The path a rolling link points at now; other paths and URIs as they are. Resolved once, while planning."""
    return os.path.realpath(path) if os.path.islink(path) else path


def sidecars(members: DataFrame, schema: StructType | str) -> DataFrame:
    """A13. (archive, member, j) of the JSON members of archives (archive, member, data); members that don't parse are left out."""
    rows = members.where("member like '%.json'").select("archive", "member", F.decode("data", "utf-8").alias("t"))
    kind = schema if isinstance(schema, str) else schema.simpleString()
    return rows.select("archive", "member", F.from_json("t", kind, {"mode": "PERMISSIVE"}).alias("j"), F.get_json_object("t", "$").alias("__ok")).where("__ok is not null and j is not null").drop("__ok")


def carrier_window(start: Column, end: Column, rate: int | Column, own_rate: Column, total: Column) -> tuple[Column, Column, Column]:
    """A15, A16. (problem, from, to) of a window in samples of ``rate`` within a carrier of ``own_rate`` and ``total`` samples.

    Positions are rescaled by whole division. Problems, in order: missing, bad_bounds (negative or not ending after its start),
    too_long (above six hours), past_end (more than 1,024 samples missing); padded is none, its end is kept.
    """
    r = rate if isinstance(rate, Column) else F.lit(rate)
    a, b = F.floor(start * own_rate / r).cast("long"), F.floor(end * own_rate / r).cast("long")
    why = (
        F.when(start.isNull() | end.isNull() | own_rate.isNull() | total.isNull(), "missing").when((start < 0) | (end <= start), "bad_bounds")
        .when(end - start > LONGEST_S * r, "too_long").when(b - total > TAIL, "past_end").when(b > total, "padded")
    )
    ok = why.isNull() | (why == "padded")
    return why, F.when(ok, a), F.when(ok, b)
