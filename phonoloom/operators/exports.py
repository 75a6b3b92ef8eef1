"""Corpus building and export: container entries, packed test sets, track tables, playlists, fact merges, attempts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import first_wins, last_wins
from .ordered import bucketed_rank

HOUR = 3_600_000


def container_entries(containers: DataFrame, entries: DataFrame, wanted: Sequence[str], least_ms: int = 500) -> DataFrame:
    """A22. One row per entry (sid, idx, s, e) of each container (sid, languages) all of whose languages are wanted: id, sid, idx, s, e.

    Ids are ``sid_0000`` and up by the place among all entries of the container, so one that is left out for its length
    keeps its number. Containers without languages are left out. The numbering goes through hour buckets.
    """
    ok = containers.where((F.size("languages") > 0) & (F.size(F.array_except("languages", F.array(*[F.lit(x) for x in wanted]))) == 0)).select("sid").distinct()
    n = bucketed_rank(entries.select("sid", "idx", "s", "e").join(ok, "sid", "left_semi"), ["sid"], "s", ["idx"], HOUR, "__k")
    return n.where(F.col("e") - F.col("s") >= least_ms).select(F.format_string("%s_%04d", "sid", F.col("__k") - 1).alias("id"), "sid", "idx", "s", "e")


def unique_ids(rows: DataFrame, key: str = "id") -> DataFrame:
    """A23. ``rows``, or an error where ``key`` repeats; the check runs before any row is returned."""
    if not rows.groupBy(key).count().where("count > 1").isEmpty():
        raise ValueError(f"repeated {key}")
    return rows


def packed_testset(recordings: DataFrame, turns: DataFrame, least_s: float, most_s: float) -> DataFrame:
    """A24. Turns (sid, idx, s, e) of recordings (sid, duration) of a length between the bounds, clamped to it; empty ones are dropped.

    Recordings without duration are left out.
    """
    r = recordings.where(F.col("duration").between(least_s, most_s)).select("sid", F.round(F.col("duration") * 1000).cast("long").alias("__dur"))
    t = turns.join(r, "sid").withColumn("s", F.greatest("s", F.lit(0))).withColumn("e", F.least("e", "__dur"))
    return t.where("e > s").drop("__dur")


def merged_facts(base: DataFrame, new: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """A19. The facts of ``base`` with those of ``new`` put over them by ``key``; within one side the last in ``order`` holds."""
    both = base.withColumn("__side", F.lit(0)).unionByName(new.withColumn("__side", F.lit(1)))
    return last_wins(both, key, ["__side", order]).drop("__side")


def identified_files(files: DataFrame, identity: DataFrame, key: str, name: str) -> DataFrame:
    """A14. Files with the name a list gives their key: matched, missing (not listed) or duplicate (a later file of the same key, by ``name``)."""
    known = first_wins(identity.select(key, "sample_id"), [key], ["sample_id"])
    first = files.groupBy(key).agg(F.min(name).alias("__first"))
    j = files.join(known, key, "left").join(first, key)
    status = F.when(F.col("sample_id").isNull(), "missing").when(F.col(name) > F.col("__first"), "duplicate").otherwise("matched")
    return j.withColumn("status", status).drop("__first")


def raw_line_id(line: Column) -> Column:
    """A21. The string of the first ``id`` field in a line of JSON, by pattern alone; null where there is none."""
    return F.nullif(F.regexp_extract(line, r'"id"\s*:\s*"((?:[^"\\]|\\.)*)"', 1), F.lit(""))


def parsed_scores(rows: DataFrame, key: str, column: str, strict: bool = True) -> DataFrame:
    """A20. (key, label, score) of JSON arrays of {label, score} in ``column``.

    Strict: a line that is no such array, a repeated key or a repeated or missing label raises. Tolerant: bad lines give no rows.
    """
    d = rows.select(key, F.from_json(column, "array<struct<label:string,score:double>>").alias("__a"))
    bad = F.col("__a").isNull() | F.exists("__a", lambda x: x.isNull() | x["label"].isNull() | x["score"].isNull()) | (F.size(F.array_distinct(F.transform("__a", lambda x: x["label"]))) < F.size("__a"))
    if strict and not (d.where(bad).isEmpty() and d.groupBy(key).count().where("count > 1").isEmpty()):
        raise ValueError("bad score lines")
    return d.where(~bad).select(key, F.inline("__a"))


def permanent_failures(attempts: DataFrame, key: str, most: int = 3) -> DataFrame:
    """B9. Keys with ``most`` failed attempts or more, and how many."""
    return attempts.groupBy(key).agg(F.count(F.lit(1)).alias("attempts")).where(F.col("attempts") >= most)


def playlist_line(name: Column, seconds: Column) -> Column:
    """B6. A playlist entry: ``#EXTINF:`` with the length to three places and the name, then the name as its address."""
    return F.concat(F.lit("#EXTINF:"), F.format_string("%.3f", seconds), F.lit(","), name, F.lit("\n"), name, F.lit(".flac"))


def export_rows(df: DataFrame, path: str, form: str) -> None:
    """B6. Writes rows as ``jsonl``, ``tsv`` (with a header) or, for a single column of lines, ``text``."""
    if form == "jsonl":
        df.write.json(path, ignoreNullFields=False)
    elif form == "tsv":
        df.write.csv(path, sep="\t", header=True)
    elif form == "text":
        df.write.text(path)
    else:
        raise ValueError(f"unknown form {form!r}")


TRACKS = ("all_shorts", "long_chunks", "all_longs", "partial")


def export_tracks(tables: dict[str, DataFrame], root: str) -> None:
    """B3. Writes the four track tables below ``root``, the kept part last, as its presence is the mark of a finished export.

    A table that is there already is kept, so an export that was broken off goes on where it stopped; unknown or
    missing tracks raise before anything is written.
    """
    if set(tables) != set(TRACKS):
        raise ValueError(f"tracks must be {', '.join(TRACKS)}")
    for name in TRACKS:
        tables[name].write.mode("ignore").parquet(f"{root}/{name}")


def exported(spark: SparkSession, root: str) -> bool:
    """B3. Whether an export is finished: the last table with its success mark."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{root}/partial/_SUCCESS")
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))
