"""Typed views over the raw tables: redelivered rows once, times in whole milliseconds, NaN as null.

Each view has a SQL twin for the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import millis
from .tables import table


def _number(c: str):
    return F.when(~F.isnan(c), F.col(c))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """idx, sid, seg_index, s, e, spk, txt, lang, q of segments with a start before their end."""
    t = table(spark, sf_dir, "segments")
    rows = t.select(
        F.col("seg_id").alias("idx"), "sid", "seg_index", millis(F.col("start_s")).alias("s"), millis(F.col("end_s")).alias("e"),
        F.col("speaker").alias("spk"), F.col("text").alias("txt"), F.col("language").alias("lang"), _number("dnsmos").alias("q"),
    )
    return rows.where("sid is not null and s is not null and e > s").dropDuplicates(["idx"])


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sid, idx, s, e, spk of diarization frames with a speaker and a start before their end."""
    t = table(spark, sf_dir, "diar_frames")
    rows = t.select("sid", F.col("frame_idx").alias("idx"), millis(F.col("start_s")).alias("s"), millis(F.col("end_s")).alias("e"), F.col("speaker").alias("spk"))
    return rows.where("sid is not null and spk is not null and s is not null and e > s").dropDuplicates(["sid", "idx"])


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest, each id once."""
    return table(spark, sf_dir, "manifest").dropDuplicates(["id"])


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dialogue records, each id once."""
    return table(spark, sf_dir, "dialogue_records").dropDuplicates(["id"])


def nv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nonverbal rows, each id once, with the record id theirs begins with."""
    return table(spark, sf_dir, "nv_rows").dropDuplicates(["id"]).withColumn("rec", F.regexp_extract("id", r"^([^_]+)_", 1))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transcript facts."""
    return table(spark, sf_dir, "seg_texts").dropDuplicates(["fact_id"])


def breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sid, lo, hi of pauses, each once."""
    t = table(spark, sf_dir, "breaks").select("sid", millis(F.col("lo")).alias("lo"), millis(F.col("hi")).alias("hi"))
    return t.where("lo is not null and hi >= lo").distinct()


SQL = {
    "seg": "select distinct on (seg_id) seg_id as idx, sid, seg_index, try_cast(round(start_s * 1000) as bigint) as s, try_cast(round(end_s * 1000) as bigint) as e, speaker as spk, text as txt, language as lang, case when isnan(dnsmos) then null else dnsmos end as q from segments where sid is not null and try_cast(round(end_s * 1000) as bigint) > try_cast(round(start_s * 1000) as bigint)",
    "frm": "select distinct on (sid, frame_idx) sid, frame_idx as idx, try_cast(round(start_s * 1000) as bigint) as s, try_cast(round(end_s * 1000) as bigint) as e, speaker as spk from diar_frames where sid is not null and speaker is not null and try_cast(round(end_s * 1000) as bigint) > try_cast(round(start_s * 1000) as bigint)",
    "man": "select distinct on (id) * from manifest",
    "rec": "select distinct on (id) * from dialogue_records",
    "nv": "select distinct on (id) *, regexp_extract(id, '^([^_]+)_', 1) as rec from nv_rows",
    "fac": "select distinct on (fact_id) * from seg_texts",
    "brk": "select distinct sid, try_cast(round(lo * 1000) as bigint) as lo, try_cast(round(hi * 1000) as bigint) as hi from breaks where lo is not null and hi is not null and try_cast(round(hi * 1000) as bigint) >= try_cast(round(lo * 1000) as bigint)",
}


def sql(body: str, *names: str) -> str:
    """``body`` behind the named view definitions."""
    return "with " + ",\n".join(f"{n} as ({SQL[n]})" for n in names) + (",\n" if body.lstrip().startswith("(") is False and body.lstrip()[:5] == "also " else "\n") + (body.lstrip()[5:] if body.lstrip()[:5] == "also " else body)
