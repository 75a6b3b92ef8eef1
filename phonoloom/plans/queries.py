"""Registered queries of the core and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import periods
from ..sources.tables import table
from . import fold_queries, join_queries, record_queries, rule_queries, sequence_queries, source_queries, unit_queries, verdict_queries

MODULES = (sequence_queries, join_queries, fold_queries, verdict_queries, record_queries, rule_queries, source_queries, unit_queries)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = periods.interval_rows(table(spark, sf_dir, "diar_frames"), ["sid", "speaker"], ["sid", "frame_idx"], "start_s", "end_s")
    got = periods.periods_and_gaps(frames, ["sid", "speaker"])
    keep = "(kind = 'period' and n >= 2) or (kind = 'gap' and end_ms - start_ms < 3600000)"
    return got.where(keep).select("sid", "speaker", "kind", "start_ms", "end_ms")


P5_SQL = """
with f as (
  select distinct sid, frame_idx, speaker, try_cast(round(start_s * 1000) as bigint) s, try_cast(round(end_s * 1000) as bigint) e
  from diar_frames
  where sid is not null and trim(sid) <> '' and speaker is not null and trim(speaker) <> ''
    and start_s is not null and end_s is not null and not isnan(start_s) and not isnan(end_s)),
v as (select * from f where e > s),
m as (select *, max(e) over (partition by sid, speaker order by s, e, frame_idx rows between unbounded preceding and 1 preceding) pe from v),
g as (select *, sum(case when pe is null or s > pe then 1 else 0 end) over (partition by sid, speaker order by s, e, frame_idx rows unbounded preceding) isle from m),
p as (select sid, speaker, isle, min(s) s, max(e) e, count(*) n from g group by all),
q as (select *, lag(e) over (partition by sid, speaker order by isle) pe from p)
select sid, speaker, 'period' as kind, s as start_ms, e as end_ms from q where n >= 2
union all
select sid, speaker, 'gap' as kind, pe as start_ms, s as end_ms from q where pe is not null and s - pe < 3600000
"""


def queries() -> dict:
    out = {"p5_found": p5_found}
    for m in MODULES:
        out |= m.QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    out = {"p5_found": P5_SQL}
    for m in MODULES:
        out |= m.ORACLES
    return out
