"""The pN_ queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lineage import settle
from ..sources.tables import table
from . import groups, language, mixing, packing, pieces, repetition, sentences, tokens, turns


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "segments")
    return turns.speaker_turns(turns.tagged_segments(s, turns.fit_tagger(s))).select("sid", "speaker", "first_seg", "last_seg")


def p1_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "segments")
    return turns.tagged_segments(s, turns.fit_tagger(s)).where("words <> ''").select("seg_id", "words").distinct()


def p1_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "segments")
    return turns.speaker_turns(turns.tagged_segments(s, turns.fit_tagger(s)), with_times=True)


def p1_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "segments")
    return turns.speaker_turns(turns.tagged_segments(s, turns.fit_tagger(s)), with_times=True, with_text=True)


def p2_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    def texts(name: str, key: str, label: str, source) -> DataFrame:
        return table(spark, sf_dir, name).select(F.lit(name).alias("tbl"), F.col(key).cast("string").alias("row_key"), "text", F.col(label).alias("label"), source.alias("source"))

    return repetition.statistics(
        texts("segments", "seg_id", "language", F.lit("segments"))
        .unionByName(texts("seg_texts", "fact_id", "language", F.coalesce("asr_model", F.lit("asr"))))
        .unionByName(texts("documents", "doc_id", "lang", F.col("source")))
    )


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetitive(p2_shares(spark, sf_dir)).select("tbl", "row_key")


def p2_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_shares(spark, sf_dir).select("tbl", "row_key", F.round("share", 6).alias("share"))


def p2_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    # every rejected text, whatever its share
    far = repetition.outliers(p2_shares(spark, sf_dir))
    return far.select("tbl", "row_key", "grp", F.round("d2", 4).alias("d2"), F.round("share", 6).alias("share"))


def _language_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    def texts(name: str, key: str, text: str, label: str) -> DataFrame:
        return table(spark, sf_dir, name).select(F.lit(name).alias("tbl"), F.col(key).cast("string").alias("row_key"), F.col(text).alias("text"), F.col(label).alias("label"))

    segments = texts("segments", "seg_id", "text", "language")
    profiles = language.fit_profiles(segments.withColumnRenamed("row_key", "key"))
    return language.identified(segments.unionByName(texts("manifest", "id", "txt", "lang")).unionByName(texts("documents", "doc_id", "text", "lang")), profiles)


def p3_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _language_parts(spark, sf_dir).distinct()


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.mislabelled(_language_parts(spark, sf_dir))


def _records(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(table(spark, sf_dir, t) for t in ("dialogue_records", "recordings", "segments"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.groups(*_records(spark, sf_dir)).where("id <> group_id").select("group_id", "id")


def p4_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.split_rows(table(spark, sf_dir, "nv_rows"), groups.splits(*_records(spark, sf_dir)))


def p4_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.splits(*_records(spark, sf_dir))


def p4_proportions(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = settle(groups.splits(*_records(spark, sf_dir)))
    return groups.reached(placed, groups.split_rows(table(spark, sf_dir, "nv_rows"), placed))


def p4_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.checked(groups.splits(*_records(spark, sf_dir)))


def p6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, overlap = pieces.limits(table(spark, sf_dir, "size_limits"), "segment")
    return pieces.cut_pieces(table(spark, sf_dir, "segments"), table(spark, sf_dir, "breaks"), round(size * 1000), round(overlap * 1000))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_pieces(spark, sf_dir).where("piece = 0").select("seg_id", "forced_cut")


def p6_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, overlap = pieces.limits(table(spark, sf_dir, "size_limits"), "segment")
    return pieces.checked(settle(p6_pieces(spark, sf_dir)), table(spark, sf_dir, "breaks"), round(size * 1000), round(overlap * 1000))


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    capacity, _ = pieces.limits(table(spark, sf_dir, "size_limits"), "container")
    return packing.pack(tokens.token_counts(table(spark, sf_dir, "documents").where("text is not null"), ["doc_id"]), int(capacity))


def p7_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    capacity, _ = pieces.limits(table(spark, sf_dir, "size_limits"), "container")
    return packing.checked(settle(p7_containers(spark, sf_dir)), int(capacity))


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    capacity, _ = pieces.limits(table(spark, sf_dir, "size_limits"), "container")
    return packing.fill(p7_containers(spark, sf_dir), int(capacity))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the first piece of each document that had to be cut
    return p7_containers(spark, sf_dir).where("doc_tokens > tokens and piece = 0").select("doc_id")


def _mixed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[tuple]]:
    sized = settle(tokens.token_counts(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "kind"]).withColumnsRenamed({"lang": "language", "kind": "domain"}))
    planned = mixing.plan(sized, table(spark, sf_dir, "mix_targets"))
    return mixing.select(spark, sized, planned), planned


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixed(spark, sf_dir)[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(spark, *_mixed(spark, sf_dir))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_shares(spark, sf_dir).where("short").select("source")


def p8_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen, planned = _mixed(spark, sf_dir)
    return mixing.checked(spark, chosen, planned)


def p9_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sentences.checked(p9_found(spark, sf_dir), docs)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences.fitted_sentences(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {k: v for k, v in globals().items() if k[:1] == "p" and k[1:2].isdigit() and callable(v)}
