"""The thin queries over the operators of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import sql


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import deduplicate

    return deduplicate(_documents(spark, sf_dir), length=50, digest=True)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import judge

    return judge(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), max_labelled=20_000)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contamination

    return contamination(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=13, share=20).drop("items", "spans")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_mix import identify

    return identify(_documents(spark, sf_dir))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .parity_join import link_components

    return link_components(_documents(spark, sf_dir), k=4, percent=85).drop("class_id")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .cover_dedup import remove_repeats

    return remove_repeats(_documents(spark, sf_dir), window=35, digest=True)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import scan

    return scan(_documents(spark, sf_dir), coverage=0.8)


#: (host, path, verdict) of the URL query.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_rules import apply_rules, rules_frame

    return apply_rules(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules_frame(spark, URL_RULES))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .rank_bpe import token_digests

    return token_digests(_documents(spark, sf_dir), vocabulary())


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .frames import scratch_path
    from .token_blocks import read_tokens, write_tokens

    path = scratch_path(spark, "tokens")
    write_tokens(_documents(spark, sf_dir), path, vocabulary(), end_id=0)
    return read_tokens(spark, path)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .token_sweep import Vocabularies, alignment

    return alignment(_documents(spark, sf_dir), Vocabularies(vocabulary(), public_tokenizers.path("piece_bpe_32k.model")))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .conversation_repair import damaged, repair_table

    return repair_table(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")), copies_col="copies").drop("lines")


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_model import fit, score

    docs = _documents(spark, sf_dir)
    return score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), max_labelled=20_000), threshold=0.3)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k[:2] == "op" and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_suffix_dedup": sql.OP1,
        "op3_decontaminate": sql.OP3,
        "op5_jaccard_join": sql.OP5,
        "op6_substring_dedup": sql.OP6,
        "op12_conversation_repair": sql.OP12,
        "op8_url_filters": """
            with p as (
                select page_id,
                    coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
                    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') as path
                from pages
            ), r(h, q, v) as (values """ + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES) + """),
            m as (
                select page_id, host, path, h || q as rule, v,
                    row_number() over (partition by page_id order by case when h is null then -1 else length(h || q) end desc) as k
                from p left join r on (host = h or ends_with(host, '.' || h)) and starts_with(path, q)
            )
            select page_id, host, path, rule, coalesce(v, 'allow') as verdict from m where k = 1
        """,
    }
