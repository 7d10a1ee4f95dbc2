"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from crownledger.llm import (
    boilerplate,
    brown,
    decontam,
    dialogue,
    lexical,
    licenses,
    mixing,
    quality,
    secrets,
    sharding,
    simhash,
    tokens,
    warc,
)
from crownledger.llm.text import read

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_decontamination": lambda spark, folder: decontam.op1_decontamination(
            read(spark, folder, "documents"), read(spark, folder, "benchmark")
        ),
        "op2_tokens": lambda spark, folder: tokens.op2_tokens(read(spark, folder, "documents")),
        "op3_secrets": lambda spark, folder: secrets.op3_secrets(read(spark, folder, "documents")),
        "op4_brown": lambda spark, folder: brown.op4_brown(read(spark, folder, "documents")),
        "op5_licenses": lambda spark, folder: licenses.op5_licenses(read(spark, folder, "documents")),
        "op6_mixing": lambda spark, folder: mixing.op6_mixing(read(spark, folder, "documents")),
        "op7_sharding": lambda spark, folder: sharding.op7_sharding(read(spark, folder, "documents")),
        "op8_warc": lambda spark, folder: warc.op8_warc(read(spark, folder, "pages")),
        "op9_quality": lambda spark, folder: quality.op9_quality(read(spark, folder, "documents")),
        "op10_simhash": lambda spark, folder: simhash.op10_simhash(read(spark, folder, "documents")),
        "op11_dialogue": lambda spark, folder: dialogue.op11_dialogue(read(spark, folder, "conversations")),
        "op12_boilerplate": lambda spark, folder: boilerplate.op12_boilerplate(read(spark, folder, "pages")),
        "op13_lexical": lambda spark, folder: lexical.op13_lexical(read(spark, folder, "documents"), read(spark, folder, "benchmark")),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_mixing": mixing.ORACLE_SQL,
        "op7_sharding": sharding.ORACLE_SQL,
        "op8_warc": warc.ORACLE_SQL,
        "op9_quality": quality.ORACLE_SQL,
        "op13_lexical": lexical.ORACLE_SQL,
    }
