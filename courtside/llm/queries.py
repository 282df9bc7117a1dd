"""One query for each text operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from courtside.llm.byte_bpe import op3_byte_bpe
from courtside.llm.collocations import op13_collocations
from courtside.llm.common import few_files, read_table
from courtside.llm.html_extract import op1_html_extract
from courtside.llm.language_id import op10_language_id
from courtside.llm.license_scan import op2_license_scan
from courtside.llm.line_dedup import op9_line_dedup
from courtside.llm.ngram_join import op5_ngram_join
from courtside.llm.packing import op6_packing
from courtside.llm.periodic_runs import op11_periodic_runs
from courtside.llm.phrase_index import op12_decontamination
from courtside.llm.quality_rules import op4_quality_rules
from courtside.llm.span_dedup import op7_span_dedup
from courtside.llm.vector_dedup import op8_vector_dedup

Query = Callable[[SparkSession, str], DataFrame]


def _on(table: str, run: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: few_files(run(read_table(spark, folder, table)))


def queries() -> dict[str, Query]:
    return {
        "op1_html_extract": _on("pages", op1_html_extract),
        "op2_license_scan": _on("documents", op2_license_scan),
        "op3_byte_bpe": _on("documents", lambda docs: op3_byte_bpe(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)),
        "op4_quality_rules": _on("documents", op4_quality_rules),
        "op5_ngram_join": _on("documents", op5_ngram_join),
        "op6_packing": _on("documents", lambda docs: op6_packing(docs, public_tokenizers.path("word_bpe_49k.json"))),
        "op7_span_dedup": _on("documents", op7_span_dedup),
        "op8_vector_dedup": _on("embeddings", op8_vector_dedup),
        "op9_line_dedup": _on("documents", op9_line_dedup),
        "op10_language_id": _on("documents", op10_language_id),
        "op11_periodic_runs": _on("documents", op11_periodic_runs),
        "op12_decontamination": lambda spark, folder: few_files(
            op12_decontamination(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
        ),
        "op13_collocations": _on("documents", op13_collocations),
    }


def oracle_sql() -> dict[str, str]:
    return {}
