"""The registered queries of the operators, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import bound_batches
from tidemark.llm.edit_counts import op10_edit_counts
from tidemark.llm.html_text import op9_html_text
from tidemark.llm.leaks import op6_leaks
from tidemark.llm.near_dup import OP2_SQL, op2_near_dup
from tidemark.llm.packing import op4_packing
from tidemark.llm.quality import op8_quality
from tidemark.llm.token_files import op3_token_files
from tidemark.llm.topk import OP1_SQL, op1_topk
from tidemark.llm.toxicity import op12_toxicity
from tidemark.llm.warc import OP5_SQL, op5_warc
from tidemark.llm.url_rules import OP7_SQL, op7_url_rules
from tidemark.llm.vector_codes import OP13_SQL, op13_vector_codes
from tidemark.llm.whitening import op11_whitening

OPERATORS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk": op1_topk,
    "op2_near_dup": op2_near_dup,
    "op3_token_files": op3_token_files,
    "op4_packing": op4_packing,
    "op5_warc": op5_warc,
    "op6_leaks": op6_leaks,
    "op7_url_rules": op7_url_rules,
    "op8_quality": op8_quality,
    "op9_html_text": op9_html_text,
    "op10_edit_counts": op10_edit_counts,
    "op11_whitening": op11_whitening,
    "op12_toxicity": op12_toxicity,
    "op13_vector_codes": op13_vector_codes,
}


def bounded(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(bound_batches(spark), sf_dir)


QUERIES = {name: bounded(query) for name, query in OPERATORS.items()}
ORACLE_SQL: dict[str, str] = {"op1_topk": OP1_SQL, "op2_near_dup": OP2_SQL, "op5_warc": OP5_SQL, "op7_url_rules": OP7_SQL, "op13_vector_codes": OP13_SQL}
