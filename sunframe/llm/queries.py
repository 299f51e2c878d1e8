"""The queries of this subpackage: one for each corpus operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sunframe.llm.bpe import op4_bpe
from sunframe.llm.classifier import op10_classifier
from sunframe.llm.forest import op8_neighbours
from sunframe.llm.licenses import op3_licenses
from sunframe.llm.packing import op7_packing
from sunframe.llm.rules import op5_rules
from sunframe.llm.secrets import op6_secrets
from sunframe.llm.simhash import op1_simhash
from sunframe.llm.store import op2_store
from sunframe.llm.urls import OP9_SQL, op9_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_store": op2_store,
    "op3_licenses": op3_licenses,
    "op4_bpe": op4_bpe,
    "op5_rules": op5_rules,
    "op6_secrets": op6_secrets,
    "op7_packing": op7_packing,
    "op8_neighbours": op8_neighbours,
    "op9_urls": op9_urls,
    "op10_classifier": op10_classifier,
}

#: DuckDB SQL by query, where SQL can express it.
ORACLES: dict[str, str] = {"op9_urls": OP9_SQL}
