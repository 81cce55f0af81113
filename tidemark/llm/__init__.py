"""Operators of a training-data pipeline, each a Spark job over whole tables."""

from __future__ import annotations

import importlib

MODULES: list[str] = ["exact_dedup", "ngram_join", "quality_rules", "mixing", "bpe", "token_files", "url_filter",
                      "quality_classifier", "toxicity", "recurrent_lm", "spelling", "alignment", "neighbours"]


def registered():
    """(queries, check SQL) of this subpackage."""
    queries, oracle = {}, {}
    for name in MODULES:
        module = importlib.import_module(f"{__name__}.{name}")
        queries.update(module.QUERIES)
        oracle.update(module.ORACLE)
    return queries, oracle
