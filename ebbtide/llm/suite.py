"""All queries of this subpackage, each beside its SQL where SQL can say it."""

from ebbtide.llm import (  # noqa: F401  (register their queries)
    bpe,
    decontaminate,
    exact_dedup,
    hard_negatives,
    importance,
    jaccard_join,
    language_id,
    line_dedup,
    lm_score,
    pii,
    sharding,
    substring_dedup,
    suffix_dedup,
)
from ebbtide.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
