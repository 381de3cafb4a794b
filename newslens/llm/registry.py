"""The queries of this subpackage, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, collocations, decontam, neardup, periodic, sharding, topk
from .chat import op6_chat_format
from .collocations import op12_collocations
from .decontam import op1_benchmark_leaks
from .html_text import op9_html_main_text
from .langid import op2_language_id
from .neardup import op4_bagminhash_near_dups
from .packing import op7_best_fit_packing
from .periodic import op11_periodic_runs
from .pii import op5_skip_chain_pii
from .quality import op8_ordinal_quality
from .sharding import op3_jump_shards
from .topk import op10_fagin_topk
from .toxicity import op13_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_benchmark_leaks,
        op2_language_id,
        op3_jump_shards,
        op4_bagminhash_near_dups,
        op5_skip_chain_pii,
        op6_chat_format,
        op7_best_fit_packing,
        op8_ordinal_quality,
        op9_html_main_text,
        op10_fagin_topk,
        op11_periodic_runs,
        op12_collocations,
        op13_toxicity,
    )
}

ORACLE_SQL: dict[str, str] = {**decontam.ORACLE_SQL, **sharding.ORACLE_SQL, **neardup.ORACLE_SQL, **chat.ORACLE_SQL, **topk.ORACLE_SQL, **periodic.ORACLE_SQL, **collocations.ORACLE_SQL}
