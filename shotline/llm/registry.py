"""Queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from . import pipeline
from .decontaminate import ORACLE_OP4, op4_decontamination
from .html import op1_html
from .langid import op3_language
from .minhash import op9_minhash
from .neighbours import op6_embedding_dedup
from .packing import op7_packing
from .pii import op5_pii
from .quality import op8_quality
from .sharding import op2_sharding
from .urls import op10_url_filter


def queries() -> dict:
    return {
        "op1_html": op1_html,
        "op2_sharding": op2_sharding,
        "op3_language": op3_language,
        "op4_decontamination": op4_decontamination,
        "op5_pii": op5_pii,
        "op6_embedding_dedup": op6_embedding_dedup,
        "op7_packing": op7_packing,
        "op8_quality": op8_quality,
        "op9_minhash": op9_minhash,
        "op10_url_filter": op10_url_filter,
        "pipeline": pipeline.run,
    }


def oracle_sql() -> dict:
    return {"op4_decontamination": ORACLE_OP4}
