"""The queries of this subpackage and, where SQL can express one, its DuckDB form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .decontamination import OP1_SQL, op1_decontamination
from .importance import op5_importance_resampling
from .language import op9_language
from .mixing import OP3_SQL, op3_mixing
from .preference import OP10_SQL, op10_preference
from .quality_rules import op7_quality_rules
from .secrets import OP6_SQL, op6_secrets
from .simhash import op4_simhash
from .token_files import op8_token_files
from .toxicity import op2_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_toxicity": op2_toxicity,
    "op3_mixing": op3_mixing,
    "op4_simhash": op4_simhash,
    "op5_importance_resampling": op5_importance_resampling,
    "op6_secrets": op6_secrets,
    "op7_quality_rules": op7_quality_rules,
    "op8_token_files": op8_token_files,
    "op9_language": op9_language,
    "op10_preference": op10_preference,
}

ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": OP1_SQL,
    "op3_mixing": OP3_SQL,
    "op6_secrets": OP6_SQL,
    "op10_preference": OP10_SQL,
}
