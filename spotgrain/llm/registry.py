"""Queries of the corpus operators, and their SQL where SQL expresses them."""

from __future__ import annotations

from . import exact_dedup
from .chunk_dedup import op3_substring_dedup
from .decontaminate import op7_benchmark_decontamination
from .exact_dedup import op6_exact_dedup
from .line_dedup import op9_line_dedup
from .mixing import op8_temperature_mix
from .secret_scan import op1_secret_scan
from .sharding import op5_histogram_sharding
from .simhash import op4_simhash_near_dedup
from .suffix_dedup import op10_suffix_dedup
from .toxicity import op2_toxicity

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_toxicity": op2_toxicity,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_histogram_sharding": op5_histogram_sharding,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_temperature_mix": op8_temperature_mix,
    "op9_line_dedup": op9_line_dedup,
    "op10_suffix_dedup": op10_suffix_dedup,
}

ORACLES = {
    "op6_exact_dedup": exact_dedup.ORACLE,
}
