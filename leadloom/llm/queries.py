"""Registered queries of this subpackage, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leadloom.llm.alignment import op11_interval_alignment
from leadloom.llm.bpe import op3_token_counts
from leadloom.llm.decontamination import op1_latent_decontamination
from leadloom.llm.fingerprints import op5_imatch_fingerprints
from leadloom.llm.licenses import op7_license_scan
from leadloom.llm.minhash import op2_bbit_minhash
from leadloom.llm.packing import op8_linear_grouping_packing
from leadloom.llm.quality import op9_pairwise_quality
from leadloom.llm.quantisation import op12_product_quantisation
from leadloom.llm.sharding import op4_interleaved_shards
from leadloom.llm.toxicity import op6_factorization_toxicity
from leadloom.llm.warc import OP10_SQL, op10_revisit_resolution
from leadloom.llm.whitening import op13_lanczos_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_latent_decontamination": op1_latent_decontamination,
    "op2_bbit_minhash": op2_bbit_minhash,
    "op3_token_counts": op3_token_counts,
    "op4_interleaved_shards": op4_interleaved_shards,
    "op5_imatch_fingerprints": op5_imatch_fingerprints,
    "op6_factorization_toxicity": op6_factorization_toxicity,
    "op7_license_scan": op7_license_scan,
    "op8_linear_grouping_packing": op8_linear_grouping_packing,
    "op9_pairwise_quality": op9_pairwise_quality,
    "op10_revisit_resolution": op10_revisit_resolution,
    "op11_interval_alignment": op11_interval_alignment,
    "op12_product_quantisation": op12_product_quantisation,
    "op13_lanczos_whitening": op13_lanczos_whitening,
}

ORACLES: dict[str, str] = {"op10_revisit_resolution": OP10_SQL}
