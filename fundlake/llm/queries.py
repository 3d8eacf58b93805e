"""Registered queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fundlake.llm import dual_tree, raking, spaced_seeds, url_rules
from fundlake.llm.context_tree import op1_context_tree
from fundlake.llm.cross_polytope import op3_cross_polytope
from fundlake.llm.dual_tree import op12_dual_tree
from fundlake.llm.fast_sketch_dedup import op4_fast_sketch_dedup
from fundlake.llm.host_paths import op8_host_paths
from fundlake.llm.mil_toxicity import op5_mil_toxicity
from fundlake.llm.nbsvm_quality import op10_nbsvm_quality
from fundlake.llm.ppm_langid import op7_ppm_langid
from fundlake.llm.raking import op2_raking
from fundlake.llm.spaced_seeds import op6_spaced_seeds
from fundlake.llm.token_alignment import op13_token_alignment
from fundlake.llm.token_store import op9_token_store
from fundlake.llm.url_rules import op11_url_rules

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_context_tree": op1_context_tree,
    "op2_raking": op2_raking,
    "op3_cross_polytope": op3_cross_polytope,
    "op4_fast_sketch_dedup": op4_fast_sketch_dedup,
    "op5_mil_toxicity": op5_mil_toxicity,
    "op6_spaced_seeds": op6_spaced_seeds,
    "op7_ppm_langid": op7_ppm_langid,
    "op8_host_paths": op8_host_paths,
    "op9_token_store": op9_token_store,
    "op10_nbsvm_quality": op10_nbsvm_quality,
    "op11_url_rules": op11_url_rules,
    "op12_dual_tree": op12_dual_tree,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES: dict[str, str] = {
    "op2_raking": raking.oracle(),
    "op6_spaced_seeds": spaced_seeds.oracle(),
    "op11_url_rules": url_rules.oracle(),
    "op12_dual_tree": dual_tree.oracle(),
}
