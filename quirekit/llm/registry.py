"""Queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from corpus_pipeline import run
from quirekit.llm.context_tree import op5_context_tree
from quirekit.llm.order_minhash import op4_order_minhash
from quirekit.llm.ordinal_quality import op7_ordinal_quality
from quirekit.llm.power_pack import op3_power_pack
from quirekit.llm.prefix_join import ORACLE as OP9
from quirekit.llm.prefix_join import op9_prefix_join
from quirekit.llm.rotated_codes import ORACLE as OP6
from quirekit.llm.rotated_codes import op6_rotated_codes
from quirekit.llm.skip_chain_pii import op2_skip_chain_pii
from quirekit.llm.slot_table import op10_slot_table
from quirekit.llm.slot_table import oracle as op10
from quirekit.llm.source_mix import ORACLE as OP8
from quirekit.llm.source_mix import op8_source_mix
from quirekit.llm.url_reputation import ORACLE as OP1
from quirekit.llm.url_reputation import op1_url_reputation


def queries() -> dict:
    """Query name to callable."""
    operators = (op1_url_reputation, op2_skip_chain_pii, op3_power_pack, op4_order_minhash, op5_context_tree, op6_rotated_codes, op7_ordinal_quality, op8_source_mix, op9_prefix_join, op10_slot_table)
    return {f.__name__: f for f in operators} | {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    """Query name to DuckDB SQL."""
    return {"op1_url_reputation": OP1, "op6_rotated_codes": OP6, "op8_source_mix": OP8, "op9_prefix_join": OP9, "op10_slot_table": op10()}
