"""Registered queries of this subpackage: name -> function of (spark, sf_dir), and DuckDB SQL where SQL can express one."""

from readloom.llm.benchmark_windows import op8_decontamination
from readloom.llm.byte_bpe import op4_byte_bpe
from readloom.llm.context_tree import op1_context_tree
from readloom.llm.exact_dedup import OP13_SQL, op13_exact_dedup
from readloom.llm.lexical_search import OP12_SQL, op12_lexical_search
from readloom.llm.paragraph_dedup import op2_paragraph_dedup
from readloom.llm.periodic_runs import op11_periodic_runs
from readloom.llm.pii import op5_pii
from readloom.llm.quality_classifier import op7_quality_classifier
from readloom.llm.quality_rules import OP6_SQL, op6_quality_rules
from readloom.llm.simhash_dedup import op9_simhash_dedup
from readloom.llm.suffix_dedup import op10_suffix_dedup
from readloom.llm.url_filter import OP3_SQL, op3_url_filter

QUERIES = {
    f.__name__: f
    for f in (
        op1_context_tree,
        op2_paragraph_dedup,
        op3_url_filter,
        op4_byte_bpe,
        op5_pii,
        op6_quality_rules,
        op7_quality_classifier,
        op8_decontamination,
        op9_simhash_dedup,
        op10_suffix_dedup,
        op11_periodic_runs,
        op12_lexical_search,
        op13_exact_dedup,
    )
}
ORACLES: dict[str, str] = {"op3_url_filter": OP3_SQL, "op6_quality_rules": OP6_SQL, "op12_lexical_search": OP12_SQL, "op13_exact_dedup": OP13_SQL}
