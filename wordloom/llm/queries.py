"""The queries of the training-data operators and the SQL that states the same results."""

from __future__ import annotations

from wordloom.llm.embedding_dedup import op8_embedding_dedup
from wordloom.llm.hmm_lm import op3_hmm_lm
from wordloom.llm.html_paths import OP1_SQL, op1_html_paths
from wordloom.llm.line_quality import OP2_SQL, op2_line_quality
from wordloom.llm.mix_sources import OP6_SQL, op6_mix_sources
from wordloom.llm.prefix_bpe import op10_prefix_bpe
from wordloom.llm.simhash_dedup import op5_simhash_dedup
from wordloom.llm.token_counts import op4_token_counts
from wordloom.llm.toxicity_ftrl import op9_toxicity_ftrl
from wordloom.llm.warc_zstd import OP7_SQL, op7_warc_zstd

QUERIES = {
    "op1_html_paths": op1_html_paths,
    "op2_line_quality": op2_line_quality,
    "op3_hmm_lm": op3_hmm_lm,
    "op4_token_counts": op4_token_counts,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_mix_sources": op6_mix_sources,
    "op7_warc_zstd": op7_warc_zstd,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_toxicity_ftrl": op9_toxicity_ftrl,
    "op10_prefix_bpe": op10_prefix_bpe,
}

#: Where SQL can't state the whole result, the tests compare with a brute-force version or a library.
ORACLE_SQL: dict[str, str] = {
    "op1_html_paths": OP1_SQL,
    "op2_line_quality": OP2_SQL,
    "op6_mix_sources": OP6_SQL,
    "op7_warc_zstd": OP7_SQL,
}
