"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from .archive import OP4_SQL, op4_warc_archive
from .chat import op12_chat_fingerprints
from .decontamination import OP9_SQL, op9_minhash_containment
from .extraction import op10_html_consensus
from .fingerprints import op6_paragraph_iblt
from .hard_negatives import op11_dual_tree
from .jaccard import op8_divide_skip_join
from .language_id import op5_byte_bigru
from .lm_scoring import op1_deleted_interpolation
from .sharding import op3_vector_shards
from .tokenizer import op7_byte_bpe
from .url_filter import op2_url_ratio
from .whitening import op13_jacobi_whitening

QUERIES = {
    "op1_deleted_interpolation": op1_deleted_interpolation,
    "op2_url_ratio": op2_url_ratio,
    "op3_vector_shards": op3_vector_shards,
    "op4_warc_archive": op4_warc_archive,
    "op5_byte_bigru": op5_byte_bigru,
    "op6_paragraph_iblt": op6_paragraph_iblt,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_divide_skip_join": op8_divide_skip_join,
    "op9_minhash_containment": op9_minhash_containment,
    "op10_html_consensus": op10_html_consensus,
    "op11_dual_tree": op11_dual_tree,
    "op12_chat_fingerprints": op12_chat_fingerprints,
    "op13_jacobi_whitening": op13_jacobi_whitening,
}

SQL = {
    "op4_warc_archive": OP4_SQL,
    "op9_minhash_containment": OP9_SQL,
}
