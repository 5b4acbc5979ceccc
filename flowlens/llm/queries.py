"""Registered queries of this package: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from .chat_format import op7_chat_format
from .cross_polytope import op4_cross_polytope
from .license_scan import op3_license_scan
from .line_dedup import op11_line_dedup
from .ngram_join import op2_ngram_jaccard_join
from .oracles import ORACLE_SQL  # noqa: F401  (read by the entry module)
from .ordinal_quality import op8_ordinal_quality
from .packing import op9_packing
from .prefix_trie import op12_prefix_trie
from .quality_rules import op6_quality_rules
from .secret_scan import op1_secret_scan
from .sentencepiece_codec import op5_sentencepiece
from .structure_repair import op13_structure_repair
from .toxicity import op10_toxicity

QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_license_scan": op3_license_scan,
    "op4_cross_polytope": op4_cross_polytope,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_quality_rules": op6_quality_rules,
    "op7_chat_format": op7_chat_format,
    "op8_ordinal_quality": op8_ordinal_quality,
    "op9_packing": op9_packing,
    "op10_toxicity": op10_toxicity,
    "op11_line_dedup": op11_line_dedup,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_structure_repair": op13_structure_repair,
}
