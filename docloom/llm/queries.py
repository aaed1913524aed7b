"""The queries of this subpackage's operators, for ``__spark_entry__``."""

from __future__ import annotations

from .chat_format import OP4_SQL, op4_chat_format
from .decontamination import OP1_SQL, op1_decontamination
from .language_id import op6_language_id
from .negatives import OP13_SQL, op13_hard_negatives
from .pii import op7_pii
from .quality_lm import op2_quality
from .ranking import OP11_SQL, op11_grouped_ranking
from .secret_scan import op8_secret_scan
from .sentencepiece_codec import op5_sentencepiece
from .sharding import op3_sharding
from .simhash import op10_simhash
from .substring_dedup import OP12_SQL, op12_substring_dedup
from .topk import OP9_SQL, op9_topk

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_quality": op2_quality,
    "op3_sharding": op3_sharding,
    "op4_chat_format": op4_chat_format,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_language_id": op6_language_id,
    "op7_pii": op7_pii,
    "op8_secret_scan": op8_secret_scan,
    "op9_topk": op9_topk,
    "op10_simhash": op10_simhash,
    "op11_grouped_ranking": op11_grouped_ranking,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLE_SQL = {"op1_decontamination": OP1_SQL, "op4_chat_format": OP4_SQL, "op9_topk": OP9_SQL, "op11_grouped_ranking": OP11_SQL, "op12_substring_dedup": OP12_SQL, "op13_hard_negatives": OP13_SQL}
