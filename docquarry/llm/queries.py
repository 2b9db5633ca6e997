"""The operators' queries and SQL."""

from __future__ import annotations

from .bpe import op10_bpe
from .chat_format import OP8_SQL, op8_chat_format
from .decontaminate import op4_decontaminate
from .language_id import op2_language_id
from .line_dedup import OP5_SQL, op5_line_dedup
from .near_dedup import OP9_SQL, op9_near_dedup
from .ogg_media import op3_ogg_media
from .quality import op6_quality
from .suffix_dedup import OP1_SQL, op1_suffix_dedup
from .toxicity import op7_toxicity

QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_language_id, op3_ogg_media, op4_decontaminate, op5_line_dedup, op6_quality, op7_toxicity, op8_chat_format, op9_near_dedup, op10_bpe)}
SQL = {"op1_suffix_dedup": OP1_SQL, "op5_line_dedup": OP5_SQL, "op8_chat_format": OP8_SQL, "op9_near_dedup": OP9_SQL}
