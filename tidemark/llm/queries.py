"""Queries of the training-data operators and the SQL that expresses some of them."""

from __future__ import annotations

from .decontaminate import OP5_SQL, op5_decontamination
from .language_id import op9_language_id
from .license_scan import OP7_SQL, op7_license_scan
from .media_sequences import op4_media_columns, pages_interleaved
from .ngram_join import op1_ngram_jaccard_join
from .pii import op3_pii
from .piece_dropout import op8_piece_dropout
from .token_counts import op10_token_counts
from .toxicity import op2_toxicity
from .url_rules import OP6_SQL, op6_url_filters

QUERIES = {f.__name__: f for f in (op1_ngram_jaccard_join, op2_toxicity, op3_pii, op4_media_columns, op5_decontamination, op6_url_filters, op7_license_scan, op8_piece_dropout, op9_language_id, op10_token_counts, pages_interleaved)}
SQL = {"op5_decontamination": OP5_SQL, "op6_url_filters": OP6_SQL, "op7_license_scan": OP7_SQL}
