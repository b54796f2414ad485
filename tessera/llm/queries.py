"""The queries of this subpackage and, where SQL can express them, their oracles."""

from __future__ import annotations

from tessera.llm.conversations import OP12_SQL, op12_conversation_repair
from tessera.llm.decontam import OP6_SQL, op6_benchmark_decontamination
from tessera.llm.html import op9_html_extraction
from tessera.llm.langid import op4_language_id
from tessera.llm.linededup import OP5_SQL, op5_line_dedup
from tessera.llm.ogg import op7_ogg_media
from tessera.llm.packing import op2_best_fit_packing
from tessera.llm.quality import op3_quality_classifier
from tessera.llm.simhash import op8_simhash_near_dedup
from tessera.llm.suffixes import op10_suffix_dedup
from tessera.llm.toxicity import op11_toxicity
from tessera.llm.warc import OP1_SQL, op1_warc_index_merge
from tessera.llm.whitening import op13_embedding_whitening

QUERIES = {
    "op1_warc_index_merge": op1_warc_index_merge,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_language_id": op4_language_id,
    "op5_line_dedup": op5_line_dedup,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_ogg_media": op7_ogg_media,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_html_extraction": op9_html_extraction,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_toxicity": op11_toxicity,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_embedding_whitening": op13_embedding_whitening,
}
ORACLES: dict[str, str] = {"op1_warc_index_merge": OP1_SQL, "op5_line_dedup": OP5_SQL, "op6_benchmark_decontamination": OP6_SQL, "op12_conversation_repair": OP12_SQL}
