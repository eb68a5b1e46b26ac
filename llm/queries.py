"""The registered queries of the operators, and the SQL that some can be compared with."""

from __future__ import annotations

from llm.centroids import ORACLE as CENTROID_SQL
from llm.centroids import op12
from llm.chat import ORACLE as CHAT_SQL
from llm.chat import op11
from llm.common import read
from llm.decontaminate import ORACLE as PHRASE_SQL
from llm.decontaminate import op4
from llm.lines import op8
from llm.middle import ORACLE as MIDDLE_SQL
from llm.middle import op13
from llm.mixing import op7
from llm.ngram_join import op5
from llm.pii import op3
from llm.quality import op9
from llm.secret_scan import op6
from llm.substring import ORACLE as SUBSTRING_SQL
from llm.substring import op10
from llm.suffix import op1
from llm.warc import ORACLE as WARC_SQL
from llm.warc import op2


def _over(fn, *tables):
    return lambda spark, sf_dir: fn(*[read(spark, sf_dir, t) for t in tables or ("documents",)])


QUERIES = {
    "op1_bwt_merge": _over(op1),
    "op2_warc_chain": _over(op2, "pages"),
    "op3_pii_boosting": _over(op3),
    "op4_positional_index": _over(op4, "documents", "benchmark"),
    "op5_bayes_jaccard": _over(op5),
    "op6_secret_network": _over(op6),
    "op7_pivotal_mixing": _over(op7),
    "op8_fuzzy_lines": _over(op8),
    "op9_quality_fertility": _over(op9),
    "op10_block_anchors": _over(op10),
    "op11_chat_round_trip": _over(op11, "conversations"),
    "op12_sharded_lloyd": _over(op12, "embeddings"),
    "op13_fill_in_middle": _over(op13),
}
ORACLES: dict[str, str] = {
    "op2_warc_chain": WARC_SQL,
    "op4_positional_index": PHRASE_SQL,
    "op10_block_anchors": SUBSTRING_SQL,
    "op11_chat_round_trip": CHAT_SQL,
    "op12_sharded_lloyd": CENTROID_SQL,
    "op13_fill_in_middle": MIDDLE_SQL,
}
