"""Operators of a training-data pipeline.  Nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Tasks get these modules' functions by value: executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from farsight.llm.decontam import OP8_SQL, op8_decontaminate
from farsight.llm.lexical import OP13_SQL, op13_lexical_search
from farsight.llm.linededup import OP3_SQL, op3_line_dedup
from farsight.llm.mixing import OP1_SQL, op1_mix
from farsight.llm.neardup import op6_neardup
from farsight.llm.ppm import op4_ppm
from farsight.llm.quality import op5_quality
from farsight.llm.simhash import op10_simhash
from farsight.llm.tokens import op7_token_counts
from farsight.llm.topk import OP11_SQL, op11_topk_search
from farsight.llm.urlfilter import OP2_SQL, op2_url_filter
from farsight.llm.warc import OP9_SQL, op9_warc
from farsight.llm.whitening import op12_whitening

QUERIES = {
    "op1_mix": op1_mix,
    "op2_url_filter": op2_url_filter,
    "op3_line_dedup": op3_line_dedup,
    "op4_ppm": op4_ppm,
    "op5_quality": op5_quality,
    "op6_neardup": op6_neardup,
    "op7_token_counts": op7_token_counts,
    "op8_decontaminate": op8_decontaminate,
    "op9_warc": op9_warc,
    "op10_simhash": op10_simhash,
    "op11_topk_search": op11_topk_search,
    "op12_whitening": op12_whitening,
    "op13_lexical_search": op13_lexical_search,
}

SQL = {
    "op1_mix": OP1_SQL,
    "op2_url_filter": OP2_SQL,
    "op3_line_dedup": OP3_SQL,
    "op8_decontaminate": OP8_SQL,
    "op9_warc": OP9_SQL,
    "op11_topk_search": OP11_SQL,
    "op13_lexical_search": OP13_SQL,
}
