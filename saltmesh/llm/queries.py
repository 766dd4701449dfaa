"""Registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .best_fit import op6_best_fit
from .decontaminate import OP12_SQL, op12_decontaminate
from .fill_middle import OP11_SQL, op11_fill_middle
from .language_crf import op2_language_crf
from .license_scan import op4_license_scan
from .media_columns import op7_media_columns
from .multi_index import op3_multi_index
from .ngram_join import OP9_SQL, op9_ngram_join
from .piece_bpe import op8_piece_bpe
from .quality_bayes import op5_quality_bayes
from .suffix_dedup import op10_suffix_dedup
from .vector_codes import OP13_SQL, op13_vector_codes
from .warc import OP1_SQL, op1_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_warc,
        op2_language_crf,
        op3_multi_index,
        op4_license_scan,
        op5_quality_bayes,
        op6_best_fit,
        op7_media_columns,
        op8_piece_bpe,
        op9_ngram_join,
        op10_suffix_dedup,
        op11_fill_middle,
        op12_decontaminate,
        op13_vector_codes,
    )
}

SQL: dict[str, str] = {"op1_warc": OP1_SQL, "op9_ngram_join": OP9_SQL, "op11_fill_middle": OP11_SQL, "op12_decontaminate": OP12_SQL, "op13_vector_codes": OP13_SQL}
