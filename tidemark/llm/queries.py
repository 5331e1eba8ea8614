"""Registered queries of this package and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.alignment import op12_alignment
from tidemark.llm.hashtree import op13_shards, shards_sql
from tidemark.llm.langid import op8_language_id
from tidemark.llm.licenses import op2_licenses
from tidemark.llm.mixing import op9_mixing
from tidemark.llm.neighbours import op3_neighbours
from tidemark.llm.parity import op4_parity
from tidemark.llm.paths import op7_paths
from tidemark.llm.pieces import op10_pieces
from tidemark.llm.quality import op6_quality
from tidemark.llm.repeats import op5_repeats
from tidemark.llm.sql import PARITY_SQL, PATHS_SQL, licenses_sql
from tidemark.llm.warc import OP1_SQL, op1_warc
from tidemark.llm.whitening import op11_whitening

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc,
    "op2_licenses": op2_licenses,
    "op3_neighbours": op3_neighbours,
    "op4_parity": op4_parity,
    "op5_repeats": op5_repeats,
    "op6_quality": op6_quality,
    "op7_paths": op7_paths,
    "op8_language_id": op8_language_id,
    "op9_mixing": op9_mixing,
    "op10_pieces": op10_pieces,
    "op11_whitening": op11_whitening,
    "op12_alignment": op12_alignment,
    "op13_shards": op13_shards,
}

ORACLES: dict[str, str] = {
    "op1_warc": OP1_SQL,
    "op2_licenses": licenses_sql(),
    "op4_parity": PARITY_SQL,
    "op7_paths": PATHS_SQL,
    "op13_shards": shards_sql(),
}
