"""All registered queries of this package and their SQL."""

from __future__ import annotations

import corpus_pipeline
from pulcra.llm import alignment, chat, decontam, exact, language, licenses, mixing, pii, quality, simhash, spelling, toxicity, warc  # noqa: F401
from pulcra.llm._base import ORACLES, QUERIES

QUERIES["pipeline"] = corpus_pipeline.run
