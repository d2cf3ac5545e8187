"""The queries of this subpackage and their SQL, by name. All modules are imported here, so that what cannot be leaves the others."""

from __future__ import annotations

import corpus_pipeline

from . import chat_format, decontaminate, forest, html_text, jaccard_join, kneser_ney, licenses, lz_fingerprint, mix, pii, repair, toxicity, whiten

MODULES = (chat_format, jaccard_join, decontaminate, mix, lz_fingerprint, kneser_ney, toxicity, pii, html_text, licenses, whiten, repair, forest)


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in getattr(m, "SQL", {}).items()}
