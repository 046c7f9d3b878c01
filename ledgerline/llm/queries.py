"""The queries of this subpackage by name, and SQL for those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from ledgerline.llm import lexical, licenses, topk, urlrules
from ledgerline.llm.decontam import op7_decontam
from ledgerline.llm.lexical import op13_lexical
from ledgerline.llm.licenses import op5_licenses
from ledgerline.llm.packing import op9_packing
from ledgerline.llm.pii import op10_pii
from ledgerline.llm.quality import op6_quality
from ledgerline.llm.simhash import op1_simhash
from ledgerline.llm.spelling import op11_spelling
from ledgerline.llm.tokencount import op4_tokencount
from ledgerline.llm.tokenfile import op8_tokenfile
from ledgerline.llm.topk import op2_topk
from ledgerline.llm.toxicity import op3_toxicity
from ledgerline.llm.urlrules import op12_urlrules

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_topk": op2_topk,
    "op3_toxicity": op3_toxicity,
    "op4_tokencount": op4_tokencount,
    "op5_licenses": op5_licenses,
    "op6_quality": op6_quality,
    "op7_decontam": op7_decontam,
    "op8_tokenfile": op8_tokenfile,
    "op9_packing": op9_packing,
    "op10_pii": op10_pii,
    "op11_spelling": op11_spelling,
    "op12_urlrules": op12_urlrules,
    "op13_lexical": op13_lexical,
}

# The others need hashes, models, tokenizers or components that SQL does not have; they are
# tested against brute force, the libraries, or held-out labels.
ORACLES: dict[str, Callable[[], str]] = {
    "op2_topk": lambda: topk.ORACLE,
    "op5_licenses": licenses.oracle,
    "op12_urlrules": lambda: urlrules.ORACLE,
    "op13_lexical": lambda: lexical.ORACLE,
}


def oracles() -> dict[str, str]:
    """The SQL by name, put together when it is asked for."""
    return {name: sql() for name, sql in ORACLES.items()}
