"""The registered queries of this folder."""

from __future__ import annotations

from .classifier import op12_quality_pu
from .divergence import DIVERGENCE_SQL, op13_divergence
from .editprint import op3_editprint
from .language import op6_language
from .mixing import op7_mixing
from .packing import op2_pack
from .pii import op9_pii
from .quality import op4_quality
from .secrets import op10_secrets
from .simhash import op1_simhash
from .substrings import op5_substrings
from .warc import op8_warc
from .whitening import op11_whitening


def registered() -> dict:
    found = (op1_simhash, op2_pack, op3_editprint, op4_quality, op5_substrings, op6_language,
             op7_mixing, op8_warc, op9_pii, op10_secrets,
             op11_whitening, op12_quality_pu, op13_divergence)
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    return {"op13_divergence": DIVERGENCE_SQL}
