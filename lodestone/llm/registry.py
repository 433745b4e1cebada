"""Queries of this package by name, and their SQL where SQL can express them."""

from __future__ import annotations

from .decontaminate import SQL as SQL6
from .decontaminate import op6_decontamination
from .divergence import SQL as SQL11
from .divergence import op11_divergence
from .exact_dedup import SQL as SQL10
from .exact_dedup import op10_exact_dedup
from .extraction import op2_extraction
from .language import op4_language
from .licenses import op3_licenses
from .line_dedup import SQL as SQL12
from .line_dedup import op12_line_dedup
from .packing import op9_packing
from .quality import op1_quality
from .secrets import op7_secrets
from .simhash import op8_simhash
from .toxicity import op5_toxicity

QUERIES = {
    f.__name__: f
    for f in (
        op1_quality, op2_extraction, op3_licenses, op4_language, op5_toxicity, op6_decontamination, op7_secrets,
        op8_simhash, op9_packing, op10_exact_dedup, op11_divergence, op12_line_dedup,
    )
}
ORACLES = {"op6_decontamination": SQL6, "op10_exact_dedup": SQL10, "op11_divergence": SQL11, "op12_line_dedup": SQL12}
