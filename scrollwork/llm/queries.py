"""The queries of this subpackage and the SQL that some of them can be held against."""

from __future__ import annotations

from .alignment import op11_alignment
from .bytes_dedup import op3_bytes
from .decontamination import op1_decontamination
from .language import op2_language
from .licenses import op6_licenses
from .neardup import op5_neardup
from .oracles import OP1, OP4, OP8
from .packing import op9_packing
from .privacy import op7_privacy
from .quality import op8_quality
from .scoring import op10_scoring
from .sketches import op12_fingerprints
from .substrings import op4_substrings
from .whitening import op13_whitening

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_language": op2_language,
    "op3_bytes": op3_bytes,
    "op4_substrings": op4_substrings,
    "op5_neardup": op5_neardup,
    "op6_licenses": op6_licenses,
    "op7_privacy": op7_privacy,
    "op8_quality": op8_quality,
    "op9_packing": op9_packing,
    "op10_scoring": op10_scoring,
    "op11_alignment": op11_alignment,
    "op12_fingerprints": op12_fingerprints,
    "op13_whitening": op13_whitening,
}

ORACLES = {"op1_decontamination": OP1, "op4_substrings": OP4, "op8_quality": OP8}
