"""Column expressions (JVM-side, codegen-friendly) used by the operators."""

from tastebud.functions.hashing import order_key, unit_interval, open_unit_interval, block_of  # noqa: F401
from tastebud.functions.numeric import (  # noqa: F401
    r6, safe_ratio, log_discount, ideal_dcg, l2_norm, l2_normalize,
)
from tastebud.functions.text import main_artist, py_strip, clip_text, fixed_width_line  # noqa: F401
