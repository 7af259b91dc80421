from estatelens.functions.sqlcompat import (  # noqa: F401
    nz_concat, asc_nulls_last, desc_nulls_first, trunc_toward_zero, substr1,
    before_last, after_last, is_yes, number_text, quoted,
)
from estatelens.functions.findings import FINDING_COLUMNS, finding, empty_findings, not_internal  # noqa: F401
