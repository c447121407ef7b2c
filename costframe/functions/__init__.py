"""Column expressions. Every function returns a `Column`; nothing here runs Python per row."""

from costframe.functions.time import la_date, la_datetime, days_in_month, invoice_month_of  # noqa: F401
from costframe.functions.costs import (  # noqa: F401
    credits_sum, net_cost, COST_MODES, cost_mode_sums,
)
from costframe.functions.labels import label_value, has_label, lacks_label, no_labels  # noqa: F401
from costframe.functions.categories import (  # noqa: F401
    compute_category, storage_category, sanitize_name, is_residual_compute,
)
