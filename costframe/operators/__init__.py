"""Relational building blocks shared by the report and catalogue plans."""

from costframe.operators.joins import broadcast_dimension, broadcast_if_small, estimated_size_bytes  # noqa: F401
from costframe.operators.pivot import fixed_pivot_sum, row_total  # noqa: F401
from costframe.operators.aggregates import two_level_mean  # noqa: F401
from costframe.operators.materialize import materialize  # noqa: F401
