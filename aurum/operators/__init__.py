from aurum.operators.lookup import left_lookup, resolve_ids  # noqa: F401
from aurum.operators.ranking import rank_by, rank_columns, rank_window, recent_n, top_n_per_group  # noqa: F401
from aurum.operators.reshape import union_sides, unpivot_sides  # noqa: F401
