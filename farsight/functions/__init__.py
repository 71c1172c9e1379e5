from farsight.functions.geometry import (  # noqa: F401
    dist2d, dist_nd, cell_index, omega_for,
)
from farsight.functions.draws import (  # noqa: F401
    TWO_POW_60, draw, draw_sql, threshold_for, bucket_of, bucket_sql,
)
from farsight.functions.params import (  # noqa: F401
    reservoir_size, sticky_r, sticky_rate, check_items_params,
)
from farsight.functions.index import dense_index  # noqa: F401
