from .releases import ReleaseConflict, Releases  # noqa: F401
from .tables import (append_daily, materialise, read_bronze, read_replaced, register_views,  # noqa: F401
                     replace_table, write_export_csv, write_ordered_csv)
