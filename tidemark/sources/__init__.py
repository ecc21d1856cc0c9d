from .landed import (list_tables, melt_records, read_cpi_payload, read_export_csv,  # noqa: F401
                     read_fx_pages, read_record_pages, read_trade_pages,
                     with_audit_columns)
