from .order_risk import (ORDER_RISK_COLUMNS, build_order_risk, mapping_losses, order_risk, prepare_order_risk,
                         prepared_order_risk, read_table)

__all__ = ["ORDER_RISK_COLUMNS", "build_order_risk", "mapping_losses", "order_risk", "prepare_order_risk",
           "prepared_order_risk", "read_table"]
