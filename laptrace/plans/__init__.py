"""End-to-end plans over the driver's tables, each registered with its SQL counterpart."""
