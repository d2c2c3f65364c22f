"""Row-level and line/order-grain transformations."""
