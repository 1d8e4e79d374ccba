"""DataFrame -> DataFrame operators (lazy; no data through the driver)."""
