"""strataload: history-keeping loads, cleansing, mastering and publishing of
warehouse tables as plain Spark DataFrame plans."""
