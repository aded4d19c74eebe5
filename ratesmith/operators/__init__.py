"""Rate, calendar, closure and trade operators (DataFrame -> DataFrame)."""
