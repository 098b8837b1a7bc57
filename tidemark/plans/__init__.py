"""Layer transforms and the report catalogue: plain DataFrame -> DataFrame."""
